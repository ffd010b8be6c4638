"""The optional site filter every dashboard query takes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def at_site(df: DataFrame, site_id: str | None) -> DataFrame:
    """Rows of one site, or all rows (also those without a site) for ``None``."""
    return df if site_id is None else df.where(F.col("site_id") == F.lit(site_id))


def facts_at(tables: Tables, name: str, site_id: str | None) -> DataFrame:
    """A fact at one site or, without the columns of the tower, everywhere.

    Without a site nothing of the tower dimension is needed, so it isn't joined where the fact
    is planned; see ``StarSchema.without_tower``.  A plain mapping gives the table it has.
    """
    if site_id is None and hasattr(tables, "without_tower"):
        return tables.without_tower(name)
    return at_site(tables[name], site_id)


def known_towers(tables: Tables, site_id: str | None, *columns: str) -> DataFrame:
    return at_site(tables["dim_tower"], site_id).select("tower_id", *columns)


def sum_by_tower(
    incidents: DataFrame, tables: Tables, site_id: str | None, measures: Mapping[str, Column]
) -> DataFrame:
    """One row of totals over the incidents of known towers.

    Counting per tower first means that one row per tower, not one per incident, meets
    the dimension: the join stays small however many incidents a single tower has.
    """
    per_tower = incidents.groupBy("tower_id").agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )
    known = per_tower.join(known_towers(tables, site_id), "tower_id")
    return known.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in measures])
