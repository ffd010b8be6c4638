"""Response percentiles from stored sketches: any range of days and sites without reading alerts.

Exact percentiles need the alerts of the whole range each time.  A quantile sketch of a few kilobytes
per day and site is written once, when the day is complete; sketches of any days and sites merge into
one that answers as if it had seen all their alerts.  An answer is a value that was seen, whose rank
is off by at most ``RANK_ERROR`` of the rows (with 99 % confidence); a range with fewer values than
``K`` is exact.  Sketches draw at random which values they keep, so answers of two builds may differ
within that bound.

Sketches are merged in tasks before their shuffle, and again after it, so that a range of years is no
more work for the last task than one of days.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpost.operators.detection import PERCENTILES, STAGES
from watchpost.operators.scope import at_site

Tables = Mapping[str, DataFrame]

K = 1000  # of the sketch; its size in kilobytes is about 1.5 times log2 of rows / K, plus 16
RANK_ERROR = 0.005  # of K = 1000, for either side


def response_sketches(tables: Tables, *, k: int = K) -> DataFrame:
    """A row per site and day: alerts, and for each stage the sketch of its seconds.

    NULLs are no values, and a stage without values on a day has a null sketch; NaN, which has no
    rank, is left out.  Alerts of an unknown tower have the null site, those without a time the
    null day.
    """
    alerts = tables["fct_alert_pipeline_latency"]
    sketches = [
        F.kll_sketch_agg_double(F.when(~F.isnan(column), F.col(column)), k).alias(column) for column in STAGES.values()
    ]
    counts = [F.count_if(F.col(c).isNotNull() & ~F.isnan(c)).alias(f"{c}_n") for c in STAGES.values()]
    return alerts.groupBy("site_id", "detection_date").agg(F.count(F.lit(1)).alias("alerts"), *counts, *sketches)


def percentiles_between(
    sketches: DataFrame, first: date | None = None, last: date | None = None, *, site_id: str | None = None
) -> DataFrame:
    """``stage``, ``n`` and P50/P95/P99 of the alerts from ``first`` to ``last``, both included.

    Always one row per stage; without alerts in the range its percentiles are null.  Without limits
    all days count, also the null day.
    """
    chosen = at_site(sketches, site_id)
    if first is not None:
        chosen = chosen.where(F.col("detection_date") >= F.lit(first))
    if last is not None:
        chosen = chosen.where(F.col("detection_date") <= F.lit(last))
    per_stage = [
        F.struct(F.lit(label).alias("stage"), F.col(f"{c}_n").alias("n"), F.when(F.col(f"{c}_n") > 0, F.col(c)).alias("sketch"))
        for label, c in STAGES.items()
    ]
    listed = chosen.select(F.inline(F.array(*per_stage)))
    merged = listed.groupBy("stage").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double(F.col("sketch"), K).alias("sketch")
    )
    ranks = F.array(*map(F.lit, PERCENTILES.values()))
    found = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(F.col("sketch"), ranks))
    answers = merged.select("stage", "n", found.alias("found"))
    stages = sketches.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, STAGES))).alias("stage"))
    return stages.join(answers, "stage", "left").select(
        "stage",
        F.coalesce("n", F.lit(0)).alias("n"),
        *[F.col("found")[i].alias(name) for i, name in enumerate(PERCENTILES)],
    )


def rank_errors(alerts: DataFrame, answers: DataFrame) -> DataFrame:
    """How far the rank of each answer is from the one asked for, as a share of the rows: 0 if the
    answer's values, which may be many, include that rank.  For tests and audits: reads the alerts.

    Alerts are counted against a row of answers for each stage, which is broadcast.
    """
    per_stage = [F.struct(F.lit(label).alias("stage"), F.col(c).alias("value")) for label, c in STAGES.items()]
    values = alerts.select(F.inline(F.array(*per_stage))).where("value is not null and not isnan(value)")
    both = values.join(F.broadcast(answers), "stage")
    counts = both.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("value") < F.col(p)).alias(f"{p}_below") for p in PERCENTILES],
        *[F.count_if(F.col("value") <= F.col(p)).alias(f"{p}_upto") for p in PERCENTILES],
    )
    errors = [
        F.greatest(F.col(f"{p}_below") / F.col("n") - share, share - F.col(f"{p}_upto") / F.col("n"), F.lit(0.0)).alias(p)
        for p, share in ((p, F.lit(float(share))) for p, share in PERCENTILES.items())
    ]
    return counts.select("stage", "n", *errors)
