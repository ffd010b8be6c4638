"""Daily fleet health kept up to date by batches instead of full rebuilds.

Means can't be merged, but sums and counts can: the state keeps, per tower and day, sums, counts and
the latest heartbeat, as exact decimals, so any order and any split of the rows into batches gives
the table of a full rebuild.  A batch, late rows included, touches the days it has rows for; only
their folders are read, merged and replaced, in the state and in the fact.  All other folders keep
their files.

A batch has a name and counts once, however often it is tried: what it will leave behind is written
aside first, and then put in place; the log says how far it came.  A try that was lost before that
point starts again, one lost after it puts the same files in place again.  While a batch is between
the two, no other one may begin.  There is one writer at a time.

Days travel to the driver as a list, one date for each day a batch touches; the rest stays in Spark.
The tower dimension is joined as it is when a day is written: after towers have changed, call
``rewrite`` for the days wanted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from watchpost.functions.numeric import round_half_away
from watchpost.plans.marts import MEASURED, health_at_towers
from watchpost.sources.warehouse import write_table

DAY = "health_date"
KEYS = ("tower_id", DAY)
FACT = "fct_fleet_health_daily"


def telemetry_state(telemetry: DataFrame) -> DataFrame:
    """Per tower and day, what merges: for each measure the sum of its six-digit decimals and how many
    values had one, the count of values, and their plain sum for those that have no such decimal."""
    parts = []
    for name in MEASURED:
        decimal = F.col(name).try_cast("decimal(18,6)")
        parts += [
            F.coalesce(F.sum(decimal), F.lit(0)).cast("decimal(38,6)").alias(f"{name}_sum"),
            F.count(decimal).alias(f"{name}_exact"),
            F.count(name).alias(f"{name}_n"),
            F.coalesce(F.sum(F.when(decimal.isNull(), F.col(name))), F.lit(0.0)).alias(f"{name}_other"),
        ]
    dated = telemetry.withColumn(DAY, F.to_date("ts"))
    return dated.groupBy(*KEYS).agg(*parts, F.max("ts").alias("last_heartbeat_ts"))


def incident_state(incidents: DataFrame) -> DataFrame:
    """Per tower and day of opening: incidents, and critical ones."""
    dated = incidents.withColumn(DAY, F.to_date("opened_at"))
    return dated.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("incidents_opened"),
        F.count_if(F.col("severity").isin("P1", "P2")).alias("critical_incidents"),
    )


STATES = {"telemetry": telemetry_state, "incidents": incident_state}


def merged(states: Sequence[DataFrame]) -> DataFrame:
    """States of the same kind added up: times by the latest, numbers by their sum."""
    whole = reduce(DataFrame.unionByName, states)
    parts = []
    for field in whole.schema:
        if field.name in KEYS:
            continue
        combine = F.max if field.name.endswith("_ts") else F.sum
        parts.append(combine(field.name).cast(field.dataType).alias(field.name))
    return whole.groupBy(*KEYS).agg(*parts)


def daily_health(telemetry: DataFrame, incidents: DataFrame) -> DataFrame:
    """Daily health from the two states; incidents on a day without telemetry do not appear."""

    def mean(name: str) -> Column:
        """As ``exact_mean`` of all values: by decimals where each value has one."""
        number = F.nullif(F.col(f"{name}_n"), F.lit(0))
        exact = F.col(f"{name}_sum").cast("double")
        whole = F.when(F.col(f"{name}_exact") == F.col(f"{name}_n"), exact).otherwise(exact + F.col(f"{name}_other"))
        return F.try_divide(whole, number).alias(name)

    means = telemetry.select(*KEYS, *[mean(name) for name in MEASURED], "last_heartbeat_ts")
    rounded = means.select(
        *KEYS,
        round_half_away(F.col("cpu_pct"), 2).alias("avg_cpu_pct"),
        round_half_away(F.col("mem_pct"), 2).alias("avg_mem_pct"),
        round_half_away(F.col("sensor_health_score"), 2).alias("avg_sensor_health"),
        round_half_away(F.col("comms_uptime_min") / 60.0 * 100, 2).alias("comms_uptime_pct"),
        round_half_away(F.col("power_watts"), 2).alias("avg_power_watts"),
        round_half_away(F.col("ambient_temp_c"), 2).alias("avg_ambient_temp_c"),
        "last_heartbeat_ts",
    )
    return rounded.join(incidents, list(KEYS), "left").fillna(0, ["incidents_opened", "critical_incidents"])


class HealthMart:
    """``fct_fleet_health_daily`` below ``root``, with its states and the log of batches.

    ``tables`` has the tower dimension.  Readings without a time belong to the null day, as in a full
    rebuild; an incident without one belongs to no day of telemetry.
    """

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, DataFrame]):
        self.spark, self.root, self.tables = spark, root, tables

    # Empty tables of the right columns.
    def create(self) -> HealthMart:
        for kind in STATES:
            write_table(self._nothing(self._schema(kind)), self._path(kind), partition_by=DAY)
        write_table(self._nothing(self._fact_schema()), f"{self.root}/{FACT}", partition_by=DAY)
        self._nothing("batch string, step string").write.mode("overwrite").parquet(f"{self.root}/batches")
        return self

    def table(self) -> DataFrame:
        schema = self._fact_schema()
        return self.spark.read.schema(schema).parquet(f"{self.root}/{FACT}").select(*schema.fieldNames())

    def apply(self, batch: str, *, telemetry: DataFrame | None = None, incidents: DataFrame | None = None) -> list[date]:
        """Adds staged rows; gives the days it has rewritten, none if the batch was there already."""
        steps = self._steps()
        if "done" in steps.get(batch, ()):
            return []
        open_ = [name for name, own in steps.items() if "written" in own and "done" not in own]
        if open_ and open_ != [batch]:
            raise RuntimeError(f"finish batch {open_[0]!r} first: it is written, but not yet in place")
        given = {k: rows for k, rows in (("telemetry", telemetry), ("incidents", incidents)) if rows is not None}
        if not open_:
            for kind, rows in given.items():
                own = STATES[kind](rows)
                days = _days(own)
                states = [own, _of_days(self._state(kind), days)]
                write_table(merged(states), self._aside(batch, kind), partition_by=DAY)
            self._note(batch, "written")
        touched: set[date | None] = set()
        for kind in given:
            aside = self._read(self._aside(batch, kind), kind)
            touched.update(_days(aside))
            write_table(aside, self._path(kind), partition_by=DAY, only_given=True)
        days = sorted(touched, key=lambda d: (d is not None, d))
        self.rewrite(days)
        self._note(batch, "done")
        return days

    def rewrite(self, days: Sequence[date | None]) -> None:
        """Builds the fact's folders of these days from the states."""
        if not days:
            return
        daily = daily_health(*(_of_days(self._state(kind), days) for kind in STATES))
        write_table(health_at_towers(daily, self.tables), f"{self.root}/{FACT}", partition_by=DAY, only_given=True)

    def _path(self, kind: str) -> str:
        return f"{self.root}/{kind}_state"

    def _aside(self, batch: str, kind: str) -> str:
        return f"{self.root}/aside/{batch}/{kind}"

    def _schema(self, kind: str) -> StructType:
        columns = ", ".join(f"{name} double" for name in MEASURED)
        empty = {
            "telemetry": f"tower_id string, ts timestamp_ntz, {columns}",
            "incidents": "tower_id string, opened_at timestamp_ntz, severity string",
        }
        return STATES[kind](self._nothing(empty[kind])).schema

    def _fact_schema(self) -> StructType:
        daily = daily_health(*(self._nothing(self._schema(kind)) for kind in STATES))
        return health_at_towers(daily, self.tables).schema

    def _nothing(self, schema: StructType | str) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _read(self, path: str, kind: str) -> DataFrame:
        schema = self._schema(kind)
        return self.spark.read.schema(schema).parquet(path).select(*schema.fieldNames())

    def _state(self, kind: str) -> DataFrame:
        return self._read(self._path(kind), kind)

    def _steps(self) -> dict[str, set[str]]:
        """How far each batch has come; two rows for each batch."""
        log = self.spark.read.schema("batch string, step string").parquet(f"{self.root}/batches")
        found: dict[str, set[str]] = {}
        for row in log.collect():
            found.setdefault(row.batch, set()).add(row.step)
        return found

    def _note(self, batch: str, step: str) -> None:
        row = self.spark.createDataFrame([(batch, step)], "batch string, step string")
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/batches")


def _days(state: DataFrame) -> list[date | None]:
    return [row[0] for row in state.select(DAY).distinct().collect()]


def _of_days(state: DataFrame, days: Sequence[date | None]) -> DataFrame:
    """Rows of these days; others' folders aren't listed or read."""
    known = [d for d in days if d is not None]
    wanted = F.col(DAY).isin(known) if known else F.lit(False)
    return state.where(wanted | F.col(DAY).isNull() if len(known) < len(days) else wanted)
