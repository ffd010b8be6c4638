"""Joins and running views along time: state at a moment, missions at a moment, outages, backlog.

None of them gathers a whole tower in one task: rows meet by tower and a span of time, and what
earlier spans know comes as one row for each of them (``watchpost.functions.cells``).
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchpost.functions.cells import last_before
from watchpost.functions.clock import AsOf, seconds_elapsed
from watchpost.functions.numeric import round_half_away
from watchpost.operators.scope import at_site, known_towers
from watchpost.plans.marts import MEASURED

Tables = Mapping[str, DataFrame]

MISSION_SPAN_DAYS = 7
SILENCE_HOURS = 6  # fixed value: telemetry is fresh up to this age


def _at_towers(facts: DataFrame, tables: Tables, site_id: str | None) -> DataFrame:
    """Rows of one site's towers; without a site all rows, also those of unknown towers."""
    return facts if site_id is None else facts.join(known_towers(tables, site_id), "tower_id", "left_semi")


def tower_state_at_detection(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """Each detection with its tower's last telemetry at or before that moment, and its age.

    Of readings at the same time the one with the largest values counts, compared in the order of
    columns.  Without an earlier reading, a tower or a time, the state is null.  Both tables are
    shuffled once, by tower and day; the last reading of earlier days comes from a row per day.
    """
    detections = _at_towers(tables["stg_detections"], tables, site_id).select(
        "detection_id", "tower_id", F.col("detected_at").alias("__at"), F.lit(1).alias("__asks")
    )
    reading = F.struct("ts", *MEASURED)
    telemetry = tables["stg_telemetry"].where("ts is not null and tower_id is not null").select(
        "tower_id", F.col("ts").alias("__at"), F.lit(0).alias("__asks"), reading.alias("__reading")
    )
    both = detections.unionByName(telemetry, allowMissingColumns=True).withColumn("__day", F.to_date("__at"))
    # A detection comes after all readings of its moment.
    found = last_before(
        both, ["tower_id"], "__day", ["__at", "__asks", "__reading", "detection_id"], {"__state": F.col("__reading")}
    ).where("__asks = 1")
    known = F.col("__at").isNotNull()
    return found.select(
        "detection_id",
        "tower_id",
        F.col("__at").alias("detected_at"),
        F.when(known, F.col("__state.ts")).alias("reading_ts"),
        *[F.when(known, F.col(f"__state.{c}")).alias(c) for c in MEASURED],
        F.when(known, F.floor(seconds_elapsed(F.col("__state.ts"), F.col("__at")))).alias("reading_age_s"),
    )


def missions_at_detection(
    tables: Tables, as_of: AsOf, *, span_days: int = MISSION_SPAN_DAYS, site_id: str | None = None
) -> DataFrame:
    """Each detection with the missions its tower ran at that moment: how many, and the latest begun.

    A mission runs from ``start_ts``, included, to ``end_ts``, left out, or to the moment asked for
    while ``end_ts`` is null, that moment included.  Of missions begun at the same time the one with
    the higher id counts.  A detection without tower or time, or without a mission, has 0; rows of one
    ``detection_id`` are counted together.

    An overlap join by tower and span of days.  Only in the spans in which a mission begins or ends is
    it compared with each detection.  In all between, it runs at any moment, so those spans have a row
    for each tower with the number of missions and the latest begun, combined in the tasks; a mission
    that is still running at the last detection is counted in its first whole span alone, and running
    sums over a tower's spans carry it on.
    """
    detections = _at_towers(tables["stg_detections"], tables, site_id).select("detection_id", "tower_id", "detected_at")
    span = lambda at: F.floor(F.datediff(at, F.lit(date(1970, 1, 1))) / span_days)
    # Spans in which nothing was detected get no row: a long mission isn't spread over all its life.
    seen = detections.agg(F.min("detected_at").alias("from"), F.max("detected_at").alias("to"))
    earliest, latest = (span(seen.select(name).scalar()) for name in ("from", "to"))
    until = F.coalesce("end_ts", as_of.now())
    last_seen = seen.select("to").scalar()
    lasting = F.when(F.col("end_ts").isNull(), last_seen <= as_of.now()).otherwise(F.col("end_ts") > last_seen)
    missions = (
        tables["stg_deployments"]
        .select(
            F.col("tower_id").alias("__tower"),
            "start_ts",
            "end_ts",
            until.alias("__until"),
            F.struct("start_ts", "deployment_id", "mission_name").alias("__mission"),
            F.coalesce(lasting, F.lit(False)).alias("__lasting"),
            span(F.col("start_ts")).alias("__first"),
            span(until).alias("__last"),
        )
        .where(F.col("__tower").isNotNull() & (F.col("start_ts") <= F.col("__until")))
    )
    asked = detections.withColumn("__asked", span(F.col("detected_at")))

    at = F.col("detected_at")
    runs = (F.col("start_ts") <= at) & F.when(F.col("end_ts").isNull(), at <= F.col("__until")).otherwise(at < F.col("end_ts"))
    ends = F.when(F.col("__lasting"), F.array("__first")).otherwise(F.array_distinct(F.array("__first", "__last")))
    partly = missions.withColumn("__span", F.explode(ends)).where(F.col("__span").between(earliest, latest))
    pairs = asked.join(partly, (F.col("tower_id") == F.col("__tower")) & (F.col("__asked") == F.col("__span")) & runs)

    begin = F.greatest(F.col("__first") + 1, earliest)
    end = F.when(F.col("__lasting"), begin).otherwise(F.least(F.col("__last") - 1, latest))
    spans = F.when((begin <= end) & (begin <= latest), F.sequence(begin, end))
    wholly = missions.withColumn("__span", F.explode(spans)).select("__tower", "__span", "__lasting", "__mission")
    cells = asked.where("tower_id is not null and __asked is not null").select(
        F.col("tower_id").alias("__tower"), F.col("__asked").alias("__span")
    )
    only = lambda kind, value: F.when(F.col("__lasting") == kind, value)
    per_cell = (
        wholly.unionByName(cells, allowMissingColumns=True)
        .groupBy("__tower", "__span")
        .agg(
            F.max(F.col("__lasting").isNull()).alias("__detected"),
            F.count(only(False, F.lit(1))).alias("__between"),
            F.max(only(False, F.col("__mission"))).alias("__latest_between"),
            F.count(only(True, F.lit(1))).alias("__began"),
            F.max(only(True, F.col("__mission"))).alias("__latest_began"),
        )
    )
    so_far = Window.partitionBy("__tower").orderBy("__span").rowsBetween(Window.unboundedPreceding, 0)  # a row per span
    running = per_cell.select(
        "__tower",
        "__span",
        "__detected",
        (F.col("__between") + F.sum("__began").over(so_far)).alias("__number"),
        F.greatest("__latest_between", F.max("__latest_began").over(so_far)).alias("__mission"),
    ).where("__detected and __number > 0")
    whole = asked.join(running, (F.col("tower_id") == F.col("__tower")) & (F.col("__asked") == F.col("__span")))

    counted = whole.select(F.col("detection_id").alias("__of"), "__number", "__mission").unionByName(
        pairs.select(F.col("detection_id").alias("__of"), F.lit(1).cast("long").alias("__number"), "__mission")
    )
    found = counted.groupBy("__of").agg(F.sum("__number").alias("missions"), F.max("__mission").alias("__latest"))
    return detections.join(found, F.col("detection_id") == F.col("__of"), "left").select(
        "detection_id",
        "tower_id",
        "detected_at",
        F.coalesce("missions", F.lit(0)).alias("missions"),
        F.col("__latest.deployment_id").alias("deployment_id"),
        F.col("__latest.mission_name").alias("mission_name"),
        F.col("__latest.start_ts").alias("mission_start_ts"),
    )


def _hours(start: Column, end: Column) -> Column:
    """Elapsed hours, two decimals."""
    return F.rint(seconds_elapsed(start, end) / 36) / 100


def telemetry_outages(
    tables: Tables, as_of: AsOf, *, silence_hours: int = SILENCE_HOURS, site_id: str | None = None
) -> DataFrame:
    """Silences of a tower longer than ``silence_hours``: the reading before, the next one, hours.

    A tower that has been silent for so long up to the moment asked for has an outage without an end,
    whose hours run to that moment; readings after it are left out.  Towers that never reported
    have none.  The reading before comes from the same day or from a row per day: the lag needs no
    window over a whole tower.
    """
    readings = _readings(tables, as_of, site_id)
    limit = F.expr(f"interval {silence_hours} hours")
    before = last_before(readings, ["tower_id"], "__day", ["ts"], {"__before": F.col("ts")})
    silences = before.where(F.col("ts") - F.col("__before") > limit).select(
        "tower_id", F.col("__before").alias("silent_from"), F.col("ts").alias("silent_to")
    )
    latest = readings.groupBy("tower_id").agg(F.max("ts").alias("silent_from"))
    lasting = latest.where(as_of.now() - F.col("silent_from") > limit).withColumn(
        "silent_to", F.lit(None).cast("timestamp_ntz")
    )
    both = silences.unionByName(lasting)
    return both.withColumn("hours", _hours(F.col("silent_from"), F.coalesce("silent_to", as_of.now())))


def telemetry_sessions(
    tables: Tables, as_of: AsOf, *, silence_hours: int = SILENCE_HOURS, site_id: str | None = None
) -> DataFrame:
    """Stretches of a tower without a silence longer than ``silence_hours``: number, begin, end, readings.

    Inside a day, silences are counted in a window by tower and day.  Whether a day's first reading
    ends a silence, and how many the days before had, comes from a row per day.  Readings are added up
    per session in the tasks before they meet.
    """
    readings = _readings(tables, as_of, site_id)
    limit = F.expr(f"interval {silence_hours} hours")
    inside = Window.partitionBy("tower_id", "__day").orderBy("ts")
    opens = F.coalesce(F.col("ts") - F.lag("ts").over(inside) > limit, F.lit(False)).cast("long")
    opened = readings.withColumn("__opens", opens)
    running = opened.withColumn("__local", F.sum("__opens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))

    days = Window.partitionBy("__tower").orderBy("__on")
    per_day = opened.groupBy(F.col("tower_id").alias("__tower"), F.col("__day").alias("__on")).agg(
        F.min("ts").alias("__first"), F.max("ts").alias("__last"), F.sum("__opens").alias("__inside")
    )
    silent = F.col("__first") - F.lag("__last").over(days) > limit
    begun = per_day.withColumn("__begins", F.coalesce(silent, F.lit(True)).cast("long"))
    earlier = F.sum(F.col("__begins") + F.col("__inside")).over(days.rowsBetween(Window.unboundedPreceding, -1))
    numbered = begun.select("__tower", "__on", (F.coalesce(earlier, F.lit(0)) + F.col("__begins")).alias("__number"))
    rows = running.join(numbered, (F.col("tower_id") == F.col("__tower")) & (F.col("__day") == F.col("__on")))
    return rows.groupBy("tower_id", (F.col("__number") + F.col("__local")).alias("session")).agg(
        F.min("ts").alias("begin_ts"), F.max("ts").alias("end_ts"), F.sum("__readings").alias("readings")
    )


def _readings(tables: Tables, as_of: AsOf, site_id: str | None) -> DataFrame:
    """A row per tower and time up to the moment asked for, and how many readings it had."""
    known = tables["stg_telemetry"].where("tower_id is not null").where(F.col("ts") <= as_of.now())
    times = _at_towers(known, tables, site_id).groupBy("tower_id", "ts").agg(F.count(F.lit(1)).alias("__readings"))
    return times.withColumn("__day", F.to_date("ts"))


def backlog_by_day(
    tables: Tables, as_of: AsOf, *, days: int = 90, site_id: str | None = None
) -> DataFrame:
    """Incidents of known towers open on each of the last days, at the time of day of ``as_of``.

    A sweep: an incident adds 1 on the first day that sees it open and takes 1 off on the first that
    sees it closed, and a running sum over days gives the backlog, whatever the number of days.
    Each number is what ``header.backlog_7d_ago`` gives for a moment seven days later.  Incidents
    closed before they were opened were never open.  The sum runs over one row for each day.
    """
    first = as_of.moment.date() - timedelta(days=days)
    time_of_day = timedelta(
        hours=as_of.moment.hour, minutes=as_of.moment.minute, seconds=as_of.moment.second,
        microseconds=as_of.moment.microsecond,
    )

    def day_seen(moment: Column) -> Column:
        """Number, from ``first``, of the first day whose cut-off is at or after the moment."""
        shifted = moment - F.lit(time_of_day)
        later = (shifted > F.to_date(shifted).cast("timestamp_ntz")).cast("int")
        return F.datediff(shifted, F.lit(first)) + later

    events = tables["stg_incidents"].where("opened_at is not null and (closed_at is null or closed_at > opened_at)")
    # Everything before the first day counts on it; what comes after the last one is left out.
    opened = F.struct(F.greatest(day_seen(F.col("opened_at")), F.lit(0)).alias("day"), F.lit(1).alias("change"))
    closed = F.struct(F.greatest(day_seen(F.col("closed_at")), F.lit(0)).alias("day"), F.lit(-1).alias("change"))
    both = F.when(F.col("closed_at").isNull(), F.array(opened)).otherwise(F.array(opened, closed))
    per_tower = (
        events.withColumn("__event", F.explode(both))
        .where(F.col("__event.day") <= days)
        .groupBy("tower_id", F.col("__event.day").alias("__day"))
        .agg(F.sum("__event.change").alias("change"))
    )
    per_day = per_tower.join(known_towers(tables, site_id), "tower_id").groupBy("__day").agg(F.sum("change").alias("change"))
    calendar = tables["stg_incidents"].sparkSession.range(days + 1).select(F.col("id").cast("int").alias("__on"))
    dense = calendar.join(per_day, F.col("__on") == F.col("__day"), "left")
    so_far = Window.orderBy("__on").rowsBetween(Window.unboundedPreceding, 0)  # a row per day
    return dense.select(
        F.date_add(F.lit(first), F.col("__on")).alias("day"),
        F.coalesce(F.sum("change").over(so_far), F.lit(0)).alias("open_incidents"),
    )


def detection_kpis_by_level(tables: Tables, as_of: AsOf) -> DataFrame:
    """Detection metrics of the fleet, each region and each site in one pass.

    Detections are added up per site once; the levels are a roll-up of those rows, one per site.
    ``level`` is ``fleet``, ``region`` or ``site``; a detection of an unknown tower has no site, and
    is in the fleet's row and in the rows of the null region and site.
    """
    day, week, before = F.col("detection_date"), as_of.date_days_ago(7), as_of.date_days_ago(14)
    score = F.col("confidence_score").try_cast("decimal(18,6)")
    flags = ("auto_resolved", "escalated_to_operator", "false_positive")
    sums = {
        "total_dets": F.count(F.lit(1)),
        "dets_7d": F.count_if(day >= week),
        "dets_prev_7d": F.count_if((day >= before) & (day < week)),
        **{f"__{flag}": F.count_if(flag) for flag in flags},
        **{f"__n_{flag}": F.count(flag) for flag in flags},
        "__score": F.sum(score),
        "__scored": F.count("confidence_score"),
        "__other": F.count("confidence_score") - F.count(score),
        "__plain": F.sum("confidence_score"),
    }
    per_site = tables["fct_detection_events"].groupBy("region", "site_id").agg(*[v.alias(k) for k, v in sums.items()])
    rolled = per_site.rollup("region", "site_id").agg(
        F.grouping_id().alias("__level"), *[F.sum(k).alias(k) for k in sums]
    )
    level = F.element_at(F.array(F.lit("site"), F.lit("region"), F.lit("fleet")), F.least(F.col("__level"), F.lit(2)).cast("int") + 1)
    mean = F.when(F.col("__other") == 0, F.col("__score").cast("double")).otherwise(F.col("__plain"))
    share = lambda part, whole: F.try_divide(part, F.col(whole)) * 100
    shares = {
        "auto_resolve_pct": share(F.col("__auto_resolved"), "__n_auto_resolved"),
        "escalation_pct": share(F.col("__escalated_to_operator"), "__n_escalated_to_operator"),
        "fp_pct": share(F.col("__false_positive"), "__n_false_positive"),
        "avg_confidence": share(mean, "__scored"),
    }
    return (
        rolled.where("total_dets is not null")
        .withColumns(shares)
        .select(
            level.alias("level"),
            "region",
            "site_id",
            "total_dets",
            "dets_7d",
            "dets_prev_7d",
            *[round_half_away(F.col(name), 1).alias(name) for name in shares],
            (F.col("dets_7d") - F.col("dets_prev_7d")).alias("dets_delta"),
        )
    )
