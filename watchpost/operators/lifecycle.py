"""How long components last, and which of them should be replaced out of which stock.

Remaining life is estimated with working units, too: a unit that still works at age t says that the
life is longer than t, and leaving it out, as a mean over failed units does, makes life look shorter
than it is.  The estimate is the product-limit one: at each age at which units failed, survival is
multiplied by the share that did not fail of all units that had reached that age.

Ages are hours as counted by the component fact.  They are aggregated first, so that a curve has
a row for each type and age, and running sums over those rows are taken in cells of ages: no type
is ordered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpost.functions.cells import last_before, running_sums
from watchpost.functions.clock import AsOf
from watchpost.functions.numeric import exact_mean, round_half_away
from watchpost.operators.scope import facts_at

Tables = Mapping[str, DataFrame]

CELL_HOURS = 1000  # ages whose rows are ordered together
DIGITS = 9  # of survival; makes results independent of the order of products
CURVE_CELLS = 256  # cells of survival in which half-lives are looked up


def component_survival(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """Per component type and age in hours: units at risk, failures, units that left working, survival.

    ``at_risk`` counts units whose age is at least this one.  A unit without a type belongs to the
    null type; one without an age is left out; an age before installation counts as it is.  Units
    that left at an age at which others failed were at risk then.  A type whose units all work has
    survival 1 at every age.
    """
    return _curve(tables, site_id).drop("__before", "__cell")


def _curve(tables: Tables, site_id: str | None) -> DataFrame:
    """The curve with survival just ``__before`` each age, and the age's ``__cell``."""
    units = facts_at(tables, "fct_component_reliability", site_id).where("observed_hours is not null")
    failed = F.coalesce(F.col("is_failed"), F.lit(False))
    ages = (
        units.groupBy("component_type", F.col("observed_hours").alias("age_hours"))
        .agg(F.count_if(failed).alias("failures"), F.count_if(~failed).alias("left_working"))
        .withColumn("__cell", F.floor(F.col("age_hours") / CELL_HOURS))
    )
    left = running_sums(
        ages,
        ["component_type"],
        "__cell",
        ["age_hours"],
        {"__left": F.col("failures") + F.col("left_working")},
        totals={"__left": "__units"},
    )
    at_risk = left.withColumn("at_risk", F.col("__units") - F.col("__left"))
    # All that were at risk failed: survival is 0, and no later age has units.
    ended = F.col("failures") == F.col("at_risk")
    steps = at_risk.withColumn("__step", F.when(~ended, F.log1p(-F.col("failures") / F.col("at_risk"))))
    product = running_sums(steps, ["component_type"], "__cell", ["age_hours"], {"__product": F.col("__step")})
    survival = F.when(ended, 0.0).otherwise(F.round(F.exp(F.col("__product") + F.col("__step")), DIGITS))
    return product.select(
        "component_type",
        "age_hours",
        "at_risk",
        "failures",
        "left_working",
        survival.alias("survival"),
        F.round(F.exp("__product"), DIGITS).alias("__before"),
        "__cell",
    )


def remaining_life(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """``component_survival`` with what a unit of that age has still before it.

    ``median_remaining_hours``: until the first age at which survival is half of now's or less; null
    where the curve doesn't come down so far.  ``expected_remaining_hours``: the area under the
    curve from this age to the last one seen, divided by survival: a mean life restricted to what
    has been observed.  Both are null where survival is 0.
    """
    age, survival = F.col("age_hours"), F.col("survival")
    # By parts, the area up to an age is age x survival before it + the sum of earlier ages x drops;
    # up to the last age, all ages x drops + that age x its survival.
    last = F.col("at_risk") == F.col("failures") + F.col("left_working")
    areas = running_sums(
        _curve(tables, site_id),
        ["component_type"],
        "__cell",
        ["age_hours"],
        {
            "__fallen": age * (F.col("__before") - survival),
            "__tail": F.when(last, age * survival),
        },
        totals={"__fallen": "__all_fallen", "__tail": "__end"},
    )
    ahead = F.col("__all_fallen") + F.col("__end") - F.col("__fallen") - age * F.col("__before")
    expected = areas.withColumn("__expected", F.when(survival > 0, ahead / survival))

    # The first age with survival of half or less is, in rising survival, the last one before the
    # half.  Each row is a point of the curve and asks for its half, a little more against rounding.
    roles = F.array(
        F.struct(survival.alias("at"), F.lit(0).alias("asks")),
        F.struct((survival / 2 + 10.0**-DIGITS / 2).alias("at"), F.lit(1).alias("asks")),
    )
    both = expected.withColumn("__role", F.explode(roles)).withColumns(
        {"__at": F.col("__role.at"), "__asks": F.col("__role.asks"), "__fall": -age}
    )
    both = both.withColumn("__curve_cell", F.floor(F.col("__at") * CURVE_CELLS))
    point = F.when((F.col("__asks") == 0) & (F.col("failures") > 0), age)
    # Of points with equal survival after rounding, the earliest age comes last.
    found = last_before(
        both, ["component_type"], "__curve_cell", ["__at", "__asks", "__fall"], {"__half": point}
    ).where("__asks = 1")
    return found.select(
        "component_type",
        "age_hours",
        "at_risk",
        "failures",
        "left_working",
        "survival",
        F.when(survival > 0, F.col("__half") - age).alias("median_remaining_hours"),
        round_half_away(F.col("__expected"), 1).alias("expected_remaining_hours"),
    )


HORIZON_DAYS = 90


def replacement_queue(
    tables: Tables, as_of: AsOf, *, horizon_days: int = HORIZON_DAYS, site_id: str | None = None
) -> DataFrame:
    """Working units due within the horizon, in order of their expected failure, and their stock.

    A unit is expected to fail when its target life, times the mean ratio of observed to target life
    of its type's failed units (1 where none has failed), is over.  Units of a part are served by
    expected failure, then id: first from ``available``, then from ``in_transit``, which arrives
    ``lead_time_days`` after the moment asked for.  ``supply``: ``covered`` from stock or from parts
    that arrive in time, ``late`` if they arrive after the expected failure, else ``short``.  A part
    without stock rows is short; stock below zero serves nobody; unknown transit or lead time is no
    supply.  With a site, the stock serves that site's units alone.

    A part's place in the queue is a running count in cells of a day, and stock meets the queue by
    part and day: a part that holds a third of all units is spread over its days.  The ratios, a row
    for each type, are broadcast.
    """
    units = facts_at(tables, "fct_component_reliability", site_id)
    # A row for each type.
    ratios = (
        units.where("is_failed")
        .groupBy(F.col("component_type").alias("__type"))
        .agg(exact_mean(F.col("actual_vs_target_ratio")).alias("__mean"))
        .select("__type", round_half_away(F.col("__mean"), 3).alias("life_ratio"))
    )
    working = units.where(~F.coalesce(F.col("is_failed"), F.lit(False)) & F.col("installed_at").isNotNull())
    # Units dealt by type would be a handful of tasks, however many units there are.
    typed = working.join(F.broadcast(ratios), F.col("component_type").eqNullSafe(F.col("__type")), "left")
    hours = F.floor(F.col("mtbf_target_hours") * F.coalesce("life_ratio", F.lit(1.0))).cast("int")
    due = (
        typed.withColumn("life_hours", hours)
        .withColumn("expected_failure", F.col("installed_at") + F.make_dt_interval(hours="life_hours"))
        .where(F.col("expected_failure") <= as_of.days_ago(-horizon_days))
        .withColumn("__day", F.to_date("expected_failure"))
        .select("component_id", "tower_id", "component_type", "part_number", "expected_failure", "__day")
    )
    queued = running_sums(
        due, ["part_number"], "__day", ["expected_failure", "component_id"], {"__ahead": F.lit(1)}
    )
    # Stock of the parts and days that are asked for: one row each.
    asked = due.select("part_number", "__day").distinct()
    stock = tables["fct_inventory_status"].select(
        F.col("part_number").alias("__part"), "available", "in_transit", "lead_time_days"
    )
    supply = asked.join(stock, F.col("part_number") == F.col("__part"), "left").select(
        F.col("part_number").alias("__of"),
        F.col("__day").alias("__on"),
        F.greatest(F.coalesce("available", F.lit(0)), F.lit(0)).alias("__stock"),
        F.when(F.col("lead_time_days").isNotNull(), F.greatest("in_transit", F.lit(0))).alias("__coming"),
        F.when(F.col("in_transit") > 0, F.date_add(as_of.today(), F.col("lead_time_days").cast("int"))).alias("arrives_on"),
    )
    served = queued.join(supply, F.col("part_number").eqNullSafe(F.col("__of")) & (F.col("__day") == F.col("__on")))
    ahead = F.col("__ahead")
    from_transit = (ahead >= F.col("__stock")) & (ahead < F.col("__stock") + F.coalesce("__coming", F.lit(0)))
    state = (
        F.when(ahead < F.col("__stock"), "covered")
        .when(from_transit & (F.col("arrives_on") <= F.col("__day")), "covered")
        .when(from_transit, "late")
        .otherwise("short")
    )
    return served.select(
        "component_id",
        "tower_id",
        "component_type",
        "part_number",
        "expected_failure",
        (ahead + 1).alias("queue_place"),
        state.alias("supply"),
        F.when(from_transit, F.col("arrives_on")).alias("arrives_on"),
    )
