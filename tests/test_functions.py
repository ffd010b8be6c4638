"""Shared expressions against Python, NumPy and DuckDB."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from watchpost.functions.clock import (
    AsOf,
    days_between,
    hours_between,
    minutes_between,
    seconds_elapsed,
)
from watchpost.functions.numeric import (
    exact_mean,
    ieee_divide,
    round_exact,
    round_half_away,
    round_half_even,
)
from watchpost.functions.ordering import rank_in
from watchpost.functions.quantiles import percentiles


def doubles() -> list[float]:
    rng = random.Random(7)
    ties = [k / 2000 for k in range(-4000, 4000, 7)] + [1.005, 2.675, 0.0005, 2.45, 2.15, -0.125, 0.0]
    return ties + [rng.uniform(-1000, 1000) for _ in range(3000)] + [1e17, -3.5e300]


def apply(spark, values, *columns):
    return [tuple(r) for r in spark.createDataFrame([(v,) for v in values], "v double").select(*columns).collect()]


@pytest.mark.parametrize("digits", [0, 1, 2, 3])
def test_round_half_away_is_sql_round(spark, digits):
    values = doubles()
    got = apply(spark, values, round_half_away(F.col("v"), digits))
    expected = duckdb.sql(f"select round(unnest({values}::double[]), {digits})").fetchall()
    assert got == expected


@pytest.mark.parametrize("digits", [1, 3])
def test_round_half_even_is_numpy_round(spark, digits):
    values = doubles()
    got = apply(spark, values, round_half_even(F.col("v"), digits))
    assert [g[0] for g in got] == np.round(values, digits).tolist()


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_round_exact_is_python_round(spark, digits):
    values = doubles()
    got = apply(spark, values, round_exact(F.col("v"), digits))
    assert [g[0] for g in got] == [round(v, digits) for v in values]


def test_rounding_keeps_null_nan_and_infinity(spark):
    values = [None, math.nan, math.inf, -math.inf]
    columns = [f(F.col("v"), 2) for f in (round_half_away, round_half_even, round_exact)]
    null, nan, inf, minus = apply(spark, values, *columns)
    assert null == (None,) * 3 and inf == (math.inf,) * 3 and minus == (-math.inf,) * 3
    assert all(math.isnan(x) for x in nan)


def test_division_by_zero_follows_ieee(spark):
    df = spark.createDataFrame([(1, 0), (-1, 0), (0, 0), (1, 4), (None, 0)], "a bigint, b bigint")
    got = [r[0] for r in df.select(ieee_divide(F.col("a"), F.col("b"))).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2])
    assert got[3] == 0.25 and got[4] is None


def test_differences_count_boundaries(spark):
    rng = random.Random(3)
    base = datetime(2024, 3, 9, 10, 59)
    pairs = [(base, datetime(2024, 3, 9, 11, 1)), (datetime(2024, 3, 9, 23, 59, 59), datetime(2024, 3, 10))]
    for _ in range(500):
        start = base + timedelta(microseconds=rng.randrange(10**14))
        pairs.append((start, start + timedelta(microseconds=rng.randrange(-(10**13), 10**13))))
    a, b = F.col("a"), F.col("b")
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [tuple(r) for r in df.select(days_between(a, b), hours_between(a, b), minutes_between(a, b)).collect()]
    for (start, end), row in zip(pairs, got):
        expected = duckdb.execute(
            "select date_diff('day', $1, $2), date_diff('hour', $1, $2), date_diff('minute', $1, $2)",
            [start, end],
        ).fetchone()
        assert row == expected
    assert got[0][1] == 1  # two minutes, but the clock passed eleven


def test_elapsed_seconds_are_exact_across_daylight_saving(spark):
    pair = (datetime(2024, 3, 10, 1, 0, 0, 1), datetime(2024, 3, 10, 4, 0, 0, 250_001))
    df = spark.createDataFrame([pair, (None, pair[1])], "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(seconds_elapsed(F.col("a"), F.col("b"))).collect()]
    assert got == [10800.25, None]


def test_as_of_accepts_text_date_and_datetime(spark):
    moment = datetime(2024, 1, 31, 12)
    assert AsOf.of("2024-01-31 12:00:00") == AsOf.of(moment) == AsOf.of(AsOf(moment))
    assert AsOf.of(moment.date()).moment == datetime(2024, 1, 31)
    with pytest.raises(ValueError):
        AsOf.of("2024-01-31T12:00:00+00:00")
    row = spark.range(1).select(AsOf(moment).days_ago(30), AsOf(moment).date_days_ago(31)).first()
    assert row[0] == datetime(2024, 1, 1, 12) and str(row[1]) == "2023-12-31"


def test_rank_in_puts_unknown_last(spark):
    df = spark.createDataFrame([("P2",), ("P9",), (None,), ("P1",)], "s string")
    assert [r[0] for r in df.select(rank_in(F.col("s"), ["P1", "P2"])).collect()] == [2, 3, 3, 1]


PROBABILITIES = {"low": 0.0, "median": 0.5, "p95": 0.95, "p99": 0.99, "high": 1.0}


def check_percentiles(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    row = percentiles(df, {"m": "v"}, PROBABILITIES, **options).first()
    present = [v for v in values if v is not None]
    for name, p in PROBABILITIES.items():
        assert row[name] == pytest.approx(np.percentile(present, p * 100), rel=1e-12, abs=1e-12)
    assert row["mean"] == pytest.approx(np.mean(present))


@pytest.mark.parametrize("size", [1, 2, 3, 101, 2000])
def test_percentiles_interpolate_exactly(spark, size):
    rng = random.Random(size)
    check_percentiles(spark, [rng.gauss(50, 400) for _ in range(size)] + [None] * (size // 3))


def test_percentiles_with_one_hot_value_and_far_outliers(spark):
    check_percentiles(spark, [7.5] * 900 + [float(k) for k in range(400)] + [1e9, -1e9])


def test_percentiles_do_not_depend_on_the_number_of_cells(spark):
    rng = random.Random(1)
    values = [rng.expovariate(0.01) for _ in range(300)] + [5.0] * 200 + [1e9, -1e9]
    for cells in (1, 2, 7, 1 << 16):
        check_percentiles(spark, values, cells=cells)


def test_percentiles_of_several_measures_and_of_nothing(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    rows = {r["measure"]: r for r in percentiles(df, {"A": "a", "B": "b"}, {"p50": 0.5}).collect()}
    assert rows["A"]["p50"] == 1.5 and rows["A"]["mean"] == 1.5
    assert rows["B"]["p50"] is None and rows["B"]["mean"] is None
    assert percentiles(df.where("a > 5"), {"A": "a"}, {"p50": 0.5}).collect()[0]["p50"] is None


def test_approximate_percentiles_stay_within_their_rank_error(spark):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("v"))
    row = percentiles(df, {"m": "v"}, {"p95": 0.95}, accuracy=1000).first()
    assert abs(row["p95"] - 19_000) <= 20_000 / 1000 + 1


def test_percentiles_rank_nan_above_all_numbers(spark):
    nan, inf = float("nan"), float("inf")

    def half(values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return percentiles(df, {"m": "v"}, {"p50": 0.5}).first()["p50"]

    assert half([1.0, 2.0, 10.0, nan]) == 6.0
    assert half([1.0, 2.0, nan]) == 2.0
    assert half([inf, 5.0, -inf]) == 5.0
    assert math.isnan(half([1.0, nan, nan]))
    assert half([1e12, -1e12, 3.0, 3.0, 3.0]) == 3.0


def test_exact_mean_does_not_depend_on_order_and_keeps_odd_values(spark):
    def mean(values, partitions=1):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)
        return df.agg(exact_mean(F.col("v")).alias("m")).first()["m"]

    values = [k * 0.1 + 0.005 for k in range(2000)]
    assert len({mean(v, n) for v in (values, values[::-1]) for n in (1, 7)}) == 1
    assert mean([]) is None and mean([None, 2.0]) == 2.0
    assert math.isnan(mean([1.0, float("nan")])) and mean([1.0, float("inf")]) == float("inf")
    assert mean([1e15, 1e15]) == 1e15
