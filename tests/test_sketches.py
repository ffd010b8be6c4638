"""Percentiles from stored sketches: rank error, merging in any split, odd values."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from fleet import records

from watchpost.operators.detection import PERCENTILES, STAGES
from watchpost.operators.sketches import RANK_ERROR, percentiles_between, rank_errors, response_sketches

COLUMNS = "site_id string, detection_date date, " + ", ".join(f"{c} double" for c in STAGES.values())


def alerts(spark, rows):
    return {"fct_alert_pipeline_latency": spark.createDataFrame(rows, COLUMNS)}


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def many(n, seed=1):
    draw = random.Random(seed)
    return [(draw.choice(["S1", "S1", "S2", None]), day(draw.randrange(10)), draw.random(), draw.lognormvariate(3, 2),
             float(draw.randrange(5)), draw.choice([None, -1e300, 7.0]), 3.0) for _ in range(n)]


@pytest.mark.parametrize("first, last, site", [(None, None, None), (2, 7, None), (4, 4, "S1"), (None, 3, "S2")])
def test_ranks_are_within_the_error(spark, first, last, site):
    rows = many(30_000)
    sketches = response_sketches(alerts(spark, rows))
    limits = [None if k is None else day(k) for k in (first, last)]
    answers = percentiles_between(sketches, *limits, site_id=site)
    chosen = [r for r in rows if (site is None or r[0] == site) and (first is None or r[1] >= day(first)) and (last is None or r[1] <= day(last))]
    errors = records(rank_errors(alerts(spark, chosen)["fct_alert_pipeline_latency"], answers))
    assert {r["stage"]: r["n"] for r in errors} == {r["stage"]: r["n"] for r in records(answers)}
    assert all(r[p] <= RANK_ERROR for r in errors for p in PERCENTILES)
    seen = {label: {r[k + 2] for r in chosen} for k, label in enumerate(STAGES)}
    assert all(r[p] in seen[r["stage"]] for r in records(answers) for p in PERCENTILES)


def test_few_values_are_exact(spark):
    rows = [("S1", day(k % 7), float(k), *[0.0] * 4) for k in range(101)]
    answer = {r["stage"]: r for r in records(percentiles_between(response_sketches(alerts(spark, rows))))}
    first = answer[next(iter(STAGES))]
    assert (first["p50"], first["p95"], first["p99"], first["n"]) == (50.0, 95.0, 99.0, 101)


def test_stored_days_merge_as_if_seen_together(spark, tmp_path):
    """Days that are written one by one answer like all days at once, within the error."""
    rows, path = many(6000, 3), str(tmp_path / "sketches")
    for k in range(10):
        own = response_sketches(alerts(spark, [r for r in rows if r[1] == day(k)]))
        own.write.mode("append").partitionBy("detection_date").parquet(path)
    answers = percentiles_between(spark.read.parquet(path), day(1), day(8))
    chosen = alerts(spark, [r for r in rows if day(1) <= r[1] <= day(8)])["fct_alert_pipeline_latency"]
    assert all(r[p] <= RANK_ERROR for r in records(rank_errors(chosen, answers)) for p in PERCENTILES)


def test_odd_values_and_no_alerts(spark):
    rows = [("S1", day(0), float("nan"), None, float("inf"), 1.0, float("-inf")), (None, None, 2.0, None, 5.0, 1.0, 3.0)]
    answer = [r for r in records(percentiles_between(response_sketches(alerts(spark, rows))))]
    assert [(r["n"], r["p50"]) for r in sorted(answer, key=lambda r: list(STAGES).index(r["stage"]))][:2] == [(1, 2.0), (0, None)]
    empty = records(percentiles_between(response_sketches(alerts(spark, []))))
    assert len(empty) == 5 and all(r["n"] == 0 and r["p99"] is None for r in empty)
    assert records(percentiles_between(response_sketches(alerts(spark, rows)), site_id="S9")) and True


def test_answers_read_no_alerts(spark, tmp_path):
    path = str(tmp_path / "sketches")
    response_sketches(alerts(spark, many(500))).write.parquet(path)
    plan = percentiles_between(spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "LocalRelation" not in plan.replace("Range", "")
