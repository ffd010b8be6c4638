"""Joins and views along time against brute force, with boundaries, ties and a hot tower."""

from __future__ import annotations

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from fleet import AS_OF, SITES, TOWERS, fleet, records, ts
from pyspark.sql import functions as F

from watchpost.functions.cells import last_before, running_sums
from watchpost.functions.clock import AsOf
from watchpost.operators import detection, header, timelines
from watchpost.plans.marts import MEASURED

MOMENT = AsOf.of(AS_OF)
NOW = ts(AS_OF)


def readings(tower, *times, cpu=1.0):
    return [{"tower_id": tower, "ts": ts(t) if isinstance(t, str) else t, **dict.fromkeys(MEASURED, cpu)} for t in times]


def detections(tower, *times, first=0):
    return [{"detection_id": f"D{first + k:05d}", "tower_id": tower, "detected_at": ts(t) if isinstance(t, str) else t,
             "target_class": "human", "confidence_score": 0.5, "auto_resolved": k % 2 == 0,
             "escalated_to_operator": k % 2 == 1, "false_positive": k % 3 == 0} for k, t in enumerate(times)]


def spread(n, seed, days=40):
    draw = random.Random(seed)
    return [NOW - timedelta(minutes=draw.randrange(days * 1440)) for _ in range(n)]


# running sums and last values


def test_running_sums_and_last_values_equal_one_window(spark):
    draw = random.Random(1)
    rows = [(draw.choice(["a", "b", None, "hot", "hot"]), draw.randrange(100), k, draw.choice([None, 1, 5, -2])) for k in range(500)]
    table = spark.createDataFrame(rows, "g string, t int, k int, v int").withColumn("cell", F.floor(F.col("t") / 7))
    sums = running_sums(table, ["g"], "cell", ["t", "k"], {"s": F.col("v")}, totals={"s": "all"})
    both = last_before(sums, ["g"], "cell", ["t", "k"], {"last": F.col("v")})
    assert both.columns == ["g", "t", "k", "v", "cell", "s", "all", "last"]
    for r in both.collect():
        group = sorted((t, k, v) for g, t, k, v in rows if g == r.g)
        earlier = [v for t, k, v in group if (t, k) < (r.t, r.k) and v is not None]
        assert r.s == sum(earlier) and r.all == sum(v for _, _, v in group if v is not None)
        assert r["last"] == (earlier[-1] if earlier else None)


# state at a moment


def test_state_is_the_last_reading_at_or_before(spark):
    star = fleet(
        spark,
        telemetry=[*readings("T1", "2024-01-10 08:00:00", cpu=1.0), *readings("T1", "2024-01-10 08:00:00", cpu=3.0),
                   *readings("T1", "2024-01-12 23:59:59", cpu=2.0), *readings("T2", "2024-01-01 00:00:00"),
                   *readings(None, "2024-01-01 00:00:00")],
        detections=[*detections("T1", "2024-01-10 07:59:59", "2024-01-10 08:00:00", "2024-01-12 12:00:00",
                                "2024-01-13 00:00:00"),
                    {"detection_id": "X1", "tower_id": "T1", "detected_at": None}, {"detection_id": "X2", "tower_id": None,
                    "detected_at": ts("2024-01-20 00:00:00")}, {"detection_id": "X3", "tower_id": "T9",
                    "detected_at": ts("2024-01-20 00:00:00")}],
    )
    found = {r["detection_id"]: (r["cpu_pct"], r["reading_age_s"]) for r in records(timelines.tower_state_at_detection(star))}
    nothing = (None, None)
    assert found == {"D00000": nothing, "D00001": (3.0, 0), "D00002": (3.0, 52 * 3600), "D00003": (2.0, 1),
                     "X1": nothing, "X2": nothing, "X3": nothing}


def test_state_with_a_hot_tower_equals_brute_force(spark):
    told = [(t, at) for k, at in enumerate(spread(400, 2)) for t in ["T1" if k % 3 == 0 else f"T{k % 5}"]]
    asked = [(t, at) for k, at in enumerate(spread(300, 3)) for t in ["T1" if k % 3 == 0 else f"T{k % 7}"]]
    star = fleet(
        spark,
        telemetry=[r for k, (t, at) in enumerate(told) for r in readings(t, at, cpu=float(k))],
        detections=[r for k, (t, at) in enumerate(asked) for r in detections(t, at, first=k)],
    )
    found = {r["detection_id"]: (r["reading_ts"], r["cpu_pct"]) for r in records(timelines.tower_state_at_detection(star))}
    for k, (tower, at) in enumerate(asked):
        before = [(x, float(c)) for c, (t, x) in enumerate(told) if t == tower and x <= at]
        assert found[f"D{k:05d}"] == max(before, default=(None, None))


# missions at a moment


def mission(k, tower, start, end):
    return {"deployment_id": f"M{k}", "tower_id": tower, "mission_name": f"name {k}", "start_ts": ts(start),
            "end_ts": ts(end) if end else None, "status": "active"}


def test_missions_include_their_begin_and_not_their_end(spark):
    star = fleet(
        spark,
        deployments=[mission(1, "T1", "2024-01-01 00:00:00", "2024-01-05 00:00:00"),
                     mission(2, "T1", "2024-01-04 00:00:00", None), mission(3, "T1", "2024-01-04 00:00:00", "2024-01-20 00:00:00"),
                     mission(4, "T2", "2024-01-09 00:00:00", "2024-01-09 00:00:00"), mission(5, "T2", "2024-03-01 00:00:00", None),
                     mission(6, "T3", "2024-01-09 00:00:00", "2024-01-02 00:00:00")],
        detections=[*detections("T1", "2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-01-04 00:00:00",
                                "2024-01-05 00:00:00", "2024-01-31 12:00:00", "2024-01-31 12:00:01"),
                    *detections("T2", "2024-01-09 00:00:00", first=10), *detections("T3", "2024-01-05 00:00:00", first=20),
                    {"detection_id": "X", "tower_id": None, "detected_at": None}],
    )
    found = {r["detection_id"]: (r["missions"], r["deployment_id"]) for r in records(timelines.missions_at_detection(star, MOMENT))}
    assert found == {"D00000": (0, None), "D00001": (1, "M1"), "D00002": (3, "M3"), "D00003": (2, "M3"),
                     "D00004": (1, "M2"), "D00005": (0, None), "D00010": (0, None), "D00020": (0, None), "X": (0, None)}


@pytest.mark.parametrize("span_days", [1, 7, 400])
def test_missions_with_a_hot_tower_equal_brute_force(spark, span_days):
    draw = random.Random(4)
    missions = []
    for k, at in enumerate(spread(120, 5, 90)):
        tower = "T1" if k % 3 == 0 else f"T{k % 4}"
        end = None if k % 5 == 0 else at + timedelta(hours=draw.randrange(1, 900))
        missions.append({"deployment_id": f"M{k:03d}", "tower_id": tower, "mission_name": "m", "start_ts": at, "end_ts": end})
    asked = [(t, at) for k, at in enumerate(spread(200, 6)) for t in ["T1" if k % 3 == 0 else f"T{k % 5}"]]
    star = fleet(spark, deployments=missions, detections=[r for k, (t, at) in enumerate(asked) for r in detections(t, at, first=k)])
    found = records(timelines.missions_at_detection(star, MOMENT, span_days=span_days))
    assert len(found) == len(asked)
    for r in found:
        running = [(m["start_ts"], m["deployment_id"]) for m in missions if m["tower_id"] == r["tower_id"]
                   and m["start_ts"] <= r["detected_at"] < (m["end_ts"] or datetime.max)]
        assert (r["missions"], r["deployment_id"]) == (len(running), max(running, default=(None, None))[1])


def most_joined(df):
    """Most rows that a join of the query has made."""
    df.collect()
    nodes, most = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        if node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
        elif node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif "Join" in node.nodeName():
            most = max(most, node.metrics().apply("numOutputRows").value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return most


def test_missions_meet_detections_only_where_they_begin_or_end(spark):
    """Missions that run at all detections of a tower, or for weeks, make no row for each pair."""
    ends = [None, "2024-03-01 00:00:00", "2023-12-20 12:00:00", "2024-01-20 00:00:00"]
    missions = [mission(k, "T1", f"2023-11-{1 + k % 25:02d} 00:00:00", ends[k % 4]) for k in range(200)]
    missions += [mission(900 + k, "T1", "2024-01-10 00:00:00", ends[k]) for k in (0, 1, 3)]
    asked = [datetime(2023, 12, 1) + timedelta(hours=17 * k) for k in range(80)]
    found = timelines.missions_at_detection(fleet(spark, deployments=missions, detections=detections("T1", *asked)), MOMENT)
    for r in records(found):
        running = [(m["start_ts"], m["deployment_id"]) for m in missions
                   if m["start_ts"] <= r["detected_at"] < (m["end_ts"] or datetime.max)]
        assert (r["missions"], r["deployment_id"]) == (len(running), max(running)[1])
    assert most_joined(found) < 80 * 200 / 5


# outages and sessions


def test_outages_and_sessions_by_hand(spark):
    star = fleet(
        spark,
        telemetry=[*readings("T1", "2024-01-30 00:00:00", "2024-01-30 06:00:00", "2024-01-30 12:00:01", "2024-01-31 11:00:00",
                             "2024-01-31 11:00:00", "2024-02-01 00:00:00"),
                   *readings("T2", "2024-01-31 05:59:59"), *readings("T3", "2024-01-31 06:00:00"), *readings(None, "2024-01-01 00:00:00")],
    )
    found = {(r["tower_id"], r["silent_from"], r["silent_to"]): r["hours"] for r in records(timelines.telemetry_outages(star, MOMENT))}
    assert found == {
        ("T1", ts("2024-01-30 06:00:00"), ts("2024-01-30 12:00:01")): 6.0,
        ("T1", ts("2024-01-30 12:00:01"), ts("2024-01-31 11:00:00")): 23.0,
        ("T2", ts("2024-01-31 05:59:59"), None): 6.0,
    }
    sessions = sorted(tuple(r.values()) for r in records(timelines.telemetry_sessions(star, MOMENT)))
    assert [(s[0], s[1], s[4]) for s in sessions] == [("T1", 1, 2), ("T1", 2, 1), ("T1", 3, 2), ("T2", 1, 1), ("T3", 1, 1)]


def test_sessions_with_a_hot_tower_cover_all_readings(spark):
    told = [(t, at) for k, at in enumerate(spread(500, 8, 60)) for t in ["T1" if k % 3 == 0 else f"T{k % 9}"]]
    star = fleet(spark, telemetry=[r for t, at in told for r in readings(t, at)])
    found = records(timelines.telemetry_sessions(star, MOMENT))
    expected = Counter()
    for tower in {t for t, _ in told}:
        number, before = 0, None
        for at in sorted(x for t, x in told if t == tower):
            number += before is None or at - before > timedelta(hours=6)
            expected[tower, number] += 1
            before = at
    assert {(r["tower_id"], r["session"]): r["readings"] for r in found} == expected


# backlog and levels


def test_backlog_equals_the_header_on_every_day(spark):
    draw = random.Random(9)
    incidents = [{"incident_id": f"I{k}", "tower_id": draw.choice(["T1", "T2", "T4", "T99"]), "opened_at": at, "severity": "P1",
                  "closed_at": draw.choice([None, at + timedelta(hours=draw.randrange(-5, 300))])} for k, at in enumerate(spread(150, 10, 30))]
    incidents += [{"incident_id": "E1", "tower_id": "T1", "opened_at": NOW - timedelta(days=9), "closed_at": NOW - timedelta(days=8)},
                  {"incident_id": "E2", "tower_id": "T1", "opened_at": NOW, "closed_at": None}]
    star = fleet(spark, sites=SITES, towers=TOWERS, incidents=incidents)
    for site in (None, "S1"):
        found = {r["day"]: r["open_incidents"] for r in records(timelines.backlog_by_day(star, MOMENT, days=20, site_id=site))}
        assert len(found) == 21
        for back in range(0, 21, 4):
            day = NOW - timedelta(days=back)
            (expected,) = header.backlog_7d_ago(star, AsOf.of(day + timedelta(days=7)), site_id=site).first()
            assert found[day.date()] == expected


def test_each_level_equals_the_query_with_that_filter(spark):
    star = fleet(spark, sites=SITES, towers=TOWERS, detections=[
        *detections("T1", *spread(40, 11), first=0), *detections("T2", *spread(9, 12), first=100),
        *detections("T3", *spread(17, 13), first=200), *detections("T4", *spread(3, 14), first=300)])
    rows = records(timelines.detection_kpis_by_level(star, MOMENT))
    assert Counter(r["level"] for r in rows) == {"fleet": 1, "region": 3, "site": 3}
    for r in rows:
        site = {"fleet": None}.get(r["level"], r["site_id"])
        if r["level"] == "fleet" or r["level"] == "site" and r["site_id"] is not None:
            expected = records(detection.detection_kpis(star, MOMENT, site_id=site))[0]
            assert {k: r[k] for k in expected} == expected


@pytest.mark.parametrize("view", ["tower_state_at_detection", "missions_at_detection", "telemetry_outages", "telemetry_sessions",
                                  "backlog_by_day", "detection_kpis_by_level"])
def test_empty_tables(spark, view):
    star = fleet(spark)
    options = [] if view == "tower_state_at_detection" else [MOMENT]
    rows = records(getattr(timelines, view)(star, *options))
    assert rows == [] or view == "backlog_by_day" and {r["open_incidents"] for r in rows} == {0}


@pytest.mark.parametrize("view", ["tower_state_at_detection", "telemetry_outages", "telemetry_sessions"])
def test_no_window_gathers_the_rows_of_a_tower(spark, view):
    """Windows by tower alone run over one row for each day, which an aggregate has made."""
    options = [] if view == "tower_state_at_detection" else [MOMENT]
    plan = getattr(timelines, view)(fleet(spark), *options)._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"Window \[(.*)\], \[([^\]]*)\], \[", plan)
    assert any("__day" in keys for _, keys in windows) and any("__day" not in keys for _, keys in windows)
    assert all(re.search(r"__(last|sum|off|seen|begins|inside)|_w\d", made) for made, keys in windows if "__day" not in keys)
