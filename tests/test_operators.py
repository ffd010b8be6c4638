"""Dashboard operators on hand-written rows: empty windows, ties, missing inputs."""

from __future__ import annotations

from datetime import date

from fleet import AS_OF, SITES, TOWERS, fleet, raw_table, records, ts
from pyspark.sql import functions as F

from watchpost.functions.clock import AsOf
from watchpost.operators import detection, header, operations, reliability, rules
from watchpost.plans.star import StarSchema
from watchpost.sources.raw import read_raw

MOMENT = AsOf.of(AS_OF)


def one(df):
    rows = records(df)
    assert len(rows) == 1
    return rows[0]


def incident(key, tower="T1", opened="2024-01-10 00:00:00", closed=None, severity="P1", **more):
    return {
        "incident_id": key,
        "tower_id": tower,
        "opened_at": ts(opened),
        "closed_at": closed and ts(closed),
        "severity": severity,
        **more,
    }


def test_header_of_an_empty_fleet_is_one_row(spark):
    row = one(header.kpi_header(fleet(spark), MOMENT))
    zero = ("active_towers", "active_deployments", "open_incidents", "critical_open",
            "failed_components_30d", "failed_components_prev_30d", "inc_open_7d_ago")
    assert all(row[name] == 0 for name in zero)
    nulls = ("uptime_7d", "uptime_prev_7d", "uptime_delta", "failures_delta", "incidents_delta")
    assert all(row[name] is None for name in nulls)


def test_incident_metrics_drop_unknown_towers_and_respect_the_site(spark):
    incidents = [
        incident("open"),
        incident("minor", severity="P3"),
        incident("closed late", closed="2024-01-24 12:00:01"),
        incident("closed at the cutoff", closed="2024-01-24 12:00:00"),
        incident("opened at the cutoff", opened="2024-01-24 12:00:00"),
        incident("too new", opened="2024-01-24 12:00:01", tower="T3"),
        incident("orphan", tower="T99"),
        incident("no site", tower="T4"),
    ]
    tables = fleet(spark, sites=SITES, towers=TOWERS, incidents=incidents)
    assert one(header.open_incidents(tables)) == {"open_incidents": 5, "critical_open": 4}
    assert one(header.open_incidents(tables, site_id="S2")) == {"open_incidents": 1, "critical_open": 1}
    assert one(header.backlog_7d_ago(tables, MOMENT)) == {"inc_open_7d_ago": 5}
    full = one(header.kpi_header(tables, MOMENT))
    assert (full["open_incidents"], full["critical_open"], full["inc_open_7d_ago"]) == (5, 4, 5)
    assert full["incidents_delta"] is None  # no change
    site = one(header.kpi_header(tables, MOMENT, site_id="S1"))
    assert (site["open_incidents"], site["inc_open_7d_ago"], site["active_towers"]) == (3, 4, 1)
    assert site["incidents_delta"] == -1.0


def test_uptime_weeks_span_eight_and_seven_dates(spark):
    days = [(date(2024, 1, 31), 30.0), (date(2024, 1, 24), 60.0), (date(2024, 1, 23), 6.0),
            (date(2024, 1, 17), 12.0), (date(2024, 1, 16), 0.0)]
    telemetry = [
        {"tower_id": "T1", "ts": ts(f"{day} 08:00:00"), "comms_uptime_min": minutes}
        for day, minutes in days
    ]
    row = one(header.uptime(fleet(spark, telemetry=telemetry), MOMENT))
    assert row == {"uptime_7d": 75.0, "uptime_prev_7d": 15.0}


def test_failure_windows_follow_the_flag(spark):
    def component(key, failed, flag=True):
        return {"component_id": key, "installed_at": ts("2023-01-01 00:00:00"), "failed_at": ts(failed),
                "is_failed": flag, "mtbf_target_hours": 1}

    components = [
        component("now", "2024-01-01 12:00:00"),
        component("before", "2024-01-01 11:59:59"),
        component("oldest", "2023-12-02 12:00:00"),
        component("too old", "2023-12-02 11:59:59"),
        component("not flagged", "2024-01-05 00:00:00", flag=False),
    ]
    row = one(header.failures(fleet(spark, components=components), MOMENT))
    assert row == {"failed_components_30d": 1, "failed_components_prev_30d": 2}


def test_change_hides_small_and_unknown_differences(spark):
    df = spark.createDataFrame(
        [(1.0, 1.04), (1.0, 1.06), (None, 1.0), (1.0, None), (float("nan"), 1.0)], "a double, b double"
    )
    got = [r[0] for r in df.select(header.change(F.col("a"), F.col("b"))).collect()]
    assert got[0] is None and round(got[1], 6) == -0.06 and got[2:] == [None, None, None]


def test_site_density_without_active_towers_or_detections(spark):
    detections = [
        {"detection_id": str(n), "tower_id": tower, "detected_at": ts("2024-01-25 00:00:00")}
        for n, tower in enumerate(["T1", "T2", "T3", "T88"])
    ] + [{"detection_id": "old", "tower_id": "T1", "detected_at": ts("2024-01-23 23:59:59")}]
    tables = fleet(spark, sites=SITES, towers=TOWERS, detections=detections)
    rows = records(operations.site_status_density(tables, MOMENT))
    assert [(r["site_id"], r["dets_7d"], r["dets_per_active_tower"]) for r in rows] == [
        ("S1", 2, 2.0),
        ("S2", 1, 0.0),
    ]
    density = {r["site_id"]: r["dets_7d"] for r in records(operations.detection_density(tables, MOMENT))}
    assert density == {"S1": 2, "S2": 1, None: 1}


def test_site_density_without_a_detection_table(spark):
    tables = dict(fleet(spark, sites=SITES, towers=TOWERS))
    del tables["fct_detection_events"]
    result = operations.site_status_density(tables, MOMENT)
    assert [(r["dets_7d"], r["dets_per_active_tower"]) for r in records(result)] == [(0, 0.0), (0, 0.0)]
    types = dict(result.dtypes)
    assert (types["dets_7d"], types["dets_per_active_tower"]) == ("bigint", "double")


def test_site_density_of_a_folder_without_detections(spark, tmp_path):
    for name, rows in {"sites": SITES, "towers": TOWERS, "incidents": []}.items():
        raw_table(spark, name, rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    tables = StarSchema(read_raw(spark, str(tmp_path)), AS_OF)
    assert "fct_detection_events" not in tables and "dim_site" in tables
    result = operations.site_status_density(tables, MOMENT)
    assert [(r["dets_7d"], r["dets_per_active_tower"]) for r in records(result)] == [(0, 0.0), (0, 0.0)]


def test_open_incidents_are_ranked_by_severity_age_and_id(spark):
    incidents = [
        incident("d", severity="P4"),
        incident("c", severity="P1", opened="2024-01-11 00:00:00"),
        incident("b", severity="P1"),
        incident("a", severity="P1"),
        incident("e", severity="P1", closed="2024-01-12 00:00:00"),
        incident("f", severity="P1", tower="T99"),
    ]
    tables = fleet(spark, sites=SITES, towers=TOWERS, incidents=incidents)
    rows = records(operations.open_incident_list(tables, MOMENT))
    assert [r["incident_id"] for r in rows] == ["a", "b", "c", "d"]
    assert rows[0]["age_hours"] == 21 * 24 + 12


def test_lists_are_cut_at_their_length(spark):
    deployments = [
        {"deployment_id": f"D{n:02d}", "start_ts": ts("2024-01-01 00:00:00"), "status": "active"}
        for n in range(30)
    ]
    rows = records(operations.active_missions(fleet(spark, deployments=deployments)))
    assert [r["deployment_id"] for r in rows] == [f"D{n:02d}" for n in range(25)]


def test_low_inventory_order(spark):
    inventory = [
        {"part_number": key, "on_hand": n, "allocated": 0, "reorder_point": 10}
        for key, n in (("w", 12), ("r2", 9), ("r1", 2), ("c", -1), ("h", 99))
    ]
    rows = records(operations.low_inventory(fleet(spark, inventory=inventory)))
    assert [r["part_number"] for r in rows] == ["c", "r1", "r2", "w"]


def test_detection_metrics_of_nothing(spark):
    tables = fleet(spark)
    row = one(detection.detection_kpis(tables, MOMENT))
    assert (row["total_dets"], row["dets_7d"], row["dets_delta"]) == (0, 0, 0)
    assert row["auto_resolve_pct"] is None and row["avg_confidence"] is None
    assert one(detection.latency_overall(tables)) == {"p50": None, "p95": None, "p99": None}
    stages = records(detection.latency_by_stage(tables))
    assert sorted(r["stage"] for r in stages) == sorted(detection.STAGES)


def test_mtbf_counts_by_flag_and_averages_only_failures(spark):
    def component(key, flag, failed, target):
        return {"component_id": key, "component_type": "radar", "is_failed": flag,
                "installed_at": ts("2024-01-01 00:00:00"), "failed_at": failed and ts(failed),
                "mtbf_target_hours": target}

    rows = [
        component("a", True, "2024-01-01 10:00:00", 100),
        component("b", False, None, 50),
        component("c", False, "2024-01-02 00:00:00", 30),
    ]
    tables = fleet(spark, components=rows)
    row = one(reliability.mtbf_by_subsystem(tables))
    assert (row["target_hours"], row["actual_hours_when_failed"]) == (60.0, 10.0)
    assert (row["installed"], row["failed"], row["failure_rate_pct"]) == (3, 1, 33.3)
    assert {r["metric"]: r["hours"] for r in records(reliability.mtbf_long(tables))} == {
        "Target": 60.0,
        "Observed at failure": 10.0,
    }


def test_uptime_trend_takes_an_optional_window(spark):
    telemetry = [
        {"tower_id": "T1", "ts": ts(f"2024-01-{day} 08:00:00"), "comms_uptime_min": 30.0} for day in (10, 30)
    ]
    tables = fleet(spark, telemetry=telemetry)
    assert reliability.uptime_trend(tables).count() == 2
    assert reliability.uptime_trend(tables, MOMENT, days=7).count() == 1
    assert reliability.uptime_long(tables).count() == 4


def test_auto_resolve_threshold_is_inclusive(spark):
    cases = [(0.85, "human", True), (0.8499999, "human", False), (0.99, "unknown", False)]
    detections = [
        {"detection_id": str(n), "confidence_score": score, "target_class": target}
        for n, (score, target, _) in enumerate(cases)
    ]
    rows = records(rules.rule_auto_resolve(fleet(spark, detections=detections)))
    got = {int(r["detection_id"]): r for r in rows}
    for n, (_, _, resolved) in enumerate(cases):
        assert (got[n]["auto_resolved"], got[n]["escalated_to_operator"]) == (resolved, not resolved)


def test_overnight_is_not_night(spark):
    hours = {5: True, 6: False, 21: False, 22: True}
    alerts = [
        {"detection_id": str(h), "detection_ts": ts(f"2024-01-30 {h:02d}:30:00")} for h in hours
    ]
    rows = records(rules.rule_overnight(fleet(spark, alert_pipeline=alerts)))
    assert {int(r["detection_id"]): r["is_overnight"] for r in rows} == hours


def test_escalation_gaps_both_ways(spark):
    detections = [
        {"detection_id": "ok", "escalated_to_operator": True},
        {"detection_id": "forgotten", "escalated_to_operator": True},
        {"detection_id": "resolved", "escalated_to_operator": False},
    ]
    alerts = [{"detection_id": "ok"}, {"detection_id": "resolved"}]
    rows = records(rules.escalation_gaps(fleet(spark, detections=detections, alert_pipeline=alerts)))
    assert {r["detection_id"]: r["problem"] for r in rows} == {
        "forgotten": "no alert",
        "resolved": "not escalated",
    }


def test_stage_latencies_round_to_tenths(spark):
    alert = {
        "detection_id": "a",
        "detection_ts": ts("2024-01-30 00:00:00"),
        "alert_generated_ts": ts("2024-01-30 00:00:02.450000"),
        "operator_notified_ts": ts("2024-01-30 00:00:04.600000"),
        "operator_ack_ts": ts("2024-01-30 00:00:04.850000"),
        "resolved_ts": ts("2024-01-31 00:00:00"),
    }
    row = one(rules.stage_latencies(fleet(spark, alert_pipeline=[alert])))
    assert row["detection_to_alert_s"] == round(2.45, 1) == 2.5
    assert row["alert_to_notify_s"] == round(2.15, 1) == 2.1
    assert row["notify_to_ack_s"] == round(0.25, 1) == 0.2
    assert row["total_response_s"] == 86400.0


def test_latest_deployment_of_active_towers(spark):
    def deployment(key, tower, start):
        return {"deployment_id": key, "tower_id": tower, "start_ts": ts(start)}

    deployments = [
        deployment("D1", "T1", "2024-01-01 00:00:00"),
        deployment("D3", "T1", "2024-01-05 00:00:00"),
        deployment("D2", "T1", "2024-01-05 00:00:00"),
        deployment("D9", "T2", "2024-01-09 00:00:00"),
    ]
    row = one(rules.latest_deployment_per_tower(fleet(spark, towers=TOWERS, deployments=deployments)))
    assert (row["tower_id"], row["deployment_id"]) == ("T1", "D3")
