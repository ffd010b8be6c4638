"""Every kind of check, passing and failing."""

from __future__ import annotations

from collections import Counter

from fleet import SITES, TOWERS, fleet, records

from watchpost.operators.quality import dq_suite, run_checks
from watchpost.plans.checks import declared_checks


def outcome(tables):
    rows = records(dq_suite(tables))
    return {(r["model"], r["column_name"], r["test"]): (r["failures"], r["status"]) for r in rows}


def test_declared_counts():
    counts = Counter(check.test for check in declared_checks())
    assert counts == {"unique": 15, "not_null": 28, "accepted_values": 9, "relationships": 5}


def test_empty_tables_pass_everything(spark):
    found = outcome(fleet(spark))
    assert len(found) == 57 and set(found.values()) == {(0, "pass")}


def test_each_kind_of_failure_is_counted(spark):
    sites = [*SITES, {"site_id": "S1", "env": "moon"}, {"site_id": None, "env": None}]
    sites += [{"site_id": "S7", "env": "moon"}, {"site_id": "S8", "env": "sea"}]
    towers = [*TOWERS, {"tower_id": "T5"}, {"tower_id": "T6", "site_id": "S9"}]
    telemetry = [{"tower_id": "T1"}, {"tower_id": "T50"}, {"tower_id": "T50"}, {"tower_id": None}]
    found = outcome(fleet(spark, sites=sites, towers=towers, telemetry=telemetry))
    assert found["stg_sites", "site_id", "unique"] == (1, "fail")
    assert found["stg_sites", "site_id", "not_null"] == (1, "fail")
    assert found["stg_sites", "env", "accepted_values"] == (2, "fail")  # distinct values
    assert found["stg_towers", "site_id", "not_null"] == (1, "fail")
    assert found["stg_towers", "site_id", "relationships"] == (2, "fail")  # rows
    assert found["stg_towers", "tower_id", "unique"] == (0, "pass")
    assert found["stg_telemetry", "tower_id", "not_null"] == (1, "fail")
    assert found["stg_telemetry", "tower_id", "relationships"] == (2, "fail")
    assert found["dim_tower", "site_id", "relationships"] == (0, "pass")
    assert found["fct_fleet_health_daily", "health_date", "not_null"][1] == "fail"


def test_a_single_check_can_run_alone(spark):
    check = [c for c in declared_checks() if (c.model, c.test) == ("stg_sites", "unique")]
    assert records(run_checks(fleet(spark, sites=SITES), check)) == [
        {"model": "stg_sites", "column_name": "site_id", "test": "unique", "failures": 0, "status": "pass"}
    ]
