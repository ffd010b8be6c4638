"""Remaining life and replacement queue against brute force on hand-written units."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from watchpost.functions.clock import AsOf
from watchpost.operators.lifecycle import component_survival, remaining_life, replacement_queue

NOW = datetime(2024, 1, 31, 12)
UNITS = """component_id string, tower_id string, component_type string, part_number string, installed_at timestamp_ntz,
    is_failed boolean, mtbf_target_hours long, observed_hours long, actual_vs_target_ratio double"""
STOCK = "part_number string, available long, in_transit long, lead_time_days long"


def unit(k, kind, hours, failed, part="P1", target=1000, installed=None):
    installed = installed or NOW - timedelta(hours=hours or 0)
    ratio = round(hours / target, 3) if failed and hours is not None else None
    return (f"C{k:05d}", "T1", kind, part, installed, failed, target, hours, ratio)


def tables(spark, units, stock=()):
    return {
        "fct_component_reliability": spark.createDataFrame(units, UNITS),
        "fct_inventory_status": spark.createDataFrame(list(stock), STOCK),
    }


def brute_curve(units):
    """``{(type, age): (at_risk, failures, left, survival, median, expected)}``"""
    out = {}
    by_type = defaultdict(list)
    for u in units:
        if u[7] is not None:
            by_type[u[2]].append((u[7], bool(u[5])))
    for kind, lives in by_type.items():
        ages, curve, s = sorted({a for a, _ in lives}), [], 1.0
        for a in ages:
            n = sum(x >= a for x, _ in lives)
            d = sum(x == a and f for x, f in lives)
            s *= 1 - d / n
            curve.append((a, n, d, sum(x == a and not f for x, f in lives), s))
        for k, (a, n, d, left, s) in enumerate(curve):
            median = next((b - a for b, _, e, _, r in curve[k:] if e and r <= s / 2 + 1e-9), None) if s else None
            area = sum(curve[j][4] * (curve[j + 1][0] - curve[j][0]) for j in range(k, len(curve) - 1))
            out[kind, a] = (n, d, left, s, median, area / s if s else None)
    return out


def check_curve(spark, units):
    rows = remaining_life(tables(spark, units)).collect()
    expected = brute_curve(units)
    assert len(rows) == len(expected)
    for r in rows:
        n, d, left, s, median, area = expected[r.component_type, r.age_hours]
        assert (r.at_risk, r.failures, r.left_working) == (n, d, left)
        assert r.survival == pytest.approx(s, abs=1e-8)
        assert r.median_remaining_hours == median
        assert r.expected_remaining_hours == (None if area is None else pytest.approx(area, abs=0.06))
    return rows


def test_textbook_curve(spark):
    units = [unit(k, "radar", h, f) for k, (h, f) in enumerate([(6, 1), (6, 1), (6, 1), (6, 0), (7, 1), (9, 0), (10, 1), (10, 0)])]
    rows = {r.age_hours: r for r in check_curve(spark, [u[:5] + (bool(u[5]),) + u[6:] for u in units])}
    assert rows[6].survival == pytest.approx(1 - 3 / 8) and rows[10].survival == pytest.approx(5 / 8 * 3 / 4 * 1 / 2)


def test_curve_equals_brute_force_across_cells(spark):
    draw = random.Random(3)
    units = [unit(k, draw.choice(["radar", "comm", None]), draw.choice([5, 999, 1000, 1001, draw.randrange(9000)]),
                  draw.random() < 0.6) for k in range(400)]
    check_curve(spark, units)


def test_all_working_all_failed_and_unknown(spark):
    units = [unit(k, "eo_ir", 100 * k, False) for k in range(5)]
    units += [unit(10 + k, "power", 70, True) for k in range(4)]
    units += [unit(20, "comm", None, False), unit(21, "comm", -3, True), unit(22, "comm", 4, None)]
    rows = check_curve(spark, units)
    assert all(r.survival == 1 and r.median_remaining_hours is None for r in rows if r.component_type == "eo_ir")
    (dead,) = [r for r in rows if r.component_type == "power"]
    assert dead.survival == 0 and dead.expected_remaining_hours is None


def test_a_third_of_all_units_at_one_age(spark):
    units = [unit(k, "radar", 500 if k % 3 == 0 else k, k % 2 == 0) for k in range(300)]
    check_curve(spark, units)


def test_no_units(spark):
    empty = tables(spark, [])
    assert component_survival(empty).collect() == remaining_life(empty).collect() == []
    assert replacement_queue(empty, AsOf.of(NOW)).collect() == []


def brute_queue(units, stock, horizon=90):
    ratios = defaultdict(list)
    for u in units:
        if u[5] and u[8] is not None:
            ratios[u[2]].append(u[8])
    due = defaultdict(list)
    for u in units:
        if not u[5] and u[4] is not None and u[6] is not None:
            own = ratios.get(u[2])
            life = math.floor(u[6] * (round(sum(own) / len(own), 3) if own else 1.0))
            fails = u[4] + timedelta(hours=life)
            if fails <= NOW + timedelta(days=horizon):
                due[u[3]].append((fails, u[0]))
    shelf = {s[0]: s[1:] for s in stock if s[0] is not None}
    out = {}
    for part, queue in due.items():
        available, coming, lead = shelf.get(part, (0, 0, None))
        available, coming = max(available or 0, 0), max(coming or 0, 0) if lead is not None else 0
        for place, (fails, name) in enumerate(sorted(queue), 1):
            arrives = None
            if place <= available:
                state = "covered"
            elif place <= available + coming:
                arrives = NOW.date() + timedelta(days=lead)
                state = "covered" if arrives <= fails.date() else "late"
            else:
                state = "short"
            out[name] = (part, fails, place, state, arrives)
    return out


def check_queue(spark, units, stock):
    found = replacement_queue(tables(spark, units, stock), AsOf.of(NOW)).collect()
    assert {r.component_id: (r.part_number, r.expected_failure, r.queue_place, r.supply, r.arrives_on) for r in found} \
        == brute_queue(units, stock)
    assert len(found) == len({r.component_id for r in found})
    return Counter(r.supply for r in found)


def working(k, part, days, kind="radar"):
    """Fails in so many days."""
    return unit(k, kind, None, False, part, 1000, NOW + timedelta(days=days, hours=-1000))


def test_stock_then_transit_then_short(spark):
    units = [working(k, "P1", days) for k, days in enumerate([-5, 3, 20, 30, 60, 89, 91])]
    assert check_queue(spark, units, [("P1", 2, 2, 25)]) == {"covered": 3, "late": 1, "short": 2}


def test_ties_unknown_parts_and_odd_stock(spark):
    units = [working(k, part, 10) for k, part in enumerate(["P1", "P1", "P1", "P2", "P3", "P3", "P4", None, None, "P5"])]
    stock = [("P1", 1, 1, 10), ("P2", -4, 1, 11), ("P3", None, 5, None), ("P5", 0, None, 3), (None, 9, 9, 1)]
    check_queue(spark, units, stock)


def test_ratio_of_failed_units_moves_the_failure(spark):
    units = [unit(k, "comm", 500 + k, True) for k in range(3)]
    units += [unit(10, "comm", None, False, "P1", 1000, NOW - timedelta(hours=500)), working(11, "P1", 200)]
    found = check_queue(spark, units, [("P1", 0, 0, 5)])
    assert sum(found.values()) == 1


def test_one_part_holds_a_third_of_all_units(spark):
    draw = random.Random(5)
    units = [working(k, "HOT" if k % 3 == 0 else f"P{k % 40}", draw.randrange(-2000, 100)) for k in range(900)]
    stock = [("HOT", 120, 60, 30), *[(f"P{k}", draw.randrange(-3, 9), draw.randrange(6), draw.randrange(60)) for k in range(0, 40, 2)]]
    check_queue(spark, units, stock)


def test_plan_never_gathers_a_part(spark):
    """Windows over units are by part and day; those by part alone are over a row for each day."""
    plan = replacement_queue(tables(spark, [working(1, "P1", 3)]), AsOf.of(NOW))._jdf.queryExecution().optimizedPlan().toString()
    whole_part = [line for line in plan.splitlines() if "Window [" in line and "__day" not in line.split("], [")[1]]
    assert all("__sum_" in line for line in whole_part)


def test_plan_never_deals_units_by_type(spark):
    """A handful of types would be a handful of tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = replacement_queue(tables(spark, [working(1, "P1", 3)]), AsOf.of(NOW))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "coalesce(__type" in plan
    assert not any("hashpartitioning(coalesce(component_type" in line for line in plan.splitlines())
