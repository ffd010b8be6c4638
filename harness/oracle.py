"""DuckDB statements for every registered query.

``MODELS`` holds named statements that refer to each other by name; ``_compose`` puts
those a query needs in front of it as common table expressions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from harness.mapping import AS_OF, raw_ctes
from harness.queries import AT_EMPTY_SITE, EMPTY_SITE, LANDS_IN, SITE, SITE_FILTERED, SKETCHED, STREAM_DELAY_DAYS
from watchpost.operators.detection import STAGES
from watchpost.plans.checks import ACCEPTED, KEYS, REFERENCES, REQUIRED
from watchpost.plans.star import MODEL_NAMES
from watchpost.sources.schemas import RAW_TABLES, staging_schema

NOW = f"timestamp '{AS_OF}'"
TODAY = f"date '{AS_OF[:10]}'"

_DUCK_TYPES = {"timestamp_ntz": "timestamp", "string": "varchar", "int": "integer"}


def _staging(name: str) -> str:
    columns = []
    for field in staging_schema(name):
        spark_type = field.dataType.simpleString()
        columns.append(f"cast({field.name} as {_DUCK_TYPES.get(spark_type, spark_type)}) as {field.name}")
    return f"select {', '.join(columns)} from {name}"


def _mean(value: str, where: str = "") -> str:
    """Mean by a sum of decimals, which does not depend on its order."""
    counted = f" filter ({where})" if where else ""
    return f"(sum(cast({value} as decimal(18,6))){counted}::double / nullif(count({value}){counted}, 0))"


MODELS: dict[str, str] = {
    **raw_ctes(),
    **{f"stg_{name}": _staging(name) for name in RAW_TABLES},
    "dim_site": """
        select s.*, count(t.tower_id) as tower_count,
          count(t.tower_id) filter (t.status = 'active') as active_tower_count,
          count(t.tower_id) filter (t.status = 'maintenance') as maintenance_tower_count
        from stg_sites s left join stg_towers t using (site_id)
        group by all
    """,
    "dim_tower": f"""
        select tower_id, model, firmware_version, status, deploy_date,
          date_diff('day', deploy_date, {TODAY}) as age_days,
          s.site_id, s.site_name, s.region, s.env
        from stg_towers t left join stg_sites s on s.site_id = t.site_id
    """,
    "fct_fleet_health_daily": f"""
        select h.tower_id, d.site_id, d.site_name, d.region, d.model, h.health_date,
          h.avg_cpu_pct, h.avg_mem_pct, h.avg_sensor_health, h.comms_uptime_pct,
          h.avg_power_watts, h.avg_ambient_temp_c, h.last_heartbeat_ts,
          coalesce(i.opened, 0) as incidents_opened, coalesce(i.critical, 0) as critical_incidents
        from (
          select tower_id, cast(ts as date) as health_date,
            round({_mean('cpu_pct')}, 2) as avg_cpu_pct, round({_mean('mem_pct')}, 2) as avg_mem_pct,
            round({_mean('sensor_health_score')}, 2) as avg_sensor_health,
            round({_mean('comms_uptime_min')} / 60.0::double * 100, 2) as comms_uptime_pct,
            round({_mean('power_watts')}, 2) as avg_power_watts,
            round({_mean('ambient_temp_c')}, 2) as avg_ambient_temp_c, max(ts) as last_heartbeat_ts
          from stg_telemetry group by 1, 2
        ) h
        left join (
          select tower_id, cast(opened_at as date) as health_date, count(*) as opened,
            count(*) filter (severity in ('P1', 'P2')) as critical
          from stg_incidents group by 1, 2
        ) i using (tower_id, health_date)
        left join dim_tower d on d.tower_id = h.tower_id
    """,
    "fct_deployment_status": f"""
        select p.deployment_id, p.tower_id, d.site_id, d.site_name, d.region, d.model,
          p.mission_name, p.start_ts, p.end_ts, p.status,
          date_diff('hour', p.start_ts, ifnull(p.end_ts, {NOW})) as duration_hours,
          date_diff('day', p.start_ts, ifnull(p.end_ts, {NOW})) as duration_days
        from stg_deployments p left join dim_tower d on d.tower_id = p.tower_id
    """,
    "fct_component_reliability": f"""
        select c.component_id, c.tower_id, d.site_id, d.site_name, d.region, d.model as tower_model,
          c.component_type, c.part_number, c.installed_at, c.failed_at, c.is_failed, c.mtbf_target_hours,
          date_diff('hour', c.installed_at, ifnull(c.failed_at, {NOW})) as observed_hours,
          round(date_diff('hour', c.installed_at, c.failed_at)::double / c.mtbf_target_hours, 3)
            as actual_vs_target_ratio
        from stg_components c left join dim_tower d on d.tower_id = c.tower_id
    """,
    "fct_inventory_status": """
        select part_number, description, category, on_hand, in_transit, allocated, available,
          reorder_point, ifnull(available < reorder_point, false) as needs_reorder,
          -- fixed values: stock levels
          case when available <= 0 then 'critical' when available < reorder_point then 'reorder'
            when available < reorder_point * 1.5 then 'watch' else 'healthy' end as stock_status,
          lead_time_days, last_updated
        from (select *, on_hand - allocated as available from stg_inventory)
    """,
    "fct_detection_events": """
        select e.detection_id, e.tower_id, d.site_id, d.site_name, d.region, d.model as tower_model,
          e.detected_at, cast(e.detected_at as date) as detection_date,
          hour(e.detected_at) as hour_of_day,
          -- fixed values: parts of the day
          case when hour(e.detected_at) between 5 and 7 then 'dawn'
            when hour(e.detected_at) between 8 and 17 then 'day'
            when hour(e.detected_at) between 18 and 20 then 'dusk'
            else 'night' end as time_of_day,
          e.target_class, e.confidence_score, e.bearing_deg, e.range_m,
          e.auto_resolved, e.escalated_to_operator, e.false_positive
        from stg_detections e left join dim_tower d on d.tower_id = e.tower_id
    """,
    "fct_alert_pipeline_latency": """
        select a.detection_id, e.tower_id, d.site_id, d.site_name, e.target_class, e.confidence_score,
          a.detection_ts, cast(a.detection_ts as date) as detection_date, a.is_overnight,
          a.detection_to_alert_s, a.alert_to_notify_s, a.notify_to_ack_s, a.ack_to_resolve_s,
          a.total_response_s, a.alert_generated_ts, a.operator_notified_ts, a.operator_ack_ts,
          a.resolved_ts
        from stg_alert_pipeline a
        join stg_detections e on e.detection_id = a.detection_id
        left join dim_tower d on d.tower_id = e.tower_id
    """,
    "known_incidents": """
        select i.*, d.site_id, d.site_name
        from stg_incidents i join dim_tower d on d.tower_id = i.tower_id
    """,
    "open_by_site": """
        select site_id, count(*) as open_incidents from known_incidents where closed_at is null group by 1
    """,
    "density": f"""
        select site_id, count(*) as dets_7d from fct_detection_events
        where detection_date >= {TODAY} - 7 group by 1
    """,
    "status_by_site": """
        select site_name, s.site_id, region, env, tower_count, active_tower_count,
          maintenance_tower_count, lat, lng, ifnull(open_incidents, 0) as open_incidents
        from dim_site s left join open_by_site o on o.site_id = s.site_id
    """,
    "mtbf": """
        select component_type, avg(mtbf_target_hours) as target_hours,
          avg(observed_hours) filter (is_failed) as actual_hours_when_failed,
          count(*) as installed, count(*) filter (is_failed) as failed
        from fct_component_reliability group by 1
    """,
    # Product-limit survival: units at risk by a running sum, survival by a running product.
    "survival_curve": """
        select component_type, age_hours, at_risk, failures, left_working,
          case when ended then 0.0::double else round(exp(sum(step) over earlier), 9) end as survival
        from (select *, failures = at_risk as ended,
            case when failures <> at_risk then ln((at_risk - failures)::double / at_risk) end as step
          from (select *, (sum(failures + left_working) over
              (partition by component_type order by age_hours desc rows unbounded preceding))::bigint as at_risk
            from (select component_type, observed_hours as age_hours,
                count(*) filter (ifnull(is_failed, false)) as failures,
                count(*) filter (not ifnull(is_failed, false)) as left_working
              from fct_component_reliability where observed_hours is not null group by 1, 2)))
        window earlier as (partition by component_type order by age_hours rows unbounded preceding)
    """,
    "life_ratios": f"""
        select component_type, round({_mean('actual_vs_target_ratio')}, 3) as life_ratio
        from fct_component_reliability where is_failed group by 1
    """,
    "readings": f"""
        select *, lag(ts) over (partition by tower_id order by ts) as before from (
          select tower_id, ts, count(*) as n from stg_telemetry
          where tower_id is not null and ts <= {NOW} group by 1, 2)
    """,
    # Detections with their batch, and the watermark that each batch meets and the last one leaves.
    "landed": f"""
        select *, {LANDS_IN} as batch, time_bucket(interval 6 hour, detected_at) as window_start
        from stg_detections where detected_at is not null
    """,
    "watermarks": f"""
        select batch, max(latest) over (order by batch rows between unbounded preceding and 1 preceding)
          - interval {STREAM_DELAY_DAYS} day as watermark, max(latest) over () - interval {STREAM_DELAY_DAYS} day as final
        from (select batch, max(detected_at) as latest from landed group by 1)
    """,
    "uptime_by_day": f"""
        select health_date, {_mean('comms_uptime_pct')} as uptime_pct,
          {_mean('avg_sensor_health')} as sensor_health
        from fct_fleet_health_daily group by 1
    """,
    "log_rows": """
        select run, 'build-' || lpad(cast(run as varchar), 8, '0') as generated_at,
          split_part(unique_id, '.', 1) as kind, split_part(unique_id, '.', -1) as name,
          status, round_even(execution_time, 3) as elapsed_s
        from log_steps
    """,
}


def _references(sql: str) -> list[str]:
    words = set(re.findall(r"\b\w+\b", re.sub(r"'[^']*'", "", sql)))
    return [name for name in MODELS if name in words]


def _compose(sql: str, models: Mapping[str, str] = MODELS) -> str:
    needed: dict[str, str] = {}

    def require(name: str) -> None:
        if name in needed:
            return
        for other in _references(models[name]):
            if other != name:
                require(other)
        needed[name] = models[name]

    for name in _references(sql):
        require(name)
    ctes = ",\n".join(f"{name} as ({body})" for name, body in needed.items())
    return f"with {ctes}\n{sql}" if ctes else sql


def _pct(flag: str) -> str:
    return f"round(avg({flag}::int) * 100, 1)"


CONFIDENCE = f"round({_mean('confidence_score')} * 100, 1)"


def _header(site: str | None) -> str:
    where = "" if site is None else f"and site_id = '{site}'"
    cutoff = f"{NOW} - interval 7 day"
    return f"""
        select n.*,
          -- fixed value: a change below 0.05 is not shown
          case when abs(uptime_7d - uptime_prev_7d) >= 0.05e0 then uptime_7d - uptime_prev_7d end as uptime_delta,
          case when abs(failed_components_30d - failed_components_prev_30d) >= 0.05e0
            then (failed_components_30d - failed_components_prev_30d)::double end as failures_delta,
          case when abs(open_incidents - inc_open_7d_ago) >= 0.05e0
            then (open_incidents - inc_open_7d_ago)::double end as incidents_delta
        from (
          select
            (select count(*) from dim_tower where status = 'active' {where}) as active_towers,
            (select count(*) from fct_deployment_status where status = 'active' {where})
              as active_deployments,
            (select count(*) from known_incidents where closed_at is null {where}) as open_incidents,
            (select count(*) from known_incidents
              where closed_at is null and severity in ('P1', 'P2') {where}) as critical_open,
            (select {_mean('comms_uptime_pct')} from fct_fleet_health_daily
              where health_date >= {TODAY} - 7 {where}) as uptime_7d,
            (select {_mean('comms_uptime_pct')} from fct_fleet_health_daily
              where health_date >= {TODAY} - 14 and health_date < {TODAY} - 7 {where}) as uptime_prev_7d,
            (select count(*) from fct_component_reliability
              where is_failed and failed_at >= {NOW} - interval 30 day {where}) as failed_components_30d,
            (select count(*) from fct_component_reliability
              where is_failed and failed_at >= {NOW} - interval 60 day
                and failed_at < {NOW} - interval 30 day {where}) as failed_components_prev_30d,
            (select count(*) from known_incidents where opened_at <= {cutoff}
              and (closed_at is null or closed_at > {cutoff}) {where}) as inc_open_7d_ago
        ) n
    """


def _stage_row(label: str, column: str) -> str:
    quantiles = ", ".join(
        f"round(quantile_cont({column}, {p}), 1) as {name}"
        for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
    )
    return f"""
        select '{label}' as stage, {quantiles}, round({_mean(column)}, 1) as avg_s
        from fct_alert_pipeline_latency
    """


def _union(rows: list[str]) -> str:
    return "\nunion all\n".join(rows)


def _freshness(sources: dict[str, str]) -> str:
    return _union(
        [f"select '{s}' as source, max({column}) as last_ts from stg_{s}" for s, column in sources.items()]
    )


def _not_null_rows() -> dict[tuple[str, str], str]:
    columns = [*KEYS.items(), *((m, c) for m, listed in REQUIRED.items() for c in listed)]
    return {(m, c): f"select count(*) - count({c}) as failures from {m}" for m, c in columns}


def _unique_rows() -> dict[tuple[str, str], str]:
    return {
        (m, c): f"""select count(*) as failures from
          (select {c} from {m} where {c} is not null group by {c} having count(*) > 1)"""
        for m, c in KEYS.items()
    }


def _accepted_rows() -> dict[tuple[str, str], str]:
    return {
        (m, c): f"""select count(distinct {c}) as failures from {m}
          where {c} not in ({', '.join(f"'{v}'" for v in values)})"""
        for (m, c), values in ACCEPTED.items()
    }


def _relationship_rows() -> dict[tuple[str, str], str]:
    return {
        (m, c): f"""select count(*) as failures from {m} child where child.{c} is not null
          and not exists (select 1 from {pm} parent where parent.{pc} = child.{c})"""
        for (m, c), (pm, pc) in REFERENCES.items()
    }


def _dq(rows: dict[tuple[str, str], str]) -> str:
    return _union(
        [f"select '{m}' as model, '{c}' as column_name, failures from ({sql})" for (m, c), sql in rows.items()]
    )


def _dq_all() -> str:
    kinds = {
        "not_null": _not_null_rows(),
        "unique": _unique_rows(),
        "accepted_values": _accepted_rows(),
        "relationships": _relationship_rows(),
    }
    rows = [f"select '{test}' as test, * from ({_dq(found)})" for test, found in kinds.items()]
    return f"select *, if(failures = 0, 'pass', 'fail') as status from ({_union(rows)})"


# Columns of the marts in their order, and all columns of doubles.
MART_COLUMNS = {
    "dim_site": """site_id site_name region env lat lng commissioned_date tower_count active_tower_count
        maintenance_tower_count""",
    "dim_tower": "tower_id model firmware_version status deploy_date age_days site_id site_name region env",
    "fct_fleet_health_daily": """tower_id site_id site_name region model health_date avg_cpu_pct avg_mem_pct
        avg_sensor_health comms_uptime_pct avg_power_watts avg_ambient_temp_c last_heartbeat_ts
        incidents_opened critical_incidents""",
    "fct_deployment_status": """deployment_id tower_id site_id site_name region model mission_name start_ts
        end_ts status duration_hours duration_days""",
    "fct_component_reliability": """component_id tower_id site_id site_name region tower_model component_type
        part_number installed_at failed_at is_failed mtbf_target_hours observed_hours
        actual_vs_target_ratio""",
    "fct_inventory_status": """part_number description category on_hand in_transit allocated available
        reorder_point needs_reorder stock_status lead_time_days last_updated""",
    "fct_detection_events": """detection_id tower_id site_id site_name region tower_model detected_at
        detection_date hour_of_day time_of_day target_class confidence_score bearing_deg range_m
        auto_resolved escalated_to_operator false_positive""",
    "fct_alert_pipeline_latency": """detection_id tower_id site_id site_name target_class confidence_score
        detection_ts detection_date is_overnight detection_to_alert_s alert_to_notify_s notify_to_ack_s
        ack_to_resolve_s total_response_s alert_generated_ts operator_notified_ts operator_ack_ts
        resolved_ts""",
}
DOUBLES = set(
    """lat lng avg_cpu_pct avg_mem_pct avg_sensor_health comms_uptime_pct avg_power_watts avg_ambient_temp_c
    actual_vs_target_ratio confidence_score bearing_deg detection_to_alert_s alert_to_notify_s
    notify_to_ack_s ack_to_resolve_s total_response_s""".split()
)
DOUBLES |= {f.name for t in RAW_TABLES for f in staging_schema(t) if f.dataType.simpleString() == "double"}


def _columns(model: str) -> list[str]:
    if model in MART_COLUMNS:
        return MART_COLUMNS[model].split()
    return staging_schema(model.removeprefix("stg_")).fieldNames()


def _counted(model: str) -> str:
    """Rows, and the sum of a hash of each row's values in the model's order."""
    values = []
    for name in _columns(model):
        value = f"cast({name} as decimal(18,6))" if name in DOUBLES else name
        values.append(f"coalesce(cast({value} as varchar), '~')")
    row = f"md5(concat_ws('|', {', '.join(values)}))"
    return f"""select '{model}' as model, count(*) as row_count,
      coalesce(sum(cast('0x' || substr({row}, 1, 8) as bigint)), 0)::bigint as checksum from {model}"""


def _sketched(name: str, first: str | None, site: str | None) -> str:
    """Every answer is within the declared error of its rank."""
    where = [f"detection_date >= date '{first}'"] * bool(first) + [f"site_id = '{site}'"] * bool(site)
    return _union(
        [
            f"""select '{name}' as days, '{label}' as stage, count(*) as n, true as p50_right, true as p95_right,
            true as p99_right from fct_alert_pipeline_latency
            where {" and ".join([f"{column} is not null", *where])} having count(*) > 0"""
            for label, column in STAGES.items()
        ]
    )


_STATEMENTS: dict[str, str] = {
    **{name: f"select * from {name}" for name in MODEL_NAMES},
    "materialize_roundtrip": _union([_counted(name) for name in MODEL_NAMES]),
    "rule_auto_resolve": """
        select detection_id, target_class, confidence_score,
          -- fixed values: threshold, and the class that is never resolved
          confidence_score >= 0.85e0 and target_class <> 'unknown' as auto_resolved,
          not (confidence_score >= 0.85e0 and target_class <> 'unknown') as escalated_to_operator
        from stg_detections
    """,
    "rule_overnight": """
        -- fixed values: the night shift
        select detection_id, detection_ts, hour(detection_ts) >= 22 or hour(detection_ts) < 6 as is_overnight
        from stg_alert_pipeline
    """,
    "escalation_queue": """
        select detection_id, tower_id, detected_at, target_class, confidence_score
        from stg_detections where escalated_to_operator
    """,
    "escalation_gaps": """
        select coalesce(q.detection_id, a.detection_id) as detection_id,
          if(a.detection_id is null, 'no alert', 'not escalated') as problem
        from (select detection_id from stg_detections where escalated_to_operator) q
        full join stg_alert_pipeline a on a.detection_id = q.detection_id
        where q.detection_id is null or a.detection_id is null
    """,
    "stage_latencies_from_ts": """
        select detection_id,
          round_even(date_diff('microsecond', detection_ts, alert_generated_ts) / 1e6, 1)
            as detection_to_alert_s,
          round_even(date_diff('microsecond', alert_generated_ts, operator_notified_ts) / 1e6, 1)
            as alert_to_notify_s,
          round_even(date_diff('microsecond', operator_notified_ts, operator_ack_ts) / 1e6, 1)
            as notify_to_ack_s,
          round_even(date_diff('microsecond', operator_ack_ts, resolved_ts) / 1e6, 1) as ack_to_resolve_s,
          round_even(date_diff('microsecond', detection_ts, resolved_ts) / 1e6, 1) as total_response_s
        from stg_alert_pipeline
    """,
    "latest_deployment_per_tower": """
        select p.tower_id, p.deployment_id, p.mission_name, p.start_ts, p.end_ts, p.status
        from stg_deployments p join stg_towers t on t.tower_id = p.tower_id and t.status = 'active'
        qualify row_number() over (partition by p.tower_id order by start_ts desc, deployment_id desc) = 1
    """,
    "site_filtered_kpis": _header(SITE),
    "site_options": """
        select site_id, site_name, region, site_name || '  ·  ' || site_id as label
        from dim_site order by site_name, site_id
    """,
    "last_telemetry": "select max(ts) as last_telemetry_ts from stg_telemetry",
    "kpi_active_towers": "select count(*) as active_towers from dim_tower where status = 'active'",
    "kpi_active_deployments": """
        select count(*) as active_deployments from fct_deployment_status where status = 'active'
    """,
    "kpi_open_incidents": """
        select count(*) as open_incidents, count(*) filter (severity in ('P1', 'P2')) as critical_open
        from known_incidents where closed_at is null
    """,
    "kpi_uptime": f"""
        select {_mean('comms_uptime_pct', f'health_date >= {TODAY} - 7')} as uptime_7d,
          {_mean('comms_uptime_pct', f'health_date >= {TODAY} - 14 and health_date < {TODAY} - 7')}
            as uptime_prev_7d
        from fct_fleet_health_daily
    """,
    "kpi_failures": f"""
        select count(*) filter (failed_at >= {NOW} - interval 30 day) as failed_components_30d,
          count(*) filter (failed_at >= {NOW} - interval 60 day and failed_at < {NOW} - interval 30 day)
            as failed_components_prev_30d
        from fct_component_reliability where is_failed
    """,
    "kpi_backlog_7d_ago": f"""
        select count(*) as inc_open_7d_ago from known_incidents
        where opened_at <= {NOW} - interval 7 day
          and (closed_at is null or closed_at > {NOW} - interval 7 day)
    """,
    "kpi_header": _header(None),
    "site_status": "select * from status_by_site order by tower_count desc, site_id",
    "det_density": "select * from density",
    "site_status_density": """
        select s.*, ifnull(dets_7d, 0) as dets_7d,
          case when active_tower_count = 0 then 0.0
            else round_even(ifnull(dets_7d, 0)::double / active_tower_count, 1) end::double
            as dets_per_active_tower
        from status_by_site s left join density d on d.site_id = s.site_id
        order by tower_count desc, s.site_id
    """,
    "active_missions": """
        select deployment_id, mission_name, tower_id, site_name, start_ts as deployed,
          duration_days as days_on_station
        from fct_deployment_status where status = 'active'
        order by start_ts desc, deployment_id limit 25
    """,
    "open_incidents": f"""
        select incident_id, severity, category, tower_id, site_name, opened_at,
          date_diff('hour', opened_at, {NOW}) as age_hours, root_cause
        from known_incidents where closed_at is null
        order by ifnull(list_position(['P1', 'P2', 'P3'], severity), 4), opened_at, incident_id limit 25
    """,
    "low_inventory": """
        select part_number, description, category, on_hand, allocated, available, reorder_point,
          stock_status, lead_time_days
        from fct_inventory_status where stock_status <> 'healthy'
    """,
    "det_kpi": f"""
        select *, dets_7d - dets_prev_7d as dets_delta from (
          select count(*) as total_dets, count(*) filter (detection_date >= {TODAY} - 7) as dets_7d,
            count(*) filter (detection_date >= {TODAY} - 14 and detection_date < {TODAY} - 7)
              as dets_prev_7d,
            {_pct('auto_resolved')} as auto_resolve_pct,
            {_pct('escalated_to_operator')} as escalation_pct,
            {_pct('false_positive')} as fp_pct, {CONFIDENCE} as avg_confidence
          from fct_detection_events)
    """,
    "latency_overall": """
        select round(q[1], 0) as p50, round(q[2], 0) as p95, round(q[3], 0) as p99
        from (select quantile_cont(total_response_s, [0.5, 0.95, 0.99]) as q from fct_alert_pipeline_latency)
    """,
    "det_volume": """
        select detection_date, target_class, count(*) as detections from fct_detection_events group by 1, 2
    """,
    "det_breakdown": f"""
        select target_class, count(*) as detections, {CONFIDENCE} as avg_confidence_pct,
          {_pct('false_positive')} as fp_rate_pct
        from fct_detection_events group by 1
    """,
    "det_hourly": f"""
        select hour_of_day, count(*) as detections, {_pct('escalated_to_operator')} as escalation_pct
        from fct_detection_events group by 1
    """,
    "latency_by_stage": _union([_stage_row(label, column) for label, column in STAGES.items()]),
    "tower_detection_summary": f"""
        select tower_id, site_name, count(*) as detections, {_pct('auto_resolved')} as auto_resolve_pct,
          {_pct('escalated_to_operator')} as escalation_pct, {_pct('false_positive')} as fp_rate_pct,
          {CONFIDENCE} as avg_confidence_pct
        from fct_detection_events group by 1, 2
        order by escalation_pct desc, tower_id, site_name limit 30
    """,
    "mtbf_by_subsystem": f"""
        select component_type, target_hours, actual_hours_when_failed, installed, failed,
          round_even(failed::double / installed * 100, 1) as failure_rate_pct
        from mtbf order by component_type
    """,
    "mtbf_long": """
        select component_type, 'Target' as metric, target_hours as hours from mtbf
        union all
        select component_type, 'Observed at failure', actual_hours_when_failed from mtbf
    """,
    "uptime_trend": f"""
        select health_date, uptime_pct, sensor_health from uptime_by_day
    """,
    "uptime_long": """
        select health_date, 'Comms uptime %' as metric, uptime_pct as value from uptime_by_day
        union all
        select health_date, 'Sensor health score', sensor_health from uptime_by_day
    """,
    "incidents_by_category": f"""
        select category, severity, count(*) as incidents from known_incidents
        where opened_at >= {NOW} - interval 30 day group by 1, 2
    """,
    "top_root_causes": """
        select root_cause, category, count(*) as incidents from known_incidents group by 1, 2
        order by incidents desc, root_cause, category limit 10
    """,
    "tower_state_at_detection": """
        select d.detection_id, d.tower_id, d.detected_at, t.ts as reading_ts, t.cpu_pct, t.mem_pct,
          t.sensor_health_score, t.comms_uptime_min, t.power_watts, t.ambient_temp_c,
          date_diff('microsecond', t.ts, d.detected_at) // 1000000 as reading_age_s
        from stg_detections d asof left join (
          select * from stg_telemetry where tower_id is not null and ts is not null
          qualify row_number() over (partition by tower_id, ts order by cpu_pct desc nulls last,
            mem_pct desc nulls last, sensor_health_score desc nulls last, comms_uptime_min desc nulls last,
            power_watts desc nulls last, ambient_temp_c desc nulls last) = 1) t
        on d.tower_id = t.tower_id and d.detected_at >= t.ts
    """,
    "missions_at_detection": f"""
        select d.detection_id, d.tower_id, d.detected_at, count(p.deployment_id) as missions,
          arg_max(p.deployment_id, (p.start_ts, p.deployment_id)) as deployment_id,
          arg_max(p.mission_name, (p.start_ts, p.deployment_id)) as mission_name, max(p.start_ts) as mission_start_ts
        from stg_detections d left join stg_deployments p
        on p.tower_id = d.tower_id and p.start_ts <= d.detected_at
          and case when p.end_ts is null then d.detected_at <= {NOW} else d.detected_at < p.end_ts end
        group by 1, 2, 3
    """,
    "telemetry_outages": f"""
        select *, round_even(date_diff('microsecond', silent_from, ifnull(silent_to, {NOW})) / 1e6 / 36, 0) / 100
          as hours
        from (
          select tower_id, before as silent_from, ts as silent_to from readings
          where ts - before > interval 6 hour
          union all
          select tower_id, max(ts), null from readings group by 1 having {NOW} - max(ts) > interval 6 hour)
    """,
    "telemetry_sessions": """
        select tower_id, session, min(ts) as begin_ts, max(ts) as end_ts, sum(n)::bigint as readings
        from (select *, (sum(case when before is null or ts - before > interval 6 hour then 1 else 0 end)
            over (partition by tower_id order by ts))::bigint as session
          from readings)
        group by 1, 2
    """,
    "backlog_by_day": f"""
        select cast(cutoff as date) as day, count(i.incident_id) as open_incidents
        from (select unnest(generate_series({NOW} - interval 90 day, {NOW}, interval 1 day)) as cutoff)
        left join known_incidents i on i.opened_at <= cutoff and (i.closed_at is null or i.closed_at > cutoff)
        group by cutoff
    """,
    "detection_kpis_by_level": f"""
        select *, dets_7d - dets_prev_7d as dets_delta from (
          select case grouping(region, site_id) when 0 then 'site' when 1 then 'region' else 'fleet' end as level,
            region, site_id, count(*) as total_dets,
            count(*) filter (detection_date >= {TODAY} - 7) as dets_7d,
            count(*) filter (detection_date >= {TODAY} - 14 and detection_date < {TODAY} - 7) as dets_prev_7d,
            {_pct('auto_resolved')} as auto_resolve_pct,
            {_pct('escalated_to_operator')} as escalation_pct,
            {_pct('false_positive')} as fp_pct, {CONFIDENCE} as avg_confidence
          from fct_detection_events group by rollup (region, site_id))
    """,
    "health_by_batches": "select * from fct_fleet_health_daily",
    "sketched_percentiles": _union([_sketched(*given) for given in SKETCHED]),
    "detection_windows": """
        select window_start, window_start + interval 6 hour as window_end, target_class, count(*) as detections,
          count(*) filter (escalated_to_operator) as escalations,
          count(*) filter (false_positive) as false_positives,
          sum(cast(confidence_score as decimal(18,6)))::double as confidence_sum
        from landed join watermarks using (batch)
        where ifnull(window_start + interval 6 hour > watermark, true)
          and window_start + interval 6 hour <= final
        group by 1, 2, 3
    """,
    "component_survival": "select * from survival_curve",
    "remaining_life": """
        select c.component_type, c.age_hours, c.at_risk, c.failures, c.left_working, c.survival,
          case when survival > 0 then (select min(h.age_hours) from survival_curve h
            where h.component_type is not distinct from c.component_type and h.failures > 0
              and h.survival <= c.survival / 2 + 5e-10) - c.age_hours end as median_remaining_hours,
          case when survival > 0 then round(area / survival, 1) end as expected_remaining_hours
        from (select *, sum(survival * (next_age - age_hours)) over
            (partition by component_type order by age_hours desc rows unbounded preceding) as area
          from (select *, lead(age_hours, 1, age_hours) over
              (partition by component_type order by age_hours) as next_age
            from survival_curve)) c
    """,
    "replacement_queue": f"""
        select component_id, tower_id, component_type, part_number, expected_failure, queue_place,
          case when queue_place <= stock then 'covered'
            when queue_place <= stock + coming and arrival <= cast(expected_failure as date) then 'covered'
            when queue_place <= stock + coming then 'late' else 'short' end as supply,
          case when queue_place > stock and queue_place <= stock + coming then arrival end as arrives_on
        from (
          select u.*, greatest(ifnull(i.available, 0), 0) as stock,
            case when i.lead_time_days is null then 0 else greatest(ifnull(i.in_transit, 0), 0) end as coming,
            {TODAY} + i.lead_time_days::int as arrival,
            row_number() over (partition by u.part_number order by expected_failure, component_id) as queue_place
          from (
            select c.component_id, c.tower_id, c.component_type, c.part_number,
              installed_at + to_hours(floor(mtbf_target_hours * ifnull(life_ratio, 1.0::double))::int)
                as expected_failure
            from fct_component_reliability c
            left join life_ratios r on r.component_type is not distinct from c.component_type
            where not ifnull(is_failed, false) and installed_at is not null) u
          left join fct_inventory_status i on i.part_number = u.part_number
          where expected_failure <= {NOW} + interval 90 day)
    """,
    "source_freshness": f"""
        select source, last_ts, date_diff('minute', last_ts, {NOW}) as age_minutes from (
          {_freshness({'telemetry': 'ts', 'incidents': 'opened_at', 'deployments': 'start_ts',
                       'inventory': 'last_updated'})})
    """,
    "freshness_status": f"""
        select source, last_ts, age_hours,
          case when age_hours <= 6 then 'pass' when age_hours <= 24 then 'warn' else 'error' end as status
        from (select *, epoch({NOW} - last_ts) / 3600::double as age_hours from (
          {_freshness({'telemetry': 'ts', 'detections': 'detected_at', 'alert_pipeline': 'detection_ts'})}))
    """,
    "run_log_steps": "select generated_at, kind, name, status, elapsed_s from log_rows",
    "run_log_files": "select generated_at, kind, name, status, elapsed_s from log_rows",
    "run_log_summary": f"""
        select kind, count(*) as steps, count(*) filter (status in ('pass', 'success')) as passed,
          count(*) filter (status is null or status not in ('pass', 'success', 'skipped')) as failed,
          round_even({_mean('elapsed_s')}, 3) as avg_s
        from log_rows group by 1
    """,
    "pipeline_status": """
        select if(n_total = n_passed, 'ok', 'fail') as status,
          if(n_total = n_passed, 'ok', 'failed') as detail,
          n_total, n_passed, n_failed, elapsed_s, generated_at
        from (
          select generated_at, run % 100 / 8.0e0 as elapsed_s, count(*) as n_total,
            count(*) filter (status in ('pass', 'success')) as n_passed,
            count(*) filter (status is null or status not in ('pass', 'success', 'skipped')) as n_failed
          from log_rows group by 1, 2)
    """,
    "dq_not_null": _dq(_not_null_rows()),
    "dq_unique": _dq(_unique_rows()),
    "dq_accepted_values": _dq(_accepted_rows()),
    "dq_relationships": _dq(_relationship_rows()),
    "dq_suite": _dq_all(),
    "empty_site_kpis": _header(EMPTY_SITE),
}

# Models whose rows a site filter cuts; all others of a statement stay whole.
_SITED = (
    "dim_site",
    "known_incidents",
    "fct_fleet_health_daily",
    "fct_deployment_status",
    "fct_component_reliability",
    "fct_detection_events",
    "fct_alert_pipeline_latency",
)


def _at(site: str, sql: str) -> str:
    """The statement over the models of one site."""
    models = {name: MODELS[name] for name in MODELS}
    for name in _SITED:
        models[name] = f"select * from ({MODELS[name]}) whole where site_id = '{site}'"
    return _compose(sql, models)


ORACLE_SITES: dict[str, str] = {
    **{f"{name}_at_site": _at(SITE, _STATEMENTS[name]) for name in SITE_FILTERED},
    **{f"{name}_at_empty_site": _at(EMPTY_SITE, _STATEMENTS[name]) for name in AT_EMPTY_SITE},
}

ORACLE_SQL: dict[str, str] = {name: _compose(sql) for name, sql in _STATEMENTS.items()} | ORACLE_SITES
