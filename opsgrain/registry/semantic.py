"""Semantic views: every measure, dynamic fields, period comparison."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import call_view, case_view
from ..plans.semantic import Period, View, average, by_granularity, distinct, pick, pop_compare, timeframe, total
from ..sources.tables import load
from .base import CALLS, register, view, with_views

_PII = ("full_name", "phone_number", "email", "postal_code", "bank", "account_card", "debit_card", "payments")

CALLS_WIDE = view(
    "events",
    lambda d: [
        *CALLS.parts[0][1](d),
        f"case when {d.k} % 7 = 0 then {d.plus('ts', f'{d.k} * 30')} else null end as callback_time",
        f"case when {d.k} % 3 = 1 then null else {d.k} * 11 end as inbound_call_difference_seconds",
        f"{d.k} % 4 as voice_pii_restart_count", f"{d.k} % 29 = 0 as rejected_voicemail",
        *[f"{d.k} % {i + 2} as {n}_match_count" for i, n in enumerate(_PII)],
        *[f"case when {d.k} % 5 = 0 then null else {d.k} % {i + 3} end as {n}_mismatch_count" for i, n in enumerate(_PII)],
        "case when event_type in ('view', 'error') then 'team a' else 'team b' end as team_name", "event_type as case_channel",
        "case when event_id % 2 = 0 then 'en' else 'es' end as case_language", "'quick' as quick_text_name", "event_type as problem_tag",
    ],
)


def even(df: DataFrame, digits: int = 6) -> DataFrame:
    """Fractions rounded, decimals as doubles."""
    kinds = (T.DoubleType, T.DecimalType, T.FloatType)
    return df.withColumns(
        {f.name: F.round(F.col(f.name).cast("double"), digits) for f in df.schema.fields if isinstance(f.dataType, kinds)}
    )


# DuckDB text of every call measure; ``n`` counts distinct contacts, the rest is as written
def _n(cond: str, what: str = "contact_id") -> str:
    return f"count(DISTINCT CASE WHEN {cond} THEN {what} END)"


def _f(expr: str) -> str:
    return f"round(CAST({expr} AS double), 6)"


def _i(expr: str) -> str:
    return f"CAST({expr} AS bigint)"


_IN = "initiation_method = 'INBOUND'"
_SQL: dict[str, str] = {
    "count_contact_id": "count(DISTINCT contact_id)",
    "case_count": "count(DISTINCT case_id)",
    "dialouts": _n("initiation_method = 'OUTBOUND'"),
    "calls_offered": _n(f"initiation_method IN ('API', 'CALLBACK') OR ({_IN} AND callback_time IS NULL)"),
    "callbacks": _n("requested_callback"),
    "inbound": _n(_IN),
    "inbound_rejected_out_of_hours": _n(f"{_IN} AND out_of_hours"),
    "handled_inbound": _n(f"{_IN} AND is_handled"),
    "rejected_volume_threshold_inbound": _n(f"{_IN} AND hit_volume_threshold"),
    "inbound_rejected_requested_callback": _n(f"{_IN} AND requested_callback"),
    "inbound_rejected_already_queued": _n(f"{_IN} AND rejected_queued"),
    "voicemail_calls": _n("is_voicemail OR rejected_voicemail"),
    "unique_callers": "count(DISTINCT customer_endpoint)",
    "unique_handled_callers": _n("is_handled", "customer_endpoint"),
    "unique_rejected_callers": _n("rejected_queued", "customer_endpoint"),
    "unique_callers_abandoned": _n("is_abandoned", "customer_endpoint"),
    "customer_callers": _n("is_customer"),
    "non_customer_calls": _n("is_customer = false"),
    "calls_abandoned": "count(DISTINCT CASE WHEN initiation_method = 'API' AND is_handled = false AND raw_ivr_outcome = 'pressed_1' THEN contact_id"
    f" WHEN {_IN} AND out_of_hours = false AND rejected_queued = false AND is_handled = false AND requested_callback IS NULL THEN contact_id END)",
    "calls_queued_abandoned": "count(DISTINCT CASE WHEN initiation_method = 'API' AND is_handled = false AND is_queued AND raw_ivr_outcome = 'pressed_1' THEN contact_id"
    f" WHEN {_IN} AND out_of_hours = false AND rejected_queued = false AND is_handled = false AND is_queued AND requested_callback IS NULL THEN contact_id END)",
    "calls_handled": _n("is_handled"),
    "calls_queued": _n("is_queued"),
    "calls_routed": "calls_offered - calls_abandoned",
    "calls_handled_in_realtime": _n(f"{_IN} AND is_handled AND call_end_time >= TIMESTAMP '2021-02-22'"),
    "callbacks_handled": _n("initiation_method = 'CALLBACK' AND is_handled"),
    "callbacks_requested": _n(f"{_IN} AND speed_to_callback IS NOT NULL"),
    "inbound_hoops": f"count(DISTINCT CASE WHEN {_IN} AND NOT out_of_hours THEN contact_id WHEN {_IN} AND out_of_hours AND is_handled THEN contact_id"
    f" WHEN {_IN} AND out_of_hours AND requested_callback THEN contact_id END)",
    "short_abandons": _n("is_abandoned AND NOT is_queued AND speed_to_callback IS NULL AND date_diff('second', call_start_time, call_end_time) <= 10"),
    "in_service_level": "count(DISTINCT CASE WHEN initiation_method IN ('API', 'INBOUND') AND wait_time < 120 AND agent_user_name IS NOT NULL THEN contact_id"
    f" WHEN {_IN} AND speed_to_callback < 1800 THEN contact_id END)",
    "total_calls_service_level": "inbound_hoops - short_abandons",
    "service_level_percent": _f("in_service_level / nullif(inbound_hoops - short_abandons, 0)"),
    "out_of_service_level": "inbound_hoops - short_abandons - in_service_level",
    "abandon_rate": _f("(calls_abandoned - short_abandons) / nullif(inbound_hoops - short_abandons, 0)"),
    "total_handle_time": _i("sum(CASE WHEN is_handled THEN handle_time END)"),
    "total_handle_time_hours": _f("sum(handle_time / 86400)"),
    "avg_handle_time": _f("sum(CASE WHEN is_handled THEN handle_time END) / 86400 / nullif(calls_handled, 0)"),
    "avg_raw_handle_time_seconds": _f("sum(CASE WHEN is_handled THEN handle_time END) / nullif(calls_handled, 0)"),
    "median_handle_time": _f("median(handle_time / 86400)"),
    "total_talk_time": _i("sum(talk_time)"),
    "total_talk_time_hours": _f("sum(talk_time / 86400)"),
    "average_talk_time_hours": _f("avg(talk_time / 86400)"),
    "total_wrap_time": _i("sum(wrap_time)"),
    "total_wrap_time_hours": _f("sum(wrap_time / 86400)"),
    "average_wrap_time_hours": _f("avg(wrap_time / 86400)"),
    "average_raw_wrap_time_hours": _f("avg(wrap_time / 86400)"),
    "average_raw_wrap_time_minutes": _f("avg(wrap_time / 60)"),
    "total_wait_time": _i("sum(wait_time)"),
    "total_wait_time_hours": _f("sum(wait_time / 86400)"),
    "average_wait_time_hours": _f("avg(wait_time / 86400)"),
    "speed_to_answer_wait_time": _i(f"sum(CASE WHEN is_handled AND {_IN} THEN wait_time END)"),
    "avg_wait_calls_in_realtime": _f(f"sum(CASE WHEN is_handled AND {_IN} THEN wait_time END) / 86400 / nullif(calls_handled_in_realtime, 0)"),
    "total_speed_to_callback": _i("sum(speed_to_callback)"),
    "avg_speed_to_callback": _f("avg(speed_to_callback / 86400)"),
    "median_speed_to_callback": _f("median(speed_to_callback / 86400)"),
    "avg_speed_to_answer": _f(
        f"(sum(CASE WHEN is_handled AND {_IN} THEN wait_time END) + sum(speed_to_callback)) / 86400 / nullif(callbacks + calls_handled_in_realtime, 0)"
    ),
    "total_speed_to_answer": _i(f"sum(speed_to_callback) + sum(CASE WHEN is_handled AND {_IN} THEN wait_time END)"),
    "total_hold_time": _i("sum(hold_time)"),
    "total_hold_time_hours": _f("sum(hold_time / 86400)"),
    "average_hold_time_hours": _f("avg(hold_time / 86400)"),
    "average_hold_time_hours_raw": _f("avg(hold_time / 86400)"),
    "hold_time_percentage": _f("sum(hold_time) / nullif(sum(handle_time), 0)"),
    "total_interaction_time": _i("sum(talk_time) + sum(hold_time)"),
    "avg_interaction_time": _f("(sum(talk_time) + sum(hold_time)) / 86400 / nullif(calls_handled, 0)"),
    "avg_interaction_time_raw_seconds": _f("(sum(talk_time) + sum(hold_time)) / nullif(calls_handled, 0)"),
    "avg_raw_interaction_time_minutes": _f("(sum(talk_time) + sum(hold_time)) / 60 / nullif(calls_handled, 0)"),
    "average_inbound_call_difference_seconds": _f("avg(inbound_call_difference_seconds / 86400)"),
    "total_pii_restart_count": _i("sum(voice_pii_restart_count)"),
    "passed_calls": _n("is_pii_passed"),
    "failed_calls": _n("is_pii_passed = false"),
    "total_voice_pii_calls": _n("is_pii_passed IS NOT NULL"),
    "voice_pii_pass_percentage": _f("passed_calls / nullif(total_voice_pii_calls, 0)"),
}
for _stem, (_match, _miss, _pct) in call_view._CHECKS.items():
    _SQL[_match] = _i(f"sum({_stem}_match_count)")
    _SQL[_miss] = _i(f"sum({_stem}_mismatch_count)")
    _SQL[_pct] = _f(f"sum({_stem}_mismatch_count) / nullif(total_voice_pii_calls, 0)")

_ALL_CALLS = [m for m in call_view.MEASURES if not m.startswith("__")]
_CALL_LIST = ", ".join(f"{_SQL[m]} AS {m}" for m in _ALL_CALLS)


@register("call_measures", with_views(f"SELECT queue_name, {_CALL_LIST} FROM m GROUP BY queue_name", m=CALLS_WIDE))
def call_measures(spark, sf_dir):
    return even(call_view.CALLS_VIEW.query(CALLS_WIDE.spark(spark, sf_dir), ["queue_name"], _ALL_CALLS))


_OUTCOME = f"""CASE WHEN {_IN} AND is_handled THEN 'Handled Inbound' WHEN {_IN} AND requested_callback THEN 'Requested Callback'
  WHEN {_IN} AND requested_callback = false THEN 'Did Not Request Callback' WHEN {_IN} AND hit_volume_threshold THEN 'Rejected, Volume Threshold'
  WHEN {_IN} AND out_of_hours THEN 'Rejected, Out of Hours' WHEN {_IN} AND rejected_queued THEN 'Rejected, Already Queued' WHEN is_abandoned THEN 'Call Abandoned' END"""


@register(
    "call_outcome_measures",
    with_views(
        f"""
SELECT {_OUTCOME} AS call_outcome, strftime(date_trunc('week', call_start_time), '%Y-%m-%d') AS call_date_parameter, {_SQL['count_contact_id']} AS count_contact_id,
  {_SQL['calls_abandoned']} AS calls_abandoned, {_SQL['unique_callers']} AS unique_callers, {_SQL['median_handle_time']} AS median_handle_time
FROM m WHERE NOT out_of_hours GROUP BY 1, 2""",
        m=CALLS_WIDE,
    ),
)
def call_outcome_measures(spark, sf_dir):
    out = call_view.CALLS_VIEW.query(
        CALLS_WIDE.spark(spark, sf_dir), ["call_outcome", "call_date_parameter"],
        ["count_contact_id", "calls_abandoned", "unique_callers", "median_handle_time"],
        filters=[~F.col("out_of_hours")], params={"date_granularity": "Week"},
    )
    return even(out)


@register(
    "call_totals",
    with_views(f"SELECT {_SQL['inbound']} AS inbound, {_SQL['service_level_percent'].replace('in_service_level', _SQL['in_service_level']).replace('inbound_hoops', _SQL['inbound_hoops']).replace('short_abandons', _SQL['short_abandons'])} AS service_level_percent, {_SQL['unique_callers']} AS volume_parameter FROM m", m=CALLS_WIDE),
)
def call_totals(spark, sf_dir):
    name = call_view.volume_measure("unique_callers")
    out = call_view.CALLS_VIEW.query(CALLS_WIDE.spark(spark, sf_dir), [], ["inbound", "service_level_percent", name])
    return even(out.withColumnRenamed(name, "volume_parameter"))


@register(
    "call_clock_comparison",
    with_views(
        """SELECT strftime(ts8, '%H:%M:%S') <= '14:30:00' AS hourly_comparison, strftime(call_start_time, '%Y-%m-%d') AS call_start_date, count(DISTINCT contact_id) AS count_contact_id
FROM (SELECT *, call_start_time + INTERVAL 8 HOUR AS ts8 FROM m) GROUP BY 1, 2""",
        m=CALLS_WIDE,
    ),
)
def call_clock_comparison(spark, sf_dir):
    return call_view.CALLS_VIEW.query(
        CALLS_WIDE.spark(spark, sf_dir), ["hourly_comparison", "call_start_date"], ["count_contact_id"], params={"as_of": "2024-01-30 14:30:00"}
    )


@register(
    "dynamic_measure",
    with_views(
        """
SELECT case_channel AS dimension_parameter, case_language AS dimension_parameter_2, strftime(time_bucket(INTERVAL 30 MINUTE, call_end_time), '%Y-%m-%d %H:%M:%S') AS call_end_parameter,
  round(avg(talk_time), 6) AS measure_parameter FROM m WHERE call_end_time >= TIMESTAMP '2024-01-10' GROUP BY 1, 2, 3""",
        m=CALLS_WIDE,
    ),
)
def dynamic_measure(spark, sf_dir):
    from ..sources.tables import since

    calls = since(CALLS_WIDE.spark(spark, sf_dir), "call_end_time", "2024-01-10")
    params = {
        "dimension_granularity": "case_channel", "dimension_granularity_2": "case_language", "call_end_granularity": "minute30",
        "measure_granularity": "average_talk_time",
    }
    return even(call_view.parameter_query(calls, ["dimension_parameter", "dimension_parameter_2", "call_end_parameter"], params))


@register(
    "dynamic_measure_default",
    with_views("SELECT team_name AS dimension_parameter, count(DISTINCT case_id) AS measure_parameter FROM m GROUP BY 1", m=CALLS_WIDE),
)
def dynamic_measure_default(spark, sf_dir):
    return call_view.parameter_query(CALLS_WIDE.spark(spark, sf_dir), ["dimension_parameter"], {"dimension_granularity": "team_name"})


# -- support cases --------------------------------------------------------------------------------

CASES_WIDE = view(
    "orders",
    lambda d: [
        "o_orderkey - o_orderkey % 2 as case_id", f"concat('No ', cast(o_orderkey as {d.text})) as case_number", "o_custkey as customer_token",
        "o_orderdate as case_creation_date_time", f"{d.plus('o_orderdate', '90000')} as updated_date_time",
        f"case when o_orderkey % 6 = 0 then null else {d.plus('o_orderdate', 'o_orderkey % 90 * 3600')} end as last_resolved_date",
        "case when o_orderkey % 31 = 0 then null else cast(floor(o_totalprice * 3) as bigint) end as case_lifetime_seconds",
        "o_orderkey % 4 as transfer_count", "o_orderkey % 5 as outgoing_emails", "o_orderkey % 3 as incoming_emails",
        "case when o_orderkey % 4 = 1 then null else o_orderkey % 3000 end as email_first_response_mins",
        "case when o_orderkey % 7 = 0 then null else o_custkey % 50 end as banking_transaction_token",
        "case when o_orderkey % 4 = 1 then null when o_orderkey % 3 = 0 then 1 else 0 end as answered_in_sl",
        "case when o_orderkey % 8 = 0 then 'auto' else null end as auto_response_category", "case when o_orderkey % 16 = 0 then 'TRUE' else 'FALSE' end as auto_responder_only_case",
        "case when o_orderkey % 9 = 0 then null else o_orderkey % 6 end as touch_count", f"case when o_orderkey % 5 = 2 then {d.plus('o_orderdate', '100')} else null end as csat_sent_at",
        "case o_orderkey % 7 when 0 then 'Email' when 1 then 'Chat' when 2 then 'Phone' when 3 then 'Reddit' when 4 then 'Twitter' when 5 then 'Walk-in' else null end as origin",
        "case when o_orderkey % 3 = 0 then null else 'Desk' end as channel", f"concat('3.', cast(o_orderkey % 60 as {d.text}), '.0') as app_version",
        "o_orderpriority as problem_tag", "o_orderstatus as problem_type", "o_orderstatus as status",
    ],
)
_H = "case_lifetime_seconds / 3600"
_CASE_SQL = {
    "max_case_creation_date_time": "strftime(max(case_creation_date_time), '%Y-%m-%d %H:%M:%S')",
    "min_case_creation_date_time": "strftime(min(case_creation_date_time), '%Y-%m-%d %H:%M:%S')",
    "max_update_date_time": "strftime(max(updated_date_time), '%Y-%m-%d %H:%M:%S')",
    "min_update_date_time": "strftime(min(updated_date_time), '%Y-%m-%d %H:%M:%S')",
    "max_last_resolved_date_time": "strftime(max(last_resolved_date), '%Y-%m-%d %H:%M:%S')",
    "min_last_resolved_date_time": "strftime(min(last_resolved_date), '%Y-%m-%d %H:%M:%S')",
    "case_lifetime_hours": _f(f"sum({_H})"),
    "average_case_lifetime_hours": _f(f"sum({_H}) / nullif(count(case_id), 0)"),
    "average_case_lifetime": f"round(sum({_H}) / nullif(count(case_id), 0), 1)",
    "average_case_lifetime_days": _f("sum(round(case_lifetime_seconds / 3600 / 24)) / nullif(count(case_id), 0)"),
    "case_lifetime_hours_minimum": _f(f"min({_H})"),
    "case_lifetime_hours_maximum": _f(f"max({_H})"),
    "case_lifetime_hours_25_percentile": _f(f"quantile_cont({_H}, 0.25)"),
    "case_lifetime_hours_50_percentile": _f(f"quantile_cont({_H}, 0.5)"),
    "case_lifetime_hours_75_percentile": _f(f"quantile_cont({_H}, 0.75)"),
    "case_lifetime_hours_95_percentile": _f(f"quantile_cont({_H}, 0.95)"),
    "total_transfers": _i("sum(transfer_count)"),
    "total_outgoing_emails": _i("sum(outgoing_emails)"),
    "total_incoming_emails": _i("sum(incoming_emails)"),
    "email_response_time_minutes": _i("sum(email_first_response_mins)"),
    "email_response_time_hours": _f("sum(email_first_response_mins) / 60"),
    "count": "count(*)",
    "case_count": "count(DISTINCT case_id)",
    "customer_count": "count(DISTINCT customer_token)",
    "transaction_count": "count(DISTINCT banking_transaction_token)",
    "average_hours_to_first_email_response": _f("avg(email_first_response_mins / 60)"),
    "count_cases_first_response_in_24_hrs": _i("sum(answered_in_sl)"),
    "percent_first_response_in_24_hrs": _f("avg(answered_in_sl)"),
    "all_autoresponded_cases": _i("sum(CASE WHEN auto_response_category IS NOT NULL THEN 1 ELSE 0 END)"),
    "percent_cases_with_autoresponse": _f("sum(CASE WHEN auto_response_category IS NOT NULL THEN 1 ELSE 0 END) / nullif(count(DISTINCT case_id), 0)"),
    "sum_touches": _i("sum(touch_count)"),
    "touches_per_case": _f("sum(touch_count) / nullif(count(case_id), 0)"),
    "percent_total_cases": _f("count(DISTINCT case_id) / sum(count(DISTINCT case_id)) OVER ()"),
    "total_cases_with_csat_sent": "count(CASE WHEN csat_sent_at IS NOT NULL THEN case_id END)",
    "drill_fields_origin": "count(*)",
    "drill_fields_case_details": "count(*)",
    "drill_fields_problem_type": "count(*)",
    "drill_fields_problem_tag": "count(*)",
}
_ALL_CASES = [m for m in case_view.MEASURES if not m.startswith("__")]
_LABEL = "CASE WHEN origin = 'Email' THEN 'Email' WHEN origin = 'Chat' THEN 'Chat' WHEN origin = 'Phone' THEN 'Phone' WHEN origin IN ('Facebook', 'Twitter', 'Reddit', 'Instagram', 'TIKTOK') THEN 'Social' END"


@register(
    "case_measures",
    with_views(
        f"""SELECT {_LABEL} AS origin_custom_sort, CASE {_LABEL} WHEN 'Email' THEN 1 WHEN 'Chat' THEN 2 WHEN 'Phone' THEN 3 WHEN 'Social' THEN 4 END AS origin_sort_key,
  {', '.join(f'{_CASE_SQL[m]} AS {m}' for m in _ALL_CASES)} FROM m GROUP BY 1, 2""",
        m=CASES_WIDE,
    ),
)
def case_measures(spark, sf_dir):
    return even(case_view.CASES_VIEW.query(CASES_WIDE.spark(spark, sf_dir), ["origin_custom_sort", "origin_sort_key"], _ALL_CASES))


@register(
    "case_dimensions",
    with_views(
        """
SELECT coalesce(channel, origin) AS handled_by, CASE WHEN auto_responder_only_case = 'TRUE' THEN 'ar_only' WHEN auto_response_category IS NOT NULL AND touch_count IS NOT NULL THEN 'both'
    ELSE 'manual_only' END AS auto_responder_or_manual, app_version < '3.30.0' AS version_comparison, app_version >= '3.54.0' AS new_survey_type,
  CASE WHEN CAST(regexp_replace(case_number, '[^0-9.]', '', 'g') AS double) > 7000 THEN 'Yes' ELSE 'No' END AS pilot_started,
  strftime(date_trunc('quarter', case_creation_date_time), '%Y-%m-%d') AS created_date_parameter, strftime(date_trunc('month', last_resolved_date), '%Y-%m-%d') AS last_resolved_month,
  count(DISTINCT case_id) AS case_count FROM m GROUP BY 1, 2, 3, 4, 5, 6, 7""",
        m=CASES_WIDE,
    ),
)
def case_dimensions(spark, sf_dir):
    return case_view.CASES_VIEW.query(
        CASES_WIDE.spark(spark, sf_dir),
        ["handled_by", "auto_responder_or_manual", "version_comparison", "new_survey_type", "pilot_started", "created_date_parameter", "last_resolved_month"],
        ["case_count"],
        params={"version_comparison_picker": "Less Than", "version_comparison_number": "3.30.0", "pilot_case_number": 7000, "date_granularity": "Quarter"},
    )


@register(
    "case_detail_set",
    with_views("SELECT case_id, case_number, origin, channel, problem_tag, problem_type, status FROM m WHERE status = 'P'", m=CASES_WIDE),
)
def case_detail_set(spark, sf_dir):
    slim = View("cases", case_view.DIMENSIONS, case_view.MEASURES, {"slim": ["case_id", "case_number", "origin", "channel", "problem_tag", "problem_type", "status"]})
    return slim.detail(CASES_WIDE.spark(spark, sf_dir), "slim", filters=[F.col("status") == "P"])


# -- timeframes and periods -----------------------------------------------------------------------

EVENT_VIEW = View(
    "events",
    {"event_type": lambda params: F.col("event_type"), "dynamic": lambda params: F.col(pick({"kind": "event_type", "person": "user_id"}, params.get("by")))},
    {"events": distinct("event_id"), "people": distinct("user_id"), "cents": total(lambda: F.round(F.col("value") * 100).cast("bigint")), "mean": average(lambda: F.col("value"))},
)


@register(
    "timeframe_dimensions",
    """
SELECT event_id, strftime(ts, '%H:%M') AS time_of_day, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS minute15,
  strftime(time_bucket(INTERVAL 30 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS minute30, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, CAST(extract(hour FROM ts) AS int) AS hour_of_day,
  strftime(ts, '%Y-%m-%d') AS date, dayname(ts) AS day_of_week, CAST(isodow(ts) - 1 AS int) AS day_of_week_index, CAST(dayofyear(ts) AS int) AS day_of_year,
  strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, CAST(weekofyear(ts) AS int) AS week_of_year, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month,
  strftime(date_trunc('quarter', ts), '%Y-%m-%d') AS quarter, CAST(year(ts) AS int) AS year, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events""",
)
def timeframe_dimensions(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"]
    names = [
        "time", "time_of_day", "minute", "minute15", "minute30", "hour", "hour_of_day", "date", "day_of_week", "day_of_week_index", "day_of_year", "week",
        "week_of_year", "month", "quarter", "year",
    ]
    return events.select("event_id", *[timeframe("ts", n).alias(n) for n in names])


@register(
    "granularity_rollup",
    """
SELECT 'Week' AS grain, strftime(date_trunc('week', ts), '%Y-%m-%d') AS bucket, count(*) AS n FROM events GROUP BY 1, 2
UNION ALL SELECT 'Month', strftime(date_trunc('month', ts), '%Y-%m-%d'), count(*) FROM events GROUP BY 1, 2
UNION ALL SELECT 'other', strftime(CAST(ts AS date), '%Y-%m-%d'), count(*) FROM events GROUP BY 1, 2""",
)
def granularity_rollup(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"]
    out = None
    for grain in ("Week", "Month", "other"):
        part = events.groupBy(by_granularity("ts", grain).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(grain).alias("grain"), "bucket", "n")
        out = part if out is None else out.union(part)
    return out


PERIOD = Period.from_filter(date(2024, 1, 16), date(2024, 1, 23), datetime(2024, 1, 30, 10, 15, 0))
_POP = """
WITH p AS (
  SELECT *, CASE WHEN ts >= TIMESTAMP '2024-01-16 10:15:00' AND ts < TIMESTAMP '2024-01-23 10:15:00' THEN 'Current Period'
      WHEN ts >= TIMESTAMP '2024-01-09 10:15:00' AND ts < TIMESTAMP '2024-01-16 10:15:00' THEN 'Previous Period' ELSE 'Not In Range' END AS period,
    CASE WHEN ts BETWEEN TIMESTAMP '2024-01-16 10:15:00' AND TIMESTAMP '2024-01-23 10:15:00' THEN TIMESTAMP '2024-01-16 10:15:00'
      WHEN ts BETWEEN TIMESTAMP '2024-01-09 10:15:00' AND TIMESTAMP '2024-01-16 10:15:00' THEN TIMESTAMP '2024-01-09 10:15:00' END AS origin FROM events)
"""
_POP_MEASURES = "count(DISTINCT event_id) AS events, count(DISTINCT user_id) AS people, CAST(sum(CAST(round(value * 100) AS bigint)) AS bigint) AS cents, round(avg(value), 6) AS mean"


@register(
    "pop_compare",
    _POP
    + f"""SELECT strftime(CAST(TIMESTAMP '2024-01-16 10:15:00' AS date) + CAST(date_diff('day', origin, ts) AS int), '%Y-%m-%d') AS axis, period, event_type, {_POP_MEASURES}
FROM p WHERE period <> 'Not In Range' GROUP BY 1, 2, 3""",
)
def pop_compare_days(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"]
    return even(pop_compare(EVENT_VIEW, events, "ts", PERIOD, "Day", ["events", "people", "cents", "mean"], dims=["event_type"]))


@register(
    "pop_compare_half_hours",
    _POP
    + """SELECT strftime(time_bucket(INTERVAL 30 MINUTE, TIMESTAMP '2024-01-16 10:15:00' + to_minutes(CAST(date_diff('minute', origin, ts) - 30 AS int))), '%Y-%m-%d %H:%M:%S') AS axis, period,
  count(DISTINCT event_id) AS events FROM p WHERE period <> 'Not In Range' GROUP BY 1, 2""",
)
def pop_compare_half_hours(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"]
    return pop_compare(EVENT_VIEW, events, "ts", PERIOD, "minute30", ["events"])


@register(
    "pop_compare_hours",
    _POP
    + """SELECT strftime(date_trunc('hour', TIMESTAMP '2024-01-16 10:15:00' + to_hours(CAST(date_diff('hour', origin, ts) AS int))), '%Y-%m-%d %H:%M:%S') AS axis, period,
  count(DISTINCT event_id) AS events FROM p WHERE period <> 'Not In Range' GROUP BY 1, 2""",
)
def pop_compare_hours(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"]
    return pop_compare(EVENT_VIEW, events, "ts", PERIOD, "Hour", ["events"], exact=True)


_AT = datetime(2024, 1, 30, 5, 15, 0)
MODES = {
    "clock": Period.from_filter(date(2024, 1, 16), date(2024, 1, 23), _AT),
    "local_date": Period.from_filter(date(2024, 1, 16), date(2024, 1, 23), _AT, mode="local_date"),
    "rollover": Period.from_filter(date(2024, 1, 16), date(2024, 1, 23), _AT, mode="rollover"),
    "rollover_open": Period.from_filter(date(2024, 1, 16), None, _AT, mode="rollover"),
    "local_open": Period.from_filter(None, date(2024, 1, 23), _AT, mode="local_date"),
}


@register(
    "pop_bounds",
    """
WITH m(mode, a, b) AS (VALUES ('clock', TIMESTAMP '2024-01-16 05:15:00', TIMESTAMP '2024-01-23 05:15:00'), ('local_date', TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-22'),
  ('rollover', TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-23'), ('rollover_open', TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-30'), ('local_open', TIMESTAMP '1970-01-01', TIMESTAMP '2024-01-22'))
SELECT mode, CASE WHEN ts >= a AND ts < b THEN 'Current Period' WHEN ts >= a - (b - a) AND ts < a THEN 'Previous Period' ELSE 'Not In Range' END AS period,
  count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts FROM events, m GROUP BY 1, 2""",
)
def pop_bounds(spark, sf_dir):
    """The periods of a date filter in each mode, with open ends."""
    events = load(spark, sf_dir, "events")["events"]
    modes = F.array(*[F.struct(F.lit(n).alias("mode"), p.bucket("ts").alias("period")) for n, p in MODES.items()])
    rows = events.select("ts", F.explode(modes).alias("m"))
    return rows.groupBy("m.mode", "m.period").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register(
    "pop_labels",
    _POP
    + """SELECT period, CASE period WHEN 'Current Period' THEN '2024-01-16 10:15:00 to 2024-01-22' WHEN 'Previous Period' THEN '2024-01-09 to 2024-01-15' END AS label,
  date_diff('day', origin, ts) + 1 AS day_number, strftime(TIMESTAMP '2024-01-09 10:15:00' + to_days(CAST(date_diff('day', origin, ts) AS int)), '%Y-%m-%d %H:%M:%S') AS on_previous,
  count(*) AS n FROM p GROUP BY ALL""",
)
def pop_labels(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"]
    rows = events.select(
        PERIOD.bucket("ts").alias("period"), PERIOD.label("ts").alias("label"), PERIOD.position("ts").cast("bigint").alias("day_number"),
        PERIOD.aligned("ts", onto_previous=True).alias("on_previous"),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@register(
    "dynamic_dimension",
    "SELECT CAST(user_id AS varchar) AS dynamic, count(DISTINCT event_id) AS events FROM events GROUP BY 1",
)
def dynamic_dimension(spark, sf_dir):
    out = EVENT_VIEW.query(load(spark, sf_dir, "events")["events"], ["dynamic"], ["events"], params={"by": "person"})
    return out.withColumn("dynamic", F.col("dynamic").cast("string"))
