"""Schemas of the published fact tables."""

from pyspark.sql.types import DecimalType

from ..sources.tables import schema

_NUMBER = DecimalType(38, 0)
_WHOLE = DecimalType(30, 0)
_TS = "timestamp_ntz"

HOURLY_QUEUE = schema(
    ("ts", _TS, "hour in UTC"),
    ("queue_id", "string", "queue"),
    ("team_name", "string", "team of the queue"),
    ("channel", "string", "channel of the queue"),
    ("business_unit_name", "string", "business unit of the queue"),
    ("entering_touches", _NUMBER, "touches that arrived in the hour"),
    ("handled_touches", _NUMBER, "touches handled in the hour"),
    ("response_time_min", _NUMBER, "response time, minutes"),
    ("handle_time_min", _NUMBER, "handle time, minutes"),
    ("touch_lifetime_min", _NUMBER, "assignment to end, minutes"),
    ("handled_backlog_touches", _NUMBER, "handled touches that were backlog"),
    ("touches_in_sla", _NUMBER, "touches answered within the target"),
    ("qualified_sla_touches", _NUMBER, "touches the target applies to"),
)

HOURLY_ADVOCATE = schema(
    ("ts", _TS, "hour in UTC"),
    ("employee_id", "string", "employee"),
    ("advocate_name", "string", "name at the time"),
    ("advocate_city", "string", "city at the time"),
    ("manager", "string", "manager at the time"),
    ("managers_manager", "string", "second-level manager at the time"),
    ("queue_id", "string", "queue"),
    ("team_name", "string", "team of the queue"),
    ("channel", "string", "channel of the queue"),
    ("business_unit_name", "string", "business unit of the queue"),
    ("handled_touches", _NUMBER, "touches handled in the hour"),
    ("response_time_min", _NUMBER, "response time, minutes"),
    ("handle_time_min", _NUMBER, "handle time, minutes"),
    ("touch_lifetime_min", _NUMBER, "assignment to end, minutes"),
    ("concurrency", _NUMBER, "lifetime over handle time"),
    ("handled_backlog_touches", _NUMBER, "handled touches that were backlog"),
    ("touches_in_sla", _NUMBER, "touches answered within the target"),
    ("qualified_sla_touches", _NUMBER, "touches the target applies to"),
)

HOURLY_ALERTS = schema(
    ("ts", _TS, "hour in UTC"),
    ("cases_created", _NUMBER, "cases created"),
    ("touches_in_sla", _NUMBER, "touches within the target"),
    ("qualified_sla_touches", _NUMBER, "touches the target applies to"),
    ("touch_sla_percent", "double", "touches_in_sla / qualified_sla_touches"),
    ("prev_hr_interval_touch_sla_pct", "double", "the same one hour earlier"),
    ("entering_touches", _NUMBER, "touches that arrived"),
    ("handled_touches", _NUMBER, "touches handled"),
    ("alert_touch_sla_dropped_10pct", "boolean", "fell by 10 points or more"),
    ("alert_12k_cases_created", "boolean", "more than 12000 cases"),
    ("alert_touch_sla_less_than_25pct", "boolean", "below 25 percent"),
)

CASE_QUEUES = schema(
    ("cq_hash_key", "string", "case and queue start"),
    ("source", "string", "system the case lives in"),
    ("case_id", "string", "case"),
    ("case_number", "string", "case number"),
    ("queue_id", "string", "queue the case is in"),
    ("queue_name", "string", "its name"),
    ("queue_type", "string", "CS, RISK, ..."),
    ("employee_id", "string", "employee who moved the case"),
    ("user_id", "string", "user who moved the case"),
    ("user_name", "string", "name of that user"),
    ("user_is_bot", "boolean", "moved by a bot"),
    ("transfer_reason", "string", "reason given"),
    ("transfer_comment", "string", "comment given"),
    ("queue_number", _WHOLE, "position in the life of the case"),
    ("queue_start_time", _TS, "entered the queue"),
    ("queue_end_time", _TS, "left the queue"),
)

CASE_TRANSFERS = schema(
    ("cq_hash_key", "string", "case and queue start"),
    ("source", "string", "system the case lives in"),
    ("case_id", "string", "case"),
    ("case_number", "string", "case number"),
    ("case_creation_date", "date", "day the case was created"),
    ("employee_id", "string", "employee who moved the case"),
    ("user_id", "string", "user who moved the case"),
    ("user_name", "string", "name of that user"),
    ("user_is_bot", "boolean", "moved by a bot"),
    ("queue_id", "string", "queue the case is in"),
    ("queue_number", _WHOLE, "position in the life of the case"),
    ("queue_name", "string", "its name"),
    ("first_time_in_queue", "string", "1 on the first visit of this queue"),
    ("queue_type", "string", "CS, RISK, ..."),
    ("trans_from_queue_type", "string", "kind of the queue before"),
    ("trans_team_type", "string", "internal or external move"),
    ("previous_trans_from_name", "string", "who made the move before"),
    ("previous_trans_from_user_id", "string", "user id of that"),
    ("previous_trans_from_queue_name", "string", "queue before"),
    ("previous_trans_from_queue_id", "string", "queue id before"),
    ("transfer_reason", "string", "reason given"),
    ("transfer_comment", "string", "comment given"),
    ("queue_start_time", _TS, "entered the queue"),
    ("queue_end_time", _TS, "left the queue"),
    ("time_in_queue_minutes", _WHOLE, "minutes in the queue"),
    ("case_life_till_queue", _WHOLE, "minutes in queues before this one"),
)
