"""Semantic view of call records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dialect import datediff_boundary, safe_ratio, same_time_of_day_or_earlier
from ..operators.classify import CALLBACK_RANGES, DAY_SLOTS_4, DAY_SLOTS_6, WAIT_RANGES, bucketize, case, hour_slot
from .semantic import Measure, View, average, by_granularity, distinct, median, number, pick, ratio, timeframes, total

_DAY = 86400
REALTIME_SINCE = "2021-02-22"


def c(name: str) -> Column:
    return F.col(name)


def _inbound() -> Column:
    return c("initiation_method") == "INBOUND"


def call_outcome() -> Column:
    """Outcome of an inbound contact; the order of the rules matters."""
    inbound = _inbound()
    return case(
        [
            (inbound & c("is_handled"), "Handled Inbound"),
            (inbound & c("requested_callback"), "Requested Callback"),
            (inbound & ~c("requested_callback"), "Did Not Request Callback"),
            (inbound & c("hit_volume_threshold"), "Rejected, Volume Threshold"),
            (inbound & c("out_of_hours"), "Rejected, Out of Hours"),
            (inbound & c("rejected_queued"), "Rejected, Already Queued"),
            (c("is_abandoned"), "Call Abandoned"),
        ]
    )


def _abandoned(extra: Column | None = None) -> Column:
    api = (c("initiation_method") == "API") & ~c("is_handled") & (c("raw_ivr_outcome") == "pressed_1")
    direct = _inbound() & ~c("out_of_hours") & ~c("rejected_queued") & ~c("is_handled") & c("requested_callback").isNull()
    return (api | direct) if extra is None else ((api & extra) | (direct & extra))


def _in_service_level() -> Column:
    method = c("initiation_method")
    answered = method.isin("API", "INBOUND") & (c("wait_time") < 120) & c("agent_user_name").isNotNull()
    return answered | (_inbound() & (c("speed_to_callback") < 1800))


def _in_hours_volume() -> Column:
    late = c("out_of_hours")
    return _inbound() & (~late | (late & c("is_handled")) | (late & c("requested_callback")))


def _calls(cond=None) -> Measure:
    return distinct("contact_id", cond)


def _sum(name: str, div: int = 1) -> Measure:
    return total(lambda: c(name) if div == 1 else c(name) / div)


def _avg(name: str, div: int = _DAY) -> Measure:
    return average(lambda: c(name) / div)


def _minus(a: str, b: str) -> Measure:
    return number(lambda x, y: x - y, a, b)


def _per(num: str, den: str, div: int = 1) -> Measure:
    return number(lambda x, y: safe_ratio(x / div, y), num, den)


# PII checks: column stem -> stem of the measure names
_CHECKS = {
    "full_name": ("total_full_name_match", "total_full_name_mismatch", "full_name_mismatch_percentage"),
    "phone_number": ("total_phone_number_match", "total_phone_number_mismatch", "phone_number_mismatch_percentage"),
    "email": ("total_email_match_count", "total_email_mismatch_count", "email_mismatch_count_percentage"),
    "postal_code": ("total_postal_code_match_count", "total_postal_code_mismatch_count", "postal_code_mismatch_count_percentage"),
    "bank": ("total_bank_match_count", "total_bank_mismatch_count", "bank_mismatch_count_percentage"),
    "account_card": ("total_account_card_match_count", "total_account_card_mismatch_count", "account_card_mismatch_count_percentage"),
    "debit_card": ("total_debit_match_count", "total_debit_mismatch_count", "debit_mismatch_count_percentage"),
    "payments": ("total_payments_match_count", "total_payments_mismatch_count", "payments_mismatch_count_percentage"),
}

MEASURES: dict[str, Measure] = {
    # volumes
    "count_contact_id": _calls(),
    "case_count": distinct("case_id"),
    "dialouts": _calls(lambda: c("initiation_method") == "OUTBOUND"),
    "calls_offered": _calls(lambda: c("initiation_method").isin("API", "CALLBACK") | (_inbound() & c("callback_time").isNull())),
    "callbacks": _calls(lambda: c("requested_callback")),
    "inbound": _calls(_inbound),
    "inbound_rejected_out_of_hours": _calls(lambda: _inbound() & c("out_of_hours")),
    "handled_inbound": _calls(lambda: _inbound() & c("is_handled")),
    "rejected_volume_threshold_inbound": _calls(lambda: _inbound() & c("hit_volume_threshold")),
    "inbound_rejected_requested_callback": _calls(lambda: _inbound() & c("requested_callback")),
    "inbound_rejected_already_queued": _calls(lambda: _inbound() & c("rejected_queued")),
    "voicemail_calls": _calls(lambda: c("is_voicemail") | c("rejected_voicemail")),
    "unique_callers": distinct("customer_endpoint"),
    "unique_handled_callers": distinct("customer_endpoint", lambda: c("is_handled")),
    "unique_rejected_callers": distinct("customer_endpoint", lambda: c("rejected_queued")),
    "unique_callers_abandoned": distinct("customer_endpoint", lambda: c("is_abandoned")),
    "customer_callers": _calls(lambda: c("is_customer")),
    "non_customer_calls": _calls(lambda: ~c("is_customer")),
    "calls_abandoned": _calls(_abandoned),
    "calls_queued_abandoned": _calls(lambda: _abandoned(c("is_queued"))),
    "calls_handled": _calls(lambda: c("is_handled")),
    "calls_queued": _calls(lambda: c("is_queued")),
    "calls_routed": _minus("calls_offered", "calls_abandoned"),
    "calls_handled_in_realtime": _calls(
        lambda: _inbound() & c("is_handled") & (c("call_end_time") >= F.lit(REALTIME_SINCE).cast("timestamp_ntz"))
    ),
    "callbacks_handled": _calls(lambda: (c("initiation_method") == "CALLBACK") & c("is_handled")),
    "callbacks_requested": _calls(lambda: _inbound() & c("speed_to_callback").isNotNull()),
    # service level
    "inbound_hoops": _calls(_in_hours_volume),
    "short_abandons": _calls(
        lambda: c("is_abandoned") & ~c("is_queued") & c("speed_to_callback").isNull()
        & (datediff_boundary("second", "call_start_time", "call_end_time") <= 10)
    ),
    "in_service_level": _calls(_in_service_level),
    "total_calls_service_level": _minus("inbound_hoops", "short_abandons"),
    "service_level_percent": ratio("in_service_level", "total_calls_service_level"),
    "out_of_service_level": _minus("total_calls_service_level", "in_service_level"),
    "abandon_rate": number(
        lambda lost, short, hoops: safe_ratio(lost - short, hoops - short), "calls_abandoned", "short_abandons", "inbound_hoops"
    ),
    # handle, talk, wrap, wait, hold
    "total_handle_time": total(lambda: F.when(c("is_handled"), c("handle_time"))),
    "total_handle_time_hours": _sum("handle_time", _DAY),
    "avg_handle_time": _per("total_handle_time", "calls_handled", _DAY),
    "avg_raw_handle_time_seconds": _per("total_handle_time", "calls_handled"),
    "median_handle_time": median(lambda: c("handle_time") / _DAY),
    "total_talk_time": _sum("talk_time"),
    "total_talk_time_hours": _sum("talk_time", _DAY),
    "average_talk_time_hours": _avg("talk_time"),
    "total_wrap_time": _sum("wrap_time"),
    "total_wrap_time_hours": _sum("wrap_time", _DAY),
    "average_wrap_time_hours": _avg("wrap_time"),
    "average_raw_wrap_time_hours": _avg("wrap_time"),
    "average_raw_wrap_time_minutes": _avg("wrap_time", 60),
    "total_wait_time": _sum("wait_time"),
    "total_wait_time_hours": _sum("wait_time", _DAY),
    "average_wait_time_hours": _avg("wait_time"),
    "speed_to_answer_wait_time": total(lambda: F.when(c("is_handled") & _inbound(), c("wait_time"))),
    "avg_wait_calls_in_realtime": _per("speed_to_answer_wait_time", "calls_handled_in_realtime", _DAY),
    "total_speed_to_callback": _sum("speed_to_callback"),
    "avg_speed_to_callback": _avg("speed_to_callback"),
    "median_speed_to_callback": median(lambda: c("speed_to_callback") / _DAY),
    "avg_speed_to_answer": number(
        lambda wait, back, n, m: safe_ratio((wait + back) / _DAY, n + m),
        "speed_to_answer_wait_time", "total_speed_to_callback", "callbacks", "calls_handled_in_realtime",
    ),
    "total_speed_to_answer": number(lambda back, wait: back + wait, "total_speed_to_callback", "speed_to_answer_wait_time"),
    "total_hold_time": _sum("hold_time"),
    "total_hold_time_hours": _sum("hold_time", _DAY),
    "average_hold_time_hours": _avg("hold_time"),
    "average_hold_time_hours_raw": _avg("hold_time"),
    # ratio of sums, as the measure has no row to take the two times from
    "hold_time_percentage": ratio("total_hold_time", "__all_handle_time"),
    "__all_handle_time": _sum("handle_time"),
    "total_interaction_time": number(lambda talk, hold: talk + hold, "total_talk_time", "total_hold_time"),
    "avg_interaction_time": _per("total_interaction_time", "calls_handled", _DAY),
    "avg_interaction_time_raw_seconds": _per("total_interaction_time", "calls_handled"),
    "avg_raw_interaction_time_minutes": _per("total_interaction_time", "calls_handled", 60),
    "average_inbound_call_difference_seconds": _avg("inbound_call_difference_seconds"),
    # identity checks
    "total_pii_restart_count": _sum("voice_pii_restart_count"),
    "passed_calls": _calls(lambda: c("is_pii_passed")),
    "failed_calls": _calls(lambda: ~c("is_pii_passed")),
    "total_voice_pii_calls": _calls(lambda: c("is_pii_passed").isNotNull()),
    "voice_pii_pass_percentage": ratio("passed_calls", "total_voice_pii_calls"),
}
for _stem, (_match, _miss, _pct) in _CHECKS.items():
    MEASURES[_match] = _sum(f"{_stem}_match_count")
    MEASURES[_miss] = _sum(f"{_stem}_mismatch_count")
    MEASURES[_pct] = ratio(_miss, "total_voice_pii_calls")

# Volume parameter -> measure.
VOLUME_CHOICES = {
    "inbound": "inbound",
    "handled": "calls_handled",
    "callbacks_requested": "callbacks_requested",
    "unique_callers": "unique_callers",
    "unique_callers_handled": "unique_handled_callers",
}


def volume_measure(value: str) -> str:
    """Measure behind the volume parameter."""
    return pick(VOLUME_CHOICES, value)


def _flag(name: str):
    return lambda params: F.coalesce(c(name).cast("boolean"), F.lit(False))


DIMENSIONS = {
    **timeframes("call_start", "call_start_time"),
    **timeframes("call_end", "call_end_time"),
    "call_date_parameter": lambda params: by_granularity("call_start_time", params.get("date_granularity")),
    "queue_name": lambda params: c("queue_name"),
    "initiation_method": lambda params: c("initiation_method"),
    "wait_time_buckets": lambda params: bucketize("wait_time", WAIT_RANGES),
    "speed_to_callback_buckets": lambda params: bucketize("speed_to_callback", CALLBACK_RANGES),
    "time_slot": lambda params: hour_slot("call_start_time", DAY_SLOTS_4),
    "time_slot_2": lambda params: hour_slot("call_start_time", DAY_SLOTS_6),
    "call_outcome": lambda params: call_outcome(),
    "is_handled": _flag("is_handled"),
    "is_queued": _flag("is_queued"),
    "is_abandoned": _flag("is_abandoned"),
    "is_customer": _flag("is_customer"),
    "is_voicemail": _flag("is_voicemail"),
    "out_of_hours": _flag("out_of_hours"),
    "is_voice_pii": lambda params: c("is_pii_passed").isNotNull(),
    "hourly_comparison": lambda params: same_time_of_day_or_earlier(
        "call_start_time", F.lit(params["as_of"]).cast("timestamp_ntz"), int(params.get("shift_hours", 8))
    ),
}

CALLS_VIEW = View("calls", DIMENSIONS, MEASURES, {"call_details": ["contact_id", "queue_name", "call_outcome", "call_start_time"]})

# -- parameter testing view: calls of a fixed period with chosen dimension and measure --------------

_PARAM_MEASURES = {
    "total_talk_time": total(lambda: c("talk_time")),
    "average_talk_time": average(lambda: c("talk_time")),
    "total_cases": distinct("case_id"),
}
# Allowed values of the two field parameters.
FIELD_CHOICES = {"team_name": "team_name", "case_channel": "case_channel", "queue_name": "queue_name"}
JOINED_CHOICES = {"quick_text_name": "quick_text_name", "problem_tag": "problem_tag"}


def dynamic_measure(value: str | None) -> str:
    return pick({m: m for m in ("average_talk_time", "total_talk_time")}, value, "total_cases")


PARAMETER_VIEW = View(
    "call_parameters",
    {
        **timeframes("call_end", "call_end_time"),
        "call_end_parameter": lambda params: by_granularity("call_end_time", params.get("call_end_granularity")),
        "dimension_parameter": lambda params: c(pick(FIELD_CHOICES, params.get("dimension_granularity"))),
        # fields of a joined table, else the language of the case
        "dimension_parameter_2": lambda params: c(pick(JOINED_CHOICES, params.get("dimension_granularity_2"), "case_language")),
    },
    _PARAM_MEASURES,
)


def parameter_query(df, dims, params: Mapping):
    """The measure named by ``params["measure_granularity"]`` under one fixed column name."""
    name = dynamic_measure(params.get("measure_granularity"))
    return PARAMETER_VIEW.query(df, dims, [name], params=params).withColumnRenamed(name, "measure_parameter")
