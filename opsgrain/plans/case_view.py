"""Semantic view of support cases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dialect import compare, digits_number
from ..operators.classify import LIFETIME_RANGES, bucketize, case
from .semantic import (
    Measure, View, average, by_granularity, distinct, highest, lowest, number, percentile, ratio, rows, share, timeframes, total,
)


def c(name: str) -> Column:
    return F.col(name)


def _hours() -> Column:
    return c("case_lifetime_seconds") / 3600


def lifetime_days() -> Column:
    return F.round(c("case_lifetime_seconds") / 3600 / 24)


def lifetime_minutes() -> Column:
    return F.round(c("case_lifetime_seconds") / 60)


def auto_response_group() -> Column:
    return F.when(c("auto_response_category").isNotNull(), 1).otherwise(0)


def _id_rows() -> Column:
    return F.when(c("case_id").isNotNull(), 1).otherwise(0)


MEASURES: dict[str, Measure] = {
    "max_case_creation_date_time": highest(lambda: c("case_creation_date_time")),
    "min_case_creation_date_time": lowest(lambda: c("case_creation_date_time")),
    "max_update_date_time": highest(lambda: c("updated_date_time")),
    "min_update_date_time": lowest(lambda: c("updated_date_time")),
    "max_last_resolved_date_time": highest(lambda: c("last_resolved_date")),
    "min_last_resolved_date_time": lowest(lambda: c("last_resolved_date")),
    "__case_rows": total(_id_rows),
    "__lifetime_days": total(lifetime_days),
    "case_lifetime_hours": total(_hours),
    "average_case_lifetime_hours": ratio("case_lifetime_hours", "__case_rows"),
    "average_case_lifetime": number(lambda h: F.round(h, 1), "average_case_lifetime_hours"),
    "average_case_lifetime_days": ratio("__lifetime_days", "__case_rows"),
    "case_lifetime_hours_minimum": lowest(_hours),
    "case_lifetime_hours_maximum": highest(_hours),
    "case_lifetime_hours_25_percentile": percentile(_hours, 0.25),
    "case_lifetime_hours_50_percentile": percentile(_hours, 0.50),
    "case_lifetime_hours_75_percentile": percentile(_hours, 0.75),
    "case_lifetime_hours_95_percentile": percentile(_hours, 0.95),
    "total_transfers": total(lambda: c("transfer_count")),
    "total_outgoing_emails": total(lambda: c("outgoing_emails")),
    "total_incoming_emails": total(lambda: c("incoming_emails")),
    "email_response_time_minutes": total(lambda: c("email_first_response_mins")),
    "email_response_time_hours": number(lambda m: m / 60, "email_response_time_minutes"),
    "count": rows(),
    "case_count": distinct("case_id"),
    "customer_count": distinct("customer_token"),
    "transaction_count": distinct("banking_transaction_token"),
    "average_hours_to_first_email_response": average(lambda: c("email_first_response_mins") / 60),
    "count_cases_first_response_in_24_hrs": total(lambda: c("answered_in_sl")),
    "percent_first_response_in_24_hrs": average(lambda: c("answered_in_sl")),
    "all_autoresponded_cases": total(auto_response_group),
    "percent_cases_with_autoresponse": ratio("all_autoresponded_cases", "case_count"),
    "sum_touches": total(lambda: c("touch_count")),
    "touches_per_case": ratio("sum_touches", "__case_rows"),
    "percent_total_cases": share("case_count"),
    "total_cases_with_csat_sent": total(lambda: F.when(c("csat_sent_at").isNotNull() & c("case_id").isNotNull(), 1).otherwise(0)),
    # counts that open a list of rows
    "drill_fields_origin": rows(),
    "drill_fields_case_details": rows(),
    "drill_fields_problem_type": rows(),
    "drill_fields_problem_tag": rows(),
}

# Label -> origins, in display order.
ORIGIN_ORDER = {
    "Email": ("Email",),
    "Chat": ("Chat",),
    "Phone": ("Phone",),
    "Social": ("Facebook", "Twitter", "Reddit", "Instagram", "TIKTOK"),
}


def origin_label(more: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Label of the origin; ``more`` adds labels behind the fixed ones."""
    return case([(c("origin").isin(*names), label) for label, names in {**ORIGIN_ORDER, **(more or {})}.items()])


def origin_rank(more: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Sort key beside the label: reports order by it."""
    order = {**ORIGIN_ORDER, **(more or {})}
    return case([(c("origin").isin(*names), F.lit(i + 1)) for i, names in enumerate(order.values())])


def handled_by() -> Column:
    return F.coalesce("channel", "origin")


def auto_or_manual() -> Column:
    return (
        F.when(c("auto_responder_only_case") == "TRUE", "ar_only")
        .when(c("auto_response_category").isNotNull() & c("touch_count").isNotNull(), "both")
        .otherwise("manual_only")
    )


def case_number_above(limit: float) -> Column:
    """Yes/No: number in the case number beyond a limit."""
    return F.when(digits_number("case_number") > limit, "Yes").otherwise("No")


DIMENSIONS = {
    **timeframes("case_creation", "case_creation_date_time"),
    **timeframes("last_resolved", "last_resolved_date"),
    "created_date_parameter": lambda params: by_granularity("case_creation_date_time", params.get("date_granularity")),
    "last_resolved_parameter": lambda params: by_granularity("last_resolved_date", params.get("date_granularity")),
    "origin": lambda params: c("origin"),
    "origin_custom_sort": lambda params: origin_label(params.get("more_origins")),
    "origin_sort_key": lambda params: origin_rank(params.get("more_origins")),
    "problem_tag": lambda params: c("problem_tag"),
    "problem_type": lambda params: c("problem_type"),
    "status": lambda params: c("status"),
    "handled_by": lambda params: handled_by(),
    "auto_responder_or_manual": lambda params: auto_or_manual(),
    "case_lifetime_buckets": lambda params: bucketize("case_lifetime_seconds", LIFETIME_RANGES),
    "case_lifetime_days": lambda params: lifetime_days(),
    "case_lifetime_minutes": lambda params: lifetime_minutes(),
    "version_comparison": lambda params: compare(
        "app_version", params["version_comparison_picker"], params["version_comparison_number"], bool(params.get("numeric_version"))
    ),
    "new_survey_type": lambda params: compare("app_version", ">=", params.get("survey_version", "3.54.0")),
    "pilot_started": lambda params: case_number_above(float(params["pilot_case_number"])),
}

SETS = {
    "case_details": [
        "case_id", "case_number", "case_creation_date", "origin", "channel", "first_assigned_queue", "last_assigned_queue",
        "problem_tag", "problem_type", "status",
    ],
    "origin": ["origin", "count"],
    "problem_type": ["problem_type", "count"],
}

CASES_VIEW = View("cases", DIMENSIONS, MEASURES, SETS)

__all__ = ["CASES_VIEW", "DIMENSIONS", "MEASURES", "ORIGIN_ORDER", "SETS"]
