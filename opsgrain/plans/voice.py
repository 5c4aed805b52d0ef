"""Call records: revalidation, queue switching, coverage, dial-outs after contact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import safe_ratio, trunc_date
from ..operators.joins import seen_before
from ..operators.metrics import coverage_gap, mixed_group_rows, null_key_gap
from ..operators.ordered import ordered, time_chunk
from ..sources.tables import in_years

Tables = Mapping[str, DataFrame]


def abandon_relogic(calls: DataFrame, tie: str = "contact_id", chunk: str = "day") -> DataFrame:
    """Recomputed ``is_abandoned_new`` and ``handle_time_new``.

    The neighbour of the second rule is the next call of the same initial contact (a lag over
    descending time); no neighbour is what the rule asks for.  ``chunk`` is the stretch of time that one task orders for a contact.
    """
    method = F.col("initiation_method")
    rows = ordered(
        calls, ["initial_contact_id"], ["call_start_time", tie], time_chunk("call_start_time", chunk), lead={"__next_method": method}
    )
    waited = F.col("wait_start_time").isNotNull()
    no_talk = F.coalesce("handle_time", F.lit(0)) < 1
    lost = (
        F.when(
            (method == "INBOUND") & waited & ~F.col("is_handled") & ~F.col("rejected_queued") & F.col("requested_callback").isNull(), True
        )
        .when(method.isin("TRANSFER", "DISCONNECT", "CALLBACK") & waited & F.col("__next_method").isNull() & no_talk, True)
        .when(
            waited & (F.lower(method) == "transfer") & no_talk
            & (F.lower("disconnect_reason") != "contact_flow_disconnect_reason"),
            True,
        )
        .otherwise(False)
    )

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return rows.withColumns(
        {"is_abandoned_new": lost, "handle_time_new": zero("talk_time") + zero("wrap_time") + zero("hold_time")}
    ).drop("__next_method")


def voice_revalidation(calls: DataFrame, *, queue: str, since_year: int = 2024) -> DataFrame:
    """Old and new contact counts per day of one queue."""
    rows = abandon_relogic(in_years(calls.filter(F.col("queue_name") == queue), "call_end_time", since_year))
    return rows.groupBy(F.col("call_end_time").cast("date").alias("day")).agg(
        F.count_if((F.col("initiation_method") == "INBOUND") & F.col("wait_start_time").isNotNull()).alias("contacts_incoming"),
        F.count_if(F.col("handle_time_new") > 0).alias("contacts_handled_new"),
        F.count_if("is_handled").alias("contacts_handled_current"),
        F.count_if("is_abandoned_new").alias("contacts_abandoned"),
    )


def queue_switching(calls: DataFrame, *, year: int = 2024) -> DataFrame:
    """Days and agents that worked both queue kinds: share of in-app calls per day."""
    rows = in_years(calls, "call_start_time", year, year).filter(F.col("agent_user_name").isNotNull())
    per = rows.groupBy(F.col("call_start_time").cast("date").alias("day"), "agent_user_name", "is_in_app_queue").agg(
        F.count("contact_id").alias("calls")
    )
    mixed = mixed_group_rows(per, ["day", "agent_user_name"], "is_in_app_queue")
    return mixed.groupBy("day").agg(
        F.sum(F.when(F.col("is_in_app_queue"), F.col("calls"))).alias("in_app_calls"),
        F.sum("calls").alias("all_calls"),
    ).withColumn("in_app_pct", safe_ratio("in_app_calls", "all_calls", 100, 2))


def in_app_calls(calls: DataFrame, *, year: int = 2024) -> DataFrame:
    rows = in_years(calls, "call_start_time", year, year).filter(F.col("agent_user_name").isNotNull() & F.col("is_in_app_queue"))
    return rows.groupBy(F.col("call_start_time").cast("date").alias("day")).agg(F.count("contact_id").alias("calls"))


def cases_without_call(t: Tables, *, since_year: int = 2023) -> DataFrame:
    """Phone cases without a call record, per week."""
    cases = in_years(t["support_cases"].filter(F.col("origin") == "Phone"), "case_creation_date_time", since_year)
    return coverage_gap(cases, t["call_records"], "case_id", trunc_date("week", "case_creation_date_time"), "week")


def calls_without_case(calls: DataFrame, *, since_year: int = 2023, min_talk: int = 5) -> DataFrame:
    """Answered inbound calls without a case, per week."""
    rows = in_years(calls, "call_start_time", since_year).filter((F.col("initiation_method") == "INBOUND") & (F.col("talk_time") > min_talk))
    return null_key_gap(rows, "case_id", trunc_date("week", "call_start_time"), "week")


def outbound_after_inbound(calls: DataFrame, *, since_year: int = 2024) -> DataFrame:
    """Endpoints dialled out, and how many of them had another contact that day or before."""
    rows = in_years(calls, "call_end_time", since_year).select(
        "customer_endpoint", F.col("call_start_time").cast("date").alias("day"), "initiation_method"
    )
    out = rows.filter(F.col("initiation_method") == "OUTBOUND")
    other = rows.filter(F.col("initiation_method") != "OUTBOUND").withColumnRenamed("day", "seen_day")
    flagged = seen_before(out, other, "customer_endpoint", "day", "seen_day", "had_contact")
    per = flagged.groupBy(F.year("day").alias("year"), "customer_endpoint").agg(F.max("had_contact").alias("had_contact"))
    totals = per.groupBy("year").agg(
        F.count_if(F.col("had_contact") & F.col("customer_endpoint").isNotNull()).alias("with_incoming"),
        F.count("customer_endpoint").alias("total_outbound"),
    )
    return totals.withColumns(
        {
            "without_incoming": F.col("total_outbound") - F.col("with_incoming"),
            "with_incoming_pct": safe_ratio("with_incoming", "total_outbound", 100, 2),
        }
    )
