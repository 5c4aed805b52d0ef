"""Life of a case: queue history, transfers, handle time, channel at survey time, repeats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import PACIFIC, UTC, convert_tz, datediff_boundary, safe_ratio, time_slice
from ..operators.history import (
    compact_changes,
    event_duration,
    field_to_columns,
    pair_events,
    to_intervals,
    transition_type,
)
from ..operators.joins import asof_dim, dim_side, fold_join, state_at
from ..operators.match import first_contact_resolution, nearest_of_each
from ..operators.metrics import side_by_side, with_totals
from ..operators.ordered import ordered, time_chunk
from ..sources.tables import conform
from .contracts import CASE_QUEUES, CASE_TRANSFERS

Tables = Mapping[str, DataFrame]


#: Order of moves of the same time.
MOVE_TIES = ["queue_id", "user_id"]


def case_moves(t: Tables, *, source: str, phone_queue: Mapping[str, str] | None = None, tz: str = PACIFIC) -> DataFrame:
    """Moves of cases into queues; ``case_history`` and ``cases`` may be streams.

    With ``phone_queue`` (queue_id, queue_name, queue_type, user_id) phone cases of ``cases`` enter that queue when they are created.
    """
    history = t["case_history"].filter(F.col("source") == source)
    cat = t["queue_catalog"].select(
        F.col("queue_id").alias("__q"), "queue_name", F.col("business_unit_name").alias("queue_type")
    )
    moves = (
        history.join(cat, F.col("new_value") == F.col("__q"))
        .select("source", "case_id", F.col("__q").alias("queue_id"), "queue_name", "queue_type",
                F.col("created_by_id").alias("user_id"), convert_tz("created_date", UTC, tz).alias("queue_start_time"))
    )
    if phone_queue:
        fixed = {
            c: F.lit(phone_queue[c]).cast(moves.schema[c].dataType).alias(c) for c in ("queue_id", "queue_name", "queue_type", "user_id")
        }
        phone = t["cases"].filter(F.col("origin") == "Phone").select(
            F.lit(source).alias("source"), F.col("case_id").cast(moves.schema["case_id"].dataType).alias("case_id"),
            fixed["queue_id"], fixed["queue_name"], fixed["queue_type"], fixed["user_id"],
            convert_tz("created_at_utc", UTC, tz).alias("queue_start_time"),
        )
        moves = moves.unionByName(phone)
    return moves


def case_queue_history(
    t: Tables,
    *,
    source: str,
    phone_queue: Mapping[str, str] | None = None,
    comment_field: str = "transfer_comment",
    reason_field: str = "transfer_reason",
    bot_last_name: str = "Bot",
    tz: str = PACIFIC,
    contract: bool = False,
    chunk: str = "day",
    stays: DataFrame | None = None,
) -> DataFrame:
    """One row per stay of a case in a queue.  ``chunk`` is the stretch of time that one task orders for a case.

    Tables: ``case_history``, ``queue_catalog``, ``users``, ``employees``, ``base_cases`` and, with ``phone_queue``, ``cases`` (see
    ``case_moves``).  ``stays`` brings them from elsewhere, such as a stream of the moves (``streaming.stateful.stays_of``).
    """
    history = t["case_history"].filter(F.col("source") == source)
    local = convert_tz("created_date", UTC, tz)
    if stays is None:
        # consecutive moves into the same queue are one stay
        moves = case_moves(t, source=source, phone_queue=phone_queue, tz=tz)
        stays = compact_changes(moves, "case_id", "queue_start_time", "queue_id", tie=MOVE_TIES, chunk=chunk)
        stays = to_intervals(stays, "case_id", "queue_start_time", tie=MOVE_TIES, number="queue_number", end="queue_end_time", chunk=chunk)

    notes = field_to_columns(
        history.withColumn("__at", local), ["case_id", "created_by_id", "__at"], "field", "new_value",
        {"transfer_comment": comment_field, "transfer_reason": reason_field},
    ).select(
        F.col("case_id").alias("__c"), F.col("created_by_id").alias("__u"), "__at", "transfer_comment", "transfer_reason"
    )
    users = t["users"].select(F.col("id").alias("__id"), F.col("name").alias("__name"), "last_name")
    out = stays.join(dim_side(users), stays["user_id"] == users["__id"], "left")
    out = asof_dim(
        out, t["employees"], ("user_id", "agent_id"), "queue_start_time",
        {"employee_id": "employee_id", "__full_name": "full_name"}, by_date=True,
    )
    out = out.join(
        notes,
        (out["case_id"] == notes["__c"]) & (out["user_id"] == notes["__u"]) & (out["queue_start_time"] == notes["__at"]),
        "left",
    )
    base = t["base_cases"].select(F.col("case_id").alias("__b"), "case_number")
    out = out.join(dim_side(base), F.col("case_id") == F.col("__b"), "left")
    out = out.select(
        F.concat(F.col("case_id").cast("string"), F.date_format("queue_start_time", "yyyy-MM-dd HH:mm:ss.SSS")).alias("cq_hash_key"),
        "source", "case_id", "case_number", "queue_id", "queue_name", "queue_type", "employee_id", "user_id",
        F.coalesce("__full_name", "__name").alias("user_name"),
        F.coalesce(F.col("last_name") == bot_last_name, F.lit(False)).alias("user_is_bot"),
        "transfer_reason", "transfer_comment", "queue_number", "queue_start_time", "queue_end_time",
    )
    return conform(out, CASE_QUEUES) if contract else out


def case_queue_transfers(
    queues: DataFrame,
    base_cases: DataFrame,
    *,
    since: str = "2019-06-01",
    auto_response_queue: str = "EMAIL AUTO RESPONSE",
    bot_name: str = "Bot",
    bot_display: str = "Support Robot",
    contract: bool = False,
    chunk: str = "day",
) -> DataFrame:
    """The stays with the move that led to each and elapsed queue time; ``history.path_steps`` has the queue path.

    Earlier queue time adds up row by row; two stays that start in the same second do not
    count each other twice.
    """
    base = base_cases.filter(F.col("case_created_at") >= F.lit(since).cast("timestamp_ntz")).select(
        F.col("case_id").alias("__b"), F.col("case_created_at").cast("date").alias("case_creation_date")
    )
    q = queues.join(dim_side(base), F.col("case_id") == F.col("__b")).drop("__b")
    q = q.withColumns(
        {
            "time_in_queue_minutes": datediff_boundary("minute", "queue_start_time", "queue_end_time"),
            "queue_type": F.trim("queue_type"),
            "__raw_type": F.col("queue_type"),
        }
    )
    q = ordered(
        q, ["case_id"], ["queue_start_time", "queue_number"], time_chunk("queue_start_time", chunk),
        lag={
            "previous_trans_from_name": F.col("user_name"),
            "previous_trans_from_user_id": F.col("user_id"),
            "previous_trans_from_queue_name": F.col("queue_name"),
            "previous_trans_from_queue_id": F.col("queue_id"),
            "__prev_type": F.col("__raw_type"),
        },
        running={"__minutes": F.coalesce(F.col("time_in_queue_minutes"), F.lit(0))},
    )
    from_kind, transfer = transition_type(
        "queue_type", "queue_name", F.col("__prev_type"), F.col("previous_trans_from_queue_name"), F.col("queue_number"),
        auto_response=auto_response_queue,
    )
    q = q.withColumns(
        {
            "trans_from_queue_type": from_kind,
            "trans_team_type": transfer,
            "case_life_till_queue": F.col("__minutes") - F.coalesce(F.col("time_in_queue_minutes"), F.lit(0)),
            "user_name": F.when(F.col("user_name") == bot_name, bot_display).otherwise(F.col("user_name")),
        }
    )
    q = ordered(
        q, ["case_id", "queue_name"], ["queue_start_time", "queue_number"], time_chunk("queue_start_time", chunk), number="__visit"
    )
    q = q.withColumn("first_time_in_queue", (F.col("__visit") == 1).cast("int"))
    out = q.select(*[f.name for f in CASE_TRANSFERS.fields])
    return conform(out, CASE_TRANSFERS) if contract else out


def handle_time_detail(t: Tables, *, case_since: str, touch_since: str, ended_since: str, link_prefix: str = "") -> DataFrame:
    """Touch rows with half-hour slices and the totals of their case and their agent."""
    touches = t["time_by_user"].join(
        t["support_cases"].select("case_id", "case_number", "problem_tag", F.col("case_creation_date_time").alias("__made")), "case_id"
    )
    users = t["users"].select(F.col("id").alias("user_id"), "email")
    people = t["employees"].filter(F.col("role_status") == "Current").select(
        F.col("email_today").alias("__mail"), "full_name", "manager", "managers_manager"
    )
    rows = fold_join(touches.join(users, "user_id", "left"), people, "email", "__mail")

    def day(text: str):
        return F.lit(text).cast("timestamp_ntz")

    rows = rows.filter(
        (F.col("__made") >= day(case_since)) & (F.col("start_timestamp") >= day(touch_since)) & (F.col("stop_timestamp") >= day(ended_since))
    )
    rows = rows.select(
        "case_number", F.concat(F.lit(link_prefix), F.col("case_id").cast("string"), F.lit("/view")).alias("link"),
        F.col("__made").cast("date").alias("case_creation_date"), "full_name", "manager", "managers_manager", "case_id", "user_id",
        F.col("start_timestamp").alias("touch_start_time"), F.col("stop_timestamp").alias("touch_end_time"),
        time_slice("start_timestamp", 30).alias("touch_start_interval"),
        time_slice("stop_timestamp", 30, end=True).alias("touch_end_interval"),
        F.col("time_spent").alias("handle_time_seconds"), "problem_tag",
    )
    rows = with_totals(rows, ["case_id"], {"total_case_handle_time_seconds": ("sum", F.col("handle_time_seconds"))})
    return with_totals(rows, ["user_id"], {"total_advocate_handle_time_seconds": ("sum", F.col("handle_time_seconds"))})


def case_handle_time(
    events: DataFrame, cases: DataFrame, labels: DataFrame, *, since: str, routes: Sequence[str] | None = None,
    start_event: str = "ASSIGN", end_event: str = "CLOSED_COMPLETE",
) -> DataFrame:
    """Seconds from an assignment to the next completion of the same case and queue."""
    named = events.withColumns(
        {"event": F.decode(F.col("logical_event_name").cast("binary"), "UTF-8"), "case_text": F.decode(F.col("case_token").cast("binary"), "UTF-8")}
    )
    starts = named.filter((F.col("event") == start_event) & (F.col("created_at") >= F.lit(since).cast("timestamp_ntz")))
    ends = named.filter(F.col("event") == end_event)
    paired = pair_events(
        starts.select("case_text", "case_queue_id", F.col("created_at").alias("assigned_at"), "id"),
        ends, ["case_text", "case_queue_id"], "assigned_at", "created_at", {"completed_at": "created_at"}, tie=["id"],
    )
    names = (
        cases.join(labels.select(F.col("id").alias("__l"), F.col("name").alias("subroute")), F.col("queue_label_id") == F.col("__l"), "left")
        .select(F.decode(F.col("token").cast("binary"), "UTF-8").alias("case_text"), "subroute")
    )
    out = paired.join(names, "case_text", "left")
    if routes is not None:
        out = out.filter(F.col("subroute").isin(*routes))
    return out.select(
        F.col("case_text").alias("case_token"), "subroute", F.col("assigned_at").cast("date").alias("date"),
        "assigned_at", "completed_at", F.col("duration_seconds").alias("handle_time_seconds"),
    )


def regulated_handle_seconds(events: DataFrame, cases: DataFrame, labels: DataFrame) -> DataFrame:
    """Target token x route: seconds from the last assignment to the last completion."""
    named = events.select("case_token", "created_at", F.decode(F.col("logical_event_name").cast("binary"), "UTF-8").alias("event"))
    full = named.join(cases.select(F.col("token").alias("case_token"), "target_token", "queue_label_id"), "case_token", "left")
    full = full.join(labels.select(F.col("id").alias("queue_label_id"), F.col("name").alias("subroute")), "queue_label_id", "left")
    full = full.withColumn("target_token", F.decode(F.col("target_token").cast("binary"), "UTF-8"))
    return event_duration(full, ["target_token", "subroute"], "event", "created_at", "ASSIGN", "CLOSED_COMPLETE", "handled_seconds")


def csat_channel(t: Tables) -> DataFrame:
    """Channel a case was in when its survey was sent."""
    sent = t["support_cases"].select("case_id", "csat_sent_at")
    return state_at(
        sent, t["channel_history"], "case_id", "csat_sent_at", "created_at_utc",
        {"csat_channel": "new_value", "entered_channel_at": "created_at_utc"}, tie=["new_value"],
    )


def contact_base(t: Tables, *, year: int | None = 2024, tz: str = PACIFIC) -> DataFrame:
    """Voice cases with a known customer; the year is tested on the converted time."""
    called = t["call_records"].select("case_id").filter(F.col("case_id").isNotNull()).distinct()
    cases = t["support_cases"].filter(F.col("customer_token").isNotNull()).join(called, "case_id", "left_semi")
    out = cases.select(
        "customer_token", "problem_tag", convert_tz("case_creation_date_time", tz, UTC).alias("case_ts_utc"), "case_id", "origin"
    ).distinct()
    if year is not None:
        lo, hi = F.lit(f"{year}-01-01").cast("timestamp_ntz"), F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
        out = out.filter((F.col("case_ts_utc") >= lo) & (F.col("case_ts_utc") < hi))
    return out


def fcr_detail(base: DataFrame, days: Sequence[int] = (7, 14, 28)) -> DataFrame:
    """Nearest other contact of the customer per case (any, same tag, other tag) and the FCR flags."""
    out = nearest_of_each(base, "customer_token", "case_id", "case_ts_utc", "problem_tag")
    return out.withColumns(first_contact_resolution("same_days", days))


def fcr_summary(detail: DataFrame, days: Sequence[int] = (7, 14, 28)) -> DataFrame:
    """One row: average and median distances, customers with repeats, FCR rates.

    Cases are counted per customer and distances first; that shuffle serves the sums per customer, which are added up then, so
    distinct customers cost no multi-distinct plan, and the medians, which are over whole days, of which there are few.
    """
    flags = [f"fcr_{n}_day" for n in days]
    kinds = ("any", "same", "different")
    cells = detail.groupBy("customer_token", *[F.abs(f"{k}_days").alias(f"{k}_days") for k in kinds]).agg(F.count(F.lit(1)).alias("n"))
    per = cells.withColumns(first_contact_resolution("same_days", days)).groupBy("customer_token").agg(
        F.sum("n").alias("n"),
        *[F.coalesce(F.sum(F.when(F.col(f), F.col("n"))), F.lit(0)).alias(f) for f in flags],
        *[F.sum(F.col(f"{k}_days") * F.col("n")).alias(f"{k}_sum") for k in kinds],
        *[F.coalesce(F.sum(F.when(F.col(f"{k}_days").isNotNull(), F.col("n"))), F.lit(0)).alias(f"{k}_n") for k in kinds],
    )
    totals = per.agg(
        *[F.round(safe_ratio(F.sum(f"{k}_sum"), F.sum(f"{k}_n"))).alias(f"avg_abs_days_since_{k}") for k in kinds],
        *[
            safe_ratio(F.count_if(F.col(f"{k}_n") > 0), F.count(F.lit(1)), 100, 2).alias(f"pct_customers_with_{k}")
            for k in ("same", "different")
        ],
        *[safe_ratio(F.sum(f), F.sum("n"), 100, 2).alias(f"total_{f}") for f in flags],
    )
    medians = cells.agg(*[F.percentile(f"{k}_days", F.lit(0.5), F.col("n")).alias(f"median_abs_days_since_{k}") for k in ("any", "same")])
    return side_by_side(totals, medians)


def fcr_flag_counts(detail: DataFrame, flag: str = "fcr_7_day") -> DataFrame:
    return detail.groupBy(flag).agg(F.count(F.lit(1)).alias("cases"))

