"""Service-level facts of the messaging, chat, e-mail and voice channels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import (
    PACIFIC,
    UTC,
    convert_tz,
    datediff_boundary,
    null_as_other,
    safe_ratio,
    trunc,
)
from ..operators.calendar import calendar_spine, on_spine
from ..operators.classify import case, union_distinct
from ..operators.joins import asof_dim, exclude, fold_join
from ..operators.metrics import backlog_flag, concurrency, distinct_counts, entering_handled, side_by_side, threshold_alerts
from ..sources.tables import conform, reload_start, trailing_filter
from ..streaming.sla import LATENESS, stream_entering_handled
from .contracts import HOURLY_ADVOCATE, HOURLY_ALERTS, HOURLY_QUEUE

Tables = Mapping[str, DataFrame]

@dataclass(frozen=True)
class ChatType:
    """A live-chat record type, its team and queue, and the longest wait within target."""

    record_type: str
    team: str
    max_wait: int
    queue_id: str


@dataclass(frozen=True)
class SlaRules:
    """Names of the organisation whose facts are built.

    ``units``: business units counted, in lower case; a queue without a unit counts as "other".  ``chat_unit``: the unit of
    live chats.  ``chat_types``: their record types.
    """

    units: Sequence[str]
    chat_unit: str
    chat_types: Sequence[ChatType]

    @property
    def record_types(self) -> list[str]:
        return [c.record_type for c in self.chat_types]


MESSAGING_TARGET_MIN = 7
EMAIL_TARGET = 24
VOICE_WAIT_SECONDS = 120
VOICE_CALLBACK_SECONDS = 1800
SHORT_ABANDON_SECONDS = 10


@dataclass(frozen=True)
class Span:
    """Calendar span [start, stop) of a run; a reload of day ``ds`` only reads what it rebuilds."""

    start: datetime
    stop: datetime

    @staticmethod
    def of(start, stop, ds: date | None = None, full: bool = False) -> Span:
        lo, hi = datetime.fromisoformat(str(start)), datetime.fromisoformat(str(stop))
        if ds is not None and full:
            hi = min(hi, datetime.combine(ds, datetime.min.time()) + timedelta(days=1))
        elif ds is not None:
            lo = max(lo, datetime.combine(reload_start(ds), datetime.min.time()))
        return Span(lo, max(lo, hi))


def _within(df: DataFrame, column: str, span: Span, unit: str, tz: str = UTC) -> DataFrame:
    """Rows of the calendar span with their truncated UTC time as ``ts``.

    The range on the raw column, a day wider on both sides for the zone, is the one that reaches the scan.
    """
    day = timedelta(days=1)

    def between(at: Column, lo: datetime, hi: datetime) -> Column:
        return (at >= F.lit(str(lo)).cast("timestamp_ntz")) & (at < F.lit(str(hi)).cast("timestamp_ntz"))

    near = df.filter(between(F.col(column), span.start - day, span.stop + day))
    out = near.withColumn("ts", trunc(unit, convert_tz(column, tz, UTC)))
    return out.filter(between(F.col("ts"), span.start, span.stop))


def _counted(rules: SlaRules) -> Column:
    return null_as_other("business_unit_name").isin(*rules.units)


def _with_queue(touches: DataFrame, catalog: DataFrame, rules: SlaRules, keep_all: bool = False) -> DataFrame:
    """Add the queue attributes and keep the counted business units (or leave that for later)."""
    cat = catalog.select(
        F.col("queue_name").alias("__qn"),
        F.col("queue_id").cast("string").alias("queue_id"),
        "team_name",
        F.col("communication_channel").alias("channel"),
        "business_unit_name",
    )
    slim = touches.drop("queue_id", "channel", "business_unit_name", "team_name")
    joined = fold_join(slim, cat, "queue_name", "__qn")
    return joined if keep_all else joined.filter(_counted(rules))


def _on_calendar(spine: DataFrame, facts: DataFrame, zeros: Sequence[str], rules: SlaRules) -> DataFrame:
    """Calendar LEFT JOIN aggregate, then the business-unit filter.

    An interval without any touch keeps one row of NULLs with zero counts; an interval that
    only holds touches of other units disappears.
    """
    joined = on_spine(spine.select("interval_start"), facts, "ts", list(zeros)).filter(_counted(rules))
    return joined.withColumnRenamed("interval_start", "ts")


def _chats(t: Tables, rules: SlaRules) -> DataFrame:
    """Chats of the given types with team, queue and the two target flags."""
    kind, types = F.col("chat_record_type"), rules.chat_types
    chats = t["chat_escalations"].filter(kind.isin(*rules.record_types))
    limit = case([(kind == c.record_type, F.lit(c.max_wait)) for c in types])
    on_time = F.col("chat_wait_time") <= limit
    return chats.withColumns(
        {
            "team_name": case([(kind == c.record_type, c.team) for c in types]),
            "queue_id": case([(kind == c.record_type, c.queue_id) for c in types]),
            "channel": F.lit("CHAT"),
            "business_unit_name": F.lit(rules.chat_unit),
            "__in": on_time & (F.col("chat_handle_time") > 0),
            "__lost": on_time & (F.col("chat_handle_time") == 0),
        }
    )


def chat_work() -> tuple[dict[str, Column | None], dict[str, Column]]:
    """Flags of ids and sums over rows that are kept of handled chats."""
    return {"handled_touches": None, "touches_in_sla": F.col("__in"), "__abandoned": F.col("__lost")}, {"handle_time_min": F.col("chat_handle_time") / 60}


def _chat_columns(work: DataFrame) -> DataFrame:
    none = F.lit(None)
    return work.withColumns(
        {
            "response_time_min": none.cast("double"),
            "touch_lifetime_min": F.col("handle_time_min"),
            "handled_backlog_touches": none.cast("bigint"),
            "qualified_sla_touches": F.col("handled_touches") - F.col("__abandoned"),
        }
    ).drop("__abandoned")


def _chat_handled(chats: DataFrame, keys: Sequence[str], avgs: bool = False) -> DataFrame:
    flags, sums = chat_work()
    means = {"avg_handle_time_min": sums["handle_time_min"]} if avgs else None
    out = _chat_columns(distinct_counts(chats, keys, "chat_transcript_id", flags, sums=sums, avgs=means))
    return out.withColumn("avg_response_time_min", F.lit(None).cast("double")) if avgs else out


def messaging_work() -> tuple[dict[str, Column | None], dict[str, Column]]:
    """Flags of ids and sums over rows that are kept of handled touches."""
    response, in_hours = F.col("response_time_seconds") / 60, F.col("in_business_hours")
    flags = {
        "handled_touches": None,
        "handled_backlog_touches": backlog_flag("touch_assignment_time", "touch_start_time", in_hours),
        "touches_in_sla": (response <= MESSAGING_TARGET_MIN) & in_hours,
        "qualified_sla_touches": in_hours,
    }
    sums = {
        "response_time_min": response,
        "handle_time_min": F.col("handle_time_seconds") / 60,
        "touch_lifetime_min": datediff_boundary("minute", "touch_assignment_time", "touch_end_time").cast("double"),
    }
    return flags, sums


def _messaging_handled(touches: DataFrame, keys: Sequence[str], row_id: str = "touch_id", avgs: bool = False) -> DataFrame:
    flags, sums = messaging_work()
    means = {f"avg_{n}": sums[n] for n in ("response_time_min", "handle_time_min")}
    return distinct_counts(touches, keys, row_id, flags, sums=sums, avgs=means if avgs else None)


_QUEUE = ["queue_id", "team_name", "channel", "business_unit_name"]
_PERSON = ["employee_id", "advocate_name", "advocate_city", "manager", "managers_manager"]
_WORK = [
    "handled_touches", "response_time_min", "handle_time_min", "touch_lifetime_min",
    "handled_backlog_touches", "touches_in_sla", "qualified_sla_touches",
]


def hourly_queue_sla(
    t: Tables, start, stop, rules: SlaRules, *, ds: date | None = None, full: bool = False,
    tz: str = PACIFIC, round_like_fact: bool = False,
) -> DataFrame:
    """Hour x queue: arrivals by start time, handled work by assignment time.

    Facts are aggregated before they meet the calendar, so the spine only adds the hours no
    touch falls into.  With ``ds`` only the trailing seven days are returned, ready for the
    reload of the fact table.
    """
    span = Span.of(start, stop, ds, full)
    spine = calendar_spine(t["messaging_touches"].sparkSession, span.start, span.stop, "hour")
    came = _within(t["messaging_touches"], "touch_start_time", span, "hour", tz)
    done = _within(t["messaging_touches"], "touch_assignment_time", span, "hour", tz)
    entering = distinct_counts(
        _with_queue(came, t["queue_catalog"], rules, keep_all=True), ["ts", *_QUEUE], "touch_start_id", {"entering_touches": None}
    )
    entering = _on_calendar(spine, entering, ["entering_touches"], rules)
    handled = _messaging_handled(_with_queue(done, t["queue_catalog"], rules), ["ts", "queue_id"])
    messaging = entering_handled(entering, handled, ["ts", "queue_id"])

    chats = _chats(t, rules)
    chat_in = distinct_counts(
        _within(chats, "chat_created_at", span, "hour", tz),
        ["ts", *_QUEUE], "chat_transcript_id", {"entering_touches": None},
    )
    chat_done = _chat_handled(
        _within(chats, "chat_start_time", span, "hour", tz), ["ts", "queue_id"]
    )
    cols = ["ts", *_QUEUE, "entering_touches", *_WORK]
    fact = messaging.select(*cols).unionByName(entering_handled(chat_in, chat_done, ["ts", "queue_id"]).select(*cols))
    return _finish(fact, HOURLY_QUEUE, ds, full, round_like_fact)


def streams_of_queue_sla(t: Tables, rules: SlaRules, *, tz: str = PACIFIC, lateness: str = LATENESS) -> dict[str, DataFrame]:
    """``hourly_queue_sla`` from streams: arrivals joined with work, for ``messaging`` and ``chat``.

    ``messaging_touches`` and ``chat_escalations`` of ``t`` are streams, ``queue_catalog`` a table.  Write both results and read them
    with ``queue_sla_of_streams``.
    """
    touches = _with_queue(t["messaging_touches"], t["queue_catalog"], rules, keep_all=True)
    touches = touches.withColumns({"__came": convert_tz("touch_start_time", tz, UTC), "__done": convert_tz("touch_assignment_time", tz, UTC)})
    flags, sums = messaging_work()
    messaging = stream_entering_handled(
        touches, touches.filter(_counted(rules)), "__came", "__done", _QUEUE, "queue_id", entering_id="touch_start_id", handled_id="touch_id",
        flags=flags, sums=sums, lateness=lateness,
    )
    chats = _chats(t, rules).withColumns({"__came": convert_tz("chat_created_at", tz, UTC), "__done": convert_tz("chat_start_time", tz, UTC)})
    flags, sums = chat_work()
    chat = stream_entering_handled(
        chats, chats, "__came", "__done", _QUEUE, "queue_id", entering_id="chat_transcript_id", handled_id="chat_transcript_id", flags=flags, sums=sums,
        lateness=lateness,
    )
    return {"messaging": messaging, "chat": chat}


def queue_sla_of_streams(messaging: DataFrame, chat: DataFrame, start, stop, rules: SlaRules) -> DataFrame:
    """The fact of ``hourly_queue_sla`` from the tables of ``streams_of_queue_sla``."""
    spine = calendar_spine(messaging.sparkSession, start, stop, "hour")
    cols = ["ts", *_QUEUE, "entering_touches", *_WORK]
    inside = spine.select(F.col("interval_start").alias("ts"))
    return _on_calendar(spine, messaging, ["entering_touches"], rules).select(*cols).unionByName(
        _chat_columns(chat).join(inside, "ts", "left_semi").select(*cols)
    )


def _finish(fact: DataFrame, contract, ds, full, round_like_fact) -> DataFrame:
    if ds is not None:
        fact = fact.filter(trailing_filter("ts", ds, full=full))
    return conform(fact, contract) if round_like_fact else fact


def _person(df: DataFrame, employees: DataFrame, key: str, at: Column, by_date: bool) -> DataFrame:
    cols = {
        "employee_id": "employee_id", "advocate_name": "full_name", "advocate_city": "city",
        "manager": "manager", "managers_manager": "managers_manager",
    }
    # the employee columns come from the dimension: without a version they are NULL
    base = df.withColumn("__person", F.col(key))
    return asof_dim(base, employees, ("__person", "employee_id"), at, cols, by_date=by_date)


def hourly_advocate_sla(
    t: Tables, start, stop, rules: SlaRules, *, ds: date | None = None, full: bool = False,
    tz: str = PACIFIC, by_date: bool = False, round_like_fact: bool = False, distinct: bool = False,
) -> DataFrame:
    """Hour x queue x employee.  ``by_date=False`` compares the employee range with the timestamp."""
    span = Span.of(start, stop, ds, full)
    spine = calendar_spine(t["messaging_touches"].sparkSession, span.start, span.stop, "hour")
    at = convert_tz("touch_assignment_time", tz, UTC)
    done = _within(t["messaging_touches"], "touch_assignment_time", span, "hour", tz)
    keys = ["ts", *_PERSON, *_QUEUE]
    people = _person(_with_queue(done, t["queue_catalog"], rules, keep_all=True), t["employees"], "employee_id", at, by_date)
    zeros = ["handled_touches", "handled_backlog_touches", "touches_in_sla", "qualified_sla_touches"]
    messaging = _on_calendar(spine, _messaging_handled(people, keys), zeros, rules)

    chat_at = convert_tz("chat_start_time", tz, UTC)
    chats = _within(_chats(t, rules), "chat_start_time", span, "hour", tz)
    chat = _chat_handled(_person(chats, t["employees"], "chat_advocate_employee_id", chat_at, True), keys)
    fact = messaging.unionByName(chat.select(*messaging.columns))
    fact = fact.withColumn("concurrency", concurrency("touch_lifetime_min", "handle_time_min")).select(
        "ts", *_PERSON, *_QUEUE, "handled_touches", "response_time_min", "handle_time_min", "touch_lifetime_min",
        "concurrency", "handled_backlog_touches", "touches_in_sla", "qualified_sla_touches",
    )
    return _finish(fact.distinct() if distinct else fact, HOURLY_ADVOCATE, ds, full, round_like_fact)


def messaging_sla_hourly(t: Tables, start, stop, rules: SlaRules, **options) -> DataFrame:
    """Ad-hoc form of the hour x queue x employee fact with the SLA in percent, rows distinct."""
    fact = hourly_advocate_sla(t, start, stop, rules, distinct=True, **options)
    return fact.withColumn("sl_percent", safe_ratio("touches_in_sla", "qualified_sla_touches", 100))


def cases_created(t: Tables, rules: SlaRules, *, since_year: int = 2018, tz: str = PACIFIC) -> DataFrame:
    """Cases created per hour from two systems: counted apart, then added."""
    first_day = F.lit(f"{since_year}-01-01").cast("timestamp_ntz")
    cases = t["cases"].filter((F.col("channel") == "Chat") & (F.col("created_at_utc") >= first_day))
    a = distinct_counts(cases.withColumn("ts", trunc("hour", "created_at_utc")), ["ts"], "case_id", {"n": None})
    chats = t["chat_escalations"].filter(
        F.col("chat_record_type").isin(*rules.record_types) & (F.col("parent_case_created_at") >= first_day)
    )
    hour = trunc("hour", convert_tz("parent_case_created_at", tz, UTC))
    b = distinct_counts(chats.withColumn("ts", hour), ["ts"], "parent_case_id", {"n": None})
    return a.unionByName(b).groupBy("ts").agg(F.sum("n").alias("cases_created"))


def hourly_alerts(
    queue_fact: DataFrame, advocate_fact: DataFrame, created: DataFrame, *, ds: date | None = None, full: bool = False,
    round_like_fact: bool = False,
) -> DataFrame:
    """SLA per hour beside the hour before, with three alerts.

    The previous hour is taken along the calendar of the fact itself.
    """
    sla = queue_fact.groupBy("ts").agg(
        F.sum("touches_in_sla").alias("touches_in_sla"),
        F.sum("qualified_sla_touches").alias("qualified_sla_touches"),
        F.sum("entering_touches").alias("entering_touches"),
    )
    sla = sla.withColumn("touch_sla_percent", safe_ratio("touches_in_sla", "qualified_sla_touches", 100, 2))
    handled = advocate_fact.groupBy("ts").agg(F.sum("handled_touches").alias("handled_touches"))
    hours = sla.join(created, "ts", "left").join(handled, "ts", "left")
    out = threshold_alerts(hours, "ts", "touch_sla_percent", "cases_created")
    out = out.select(
        "ts", "cases_created", "touches_in_sla", "qualified_sla_touches", "touch_sla_percent",
        F.col("prev_touch_sla_percent").alias("prev_hr_interval_touch_sla_pct"),
        "entering_touches", "handled_touches",
        F.col("alert_drop").alias("alert_touch_sla_dropped_10pct"),
        F.col("alert_volume").alias("alert_12k_cases_created"),
        F.col("alert_floor").alias("alert_touch_sla_less_than_25pct"),
    )
    return _finish(out, HOURLY_ALERTS, ds, full, round_like_fact)


def daily_advocate_sla(t: Tables, start, stop, rules: SlaRules, *, tz: str = PACIFIC) -> DataFrame:
    """Day x team arrivals beside day x advocate work of the same team, rows distinct."""
    span = Span.of(start, stop)
    spine = calendar_spine(t["messaging_touches"].sparkSession, span.start, span.stop, "day")
    team = ["team_name", "channel", "business_unit_name"]
    came = _within(t["messaging_touches"], "touch_start_time", span, "day", tz)
    at = convert_tz("touch_assignment_time", tz, UTC)
    done = _within(t["messaging_touches"], "touch_assignment_time", span, "day", tz)
    entering = distinct_counts(
        _with_queue(came, t["queue_catalog"], rules, keep_all=True), ["ts", *team], "touch_start_id", {"entering_touches": None}
    )
    entering = _on_calendar(spine, entering, ["entering_touches"], rules)
    who = ["employee_id", "advocate_name", "advocate_city"]
    people = _person(_with_queue(done, t["queue_catalog"], rules), t["employees"], "employee_id", at, True)
    handled = _messaging_handled(people, ["ts", *who, *team], avgs=True)

    chats = _chats(t, rules)
    chat_in = distinct_counts(
        _within(chats, "chat_created_at", span, "day", tz),
        ["ts", *team], "chat_transcript_id", {"entering_touches": None},
    )
    named = chats.withColumns(
        {
            "employee_id": F.col("chat_advocate_employee_id"),
            "advocate_name": F.col("chat_advocate"),
            "advocate_city": F.col("chat_advocate_city"),
        }
    )
    chat_done = _chat_handled(
        _within(named, "chat_start_time", span, "day", tz), ["ts", *who, *team], avgs=True
    )

    def side(arrivals: DataFrame, work: DataFrame) -> DataFrame:
        work = work.withColumns(
            {
                "sl_percent": safe_ratio("touches_in_sla", "qualified_sla_touches", 100),
                "concurrency": concurrency("touch_lifetime_min", "handle_time_min"),
            }
        ).drop("channel", "business_unit_name")
        out = entering_handled(arrivals, work, ["ts", "team_name"])
        return out.select(
            F.col("ts").cast("date").alias("day"), *who, *team, "entering_touches", "handled_touches",
            "handled_backlog_touches", "touches_in_sla", "qualified_sla_touches", "sl_percent", "response_time_min",
            "avg_response_time_min", "handle_time_min", "avg_handle_time_min", "touch_lifetime_min", "concurrency",
        )

    return side(entering, handled).unionByName(side(chat_in, chat_done)).distinct()


# -- e-mail -------------------------------------------------------------------------------


def _email_handled(touches: DataFrame, keys: Sequence[str], response: Column, target: float) -> DataFrame:
    handle = F.col("touch_handle_time") / 60
    return distinct_counts(
        touches,
        keys,
        "touch_id",
        {"handled_touches": None, "touches_in_sl": (response <= target) & (F.col("touch_type") != "TRN")},
        sums={"response_time_min": response, "handle_time_min": handle},
        avgs={"avg_response_time_min": response, "avg_handle_time_min": handle},
    ).withColumn("sl_percent", safe_ratio("touches_in_sl", "handled_touches"))


def _emails(t: Tables, ts: str, span: Span, rules: SlaRules) -> DataFrame:
    rows = _within(t["email_touches"], ts, span, "hour")
    return _with_queue(rows, t["queue_catalog"], rules).filter(F.col("channel") == "EMAIL")


def email_sla_hourly(t: Tables, start, stop, rules: SlaRules, *, response: str = "response_time_minutes", target: float = EMAIL_TARGET) -> DataFrame:
    """Hour x team.  The target is in the unit of the ``response`` column, which is a choice."""
    team, span = ["team_name", "channel", "business_unit_name"], Span.of(start, stop)
    entering = distinct_counts(_emails(t, "touch_start_time", span, rules), ["ts", *team], "touch_id", {"entering_touches": None})
    handled = _email_handled(_emails(t, "touch_time", span, rules), ["ts", "advocate_id", *team], F.col(response), target)
    out = entering_handled(entering, handled.drop("channel", "business_unit_name"), ["ts", "team_name"])
    return out.select(
        "ts", "advocate_id", *team, "entering_touches", "handled_touches", "touches_in_sl", "sl_percent",
        "response_time_min", "avg_response_time_min", "handle_time_min", "avg_handle_time_min",
    )


def email_sla_total(t: Tables, start, stop, rules: SlaRules, *, response: str = "response_time_minutes", target: float = EMAIL_TARGET) -> DataFrame:
    """The same measures without grouping, one row."""
    span = Span.of(start, stop)
    entering = distinct_counts(_emails(t, "touch_start_time", span, rules), [], "touch_id", {"entering_touches": None})
    handled = _email_handled(_emails(t, "touch_time", span, rules), [], F.col(response), target)
    return side_by_side(entering, handled)


# E-mail touch types per counter.
EMAIL_TYPES = {
    "email_handled": ("EML", "EML/STS"),
    "transfer_handled": ("TRN", "EML/TRN"),
    "resolved_handled": ("STS",),
    "bulk_handled": ("TR", "EML/TR"),
    "response_handled": ("EML", "EML/TRN", "TR", "EML/STS", "EML/TR"),
}


def email_touch_types(t: Tables, keys: Sequence[str], target_hours: float = EMAIL_TARGET) -> DataFrame:
    """Volumes per touch type, response time over the response types, average times."""
    kind, hours = F.col("touch_type"), F.col("response_time_hours")
    flags: dict = {"handled_volume": None}
    flags.update({n: kind.isin(*types) for n, types in EMAIL_TYPES.items()})
    flags["handled_in_sl"] = (hours <= target_hours) & (kind != "TRN")
    out = distinct_counts(
        t["email_touches"], keys, "touch_id", flags,
        sums={
            "total_response_time": F.when(kind.isin(*EMAIL_TYPES["response_handled"]), hours).otherwise(0),
            "total_handle_time": F.col("touch_handle_time"),
        },
    )
    return out.withColumns(
        {
            "art": safe_ratio("total_response_time", "response_handled"),
            "aht": safe_ratio("total_handle_time", "handled_volume"),
        }
    )


def email_sla_30min(t: Tables, *, target_hours: float = EMAIL_TARGET) -> DataFrame:
    """Half-hour x queue: share of answers in target, 0 where there is none."""
    from ..functions.dialect import time_slice

    sliced = t["email_touches"].withColumns(
        {"slice_start": time_slice("touch_start_time", 30), "ended_utc": convert_tz("touch_time", PACIFIC, UTC)}
    )
    detail = email_touch_types({"email_touches": sliced}, ["slice_start", "ended_utc", "queue_name", "queue_id"], target_hours)
    kept = detail.filter(F.col("slice_start").isNotNull() & (F.col("response_handled") > 0))
    return kept.groupBy("slice_start", "queue_name").agg(
        F.sum("response_handled").alias("response_volume"),
        F.sum("handled_in_sl").alias("handled_volume"),
        F.coalesce(safe_ratio(F.sum("handled_in_sl"), F.sum("response_handled")), F.lit(0.0)).alias("percent_in_sla"),
    )


# -- voice --------------------------------------------------------------------------------


def _voice(calls: DataFrame, keys: Sequence[str]) -> DataFrame:
    method = F.col("initiation_method")
    inbound, handled, late = method == "INBOUND", F.col("is_handled"), F.col("out_of_hours")
    callback = F.col("speed_to_callback")
    lasted = datediff_boundary("second", "call_start_time", "call_end_time")
    minutes = {n: F.col(n) / 60 for n in ("handle_time", "wrap_time", "hold_time")}
    minutes["response_time"] = callback / 60
    out = distinct_counts(
        calls,
        keys,
        "contact_id",
        {
            "touches_entering": inbound,
            "touches_handled": handled,
            "handled_inbound": inbound & handled,
            "inbound_touches_hoops": inbound & (~late | (late & handled)),
            "short_abandons": F.col("is_abandoned") & ~F.col("is_queued") & callback.isNull() & (lasted <= SHORT_ABANDON_SECONDS),
            "dialouts": method == "OUTBOUND",
            "touches_in_sl": (
                method.isin("API", "INBOUND") & (F.col("wait_time") < VOICE_WAIT_SECONDS) & F.col("agent_user_name").isNotNull()
            )
            | (inbound & (callback < VOICE_CALLBACK_SECONDS)),
        },
        sums={
            "count_of_callbacks": F.when(callback.isNotNull() & F.col("contact_id").isNotNull(), 1).otherwise(0),
            **{f"{n}_min": c for n, c in minutes.items()},
        },
        avgs={f"avg_{n}_min": c for n, c in minutes.items()},
    )
    qualified = F.when(F.col("inbound_touches_hoops") != 0, F.col("inbound_touches_hoops") - F.col("short_abandons"))
    out = out.withColumn("qualified_sla_touches", qualified)
    return out.withColumn("sl_percent", safe_ratio("touches_in_sl", "qualified_sla_touches"))


_VOICE_COUNTS = [
    "touches_entering", "touches_handled", "handled_inbound", "inbound_touches_hoops", "short_abandons", "dialouts",
    "touches_in_sl", "count_of_callbacks",
]


def voice_sla_hourly(
    t: Tables, start, stop, *, core_vertical: str, verticals: Mapping[str, Sequence[str]] = MappingProxyType({}), tz: str = PACIFIC
) -> DataFrame:
    """Hour x vertical; hours without a call keep a row with zero counts.

    ``verticals`` names the queues of each vertical; all others, and hours without a call, belong to ``core_vertical``.
    """
    span = Span.of(start, stop)
    spine = calendar_spine(t["call_records"].sparkSession, span.start, span.stop, "hour")
    calls = _within(t["call_records"], "call_start_time", span, "hour", tz)
    named = [(F.col("queue_name").isin(*queues), name) for name, queues in verticals.items()]
    vertical = case(named, F.lit(core_vertical)) if named else F.lit(core_vertical)
    rows = _voice(calls.withColumn("vertical", vertical), ["ts", "vertical"])
    out = on_spine(spine.select("interval_start"), rows, "ts", _VOICE_COUNTS).fillna(core_vertical, subset=["vertical"])
    return out.withColumnRenamed("interval_start", "ts").withColumn("channel", F.lit("Voice"))


def voice_sla_total(t: Tables, start, stop, *, tz: str = PACIFIC) -> DataFrame:
    return _voice(_within(t["call_records"], "call_start_time", Span.of(start, stop), "hour", tz), [])


# -- unified touches ----------------------------------------------------------------------


_UNI_KEYS = ["employee_id", "full_name", "city", "team_name", "channel", "business_unit_name"]


def _unified(t: Tables, channel: str, rules: SlaRules, without_chats: bool = False) -> DataFrame:
    rows = t["unified_touches"].filter(F.col("channel") == channel)
    if without_chats:
        escalated = t["chat_escalations"].filter(F.col("chat_record_type").isin(*rules.record_types))
        rows = exclude(rows, escalated.select(F.col("parent_case_id").alias("case_id")), ["case_id"])
    return _with_queue(rows, t["queue_catalog"], rules)


def _uni_person(df: DataFrame, employees: DataFrame, at: str) -> DataFrame:
    cols = {"employee_id": "employee_id", "full_name": "full_name", "city": "city"}
    return asof_dim(df, employees, ("advocate_id", "agent_id"), at, cols, by_date=True)


def _unified_handled(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    in_hours = F.col("in_business_hours")
    out = distinct_counts(
        df,
        keys,
        "touch_id",
        {
            "handled_touches": None,
            "handled_backlog_touches": backlog_flag("touch_assignment_time", "touch_start_time", in_hours),
            **flags,
        },
        sums={
            "response_time_min": F.when(in_hours, F.col("response_time") / 60),
            "handle_time_min": F.col("handle_time") / 60,
            "touch_lifetime_min": datediff_boundary("minute", "touch_assignment_time", "touch_end_time").cast("double"),
        },
    )
    return out.withColumn("concurrency", concurrency("touch_lifetime_min", "handle_time_min"))


def _unified_sla(rows: DataFrame, employees: DataFrame, flags: Mapping[str, Column], base: str, since_year: int) -> DataFrame:
    first = F.lit(f"{since_year}-01-01").cast("timestamp_ntz")
    came = _uni_person(rows.filter(F.col("touch_start_time") >= first), employees, "touch_start_time")
    entering = distinct_counts(
        came.withColumn("ts", trunc("hour", "touch_assignment_time")), ["ts", *_UNI_KEYS], "touch_id", {"entering_touches": None}
    )
    done = _uni_person(rows, employees, "touch_assignment_time").withColumn("ts", trunc("hour", "touch_start_time"))
    handled = _unified_handled(done, ["ts", "advocate_id", *_UNI_KEYS], flags)
    handled = handled.withColumn("percent_touches_in_sla", safe_ratio("touches_in_sla", base, 100))
    slim = handled.drop("advocate_id", "full_name", "city", "channel", "business_unit_name")
    return entering_handled(entering, slim, ["ts", "employee_id", "team_name"])


def email_sla_unified(t: Tables, rules: SlaRules, *, target: float = EMAIL_TARGET, since_year: int = 2022) -> DataFrame:
    flags = {
        "touches_in_sla": (F.col("response_time") / 60 <= target) & (F.lower("inbound_type") != "transfer"),
        "response_handled": F.col("inbound_type").isin("EML", "EML/TRN", "TR"),
    }
    return _unified_sla(_unified(t, "Email", rules), t["employees"], flags, "response_handled", since_year)


def messaging_sla_unified(t: Tables, rules: SlaRules, *, since_year: int = 2022, tz: str = PACIFIC) -> DataFrame:
    """Hour x advocate from unified touches, cases with a live-chat escalation counted from the chats."""
    in_hours = F.col("in_business_hours")
    flags = {
        "touches_in_sla": (F.col("response_time") / 60 <= MESSAGING_TARGET_MIN) & in_hours,
        "qualified_sla_touches": in_hours,
    }
    rows = _unified(t, "Chat", rules, without_chats=True)
    messaging = _unified_sla(rows, t["employees"], flags, "qualified_sla_touches", since_year)

    chats = _chats(t, rules).filter(F.col("chat_created_at") >= F.lit(f"{since_year}-01-01").cast("timestamp_ntz"))
    named = chats.withColumns(
        {
            "employee_id": F.col("chat_advocate_employee_id"),
            "full_name": F.col("chat_advocate"),
            "city": F.col("chat_advocate_city"),
        }
    )
    came = named.withColumn("ts", trunc("hour", convert_tz("chat_created_at", tz, UTC)))
    done = named.withColumn("ts", trunc("hour", convert_tz("chat_start_time", tz, UTC)))
    entering = distinct_counts(came, ["ts", *_UNI_KEYS], "chat_transcript_id", {"entering_touches": None})
    handled = _chat_handled(done, ["ts", *_UNI_KEYS]).withColumns(
        {
            "concurrency": concurrency("touch_lifetime_min", "handle_time_min"),
            "percent_touches_in_sla": safe_ratio("touches_in_sla", "qualified_sla_touches", 100),
        }
    )
    chat = entering_handled(entering, handled.drop("full_name", "city", "channel", "business_unit_name"), ["ts", "employee_id", "team_name"])
    schema = {f.name: f.dataType.simpleString() for f in messaging.schema.fields}
    return union_distinct([messaging, chat], schema)


def messaging_sla_total(t: Tables, start, stop, rules: SlaRules, *, tz: str = PACIFIC) -> DataFrame:
    """Ungrouped messaging and chat totals, two rows."""
    span = Span.of(start, stop)
    came = _within(t["messaging_touches"], "touch_start_time", span, "hour", tz)
    done = _within(t["messaging_touches"], "touch_assignment_time", span, "hour", tz)
    entering = distinct_counts(_with_queue(came, t["queue_catalog"], rules), [], "touch_start_id", {"entering_touches": None})
    handled = _messaging_handled(_with_queue(done, t["queue_catalog"], rules), [], avgs=True)
    chats = _chats(t, rules)
    chat_in = distinct_counts(
        _within(chats, "chat_created_at", span, "hour", tz), [], "chat_transcript_id", {"entering_touches": None}
    )
    chat_done = _chat_handled(_within(chats, "chat_start_time", span, "hour", tz), [], avgs=True)
    parts = []
    for name, a, b in (("messaging", entering, handled), ("chat", chat_in, chat_done)):
        row = side_by_side(a, b).withColumns(
            {
                "sl_percent": safe_ratio("touches_in_sla", "qualified_sla_touches", 100),
                "concurrency": concurrency("touch_lifetime_min", "handle_time_min"),
                "source": F.lit(name),
            }
        )
        parts.append(row)
    return parts[0].unionByName(parts[1])


def sla_grand_totals(t: Tables, channel: str, start, stop, rules: SlaRules) -> DataFrame:
    """Ungrouped reconciliation of one channel."""
    if channel == "voice":
        return voice_sla_total(t, start, stop)
    return {"email": email_sla_total, "messaging": messaging_sla_total}[channel](t, start, stop, rules)
