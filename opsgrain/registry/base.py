"""Registration, and the views that show the test tables as support-desk tables.

A view is a list of column expressions over one table.  The same list feeds the Spark plan
and the DuckDB text, so both sides start from the same rows; what is done with them is
written independently.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from ..sources.tables import load, text_times

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; times come out as text, like in the SQL.

    This is the entry for sessions that somebody else made: the settings every plan relies on are set here, once, and nowhere in the library.
    """

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return text_times(fn(configure(spark), sf_dir))

        run.__name__ = name
        run.__module__ = fn.__module__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


class _Spark:
    text = "string"
    k = "k"

    @staticmethod
    def stamp(day: str) -> str:
        return f"cast('{day}' as timestamp_ntz)"

    @staticmethod
    def plus(ts: str, seconds: str) -> str:
        return f"timestampadd(SECOND, cast({seconds} as int), {ts})"


class _Duck:
    text = "varchar"
    k = "k"

    @staticmethod
    def stamp(day: str) -> str:
        return f"cast('{day}' as timestamp)"

    @staticmethod
    def plus(ts: str, seconds: str) -> str:
        return f"({ts} + to_seconds(cast({seconds} as int)))"


@dataclass(frozen=True)
class View:
    """table + column expressions (+ filter); several parts are a UNION ALL."""

    parts: Sequence[tuple[str, Callable]] = field(default_factory=tuple)
    where: str | None = None

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        out = None
        for table, cols in self.parts:
            df = load(spark, sf_dir, table)[table]
            if table == "events":
                # the attribute is used many times below, so it is read from the text once
                df = df.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
            if self.where:
                df = df.where(self.where)
            df = df.selectExpr(*cols(_Spark))
            out = df if out is None else out.unionAll(df)
        return out

    def sql(self) -> str:
        cond = f" WHERE {self.where}" if self.where else ""
        source = {"events": "(SELECT *, CAST(json_extract(props, '$.k') AS int) AS k FROM events)"}
        return " UNION ALL ".join(f"SELECT {', '.join(cols(_Duck))} FROM {source.get(table, table)}{cond}" for table, cols in self.parts)


def view(table: str, cols: Callable, where: str | None = None) -> View:
    return View(((table, cols),), where)


MESSAGING = view(
    "events",
    lambda d: [
        "event_id as touch_id",
        "event_id - event_id % 2 as touch_start_id",
        "cast(floor(event_id / 3) as bigint) as case_id",
        "user_id as employee_id",
        f"concat('Queue ', cast({d.k} % 6 as {d.text})) as queue_name",
        "ts as touch_start_time",
        f"{d.plus('ts', f'{d.k} * 600')} as touch_assignment_time",
        f"{d.plus('ts', f'{d.k} * 600 + floor(value) * 4')} as touch_end_time",
        f"case when {d.k} = 7 then null else cast(floor(value * 2) as bigint) end as response_time_seconds",
        f"case when {d.k} = 11 then null when {d.k} = 13 then 0 else cast(floor(value) as bigint) end as handle_time_seconds",
        f"case when {d.k} = 99 then null else extract(hour from ts) between 8 and 17 end as in_business_hours",
    ],
)

CATALOG = view(
    "region",
    lambda d: [
        "r_regionkey as queue_id",
        f"concat('QUEUE ', cast(r_regionkey as {d.text})) as queue_name",
        "r_name as team_name",
        "case when r_regionkey % 2 = 0 then 'CHAT' else 'EMAIL' end as communication_channel",
        "case r_regionkey when 0 then 'Customer Success - Specialty' when 1 then 'CUSTOMER SUCCESS - CORE'"
        " when 2 then 'Other' when 3 then null else 'Finance' end as business_unit_name",
    ],
)


def _employee(first: str, last: str, city: str):
    return lambda d: [
        "c_custkey as employee_id",
        "c_custkey as agent_id",
        f"concat('u', cast(c_custkey as {d.text})) as uid",
        "c_name as full_name",
        f"{city} as city",
        f"concat('M', cast(c_nationkey % 5 as {d.text})) as manager",
        f"concat('D', cast(c_nationkey % 2 as {d.text})) as managers_manager",
        "case when c_nationkey % 3 = 0 then 'MET 1' when c_nationkey % 3 = 1 then 'core' else null end as team_code",
        "c_nationkey % 2 = 0 as is_bpo",
        "c_nationkey % 7 <> 0 as is_advocate",
        f"cast('{first}' as date) as start_date",
        f"cast('{last}' as date) as end_date",
    ]


EMPLOYEES = View(
    (
        ("customer", _employee("2023-01-01", "2024-01-14", "c_mktsegment")),
        ("customer", _employee("2024-01-15", "2024-01-28", "lower(c_mktsegment)")),
    )
)

CHATS = view(
    "events",
    lambda d: [
        "event_id as chat_transcript_id",
        "case event_type when 'signup' then 'RD Chat' when 'error' then 'Internal Advocate Success' else 'Other' end as chat_record_type",
        "ts as chat_created_at",
        f"{d.plus('ts', 'floor(value) * 10')} as chat_start_time",
        "cast(floor(value) as bigint) as chat_wait_time",
        f"case when {d.k} < 20 then 0 else {d.k} * 20 end as chat_handle_time",
        "user_id as chat_advocate_employee_id",
        f"concat('A', cast(user_id as {d.text})) as chat_advocate",
        f"concat('C', cast(user_id % 4 as {d.text})) as chat_advocate_city",
        "cast(floor(event_id / 3) as bigint) as parent_case_id",
        "ts as parent_case_created_at",
    ],
)

CASES_UTC = view(
    "events",
    lambda d: [
        "cast(floor(event_id / 2) as bigint) as case_id",
        "case when event_type in ('view', 'click') then 'Chat' else 'Email' end as channel",
        "ts as created_at_utc",
    ],
)

EMAILS = view(
    "events",
    lambda d: [
        "event_id as touch_id",
        "cast(floor(event_id / 3) as bigint) as case_id",
        "user_id as advocate_id",
        f"concat('Queue ', cast({d.k} % 6 as {d.text})) as queue_name",
        f"{d.k} % 6 as queue_id",
        f"case {d.k} % 7 when 0 then 'EML' when 1 then 'EML/STS' when 2 then 'TRN' when 3 then 'EML/TRN'"
        " when 4 then 'STS' when 5 then 'TR' else 'EML/TR' end as touch_type",
        "ts as touch_start_time",
        f"{d.plus('ts', 'floor(value) * 8')} as touch_time",
        f"case when {d.k} = 7 then null else cast(floor(value / 10) as bigint) end as response_time_minutes",
        f"case when {d.k} = 7 then null else cast(floor(value / 8) as bigint) end as response_time_hours",
        f"case when {d.k} = 11 then null else cast(floor(value) as bigint) end as touch_handle_time",
    ],
)

CALLS = view(
    "events",
    lambda d: [
        "event_id as contact_id",
        "cast(floor(event_id / 4) as bigint) as initial_contact_id",
        f"case when {d.k} % 10 = 0 then null else cast(floor(event_id / 2) as bigint) end as case_id",
        f"concat('Queue ', cast({d.k} % 6 as {d.text})) as queue_name",
        f"case when {d.k} % 9 = 0 then 'TRANSFER' when event_type in ('view', 'signup') then 'INBOUND' when event_type = 'purchase' then 'OUTBOUND'"
        " when event_type = 'error' then 'CALLBACK' else 'API' end as initiation_method",
        f"case when {d.k} % 5 = 0 then null else user_id end as agent_user_name",
        "user_id as customer_endpoint",
        "event_type as system_endpoint",
        "ts as call_start_time",
        f"{d.plus('ts', 'floor(value / 10)')} as call_end_time",
        f"{d.k} * 2 as wait_time",
        f"case when {d.k} % 4 = 0 then null else ts end as wait_start_time",
        f"case when {d.k} = 11 then null else cast(floor(value) as bigint) end as handle_time",
        "cast(floor(value / 2) as bigint) as talk_time",
        f"case when {d.k} % 8 = 0 then null else {d.k} end as wrap_time",
        f"cast({d.k} % 30 as bigint) as hold_time",
        f"case when {d.k} % 7 = 0 then {d.k} * 30 else null end as speed_to_callback",
        f"{d.k} % 3 <> 0 as is_handled",
        f"{d.k} % 3 = 0 as is_abandoned",
        f"{d.k} % 2 = 0 as is_queued",
        "extract(hour from ts) >= 18 as out_of_hours",
        f"{d.k} % 11 = 0 as rejected_queued",
        f"case when {d.k} % 7 = 0 then true when {d.k} % 13 = 0 then false else null end as requested_callback",
        f"{d.k} % 17 = 0 as hit_volume_threshold",
        f"{d.k} % 4 <> 1 as is_customer",
        f"{d.k} % 19 = 0 as is_voicemail",
        f"case when {d.k} % 23 = 0 then true when {d.k} % 5 = 1 then false else null end as is_pii_passed",
        f"case when {d.k} % 6 = 0 then 'pressed_1' when {d.k} % 6 = 1 then null else 'timeout' end as raw_ivr_outcome",
        f"case when {d.k} % 12 = 0 then 'CONTACT_FLOW_DISCONNECT_REASON' else 'CUSTOMER_DISCONNECT' end as disconnect_reason",
        "case when user_id % 3 = 0 then true else false end as is_in_app_queue",
    ],
)

UNIFIED = view(
    "events",
    lambda d: [
        "event_id as touch_id",
        "cast(floor(event_id / 3) as bigint) as case_id",
        "user_id as advocate_id",
        f"concat('Queue ', cast({d.k} % 6 as {d.text})) as queue_name",
        "case when event_type in ('signup', 'click', 'view') then 'Chat' else 'Email' end as channel",
        "ts as touch_assignment_time",
        f"{d.plus('ts', f'{d.k} * 300')} as touch_start_time",
        f"{d.plus('ts', f'{d.k} * 300 + floor(value)')} as touch_end_time",
        f"case when {d.k} = 7 then null else cast(floor(value * 4) as bigint) end as response_time",
        f"case when {d.k} = 11 then null else cast(floor(value) as bigint) end as handle_time",
        f"case when {d.k} = 99 then null else extract(hour from ts) between 8 and 17 end as in_business_hours",
        f"case {d.k} % 5 when 0 then 'EML' when 1 then 'EML/TRN' when 2 then 'TR' when 3 then 'Transfer' else null end as inbound_type",
    ],
)

SUPPORT_CASES = view(
    "orders",
    lambda d: [
        "o_orderkey as case_id",
        "o_custkey as customer_token",
        "o_orderdate as case_creation_date_time",
        "case when o_orderkey % 17 = 0 then null else o_orderpriority end as problem_tag",
        "case o_orderstatus when 'O' then 'Chat' when 'F' then 'Phone' else 'Email' end as origin",
        "case when o_orderkey % 5 = 0 then null else o_orderpriority end as channel",
        "case when o_orderstatus = 'F' then 'Closed' when o_orderstatus = 'P' then 'Resolved' else 'Open' end as status",
        "o_totalprice as amount",
    ],
)

CLASSIFIED = view(
    "labels",
    lambda d: ["doc_id as case_id", "quality as has_complaint_reviewed", "toxic as has_complaint_model"],
)


@lru_cache(maxsize=1)
def _own_folder() -> tempfile.TemporaryDirectory:
    """Removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix="opsgrain-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for the files of one query: below ``spark.checkpoint.dir``, one of its own only where that is unset and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = root or _own_folder().name
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def frames(spark: SparkSession, sf_dir: str, **views: View) -> dict[str, DataFrame]:
    return {name: v.spark(spark, sf_dir) for name, v in views.items()}


def with_views(sql: str, **views: View) -> str:
    """The views as CTEs in front of ``sql``, which starts with further CTEs or SELECT."""
    ctes = ", ".join(f"{name} AS ({v.sql()})" for name, v in views.items())
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def times(*cols: str) -> str:
    """DuckDB text of timestamp columns, to be put into a select list."""
    return ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c.split('.')[-1]}" for c in cols)
