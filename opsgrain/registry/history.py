"""Change logs, paths, first and latest rows, lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dialect import array_slice0
from ..operators import history as h
from ..operators.joins import asof_dim, state_at
from ..operators.metrics import concurrency, distinct_counts, with_totals
from ..operators.ordered import ordered
from ..plans import cases, complaints, jobs
from ..sources.tables import load
from .base import EMPLOYEES, View, frames, register, view, with_views

# a customer's events read as the moves of a case between queues
CASE_HISTORY = View(
    (
        (
            "events",
            lambda d: [
                "'S1' as source", "user_id as case_id", "'owner' as field", f"{d.k} % 6 as new_value",
                "event_id % 40 as created_by_id", "ts as created_date",
            ],
        ),
        (
            "events",
            lambda d: [
                "'S1' as source", "user_id as case_id", "'transfer_reason' as field", f"{d.k} % 6 + 100 as new_value",
                "event_id % 40 as created_by_id", "ts as created_date",
            ],
        ),
        (
            "events",
            lambda d: [
                "case when event_id % 3 = 0 then 'S1' else 'S0' end as source", "user_id as case_id", "'transfer_comment' as field",
                f"{d.k} + 1000 as new_value", "event_id % 40 as created_by_id", "ts as created_date",
            ],
        ),
    )
)
QUEUES = view(
    "region",
    lambda d: [
        "cast(r_regionkey as int) as queue_id",
        "case r_regionkey when 0 then 'EMAIL AUTO RESPONSE' when 1 then 'RISK ATO' when 2 then 'ACCOUNT LOCK' else r_name end as queue_name",
        "case when r_regionkey in (1, 2) then 'RISK' else 'CS' end as business_unit_name",
    ],
)
USERS = view(
    "customer",
    lambda d: [
        "c_custkey as id", "concat('user ', c_name) as name", "case when c_custkey % 20 = 0 then 'Bot' else 'Doe' end as last_name",
        f"concat('MAIL', cast(c_custkey as {d.text}), '@x.org') as email",
    ],
)
BASE_CASES = view(
    "customer",
    lambda d: [
        "c_custkey as case_id", f"concat('N', cast(c_custkey as {d.text})) as case_number",
        f"{d.plus(d.stamp('2019-05-20'), 'c_custkey % 30 * 86400')} as case_created_at",
    ],
)
PHONE_CASES = view(
    "events",
    lambda d: ["user_id + 100000 as case_id", "'Phone' as origin", "ts as created_at_utc"],
    "event_type = 'error'",
)
_PHONE = {"queue_id": "9", "queue_name": "Phone Internal", "queue_type": "CS", "user_id": "7"}

# eight hours back: UTC to Pacific in January
_STAYS = """
WITH mv AS (
  SELECT 'S1' AS source, ch.case_id, q.queue_id, q.queue_name, q.business_unit_name AS queue_type, created_by_id AS user_id,
    created_date - INTERVAL 8 HOUR AS st
  FROM ch JOIN q ON ch.new_value = q.queue_id WHERE source = 'S1'
  UNION ALL
  SELECT 'S1', case_id, 9, 'Phone Internal', 'CS', 7, created_at_utc - INTERVAL 8 HOUR FROM ph WHERE origin = 'Phone'),
lg AS (SELECT *, lag(queue_id) OVER (PARTITION BY case_id ORDER BY st, queue_id, user_id) AS pq FROM mv),
kept AS (SELECT * FROM lg WHERE pq IS NULL OR pq <> queue_id),
num AS (
  SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY st, queue_id, user_id) AS queue_number,
    lead(st) OVER (PARTITION BY case_id ORDER BY st, queue_id, user_id) - INTERVAL 1 SECOND AS en FROM kept),
notes AS (
  SELECT case_id, created_by_id, created_date - INTERVAL 8 HOUR AS at, max(CASE WHEN field = 'transfer_comment' THEN new_value END) AS transfer_comment,
    max(CASE WHEN field = 'transfer_reason' THEN new_value END) AS transfer_reason
  FROM ch WHERE source = 'S1' AND field IN ('transfer_comment', 'transfer_reason') GROUP BY 1, 2, 3),
stays AS (
  SELECT concat(CAST(num.case_id AS varchar), strftime(st, '%Y-%m-%d %H:%M:%S.%g')) AS cq_hash_key, num.source, num.case_id, b.case_number, num.queue_id,
    num.queue_name, num.queue_type, e.employee_id, num.user_id, coalesce(e.full_name, u.name) AS user_name,
    coalesce(u.last_name = 'Bot', false) AS user_is_bot, transfer_reason, transfer_comment, queue_number, st AS queue_start_time, en AS queue_end_time
  FROM num LEFT JOIN u ON num.user_id = u.id
  LEFT JOIN e ON num.user_id = e.agent_id AND CAST(st AS date) BETWEEN e.start_date AND e.end_date
  LEFT JOIN notes n ON n.case_id = num.case_id AND n.created_by_id = num.user_id AND n.at = st
  LEFT JOIN b ON b.case_id = num.case_id)
"""
_STAY_VIEWS = dict(ch=CASE_HISTORY, q=QUEUES, u=USERS, e=EMPLOYEES, b=BASE_CASES, ph=PHONE_CASES)


def _stays(spark, sf_dir):
    t = frames(
        spark, sf_dir, case_history=CASE_HISTORY, queue_catalog=QUEUES, users=USERS, employees=EMPLOYEES, base_cases=BASE_CASES,
        cases=PHONE_CASES,
    )
    return cases.case_queue_history(t, source="S1", phone_queue=_PHONE), t


@register(
    "queue_history",
    with_views(
        _STAYS
        + """SELECT * REPLACE (strftime(queue_start_time, '%Y-%m-%d %H:%M:%S') AS queue_start_time,
  strftime(queue_end_time, '%Y-%m-%d %H:%M:%S') AS queue_end_time) FROM stays""",
        **_STAY_VIEWS,
    ),
)
def queue_history(spark, sf_dir):
    return _stays(spark, sf_dir)[0]


@register(
    "queue_transfers",
    with_views(
        _STAYS
        + """, x AS (
  SELECT s.*, CAST(b.case_created_at AS date) AS made, date_diff('minute', queue_start_time, queue_end_time) AS mins FROM stays s JOIN b USING (case_id)
  WHERE b.case_created_at >= TIMESTAMP '2019-06-01'),
y AS (
  SELECT *, lag(queue_name) OVER w AS pqn, lag(queue_type) OVER w AS pqt, lag(user_name) OVER w AS pun, lag(user_id) OVER w AS pui, lag(queue_id) OVER w AS pqi,
    coalesce(sum(mins) OVER (PARTITION BY case_id ORDER BY queue_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life,
    row_number() OVER (PARTITION BY case_id, queue_name ORDER BY queue_number) AS visit
  FROM x WINDOW w AS (PARTITION BY case_id ORDER BY queue_number)),
z AS (SELECT *, CASE WHEN pqn = 'EMAIL AUTO RESPONSE' THEN 'OMNI' WHEN queue_number = 1 THEN 'FIRST QUEUE' ELSE pqt END AS frm FROM y)
SELECT cq_hash_key, source, case_id, case_number, strftime(made, '%Y-%m-%d') AS case_creation_date, employee_id, user_id, user_name, user_is_bot, queue_id,
  queue_number, queue_name, CAST(visit = 1 AS int) AS first_time_in_queue, queue_type, frm AS trans_from_queue_type,
  CASE WHEN frm IN ('FIRST QUEUE', 'OMNI') THEN frm WHEN frm = 'CS' AND queue_type = pqt THEN 'INTERNAL TRANSFER'
    WHEN frm = 'RISK' AND queue_name = pqn THEN 'INTERNAL TRANSFER'
    WHEN (queue_name LIKE '%ATO%' OR queue_name LIKE '%LOCK%') AND (pqn LIKE '%ATO%' OR pqn LIKE '%LOCK%') THEN 'INTERNAL TRANSFER'
    ELSE 'EXTERNAL TRANSFER' END AS trans_team_type,
  pun AS previous_trans_from_name, pui AS previous_trans_from_user_id, pqn AS previous_trans_from_queue_name, pqi AS previous_trans_from_queue_id,
  transfer_reason, transfer_comment, strftime(queue_start_time, '%Y-%m-%d %H:%M:%S') AS queue_start_time,
  strftime(queue_end_time, '%Y-%m-%d %H:%M:%S') AS queue_end_time, mins AS time_in_queue_minutes, CAST(life AS bigint) AS case_life_till_queue FROM z""",
        **_STAY_VIEWS,
    ),
)
def queue_transfers(spark, sf_dir):
    stays, t = _stays(spark, sf_dir)
    return cases.case_queue_transfers(stays, t["base_cases"])


@register(
    "field_history_pivot",
    """
SELECT user_id, strftime(CAST(ts AS date), '%Y-%m-%d') AS day, max(CASE WHEN event_type = 'view' THEN value END) AS last_view,
  max(CASE WHEN event_type = 'click' THEN value END) AS last_click, max(CASE WHEN event_type = 'error' THEN value END) AS last_error
FROM events WHERE event_type IN ('view', 'click', 'error') GROUP BY 1, 2""",
)
def field_history_pivot(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"].withColumn("day", F.col("ts").cast("date"))
    return h.field_to_columns(
        events, ["user_id", "day"], "event_type", "value", {"last_view": "view", "last_click": "click", "last_error": "error"}
    )


@register(
    "event_duration_pivot",
    """
WITH p AS (SELECT user_id, max(CASE WHEN event_type = 'signup' THEN ts END) AS a, max(CASE WHEN event_type = 'purchase' THEN ts END) AS b FROM events GROUP BY 1)
SELECT user_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS start_ts, strftime(b, '%Y-%m-%d %H:%M:%S') AS end_ts, date_diff('second', a, b) AS duration_seconds FROM p""",
)
def event_duration_pivot(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"]
    return h.event_duration(events, ["user_id"], "event_type", "ts", "signup", "purchase")


CASE_EVENTS = view(
    "events",
    lambda d: [
        "event_id as id", f"cast(user_id as {d.text}) as case_token", f"{d.k} % 3 as case_queue_id",
        "case event_type when 'signup' then 'ASSIGN' when 'purchase' then 'CLOSED_COMPLETE' else 'CREATE_CASE' end as logical_event_name",
        "ts as created_at",
    ],
)
TOKEN_CASES = view(
    "customer",
    lambda d: [f"cast(c_custkey as {d.text}) as token", "c_nationkey as queue_label_id", f"concat('T', cast(c_custkey as {d.text})) as target_token"],
)
LABELS = view("nation", lambda d: ["case when n_regionkey = 4 then -1 - n_nationkey else n_nationkey end as id", "n_name as name"])


@register(
    "event_pair_duration",
    with_views(
        """
WITH p AS (
  SELECT a.case_token, a.created_at AS assigned_at, min(b.created_at) AS completed_at, a.id
  FROM a JOIN a b ON a.case_token = b.case_token AND a.case_queue_id = b.case_queue_id AND b.created_at >= a.created_at
  WHERE a.logical_event_name = 'ASSIGN' AND b.logical_event_name = 'CLOSED_COMPLETE' AND a.created_at >= TIMESTAMP '2024-01-03' GROUP BY 1, 2, 4)
SELECT p.case_token, l.name AS subroute, strftime(assigned_at, '%Y-%m-%d') AS date, strftime(assigned_at, '%Y-%m-%d %H:%M:%S') AS assigned_at,
  strftime(completed_at, '%Y-%m-%d %H:%M:%S') AS completed_at, date_diff('second', p.assigned_at, p.completed_at) AS handle_time_seconds
FROM p LEFT JOIN c ON c.token = p.case_token LEFT JOIN l ON l.id = c.queue_label_id""",
        a=CASE_EVENTS, c=TOKEN_CASES, l=LABELS,
    ),
)
def event_pair_duration(spark, sf_dir):
    t = frames(spark, sf_dir, a=CASE_EVENTS, c=TOKEN_CASES, l=LABELS)
    return cases.case_handle_time(t["a"], t["c"], t["l"], since="2024-01-03")


@register(
    "regulated_handle_seconds",
    with_views(
        """
WITH p AS (
  SELECT c.target_token, l.name AS subroute, max(CASE WHEN a.logical_event_name = 'ASSIGN' THEN a.created_at END) AS s,
    max(CASE WHEN a.logical_event_name = 'CLOSED_COMPLETE' THEN a.created_at END) AS e
  FROM a LEFT JOIN c ON a.case_token = c.token LEFT JOIN l ON c.queue_label_id = l.id GROUP BY 1, 2)
SELECT target_token, subroute, strftime(s, '%Y-%m-%d %H:%M:%S') AS start_ts, strftime(e, '%Y-%m-%d %H:%M:%S') AS end_ts, date_diff('second', s, e) AS handled_seconds FROM p""",
        a=CASE_EVENTS, c=TOKEN_CASES, l=LABELS,
    ),
)
def regulated_handle_seconds(spark, sf_dir):
    t = frames(spark, sf_dir, a=CASE_EVENTS, c=TOKEN_CASES, l=LABELS)
    return cases.regulated_handle_seconds(t["a"], t["c"], t["l"])


TIME_BY_USER = view(
    "events",
    lambda d: [
        "cast(floor(event_id / 3) as bigint) as case_id", "user_id", "ts as start_timestamp",
        f"{d.plus('ts', 'floor(value) * 10')} as stop_timestamp", "cast(floor(value) * 10 as bigint) as time_spent",
    ],
)
NUMBERED_CASES = view(
    "orders",
    lambda d: [
        "o_orderkey as case_id", f"concat('N', cast(o_orderkey as {d.text})) as case_number", "o_orderpriority as problem_tag",
        "o_orderdate as case_creation_date_time",
    ],
)
CURRENT_STAFF = view(
    "customer",
    lambda d: [
        "c_name as full_name", f"concat('mail', cast(c_custkey as {d.text}), '@X.org') as email_today",
        "case when c_custkey % 10 = 0 then 'Left' else 'Current' end as role_status",
        f"concat('M', cast(c_nationkey % 5 as {d.text})) as manager", f"concat('D', cast(c_nationkey % 2 as {d.text})) as managers_manager",
    ],
)


@register(
    "handle_time_totals",
    with_views(
        """
WITH j AS (
  SELECT c.case_number, concat('https://desk.example/case/', CAST(t.case_id AS varchar), '/view') AS link, strftime(c.case_creation_date_time, '%Y-%m-%d') AS case_creation_date,
    e.full_name, e.manager, e.managers_manager, t.case_id, t.user_id, t.start_timestamp AS s, t.stop_timestamp AS f, t.time_spent AS handle_time_seconds, c.problem_tag
  FROM t JOIN c ON t.case_id = c.case_id LEFT JOIN u ON t.user_id = u.id LEFT JOIN e ON lower(u.email) = lower(e.email_today) AND e.role_status = 'Current'
  WHERE CAST(c.case_creation_date_time AS date) >= DATE '1996-01-01' AND CAST(t.start_timestamp AS date) >= DATE '2024-01-03' AND CAST(t.stop_timestamp AS date) >= DATE '2024-01-04')
SELECT j.* EXCLUDE (s, f), strftime(s, '%Y-%m-%d %H:%M:%S') AS touch_start_time, strftime(f, '%Y-%m-%d %H:%M:%S') AS touch_end_time,
  strftime(time_bucket(INTERVAL 30 MINUTE, s), '%Y-%m-%d %H:%M:%S') AS touch_start_interval,
  strftime(time_bucket(INTERVAL 30 MINUTE, f) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS touch_end_interval,
  CAST(sum(handle_time_seconds) OVER (PARTITION BY case_id) AS bigint) AS total_case_handle_time_seconds,
  CAST(sum(handle_time_seconds) OVER (PARTITION BY user_id) AS bigint) AS total_advocate_handle_time_seconds FROM j""",
        t=TIME_BY_USER, c=NUMBERED_CASES, u=USERS, e=CURRENT_STAFF,
    ),
)
def handle_time_totals(spark, sf_dir):
    t = frames(spark, sf_dir, time_by_user=TIME_BY_USER, support_cases=NUMBERED_CASES, users=USERS, employees=CURRENT_STAFF)
    return cases.handle_time_detail(
        t, case_since="1996-01-01", touch_since="2024-01-03", ended_since="2024-01-04", link_prefix="https://desk.example/case/"
    )


CHANNEL_HISTORY = view(
    "events",
    lambda d: ["case when event_type = 'error' then -1 - user_id else user_id end as case_id", "event_type as new_value", "ts as created_at_utc"],
)
SURVEYS = view(
    "customer",
    lambda d: ["c_custkey as case_id", f"{d.plus(d.stamp('2024-01-02'), 'c_custkey % 25 * 86400 + c_nationkey * 3600')} as csat_sent_at"],
)


@register(
    "asof_channel",
    with_views(
        """
WITH r AS (
  SELECT c.case_id, c.csat_sent_at, hh.new_value AS csat_channel, hh.created_at_utc AS entered_channel_at,
    row_number() OVER (PARTITION BY c.case_id ORDER BY hh.created_at_utc DESC, hh.new_value DESC) AS rn
  FROM c JOIN hh ON c.case_id = hh.case_id AND c.csat_sent_at >= hh.created_at_utc)
SELECT case_id, strftime(csat_sent_at, '%Y-%m-%d %H:%M:%S') AS csat_sent_at, csat_channel, strftime(entered_channel_at, '%Y-%m-%d %H:%M:%S') AS entered_channel_at
FROM r WHERE rn = 1""",
        c=SURVEYS, hh=CHANNEL_HISTORY,
    ),
)
def asof_channel(spark, sf_dir):
    return cases.csat_channel(frames(spark, sf_dir, support_cases=SURVEYS, channel_history=CHANNEL_HISTORY))


@register(
    "asof_order_before_event",
    """
WITH r AS (SELECT event_id, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY event_id ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM events LEFT JOIN orders ON user_id = o_custkey AND ts >= o_orderdate)
SELECT event_id, o_orderkey AS last_order, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS last_order_date FROM r WHERE rn = 1""",
)
def asof_order_before_event(spark, sf_dir):
    t = load(spark, sf_dir, "events", "orders")
    facts = t["events"].select("event_id", F.col("user_id").alias("o_custkey"), "ts")
    out = state_at(
        facts, t["orders"], "o_custkey", "ts", "o_orderdate", {"last_order": "o_orderkey", "last_order_date": "o_orderdate"},
        tie=["o_orderkey"], how="left", chunk="month",
    )
    return out.select("event_id", "last_order", "last_order_date")


# an order is a version of its customer's record, valid until the next order
@register(
    "advocate_sla_scd",
    """
WITH dim AS (
  SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS date) AS s,
    coalesce(lead(CAST(o_orderdate AS date)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1, DATE '9999-12-31') AS e FROM orders),
f AS (
  SELECT l_suppkey AS employee_id, CAST(l_shipdate AS date) AS d, l_orderkey, l_quantity, l_linenumber, l_shipdate, l_linestatus, o_custkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT dim.o_orderpriority AS team, count(DISTINCT f.l_orderkey) AS handled, count(DISTINCT CASE WHEN l_linestatus = 'F' THEN f.l_orderkey END) AS qualified,
  count(DISTINCT CASE WHEN l_quantity <= 10 AND l_linestatus = 'F' THEN f.l_orderkey END) AS in_sla, CAST(sum(l_quantity) AS double) AS lifetime,
  round(CAST(sum(l_quantity) AS double) / nullif(CAST(sum(l_linenumber) AS double), 0), 6) AS concurrency
FROM f LEFT JOIN dim ON f.o_custkey = dim.o_custkey AND f.d BETWEEN dim.s AND dim.e GROUP BY 1""",
)
def advocate_sla_scd(spark, sf_dir):
    t = load(spark, sf_dir, "orders", "lineitem")
    versions = t["orders"].select("o_custkey", "o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("start_date"))
    dim = h.to_intervals(versions, "o_custkey", "start_date", tie=["o_orderkey"], end="end_ts", gap_seconds=86400)
    dim = dim.withColumn("end_date", F.coalesce(F.col("end_ts").cast("date"), F.lit("9999-12-31").cast("date")))
    facts = t["lineitem"].join(t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    seen = asof_dim(facts, dim, "o_custkey", "l_shipdate", {"team": "o_orderpriority"})
    closed = F.col("l_linestatus") == "F"
    out = distinct_counts(
        seen, ["team"], "l_orderkey", {"handled": None, "qualified": closed, "in_sla": (F.col("l_quantity") <= 10) & closed},
        sums={"lifetime": F.col("l_quantity"), "__handle": F.col("l_linenumber")},
    )
    return out.withColumn("concurrency", F.round(concurrency("lifetime", "__handle"), 6)).drop("__handle")


COMPLAINT_LOG = View(
    (
        (
            "events",
            lambda d: [
                "event_id as log_id", "user_id as parent_id", "'Status' as field", f"cast({d.k} as {d.text}) as old_value",
                f"case {d.k} % 6 when 0 then 'Closed' when 1 then 'Archived' when 2 then 'Withdrawn' when 3 then 'Inquiry (Not a Complaint)' when 4 then 'Open' else null end as new_value",
                "event_id % 50 as created_by_id", "ts as created_at_utc",
            ],
        ),
        (
            "events",
            lambda d: [
                "event_id + 1000000000 as log_id", "user_id as parent_id", "'Owner' as field", "event_type as old_value",
                f"case when {d.k} % 2 = 0 then 'Some Name' else concat('id', cast({d.k} as {d.text})) end as new_value",
                "event_id % 50 as created_by_id", "ts as created_at_utc",
            ],
        ),
    )
)
_DONE = "coalesce(new_value IN ('Closed', 'Inquiry (Not a Complaint)', 'Archived', 'Withdrawn'), false)"


@register(
    "touch_status_history",
    with_views(
        f"""
WITH own AS (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY created_at_utc, log_id) AS rn FROM g WHERE field = 'Owner')
SELECT parent_id, field, old_value, new_value, strftime(created_at_utc, '%Y-%m-%d %H:%M:%S') AS ts, false AS is_touch FROM own WHERE rn = 1
UNION ALL
SELECT parent_id, field, old_value, new_value, strftime(created_at_utc, '%Y-%m-%d %H:%M:%S'), {_DONE} FROM g WHERE field = 'Status'""",
        g=COMPLAINT_LOG,
    ),
)
def touch_status_history(spark, sf_dir):
    return complaints.touch_status_history(COMPLAINT_LOG.spark(spark, sf_dir), tie=["log_id"])


@register(
    "touch_owner_history",
    with_views(
        f"""
SELECT parent_id, field, old_value, new_value, strftime(created_at_utc, '%Y-%m-%d %H:%M:%S') AS ts, {_DONE} AS is_touch, u.name
FROM g LEFT JOIN u ON g.created_by_id = u.id WHERE field = 'Owner' AND new_value NOT ILIKE '% %'
UNION ALL
SELECT parent_id, field, old_value, new_value, strftime(created_at_utc, '%Y-%m-%d %H:%M:%S'), {_DONE}, new_value FROM g WHERE field = 'Status'""",
        g=COMPLAINT_LOG, u=USERS,
    ),
)
def touch_owner_history(spark, sf_dir):
    return complaints.touch_owner_history(COMPLAINT_LOG.spark(spark, sf_dir), USERS.spark(spark, sf_dir))


@register(
    "touch_counts",
    with_views(f"SELECT parent_id, count(*) AS handled_count FROM g WHERE field = 'Status' AND {_DONE} GROUP BY 1", g=COMPLAINT_LOG),
)
def touch_counts(spark, sf_dir):
    return complaints.handled_counts(COMPLAINT_LOG.spark(spark, sf_dir))


@register(
    "latest_version_ties",
    """
WITH m AS (SELECT *, max(l_shipdate) OVER (PARTITION BY l_orderkey) AS top FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM m WHERE l_shipdate = top""",
)
def latest_version_ties(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem")["lineitem"]
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"]
    return h.latest_version(items.select(*cols), ["l_orderkey"], "l_shipdate")


JOBS = view(
    "part",
    lambda d: [
        "p_partkey as id", "p_name as name", "p_type as cron", "case p_size % 5 when 0 then 'DELETED' when 1 then 'ARCHIVED' when 2 then 'INACTIVE' else 'ACTIVE' end as state",
        "p_partkey % 90 as create_user_id", "p_partkey % 130 as update_user_id", "p_size % 4 as project_id",
        f"{d.stamp('2023-01-05')} as created_at", f"{d.plus(d.stamp('2023-02-01'), 'p_size * 40000')} as updated_at",
        "concat('select * from raw_oltp.', p_name, ' where brand = ', p_brand) as raw_sql",
    ],
)
JOB_ITEMS = view(
    "lineitem",
    lambda d: [
        "l_partkey as job_id", "l_linenumber as job_version",
        f"concat('[\"db', cast(l_suppkey % 3 as {d.text}), '.s.t', cast(l_partkey % 7 as {d.text}), '\", \"db.main.', l_returnflag, '\"]') as source_tables",
        f"concat('out.mart.', l_linestatus, cast(l_partkey % 5 as {d.text})) as target_table",
    ],
)
JOB_USERS = view("customer", lambda d: ["case when c_mktsegment = 'BUILDING' then -1 - c_custkey else c_custkey end as id", "c_name as user_name"])
_TOP = """top AS (SELECT i.*, max(job_version) OVER (PARTITION BY job_id) AS mx FROM i)"""


@register(
    "job_owners",
    with_views(
        f"""
WITH {_TOP}
SELECT DISTINCT t.job_id, j.name, j.cron, j.state, c.user_name AS create_user_name, p.user_name AS update_user_name,
  strftime(j.created_at, '%Y-%m-%d') AS created_at, strftime(j.updated_at, '%Y-%m-%d') AS updated_at, t.job_version, j.project_id
FROM top t LEFT JOIN j ON t.job_id = j.id LEFT JOIN u c ON j.create_user_id = c.id LEFT JOIN u p ON j.update_user_id = p.id
WHERE t.job_version = t.mx AND j.project_id IN (1, 2) AND j.state NOT IN ('DELETED', 'ARCHIVED') AND j.name ILIKE '%RED%'""",
        i=JOB_ITEMS, j=JOBS, u=JOB_USERS,
    ),
)
def job_owners(spark, sf_dir):
    t = frames(spark, sf_dir, job_items=JOB_ITEMS, jobs=JOBS, users=JOB_USERS)
    return jobs.job_owners(t, projects=[1, 2], name_pattern="%red%")


@register(
    "jobs_by_text",
    with_views("SELECT project_id, id, name FROM j WHERE project_id IN (1, 2) AND state NOT IN ('DELETED', 'ARCHIVED', 'INACTIVE') AND (raw_sql ILIKE '%blue%' OR raw_sql ILIKE '%brand#1%')", j=JOBS),
)
def jobs_by_text(spark, sf_dir):
    return jobs.jobs_by_text(JOBS.spark(spark, sf_dir), projects=[1, 2], patterns=["%BLUE%", "%Brand#1%"])


@register(
    "lineage_explode",
    with_views(
        f"""
WITH {_TOP}, e AS (SELECT job_id, unnest(from_json(source_tables, '["varchar"]')) AS a FROM top WHERE job_version = mx)
SELECT DISTINCT job_id, a AS source_table_address, split_part(a, '.', 1) AS source_database_name, split_part(a, '.', 2) AS source_schema_name,
  split_part(a, '.', 3) AS source_table_name FROM e""",
        i=JOB_ITEMS,
    ),
)
def lineage_explode(spark, sf_dir):
    return jobs.source_tables(JOB_ITEMS.spark(spark, sf_dir))


@register(
    "lineage_targets",
    with_views(
        f"""
WITH {_TOP}
SELECT DISTINCT job_id, target_table AS target_table_address, split_part(target_table, '.', 1) AS target_database_name,
  split_part(target_table, '.', 2) AS target_schema_name, split_part(target_table, '.', 3) AS target_table_name FROM top WHERE job_version = mx""",
        i=JOB_ITEMS,
    ),
)
def lineage_targets(spark, sf_dir):
    return jobs.target_tables(JOB_ITEMS.spark(spark, sf_dir))


@register(
    "job_items_latest",
    with_views(
        """
WITH f AS (SELECT i.* FROM i JOIN j ON i.job_id = j.id WHERE project_id IN (1, 2) AND state NOT IN ('DELETED', 'ARCHIVED', 'INACTIVE')),
m AS (SELECT f.*, max(job_version) OVER (PARTITION BY job_id) AS mx FROM f)
SELECT job_id, job_version, source_tables, target_table FROM m WHERE job_version = mx""",
        i=JOB_ITEMS, j=JOBS,
    ),
)
def job_items_latest(spark, sf_dir):
    t = frames(spark, sf_dir, job_items=JOB_ITEMS, jobs=JOBS)
    return jobs.latest_items(t, projects=[1, 2])


QUERY_LOG = view(
    "documents",
    lambda d: ["source as user_name", "lang as query_type", "text as query_text", f"cast({d.plus(d.stamp('2023-01-01'), 'doc_id % 700 * 86400')} as date) as end_date"],
)


@register(
    "text_usage_search",
    with_views(
        """
SELECT user_name, query_type, md5(query_text) AS query_hash, strftime(max(end_date), '%Y-%m-%d') AS query_last_run, length(query_text) AS query_text
FROM q WHERE end_date >= DATE '2023-01-01' AND end_date < DATE '2024-01-01' AND lower(user_name) NOT IN ('src1', 'src2')
  AND query_text ILIKE '%the%' AND query_text ILIKE '%an_%' GROUP BY user_name, query_type, query_text""",
        q=QUERY_LOG,
    ),
)
def text_usage_search(spark, sf_dir):
    log = QUERY_LOG.spark(spark, sf_dir)
    out = jobs.table_usage(log, patterns=["%THE%", "%an_%"], year=2023, skip_users=["src1", "src2"])
    return out.withColumn("query_text", F.length("query_text").cast("bigint"))


@register(
    "state_stays_on_turns",
    """
WITH l AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations),
k AS (SELECT * FROM l WHERE p IS NULL OR p <> role),
n AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS seq FROM k)
SELECT n.*, max(seq) OVER (PARTITION BY conv_id) AS steps FROM n""",
)
def state_stays_on_turns(spark, sf_dir):
    """Change points of the speaker per conversation, ordered by turn instead of time."""
    from ..operators.ordered import ordered

    talk = load(spark, sf_dir, "conversations")["conversations"].select("conv_id", "turn", "role")
    span = F.floor(F.col("turn") / 100)
    seen = ordered(talk, ["conv_id"], ["turn"], span, lag={"p": F.col("role")})
    kept = seen.filter(F.col("p").isNull() | (F.col("p") != F.col("role"))).drop("p")
    numbered = ordered(kept, ["conv_id"], ["turn"], span, number="seq")
    return with_totals(numbered, ["conv_id"], {"steps": ("max", F.col("seq"))})


@register(
    "first_message",
    """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations WHERE role = 'user')
SELECT conv_id, turn, length(text) AS chars FROM r WHERE rn = 1""",
)
def first_message(spark, sf_dir):
    talk = load(spark, sf_dir, "conversations")["conversations"].filter("role = 'user'")
    slim = talk.select("conv_id", "turn", F.length("text").cast("bigint").alias("chars"))
    return h.first_event(slim, ["conv_id"], "turn")


@register(
    "elapsed_before",
    """
SELECT event_id, CAST(coalesce(sum(CAST(floor(value) AS bigint)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS elapsed_before FROM events""",
)
def elapsed_before(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"].withColumn("spent", F.floor("value"))
    return h.elapsed_until(events, "user_id", "ts", "spent", tie=["event_id"]).select("event_id", "elapsed_before")


@register(
    "path_steps",
    """
WITH n AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS step FROM conversations)
SELECT conv_id, step, role AS value, step - 1 AS prior_steps, count(*) OVER (PARTITION BY conv_id) - step AS later_steps,
  step = count(*) OVER (PARTITION BY conv_id) AS is_last FROM n""",
)
def path_steps(spark, sf_dir):
    talk = load(spark, sf_dir, "conversations")["conversations"].select("conv_id", "turn", "role")
    numbered = ordered(talk, ["conv_id"], ["turn"], F.floor(F.col("turn") / 100), number="seq")
    return h.path_steps(numbered, "conv_id", "seq", "role")


@register(
    "queue_paths",
    with_views(
        _STAYS
        + """SELECT case_id, queue_number AS step, queue_name AS value, queue_number - 1 AS prior_steps,
  count(*) OVER (PARTITION BY case_id) - queue_number AS later_steps, lead(queue_number) OVER (PARTITION BY case_id ORDER BY queue_number) IS NULL AS is_last FROM stays""",
        **_STAY_VIEWS,
    ),
)
def queue_paths(spark, sf_dir):
    return h.path_steps(_stays(spark, sf_dir)[0], "case_id", "queue_number", "queue_name")


@register(
    "array_slices",
    """
WITH a AS (SELECT p_partkey, string_split(p_type, ' ') AS words FROM part)
SELECT p_partkey, array_to_string(words[1:1], ', ') AS head, array_to_string(words[2:], ', ') AS rest, len(words) AS words_n FROM a""",
)
def array_slices(spark, sf_dir):
    words = F.split("p_type", " ", -1)
    return load(spark, sf_dir, "part")["part"].select(
        "p_partkey", F.array_join(array_slice0(words, 0, 1), ", ").alias("head"),
        F.array_join(array_slice0(words, 1, F.size(words)), ", ").alias("rest"), F.size(words).cast("bigint").alias("words_n"),
    )


@register(
    "filled_state",
    """
SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_signup FROM events""",
)
def filled_state(spark, sf_dir):
    from ..operators.ordered import fill_forward, time_chunk

    events = load(spark, sf_dir, "events")["events"]
    rows = events.select("event_id", "user_id", "ts", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("last_signup"))
    return fill_forward(rows, ["user_id"], ["ts", "event_id"], time_chunk("ts"), ["last_signup"]).select("event_id", "last_signup")


@register(
    "pivot_events",
    """
SELECT user_id, max(CASE WHEN event_type = 'signup' THEN value END) AS signup, max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
  max(CASE WHEN event_type = 'refund' THEN value END) AS refund FROM events GROUP BY 1""",
)
def pivot_events(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"]
    return h.pivot_max(events, ["user_id"], "event_type", "value", ["signup", "purchase", "refund"])
