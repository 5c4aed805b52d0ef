"""Nearest contacts, tolerance matches, keys from text, remediation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dialect import regexp_first
from ..operators.joins import exclude, seen_before
from ..operators.match import nearest_related
from ..plans import cases, complaints, payments, voice
from ..sources.tables import load
from .base import CALLS, EMPLOYEES, SUPPORT_CASES, View, frames, register, view, with_views
from .rules import REMEDIATION

# every order is a case with a call, so that the repeat logic runs over the whole table
_NEAR = """
near AS (
  SELECT b1.case_id, {name}, date_diff('day', b1.ts, b2.ts) AS dd, b2.ts AS ts2, b2.tag AS tag2,
    row_number() OVER (PARTITION BY b1.case_id ORDER BY abs(date_diff('day', b1.ts, b2.ts)),
      CASE WHEN (b2.ts, b2.case_id) < (b1.ts, b1.case_id) THEN 0 ELSE 1 END,
      CASE WHEN (b2.ts, b2.case_id) < (b1.ts, b1.case_id) THEN -epoch(b2.ts) ELSE epoch(b2.ts) END,
      CASE WHEN (b2.ts, b2.case_id) < (b1.ts, b1.case_id) THEN -b2.case_id ELSE b2.case_id END) AS rn
  FROM base b1 JOIN base b2 ON b1.cust = b2.cust AND b1.case_id <> b2.case_id {cond})"""


def _near(name: str, cond: str) -> str:
    return _NEAR.format(name=f"'{name}' AS kind", cond=cond).replace("near AS", f"{name}_n AS", 1)


_FCR = f"""
WITH base AS (SELECT customer_token AS cust, problem_tag AS tag, case_creation_date_time AS ts, case_id FROM s WHERE customer_token IS NOT NULL),
{_near('any', '')}, {_near('same', 'AND b1.tag = b2.tag')}, {_near('different', 'AND b1.tag <> b2.tag')},
fcr AS (
  SELECT b.case_id, b.cust, b.tag, b.ts, a.dd AS any_days, a.ts2 AS any_ts, a.tag2 AS any_tag, r.dd AS same_days, r.ts2 AS same_ts, r.tag2 AS same_tag,
    n.dd AS different_days, n.ts2 AS different_ts, n.tag2 AS different_tag, abs(coalesce(r.dd, 100)) > 7 AS fcr_7_day,
    abs(coalesce(r.dd, 100)) > 14 AS fcr_14_day, abs(coalesce(r.dd, 100)) > 28 AS fcr_28_day
  FROM base b LEFT JOIN any_n a ON a.case_id = b.case_id AND a.rn = 1 LEFT JOIN same_n r ON r.case_id = b.case_id AND r.rn = 1
  LEFT JOIN different_n n ON n.case_id = b.case_id AND n.rn = 1)
"""


def _contacts(spark, sf_dir):
    s = SUPPORT_CASES.spark(spark, sf_dir)
    return cases.contact_base({"support_cases": s, "call_records": s.select("case_id")}, year=None, tz="UTC")


def _fcr(spark, sf_dir):
    return cases.fcr_detail(_contacts(spark, sf_dir))


@register(
    "first_contact_resolution",
    with_views(
        _FCR
        + """SELECT round(avg(abs(any_days))) AS avg_abs_days_since_any, round(avg(abs(same_days))) AS avg_abs_days_since_same,
  round(avg(abs(different_days))) AS avg_abs_days_since_different, median(abs(any_days)) AS median_abs_days_since_any,
  median(abs(same_days)) AS median_abs_days_since_same,
  round(count(DISTINCT CASE WHEN same_days IS NOT NULL THEN cust END) / count(DISTINCT cust) * 100, 2) AS pct_customers_with_same,
  round(count(DISTINCT CASE WHEN different_days IS NOT NULL THEN cust END) / count(DISTINCT cust) * 100, 2) AS pct_customers_with_different,
  round(count_if(fcr_7_day) / count(DISTINCT case_id) * 100, 2) AS total_fcr_7_day, round(count_if(fcr_14_day) / count(DISTINCT case_id) * 100, 2) AS total_fcr_14_day,
  round(count_if(fcr_28_day) / count(DISTINCT case_id) * 100, 2) AS total_fcr_28_day FROM fcr""",
        s=SUPPORT_CASES,
    ),
)
def first_contact_resolution(spark, sf_dir):
    return cases.fcr_summary(cases.fcr_detail(_contacts(spark, sf_dir).drop("origin")))


@register(
    "first_contact_detail",
    with_views(
        _FCR
        + """SELECT case_id, cust AS customer_token, tag AS problem_tag, any_days, any_tag, same_days, same_tag, different_days, different_tag,
  strftime(any_ts, '%Y-%m-%d %H:%M:%S') AS any_ts, strftime(same_ts, '%Y-%m-%d %H:%M:%S') AS same_ts, strftime(different_ts, '%Y-%m-%d %H:%M:%S') AS different_ts,
  fcr_7_day, fcr_14_day, fcr_28_day FROM fcr""",
        s=SUPPORT_CASES,
    ),
)
def first_contact_detail(spark, sf_dir):
    return _fcr(spark, sf_dir).drop("case_ts_utc", "origin")


@register(
    "first_contact_flag_counts",
    with_views(_FCR + "SELECT fcr_7_day, count(*) AS cases FROM fcr GROUP BY 1", s=SUPPORT_CASES),
)
def first_contact_flag_counts(spark, sf_dir):
    s = SUPPORT_CASES.spark(spark, sf_dir)
    base = cases.contact_base({"support_cases": s, "call_records": s.select("case_id")}, year=None, tz="UTC")
    near = nearest_related(base, "customer_token", "case_id", "case_ts_utc", "problem_tag", "same")
    from ..operators.match import first_contact_resolution as flags

    return cases.fcr_flag_counts(near.withColumns(flags("same_days")))


@register(
    "nearest_other_kind",
    f"WITH base AS (SELECT user_id AS cust, event_type AS tag, ts, event_id AS case_id FROM events), {_near('different', 'AND b1.tag <> b2.tag')}"
    " SELECT case_id AS event_id, dd AS different_days, tag2 AS different_tag FROM different_n WHERE rn = 1",
)
def nearest_other_kind(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"]
    near = nearest_related(events, "user_id", "event_id", "ts", "event_type", "different", chunk="day")
    return near.filter(F.col("different_days").isNotNull()).select("event_id", "different_days", "different_tag")


# -- payments ---------------------------------------------------------------------------------

PAYMENTS = view(
    "events",
    lambda d: [
        "event_id as payment_id", "user_id as recipient_token", "event_id % 3 as sender_token", "ts as created_at", "value as amount_usd",
        "case when event_id % 4 = 1 then 'TRANSFER' else 'REIMBURSEMENT' end as creation_mechanism",
        f"case when {d.k} % 10 = 3 then 'FAILED' else 'PAID_OUT' end as state",
        f"case when {d.k} % 6 = 0 then 'MANUALLY_REVERSED' else null end as failure_reason",
        f"case when {d.k} % 5 = 0 then 'FAILURE' else 'SUCCESS' end as pull_result",
    ],
)
AUDITS = View(
    (
        (
            "events",
            lambda d: [
                "event_id as id", "user_id as entity_token", f"{d.plus('ts', f'{d.k} * 4000 - 200000')} as created_at",
                "case when event_type in ('view', 'click') then 'pay::View' else 'pay::Reimburse now' end as action_name",
                f"case when {d.k} % 4 = 0 then null when {d.k} % 4 = 1 then 'no number' else concat('see case ', cast(10000000 + event_id as {d.text}), ' CCN-', cast({d.k} as {d.text})) end as comment",
                "concat('u', cast(user_id as " + d.text + ")) as actor_uid",
            ],
        ),
        # entries of the same second as the payment
        (
            "events",
            lambda d: [
                "event_id + 1000000000 as id", "user_id as entity_token", "date_trunc('second', ts) as created_at", "'PAY::REIMBURSE' as action_name",
                f"concat('case ', cast(10000000 + {d.k} as {d.text})) as comment", f"concat('u', cast(user_id as {d.text})) as actor_uid",
            ],
        ),
    )
)
PAY_CASES = view(
    "orders",
    lambda d: [
        "o_orderkey as case_id", f"cast(10000000 + o_orderkey as {d.text}) as case_number", "o_custkey as customer_token",
        f"{d.plus(d.stamp('2024-01-01'), 'o_orderkey % 40 * 60000')} as created_at_utc", "o_orderstatus as origin",
        f"case when o_orderkey % 2 = 0 then concat('B', cast(o_orderkey as {d.text})) else null end as banking_token",
        "case when o_orderstatus = 'F' then o_orderkey else null end as payment_id",
    ],
)
CASE_PAYMENTS = view(
    "lineitem",
    lambda d: [
        "l_orderkey as case_id", "l_partkey as payment_id",
        f"case when l_returnflag = 'A' then concat('T', cast(l_partkey as {d.text})) else null end as banking_token",
    ],
)
DUTIES = view(
    "events",
    lambda d: [
        "event_id as assignment_id", "case when event_type = 'signup' then user_id else -1 - user_id end as customer_token", f"{d.plus('ts', '5 * 3600')} as occurred_at",
        f"case when {d.k} % 3 = 0 then null else {d.plus('ts', '6 * 3600')} end as submitted_at", "event_type as queue",
    ]
)
_PAY_VIEWS = dict(p=PAYMENTS, al=AUDITS, e=EMPLOYEES, sc=PAY_CASES, ff=CASE_PAYMENTS, n=DUTIES)


def _pay(spark, sf_dir):
    return frames(
        spark, sf_dir, payments=PAYMENTS, audit_logs=AUDITS, employees=EMPLOYEES, support_cases=PAY_CASES, case_payments=CASE_PAYMENTS,
        assignments=DUTIES,
    )


_AUDIT_ROWS = """au AS (
  SELECT al.*, nullif(regexp_extract(comment, '[0-9]{8}([0-9]{1})?'), '') AS number FROM al WHERE action_name ILIKE '%reimburse%'),
"""


PAYMENT_AUDIT_SQL = f"""
WITH {_AUDIT_ROWS}
pay AS (SELECT * FROM p WHERE creation_mechanism = 'REIMBURSEMENT' AND sender_token = 1 AND created_at >= TIMESTAMP '2024-01-03' AND state = 'PAID_OUT'),
j AS (
  SELECT pay.*, au.id AS audit_id, au.created_at AS audit_at, au.comment AS audit_comment, au.action_name AS audit_action, au.actor_uid,
    au.number AS case_number, sc.case_id, sc.origin AS case_origin, ff.payment_id AS case_payment_id, ff.banking_token AS case_banking_token,
    n.assignment_id, n.queue AS assignment_queue, n.submitted_at AS assignment_submitted_at, s2.case_id AS recent_case_id, s2.created_at_utc AS recent_case_at,
    s2.case_number AS recent_case_number, f2.case_id AS linked_case_id, e.agent_id, e.team_code AS agent_team,
    count(*) OVER (PARTITION BY pay.recipient_token) AS payments_per_customer,
    row_number() OVER (PARTITION BY pay.payment_id ORDER BY CASE WHEN ff.banking_token IS NULL THEN 0 ELSE 1 END, au.created_at NULLS LAST, au.id, ff.payment_id NULLS FIRST,
      n.occurred_at NULLS LAST, n.assignment_id, s2.created_at_utc NULLS LAST, s2.case_id, f2.case_id) AS rn
  FROM pay
  LEFT JOIN au ON pay.recipient_token = au.entity_token AND pay.created_at BETWEEN au.created_at - INTERVAL 1 DAY AND au.created_at + INTERVAL 1 DAY
  LEFT JOIN e ON au.actor_uid = e.uid AND pay.created_at BETWEEN e.start_date AND e.end_date
  LEFT JOIN sc ON au.number = sc.case_number
  LEFT JOIN ff ON sc.case_id = ff.case_id
  LEFT JOIN n ON pay.recipient_token = n.customer_token AND CAST(pay.created_at AS date) = CAST(n.occurred_at - INTERVAL 8 HOUR AS date)
  LEFT JOIN sc s2 ON pay.recipient_token = s2.customer_token AND s2.created_at_utc BETWEEN pay.created_at - INTERVAL 3 DAY AND pay.created_at
  LEFT JOIN ff f2 ON pay.payment_id = f2.payment_id)
SELECT j.* EXCLUDE (rn, audit_at, created_at, assignment_submitted_at, recent_case_at), recipient_token AS customer_token, 'P2P Reimbursement' AS type,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, strftime(audit_at, '%Y-%m-%d %H:%M:%S') AS audit_at,
  strftime(assignment_submitted_at, '%Y-%m-%d %H:%M:%S') AS assignment_submitted_at, strftime(recent_case_at, '%Y-%m-%d %H:%M:%S') AS recent_case_at,
  case_id IS NOT NULL AS has_case_from_audit, assignment_submitted_at IS NOT NULL AS has_assignment, recent_case_id IS NOT NULL AS has_recent_case,
  linked_case_id IS NOT NULL AS has_payment_on_case, audit_id IS NOT NULL AS has_audit FROM j WHERE rn = 1"""


@register("payment_audit_match", with_views(PAYMENT_AUDIT_SQL, **_PAY_VIEWS))
def payment_audit_match(spark, sf_dir):
    return payments.match_reimbursements(_pay(spark, sf_dir), sender_token=1, since="2024-01-03")


@register(
    "reimburse_refund_union",
    with_views(
        f"""
WITH {_AUDIT_ROWS}
a AS (
  SELECT p.*, 'P2P Reimbursement' AS type, p.recipient_token AS customer_token, au.id AS audit_id, au.created_at AS audit_at, au.comment AS audit_comment, au.action_name AS audit_action,
    au.actor_uid, au.number AS case_number, sc.case_id, sc.created_at_utc AS case_at, sc.banking_token AS case_banking_token, sc.origin AS case_origin,
    count(*) OVER (PARTITION BY p.recipient_token) AS payments_per_customer, e.agent_id, e.team_code AS agent_team,
    row_number() OVER (PARTITION BY p.payment_id ORDER BY CASE WHEN sc.banking_token IS NULL THEN 0 ELSE 1 END, au.created_at NULLS LAST, au.id) AS rn
  FROM p LEFT JOIN au ON p.recipient_token = au.entity_token AND date_trunc('second', p.created_at) = date_trunc('second', au.created_at)
  LEFT JOIN e ON au.actor_uid = e.uid AND p.created_at BETWEEN e.start_date AND e.end_date LEFT JOIN sc ON au.number = sc.case_number
  WHERE creation_mechanism = 'REIMBURSEMENT' AND sender_token = 1 AND p.created_at >= TIMESTAMP '2024-01-02' AND state = 'PAID_OUT'),
b AS (
  SELECT p.*, 'Refund' AS type, p.sender_token AS customer_token, au.id AS audit_id, au.created_at AS audit_at, au.comment AS audit_comment, au.action_name AS audit_action,
    au.actor_uid, sc.case_number, sc.case_id, sc.created_at_utc AS case_at, sc.banking_token AS case_banking_token, sc.origin AS case_origin,
    count(*) OVER (PARTITION BY p.sender_token) AS payments_per_customer, e.agent_id, e.team_code AS agent_team,
    row_number() OVER (PARTITION BY p.payment_id ORDER BY sc.created_at_utc NULLS LAST, sc.case_id, au.created_at NULLS LAST, au.id) AS rn
  FROM p LEFT JOIN au ON p.recipient_token = au.entity_token AND date_trunc('second', p.created_at) = date_trunc('second', au.created_at)
  LEFT JOIN e ON au.actor_uid = e.uid AND p.created_at BETWEEN e.start_date AND e.end_date LEFT JOIN sc ON p.payment_id = sc.payment_id
  WHERE p.created_at >= TIMESTAMP '2024-01-02' AND failure_reason = 'MANUALLY_REVERSED' AND pull_result = 'SUCCESS'),
u AS (SELECT * EXCLUDE (rn) FROM a WHERE rn = 1 UNION SELECT * EXCLUDE (rn) FROM b WHERE rn = 1)
SELECT * REPLACE (strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, strftime(audit_at, '%Y-%m-%d %H:%M:%S') AS audit_at,
  strftime(case_at, '%Y-%m-%d %H:%M:%S') AS case_at) FROM u""",
        **_PAY_VIEWS,
    ),
)
def reimburse_refund_union(spark, sf_dir):
    return payments.reimbursements_and_refunds(_pay(spark, sf_dir), sender_token=1, since="2024-01-02")


@register(
    "regex_key_join",
    """
WITH d AS (SELECT doc_id, nullif(regexp_extract(text, '[0-9]{8}([0-9]{1})?'), '') AS num, nullif(regexp_extract(text, 'CCN-[0-9]+'), '') AS ccn FROM documents),
k AS (SELECT regexp_extract(text, '[0-9]{8,9}') AS number, min(doc_id) AS case_id FROM documents GROUP BY 1)
SELECT doc_id, num AS case_number, ccn AS complaint_number, case_id FROM d LEFT JOIN k ON num = k.number""",
)
def regex_key_join(spark, sf_dir):
    """The first text that mentions a number is its case; every text is joined to it by the whole number."""
    docs = load(spark, sf_dir, "documents")["documents"].select("doc_id", "text")
    found = payments.comment_references(docs, "text").drop("text")
    number = F.regexp_extract("text", "[0-9]{8,9}", 0).alias("case_number")
    keys = docs.groupBy(number).agg(F.min("doc_id").alias("case_id"))
    return found.join(keys, "case_number", "left")


@register(
    "regex_counts",
    """
SELECT lang, count(nullif(regexp_extract(text, '[0-9]{4,}'), '')) AS with_number, count(nullif(regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+'), '')) AS with_mail
FROM documents GROUP BY 1""",
)
def regex_counts(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")["documents"]
    return docs.groupBy("lang").agg(
        F.count(regexp_first("text", "[0-9]{4,}")).alias("with_number"),
        F.count(regexp_first("text", "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+")).alias("with_mail"),
    )


@register(
    "anti_join_exclude",
    "SELECT c_custkey, c_mktsegment FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') o ON c_custkey = o_custkey WHERE o_orderkey IS NULL",
)
def anti_join_exclude(spark, sf_dir):
    t = load(spark, sf_dir, "customer", "orders")
    pending = t["orders"].filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return exclude(t["customer"].select("c_custkey", "c_mktsegment"), pending, ["c_custkey"])


@register(
    "prior_inbound_rate",
    with_views(
        """
WITH o AS (SELECT customer_endpoint, CAST(call_start_time AS date) AS ds FROM m WHERE call_end_time >= TIMESTAMP '2024-01-01' AND initiation_method = 'OUTBOUND'),
n AS (SELECT customer_endpoint, CAST(call_start_time AS date) AS ds FROM m WHERE call_end_time >= TIMESTAMP '2024-01-01' AND initiation_method <> 'OUTBOUND')
SELECT CAST(extract(year FROM o.ds) AS int) AS year, count(DISTINCT n.customer_endpoint) AS with_incoming, count(DISTINCT o.customer_endpoint) AS total_outbound,
  count(DISTINCT o.customer_endpoint) - count(DISTINCT n.customer_endpoint) AS without_incoming,
  round(count(DISTINCT n.customer_endpoint) / nullif(count(DISTINCT o.customer_endpoint), 0) * 100, 2) AS with_incoming_pct
FROM o LEFT JOIN n ON o.customer_endpoint = n.customer_endpoint AND o.ds >= n.ds GROUP BY 1""",
        m=CALLS,
    ),
)
def prior_inbound_rate(spark, sf_dir):
    return voice.outbound_after_inbound(CALLS.spark(spark, sf_dir))


@register(
    "prior_contact_flag",
    """
WITH f AS (SELECT user_id, min(CAST(ts AS date)) AS first_view FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT e.event_id, coalesce(CAST(e.ts AS date) >= first_view, false) AS viewed FROM events e LEFT JOIN f USING (user_id) WHERE event_type = 'purchase'""",
)
def prior_contact_flag(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"].withColumn("day", F.col("ts").cast("date"))
    views = events.filter("event_type = 'view'").select("user_id", F.col("day").alias("view_day"))
    buys = events.filter("event_type = 'purchase'").select("event_id", "user_id", "day")
    return seen_before(buys, views, "user_id", "day", "view_day", "viewed").select("event_id", "viewed")


# -- remediation ----------------------------------------------------------------------------------

REM_COMPLAINTS = view(
    "orders",
    lambda d: [
        "o_orderkey as complaint_id", "o_custkey as case_id", "case when o_orderstatus = 'P' then 'Closed' else 'In Progress' end as complaint_status",
        "case when o_orderkey % 5 = 0 then 'Tier 1' else 'Tier 2' end as severity_tier", "o_orderkey % 13 = 0 as is_duplicate",
        "case o_orderkey % 6 when 0 then 'Lending' when 1 then 'Regulatory' else 'Internal' end as workflow",
        "case when o_orderkey % 9 = 0 then 'Other' else 'Main' end as business_unit",
        "case when o_orderkey % 10 = 0 then 'CA Investigation only' when o_orderkey % 10 = 1 then null else 'agency' end as third_party_source",
        "case when o_orderkey % 7 = 0 then 'Canada' when o_orderkey % 7 = 1 then null when o_orderkey % 7 = 2 then 'Unknown' else 'United States' end as country",
        "o_orderkey % 8 = 0 as is_central_team", "case when o_orderkey % 3 = 0 then null else 'refund' end as resulting_action",
        "case when o_orderkey % 4 = 0 then null else o_orderdate end as closed_ts_utc", "o_orderdate as created_ts_utc", "o_orderpriority as review_notes",
    ],
)
REM_CASES = view(
    "customer",
    lambda d: [
        "c_custkey as case_id", f"concat('N', cast(c_custkey as {d.text})) as case_number",
        "case c_custkey % 4 when 0 then 'Closed' when 1 then 'Resolved' when 2 then 'Open' else null end as status",
        f"{d.plus(d.stamp('2024-01-01'), 'c_nationkey * 40000')} as case_creation_date_time_utc",
        f"case when c_custkey % 3 = 0 then null else {d.plus(d.stamp('2024-01-02'), 'c_nationkey * 90000')} end as first_resolved_at",
        f"case when c_custkey % 5 = 0 then null else {d.plus(d.stamp('2024-01-04'), 'c_nationkey * 90000')} end as last_resolved_at",
    ],
)
REM_OWNERS = view(
    "events",
    lambda d: [
        "case when event_type in ('view', 'error') then user_id else -1 - user_id end as case_id", f"cast({d.k} as bigint) as new_value", f"case when {d.k} % 10 = 4 then 'Escalations' else 'Team' end as new_name", "ts as created_at_utc",
    ],
)
REM_MAILS = view(
    "events",
    lambda d: [
        "event_id as email_id", "user_id as case_id", "event_id % 300 as created_by_id", "ts as email_created_at",
        "case when event_type = 'click' then 'outgoing' else 'incoming' end as direction",
    ],
)


@register(
    "remediation_buckets",
    with_views(
        """
WITH r AS (SELECT case_id, coalesce(first_resolved_at, last_resolved_at) AS res FROM k),
own AS (
  SELECT DISTINCT o.case_id FROM o JOIN e ON o.new_value = e.agent_id AND o.created_at_utc BETWEEN e.start_date AND e.end_date
  JOIN r ON r.case_id = o.case_id WHERE e.team_code ILIKE '%met%' OR e.team_code ILIKE '%eret%'),
q0 AS (SELECT o.case_id, coalesce(created_at_utc > res, false) AS late, row_number() OVER (PARTITION BY o.case_id ORDER BY created_at_utc) AS rn
  FROM o JOIN r ON r.case_id = o.case_id WHERE new_name = 'Escalations'),
m0 AS (
  SELECT m.case_id, e.team_code AS tc, row_number() OVER (PARTITION BY m.case_id ORDER BY (e.team_code ILIKE '%met%' OR e.team_code ILIKE '%eret%') DESC NULLS FIRST,
    email_created_at DESC, email_id) AS rn
  FROM m JOIN e ON m.created_by_id = e.agent_id AND m.email_created_at BETWEEN e.start_date AND e.end_date WHERE direction = 'outgoing'),
f AS (
  SELECT c.*, k.case_number, k.status, k.case_creation_date_time_utc, m0.tc, own.case_id IS NOT NULL AS owned, q0.late,
    coalesce(m0.tc ILIKE '%met%' OR m0.tc ILIKE '%eret%', false) AS sp, k.status IN ('Closed', 'Resolved') AS done
  FROM c LEFT JOIN k ON c.case_id = k.case_id LEFT JOIN own ON own.case_id = c.case_id LEFT JOIN q0 ON q0.case_id = c.case_id AND q0.rn = 1
  LEFT JOIN m0 ON m0.case_id = c.case_id AND m0.rn = 1
  WHERE complaint_status = 'In Progress' AND severity_tier = 'Tier 2' AND NOT is_duplicate AND workflow NOT IN ('Lending', 'Investing', 'Global')
    AND business_unit = 'Main' AND coalesce(third_party_source, '') NOT ILIKE '%investigation%' AND coalesce(country, 'United States') IN ('United States', 'Unknown'))
SELECT CASE WHEN is_central_team THEN 'No Action Required: Handled by the central team'
    WHEN sp AND done AND resulting_action IS NOT NULL THEN 'Bulk Update Status to Closed: Resolved case with specialist email response & Resulting Action'
    WHEN sp AND done THEN 'Bulk Update Status to Closed: Resolved case with specialist email response'
    WHEN sp AND NOT done THEN 'TBD: Unresolved case with specialist email response'
    WHEN tc IS NOT NULL AND done THEN 'TBD: Resolved case with email response'
    WHEN owned AND done THEN 'TBD: Resolved case with specialist ownership'
    WHEN done AND closed_ts_utc IS NOT NULL THEN 'Requires Review: Complaint has closed date and case is resolved'
    WHEN late THEN 'Requires Review: Case Resolved Before Escalation Queue' ELSE 'Requires Review: No Bucket' END AS remediation_bucket,
  case_number, case_id, strftime(case_creation_date_time_utc, '%Y-%m-%d %H:%M:%S') AS case_creation_date_time_utc,
  concat('https://desk.example/', CAST(case_id AS varchar), '/view') AS link, complaint_id, complaint_status, strftime(created_ts_utc, '%Y-%m-%d %H:%M:%S') AS created_ts_utc,
  review_notes FROM f""",
        c=REM_COMPLAINTS, k=REM_CASES, o=REM_OWNERS, m=REM_MAILS, e=EMPLOYEES,
    ),
)
def remediation_buckets(spark, sf_dir):
    t = frames(spark, sf_dir, complaints=REM_COMPLAINTS, cases=REM_CASES, owner_history=REM_OWNERS, emails=REM_MAILS, employees=EMPLOYEES)
    return complaints.remediation_list(
        t, specialist=["%met%", "%eret%"], escalation_queue="Escalations", business_unit="Main", texts=REMEDIATION, link_prefix="https://desk.example/"
    )


@register(
    "distinct_review_notes",
    with_views(
        """SELECT DISTINCT review_notes FROM c WHERE complaint_status = 'In Progress' AND severity_tier = 'Tier 2' AND NOT is_duplicate
  AND workflow NOT IN ('Lending', 'Investing', 'Global') AND business_unit = 'Main' AND coalesce(third_party_source, '') NOT ILIKE '%investigation%'
  AND coalesce(country, 'United States') IN ('United States', 'Unknown')""",
        c=REM_COMPLAINTS,
    ),
)
def distinct_review_notes(spark, sf_dir):
    return complaints.distinct_notes(remediation_buckets(spark, sf_dir))


@register(
    "nearest_in_window",
    """
WITH v AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view'), b AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
j AS (SELECT b.event_id, v.event_id AS view_id, v.value, count(v.event_id) OVER (PARTITION BY b.event_id) AS views,
  row_number() OVER (PARTITION BY b.event_id ORDER BY CASE WHEN v.value > 100 THEN 0 ELSE 1 END, v.ts, v.event_id) AS rn
  FROM b LEFT JOIN v ON b.user_id = v.user_id AND v.ts BETWEEN b.ts - INTERVAL 36 HOUR AND b.ts + INTERVAL 12 HOUR)
SELECT event_id, view_id, value, views FROM j WHERE rn = 1""",
)
def nearest_in_window(spark, sf_dir):
    from ..operators.match import match_with_tolerance

    events = load(spark, sf_dir, "events")["events"]
    views = events.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"), "value")
    buys = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    out = match_with_tolerance(
        buys, views, "user_id", "ts", "view_ts", {"view_id": "view_id", "value": "value"}, row_id="event_id",
        before_seconds=36 * 3600, after_seconds=12 * 3600, prefer=F.col("value") > 100, tie=["view_id"], count="views",
    )
    return out.select("event_id", "view_id", "value", "views")
