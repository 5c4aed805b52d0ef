"""Rates, shares, intervals, percentiles, classified volume."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import business_days_between
from ..functions.dialect import trunc, trunc_date
from ..operators import classify as c
from ..operators import rollups
from ..operators.intervals import prorate_to_intervals
from ..operators.metrics import percent_of_total, trailing_ratio
from ..operators.percentiles import exact_percentiles
from ..operators.quality import conservation_check
from ..plans import cases, complaints, volume, voice, workforce
from ..sources.tables import load, write
from .base import CALLS, EMPLOYEES, View, frames, register, view, with_views, work_folder
from .history import CASE_EVENTS, LABELS, TOKEN_CASES
from .rules import ARRIVALS, TOUCHES
from .sla import rounded

# -- intervals -------------------------------------------------------------------------------

WORK = view(
    "events",
    lambda d: [
        "event_id as case_id", f"concat('p', cast(user_id as {d.text})) as full_name", "date_trunc('second', ts) as touch_start_time",
        f"{d.plus('date_trunc(' + chr(39) + 'second' + chr(39) + ', ts)', 'floor(value) * 20')} as touch_end_time",
    ],
)
_PARTS = """
s AS (
  SELECT case_id, full_name, touch_start_time AS s, touch_end_time AS e,
    unnest(generate_series(time_bucket(INTERVAL 30 MINUTE, touch_start_time), time_bucket(INTERVAL 30 MINUTE, touch_end_time), INTERVAL 30 MINUTE)) AS a
  FROM m WHERE touch_end_time >= touch_start_time),
parts AS (SELECT *, a + INTERVAL 30 MINUTE AS b FROM s WHERE NOT (e = a AND e > s))
"""


def _fix(df):
    return df.withColumn("touch_start_time", F.col("touch_start_time").cast("timestamp_ntz")).withColumn(
        "touch_end_time", F.col("touch_end_time").cast("timestamp_ntz")
    )


@register(
    "prorated_intervals",
    with_views(
        f"""WITH {_PARTS}
SELECT case_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS interval_start, strftime(b, '%Y-%m-%d %H:%M:%S') AS interval_end,
  date_diff('second', greatest(s, a), least(e, b)) AS interval_seconds FROM parts""",
        m=WORK,
    ),
)
def prorated_intervals(spark, sf_dir):
    parts = prorate_to_intervals(_fix(WORK.spark(spark, sf_dir)), "touch_start_time", "touch_end_time")
    return parts.select("case_id", "interval_start", "interval_end", "interval_seconds")


@register(
    "prorated_intervals_compat",
    with_views(
        """WITH s AS (
  SELECT case_id, touch_start_time AS s, touch_end_time AS e,
    unnest(generate_series(time_bucket(INTERVAL 30 MINUTE, touch_start_time) - INTERVAL 30 MINUTE, time_bucket(INTERVAL 30 MINUTE, touch_end_time), INTERVAL 30 MINUTE)) AS a
  FROM m),
p AS (SELECT *, a + INTERVAL 30 MINUTE AS b FROM s WHERE e >= a AND s <= a + INTERVAL 30 MINUTE)
SELECT case_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS interval_start,
  CASE WHEN s >= a AND e <= b THEN date_diff('second', s, e) WHEN s >= a THEN date_diff('second', s, b) ELSE date_diff('second', a, e) END AS interval_seconds FROM p""",
        m=WORK,
    ),
)
def prorated_intervals_compat(spark, sf_dir):
    parts = prorate_to_intervals(_fix(WORK.spark(spark, sf_dir)), "touch_start_time", "touch_end_time", compat=True)
    return parts.select("case_id", "interval_start", "interval_seconds")


@register(
    "interval_productivity",
    with_views(
        f"""WITH {_PARTS}
SELECT strftime(a, '%Y-%m-%d %H:%M:%S') AS interval_start, strftime(b, '%Y-%m-%d %H:%M:%S') AS interval_end, strftime(a, '%Y-%m-%d') AS report_date,
  count(DISTINCT full_name) AS total_advocates, round(sum(date_diff('second', greatest(s, a), least(e, b))) / 60, 6) AS total_minutes FROM parts GROUP BY a, b""",
        m=WORK,
    ),
)
def interval_productivity(spark, sf_dir):
    return rounded(workforce.interval_productivity(_fix(WORK.spark(spark, sf_dir))), ["total_minutes"])


@register(
    "interval_conservation",
    with_views(
        f"""WITH {_PARTS}, p AS (SELECT case_id, sum(date_diff('second', greatest(s, a), least(e, b))) AS v FROM parts GROUP BY 1),
w AS (SELECT case_id, date_diff('second', touch_start_time, touch_end_time) AS v FROM m)
SELECT count(*) AS broken_cases FROM w LEFT JOIN p ON w.case_id = p.case_id WHERE p.v IS DISTINCT FROM w.v""",
        m=WORK,
    ),
)
def interval_conservation(spark, sf_dir):
    """Parts of every span add up to the span."""
    work = _fix(WORK.spark(spark, sf_dir))
    parts = prorate_to_intervals(work, "touch_start_time", "touch_end_time")
    whole = work.withColumn("seconds", F.unix_seconds(F.col("touch_end_time").cast("timestamp")) - F.unix_seconds(F.col("touch_start_time").cast("timestamp")))
    return conservation_check(parts, whole, "case_id", "interval_seconds", "seconds").agg(F.count(F.lit(1)).alias("broken_cases"))


ACTIVITY = view(
    "events",
    lambda d: [
        f"concat('p', cast(user_id as {d.text}), '@desk.example') as email", "ts as date_time",
        "case when event_type in ('view', 'click') then 'Available' else 'Break' end as code",
        f"case when {d.k} = 5 then null else {d.plus('ts', 'floor(value) * 25')} end as status_remove_time",
    ],
)


@register(
    "available_minutes",
    with_views(
        """
WITH iv AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-11 23:30:00', INTERVAL 30 MINUTE)) AS a),
b AS (SELECT substring(email, 1, position('@' IN email) - 1) AS login, date_time AS s, status_remove_time AS e FROM m WHERE code = 'Available'),
j AS (SELECT DISTINCT a, CAST(a AS date) AS d, login, s, e, CASE WHEN e IS NULL THEN NULL WHEN a + INTERVAL 30 MINUTE < e THEN 30 ELSE date_diff('minute', a, e) END AS mins
  FROM iv LEFT JOIN b ON a BETWEEN s AND e)
SELECT strftime(d, '%Y-%m-%d') AS report_date, strftime(a, '%Y-%m-%d %H:%M:%S') AS interval_start, login, strftime(s, '%Y-%m-%d %H:%M:%S') AS start_ts,
  strftime(e, '%Y-%m-%d %H:%M:%S') AS end_ts, mins AS available_minutes, CAST(sum(mins) OVER (PARTITION BY d) AS bigint) AS day_minutes FROM j""",
        m=ACTIVITY,
    ),
)
def available_minutes(spark, sf_dir):
    return workforce.available_minutes(ACTIVITY.spark(spark, sf_dir), "2024-01-02", "2024-01-12")


CHAT_WORK = view(
    "events",
    lambda d: [
        "case event_type when 'error' then 'Internal Advocate Success' else 'Other' end as chat_record_type", "ts as chat_start_time",
        f"concat('p', cast(user_id as {d.text})) as chat_advocate_login", "user_id % 2 = 0 as chat_advocate_is_bpo",
    ],
)


@register(
    "escalation_activity",
    with_views(
        """
SELECT DISTINCT strftime(x.chat_start_time, '%Y-%m-%d %H:%M:%S') AS worked_ts, x.chat_advocate_login AS login, x.chat_advocate_is_bpo, strftime(m.date_time, '%Y-%m-%d %H:%M:%S') AS start_ts,
  m.code, strftime(m.status_remove_time, '%Y-%m-%d %H:%M:%S') AS end_ts
FROM x JOIN m ON x.chat_advocate_login = split_part(m.email, '@', 1) AND x.chat_start_time BETWEEN m.date_time AND m.status_remove_time
WHERE x.chat_record_type = 'Internal Advocate Success'""",
        x=CHAT_WORK, m=ACTIVITY,
    ),
)
def escalation_activity(spark, sf_dir):
    return workforce.escalation_activity(CHAT_WORK.spark(spark, sf_dir), ACTIVITY.spark(spark, sf_dir), "Internal Advocate Success")


# -- volume -----------------------------------------------------------------------------------

V_TOUCHES = View(
    (
        (
            "events",
            lambda d: [
                "event_id as touch_id", "cast(floor(event_id / 3) as bigint) as case_id",
                "case when event_id % 10 = 0 then 'other' else 'desk' end as source",
                "case event_type when 'view' then 'Chat' when 'error' then 'Phone' when 'click' then null else 'Email' end as channel",
                "case event_id % 8 when 0 then 'US Banking desk' when 1 then 'risk ato' when 2 then 'Claim docs 2' when 3 then 'my IDV Florida Limits'"
                " when 4 then 'x Missing Deposits' else 'General' end as queue_name",
                "ts as created_at", f"{d.plus('ts', '7200')} as touch_start_time",
                f"case when {d.k} = 3 then null else cast(floor(value) as bigint) end as handle_time",
            ],
        ),
    )
)
V_CASES = view(
    "orders",
    lambda d: [
        "o_orderkey as case_id", "case o_orderkey % 5 when 0 then 'Chat' when 1 then 'Apparel' when 2 then null when 3 then 'Twitter' else 'Email' end as origin",
        "case o_orderkey % 9 when 0 then 'Banking' when 1 then 'Priority Disputes A' when 2 then 'RISK ATO VOICE' when 3 then 'the Pay Disputes' when 4 then 'Compliance Review'"
        " when 5 then 'Disputes Card x' else 'General' end as first_assigned_queue",
    ],
)
V_REVIEWS = view("customer", lambda d: ["c_custkey as token", "case when c_custkey % 2 = 0 then 'ADVOCATE' else 'AUTO' end as method_of_review", f"{d.plus(d.stamp('2024-01-01'), 'c_custkey % 60 * 86400')} as created_at"])
V_DUTIES = view(
    "events",
    lambda d: [
        "event_id % 4000 as assignment_id", f"{d.plus('ts', '0')} as occurred_at", f"{d.plus('ts', '90000')} as claimed_at",
        f"case event_id % 9 when 0 then 'scam_payment_1' when 1 then 'risk_ATO_q' when 2 then 'x_idv' when 3 then 'rdc_returns_rars' when 4 then 'TRANSACTION_MONITORING'"
        " when 5 then 'RDC_RETURNS_RARS' when 6 then 'threat_of_harm' when 7 then 'check_deposit_manual_review_x' else 'unknown' end as queue",
        f"case when event_id % 4 = 0 then null else cast(floor(value) as int) end as handled_minutes",
    ],
)
V_BANK = view("orders", lambda d: ["o_orderkey as case_id", "case when o_orderkey % 4 = 0 then 'BANKING RDC RR' else 'ACH' end as case_type", f"{d.plus(d.stamp('2024-01-01'), 'o_orderkey % 1000 * 3000')} as created_at"])
V_TAGS = view("events", lambda d: ["event_id as primary_key", f"concat('T', cast(user_id as {d.text})) as target_token", "cast(ts as date) as hashtag_at"])
V_CARDS = view("events", lambda d: ["user_id as customer_token", f"concat('T', cast(user_id + 1 as {d.text})) as token", "ts as created_at"])
V_SOCIAL = view("conversations", lambda d: ["conv_id as case_id", "role as channel_type", f"{d.plus(d.stamp('2024-01-05'), 'turn * 100000')} as created_at"])
V_CALLS = view(
    "events",
    lambda d: [
        "event_id as contact_id", "ts as case_created_date", "extract(hour from ts) >= 18 as out_of_hours",
        f"case when {d.k} = 50 then null else {d.k} % 3 <> 0 end as is_handled", f"case when {d.k} = 11 then null else cast(floor(value) as bigint) end as handle_time",
    ],
)
_VOL = dict(ut=V_TOUCHES, sc=V_CASES, rv=V_REVIEWS, nq=V_DUTIES, br=V_BANK, bh=V_TAGS, cd=V_CARDS, so=V_SOCIAL, cr=V_CALLS, a=CASE_EVENTS, c=TOKEN_CASES, l=LABELS)


def _volume_sql(queue: str, item: str, day: str, duty_day: str, frauds: str) -> str:
    def q(*patterns):
        return "(" + " OR ".join(f"{queue} ILIKE '{p}'" for p in patterns) + ")"

    def n(*patterns):
        return "(" + " OR ".join(f"queue ILIKE '{p}'" for p in patterns) + ")"

    return f"""
WITH reg AS (
  SELECT target_token, date_diff('second', s, e) AS hs FROM (
    SELECT c.target_token, l.name AS subroute, max(CASE WHEN a.logical_event_name = 'ASSIGN' THEN a.created_at END) AS s,
      max(CASE WHEN a.logical_event_name = 'CLOSED_COMPLETE' THEN a.created_at END) AS e
    FROM a LEFT JOIN c ON a.case_token = c.token LEFT JOIN l ON c.queue_label_id = l.id GROUP BY 1, 2)),
u AS (
  SELECT CAST({day} AS date) AS d, CAST({item} AS varchar) AS id, CASE
      WHEN {q('%Coin IDV%', '%IDV Florida Limits%', '%IDV Manual Verification%', '%Compliance Review%')} THEN 'AR' WHEN {q('%Risk EV Manual Verification%')} THEN 'AR'
      WHEN {q('Risk ATO', 'Risk ATO Voice', 'ATO Brokerage and Lending', '%Messaging Risk ATO Specialty%')} THEN 'ATO'
      WHEN {q('%Pay Disputes%', '%Disputes Card%', '%Disputes P2P%', '%Disputes Service Claim%', '%Priority Disputes%', '%Disputes Specialty%', '%Claim Docs%')} THEN 'Disputes'
      WHEN {q('%Mobile Check Deposits%')} THEN 'Remote Deposit Capture' WHEN {q('%Banking%', '%Risk: Paper Money%')} THEN 'Banking'
      WHEN {q('%Missing Deposits%')} THEN 'Remote Deposit Capture' WHEN {q('%Card Suspension%')} THEN 'Banking'
      WHEN {q('%Standard Deposit R06 and Reversal%')} THEN 'Remote Deposit Capture'
      WHEN origin = 'Chat' THEN 'Messaging' WHEN origin = 'Apparel' THEN 'Apparel' WHEN origin IS NULL THEN 'Messaging' ELSE origin END AS cl,
    CAST(handle_time AS double) AS h, true AS timed
  FROM ut LEFT JOIN sc ON ut.case_id = sc.case_id WHERE source = 'desk' AND coalesce(channel, origin) NOT IN ('Twitter', 'Phone')
  UNION ALL SELECT CAST(created_at AS date), CAST(token AS varchar), 'AR', NULL, false FROM rv WHERE method_of_review = 'ADVOCATE'
  UNION ALL SELECT * FROM (
    SELECT DISTINCT CAST({duty_day} + INTERVAL 8 HOUR AS date) AS d, CAST(assignment_id AS varchar) AS id, CASE WHEN {n('%scam_payment%')} THEN 'AR' WHEN {n('%instrument_verification%')} THEN 'AR'
      WHEN {n('%enhanced_verification%')} THEN 'AR' WHEN {n('%risk_elder_abuse%', '%threat_of_harm%', '%brokerage_elder_abuse%')} THEN 'AR' WHEN {n('%ato%')} THEN 'ATO'
      WHEN {n('%check_deposit_manual_review%')} THEN 'Remote Deposit Capture' WHEN {n('%idv%')} THEN 'AR' WHEN queue = 'rdc_returns_rars' THEN 'Remote Deposit Capture'
      WHEN queue = 'TRANSACTION_MONITORING' THEN '{frauds}' END AS cl, handled_minutes * 60.0 AS h, handled_minutes IS NOT NULL FROM nq) WHERE cl IS NOT NULL
  UNION ALL SELECT CAST(created_at + INTERVAL 8 HOUR AS date), CAST(case_id AS varchar), CASE WHEN case_type = 'BANKING RDC RR' THEN 'Remote Deposit Capture' ELSE 'Banking' END, NULL, false FROM br
  UNION ALL SELECT hashtag_at, CAST(primary_key AS varchar), 'Remote Deposit Capture', hs, hs IS NOT NULL FROM bh LEFT JOIN reg ON bh.target_token = reg.target_token
  UNION ALL SELECT CAST(created_at + INTERVAL 8 HOUR AS date), CAST(customer_token AS varchar), 'AR', hs, hs IS NOT NULL FROM cd LEFT JOIN reg ON cd.token = reg.target_token
  UNION ALL SELECT CAST(created_at + INTERVAL 8 HOUR AS date), CAST(case_id AS varchar), 'Social', NULL, false FROM so
  UNION ALL SELECT CAST(case_created_date + INTERVAL 8 HOUR AS date), CAST(contact_id AS varchar), 'Voice', handle_time, true FROM cr WHERE NOT out_of_hours AND is_handled)
SELECT strftime(date_trunc('month', d), '%Y-%m-%d') AS month, cl AS classification, count(DISTINCT CASE WHEN NOT timed THEN id END) AS without_time,
  count(DISTINCT CASE WHEN timed THEN id END) AS with_time, count(DISTINCT id) AS total, round(sum(h) / 60, 2) AS handle_time_minutes
FROM u WHERE d BETWEEN DATE '2024-01-02' AND DATE '2024-02-10' GROUP BY date_trunc('month', d), cl"""


def _volume_frames(spark, sf_dir):
    t = frames(
        spark, sf_dir, unified_touches=V_TOUCHES, support_cases=V_CASES, identity_reviews=V_REVIEWS, assignments=V_DUTIES, bank_risk_cases=V_BANK,
        bank_hashtags=V_TAGS, card_designs=V_CARDS, social_cases=V_SOCIAL, call_records=V_CALLS, events=CASE_EVENTS, cases=TOKEN_CASES, labels=LABELS,
    )
    t["regulated"] = cases.regulated_handle_seconds(t["events"], t["cases"], t["labels"])
    return t


@register("conformed_volume", with_views(_volume_sql("first_assigned_queue", "ut.case_id", "created_at", "occurred_at", "Banking Fraud"), **_VOL))
def conformed_volume(spark, sf_dir):
    return volume.monthly_volume(_volume_frames(spark, sf_dir), "2024-01-02", "2024-02-10", ARRIVALS)


@register("conformed_touches", with_views(_volume_sql("queue_name", "touch_id", "touch_start_time", "claimed_at", "Banking Frauds"), **_VOL))
def conformed_touches(spark, sf_dir):
    return volume.monthly_touches(_volume_frames(spark, sf_dir), "2024-01-02", "2024-02-10", TOUCHES)


@register(
    "union_distinct_parts",
    """
SELECT o_custkey AS person, o_orderstatus AS kind, CAST(NULL AS varchar) AS note FROM orders
UNION SELECT user_id, NULL, event_type FROM events""",
)
def union_distinct_parts(spark, sf_dir):
    t = load(spark, sf_dir, "orders", "events")
    a = t["orders"].select(F.col("o_custkey").alias("person"), F.col("o_orderstatus").alias("kind"))
    b = t["events"].select(F.col("user_id").alias("person"), F.col("event_type").alias("note"))
    return c.union_distinct([a, b], {"person": "bigint", "kind": "string", "note": "string"})


# -- model metrics ------------------------------------------------------------------------------

M_CASES = view(
    "documents",
    lambda d: [
        "doc_id as case_id", f"{d.plus(d.stamp('2023-09-10'), 'doc_id % 300 * 86400 + 43200')} as case_creation_date_time",
        f"{d.plus(d.stamp('2023-09-10'), 'doc_id % 300 * 86400 + 43200')} as created_at_utc",
        "case when lang = 'en' then 'Chat' else 'Email' end as origin", "n_chars % 3 = 0 as is_flagged_by_advocate", "n_chars % 4 = 0 as is_flagged_by_model",
    ],
)
M_MODEL = View(
    (
        (
            "labels",
            lambda d: [
                "doc_id as case_id", "quality as has_complaint_reviewed", "case when doc_id % 5 = 0 then 1 - toxic else toxic end as has_complaint_model",
                f"{d.plus(d.stamp('2023-09-10'), 'doc_id % 300 * 86400')} as case_creation_date_time",
            ],
        ),
    )
)
M_COMPLAINTS = view(
    "documents",
    lambda d: ["case when lang = 'de' then -1 - doc_id else doc_id end as case_id", "case when n_chars % 2 = 0 then 'Internal' else 'Global' end as workflow"],
)
# noon timestamps: the Pacific shift of seven or eight hours never changes the day
_MONTH = "CAST(date_trunc('month', {} - INTERVAL 8 HOUR) AS date)"


@register(
    "confusion_monthly",
    with_views(
        f"""
WITH b AS (
  SELECT s.*, m.has_complaint_reviewed AS t, m.has_complaint_model AS p, {_MONTH.format('s.case_creation_date_time')} AS mo FROM s JOIN m ON s.case_id = m.case_id),
x AS (
  SELECT mo, count(CASE WHEN t = 1 THEN 1 END) AS cases_with_complaints, count(*) AS reviewed_cases, count(CASE WHEN t = 1 AND p = 1 THEN 1 END) AS tp,
    count(CASE WHEN t = 1 AND p = 0 THEN 1 END) AS fn, count(CASE WHEN t = 0 AND p = 1 THEN 1 END) AS fp,
    count(DISTINCT CASE WHEN (is_flagged_by_advocate OR is_flagged_by_model) AND origin = 'Chat' THEN case_id END) / nullif(count(DISTINCT CASE WHEN origin = 'Chat' THEN case_id END), 0) AS ar
  FROM b GROUP BY 1 HAVING count(*) >= 5),
y AS (SELECT *, tp / nullif(tp + fn, 0) AS rc, tp / nullif(tp + fp, 0) AS pr FROM x)
SELECT strftime(mo, '%Y-%m-%d') AS month, cases_with_complaints, reviewed_cases, round(rc, 6) AS recall, round(pr, 6) AS precision, round(ar, 6) AS chat_alert_rate,
  round(cases_with_complaints / nullif(reviewed_cases, 0), 6) AS observed_rate, round(ar * pr / nullif(rc, 0), 6) AS expected_rate,
  round((fn + tp) / nullif(reviewed_cases, 0), 6) AS expected_rate_v2, row_number() OVER (ORDER BY mo DESC) = 1 AS most_recent_month FROM y""",
        s=M_CASES, m=M_MODEL,
    ),
)
def confusion_monthly(spark, sf_dir):
    t = frames(spark, sf_dir, support_cases=M_CASES, model_comparison=M_MODEL)
    out = complaints.model_metrics_monthly(t, min_reviewed=5)
    return rounded(out, ["recall", "precision", "chat_alert_rate", "observed_rate", "expected_rate", "expected_rate_v2"])


@register(
    "flag_counts",
    with_views(
        """SELECT count(CASE WHEN (is_flagged_by_advocate OR is_flagged_by_model) AND origin = 'Chat' THEN 1 END) AS flagged_by_advocate,
  count(CASE WHEN has_complaint_reviewed = 1 THEN 1 END) AS flagged_by_review FROM s JOIN m ON s.case_id = m.case_id""",
        s=M_CASES, m=M_MODEL,
    ),
)
def flag_counts(spark, sf_dir):
    return complaints.flag_counts(frames(spark, sf_dir, support_cases=M_CASES, model_comparison=M_MODEL))


@register(
    "cross_join_months",
    with_views(
        f"""
WITH mon AS (SELECT CAST(unnest(generate_series(DATE '2023-09-01', DATE '2025-08-01', INTERVAL 1 MONTH)) AS date) AS mo),
sm AS (SELECT *, {_MONTH.format('created_at_utc')} AS mo FROM s),
rev AS (SELECT mo, count(DISTINCT CASE WHEN has_complaint_reviewed = 1 THEN sm.case_id END) AS f, count(DISTINCT CASE WHEN m.case_id IS NOT NULL THEN sm.case_id END) AS n
  FROM sm LEFT JOIN m ON sm.case_id = m.case_id WHERE mo >= DATE '2023-10-01' GROUP BY 1),
al AS (
  SELECT mon.mo, count(DISTINCT CASE WHEN has_complaint_reviewed = 1 AND has_complaint_model = 1 THEN case_id END) AS tp,
    count(DISTINCT CASE WHEN has_complaint_reviewed = 1 AND has_complaint_model = 0 THEN case_id END) AS fn,
    count(DISTINCT CASE WHEN has_complaint_reviewed = 0 AND has_complaint_model = 1 THEN case_id END) AS fp
  FROM m CROSS JOIN mon WHERE case_creation_date_time >= TIMESTAMP '2023-11-01' GROUP BY 1),
ra AS (SELECT mo, count(DISTINCT CASE WHEN is_flagged_by_model THEN case_id END) AS a, count(DISTINCT CASE WHEN origin = 'Chat' THEN case_id END) AS b FROM sm
  WHERE created_at_utc >= TIMESTAMP '2023-11-01' GROUP BY 1),
ra3 AS (SELECT mo, a / nullif(b, 0) AS r, sum(a) OVER w / nullif(sum(b) OVER w, 0) AS r3 FROM ra WINDOW w AS (ORDER BY mo ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
fl AS (SELECT mo, count(DISTINCT c.case_id) AS a, count(DISTINCT sm.case_id) AS b FROM sm LEFT JOIN c ON sm.case_id = c.case_id AND workflow = 'Internal'
  WHERE created_at_utc >= TIMESTAMP '2023-11-01' GROUP BY 1),
fl3 AS (SELECT mo, a / nullif(b, 0) AS r, sum(a) OVER w / nullif(sum(b) OVER w, 0) AS r3 FROM fl WINDOW w AS (ORDER BY mo ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
z AS (
  SELECT rev.mo, f, n, f / nullif(n, 0) AS er, tp / nullif(tp + fn, 0) AS rc, tp / nullif(tp + fp, 0) AS pr, ra3.r AS ar, ra3.r3 AS ar3, fl3.r AS fr, fl3.r3 AS fr3
  FROM rev LEFT JOIN ra3 ON rev.mo = ra3.mo LEFT JOIN fl3 ON ra3.mo = fl3.mo LEFT JOIN al ON rev.mo = al.mo),
y AS (SELECT *, ar * pr / nullif(rc, 0) AS mer FROM z)
SELECT strftime(mo, '%Y-%m-%d') AS month, f AS flagged_by_review, n AS reviewed_cases, round(er, 6) AS review_expected_rate, round(rc, 6) AS recall, round(pr, 6) AS precision,
  round(ar, 6) AS model_alert_rate, round(ar3, 6) AS model_alert_rate_3m, round(mer, 6) AS model_expected_rate, round(fr, 6) AS flagging_rate, round(fr3, 6) AS flagging_rate_3m,
  round(fr / nullif(er, 0), 6) AS review_identification_rate, round(fr / nullif(mer, 0), 6) AS model_identification_rate,
  row_number() OVER (ORDER BY mer IS NOT NULL DESC, mo DESC) = 1 AS most_recent_valid_month FROM y""",
        s=M_CASES, m=M_MODEL, c=M_COMPLAINTS,
    ),
)
def cross_join_months(spark, sf_dir):
    t = frames(spark, sf_dir, support_cases=M_CASES, model_comparison=M_MODEL, complaints=M_COMPLAINTS)
    out = complaints.model_metrics_table(
        t, review_since="2023-10-01", data_since="2023-11-01", months_from="2023-09-01", months_to="2025-09-01"
    )
    return rounded(out, [
        "review_expected_rate", "recall", "precision", "model_alert_rate", "model_alert_rate_3m", "model_expected_rate", "flagging_rate",
        "flagging_rate_3m", "review_identification_rate", "model_identification_rate",
    ])


@register(
    "trailing3_rate",
    """
WITH m AS (SELECT date_trunc('month', o_orderdate) AS mo, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS closed, count(*) AS total FROM orders GROUP BY 1)
SELECT strftime(mo, '%Y-%m-%d') AS month, closed, total,
  round(sum(closed) OVER (ORDER BY mo ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) / sum(total) OVER (ORDER BY mo ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rate_3m FROM m""",
)
def trailing3_rate(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")["orders"]
    monthly = orders.groupBy(trunc_date("month", "o_orderdate").alias("month")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("closed"), F.count(F.lit(1)).alias("total")
    )
    return rounded(trailing_ratio(monthly, "closed", "total", "month", "rate_3m"), ["rate_3m"])


MESSAGES = view("events", lambda d: ["event_id as message_token", "ts as message_at_utc", "case when event_type = 'error' then 'BOT' else 'CUSTOMER' end as sender"])
PROSPECTS = view(
    "events",
    lambda d: [
        "case when event_type = 'click' then -1 - event_id else event_id end as chat_message_token", "user_id as conversation_token",
        f"{d.plus('ts', f'{d.k} * 60')} as detected_at",
    ],
)


@register(
    "incident_labels",
    with_views(
        """
WITH l AS (
  SELECT c.message_token, c.message_at_utc, p.conversation_token, p.detected_at,
    CASE WHEN message_at_utc BETWEEN TIMESTAMP '2024-01-05 10:00:00' AND TIMESTAMP '2024-01-07 12:00:00' THEN 'first'
      WHEN message_at_utc BETWEEN TIMESTAMP '2024-01-07 00:00:00' AND TIMESTAMP '2024-01-15 06:30:00' THEN 'second' END AS lab
  FROM c JOIN p ON c.message_token = p.chat_message_token WHERE sender = 'CUSTOMER'),
r AS (SELECT *, row_number() OVER (PARTITION BY conversation_token ORDER BY detected_at, message_token) AS rn FROM l WHERE lab IS NOT NULL)
SELECT message_token, strftime(message_at_utc, '%Y-%m-%d %H:%M:%S') AS message_at_utc, conversation_token, strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_at,
  lab AS incident_label, CASE lab WHEN 'first' THEN '2024-01-05 10:00:00' ELSE '2024-01-07 00:00:00' END AS incident_start,
  CASE lab WHEN 'first' THEN '2024-01-07 12:00:00' ELSE '2024-01-15 06:30:00' END AS incident_end,
  (SELECT count(*) FROM generate_series(CAST(detected_at AS date) + 1, DATE '2024-02-05', INTERVAL 1 DAY) g(x) WHERE isodow(x) < 6) AS age_business_days
FROM r WHERE rn = 1""",
        c=MESSAGES, p=PROSPECTS,
    ),
)
def incident_labels(spark, sf_dir):
    return complaints.incident_prospects(
        MESSAGES.spark(spark, sf_dir), PROSPECTS.spark(spark, sf_dir),
        [("first", "2024-01-05 10:00:00", "2024-01-07 12:00:00"), ("second", "2024-01-07 00:00:00", "2024-01-15 06:30:00")], as_of="2024-02-05",
    )


# -- workforce ------------------------------------------------------------------------------------

SCHEDULE = view(
    "events",
    lambda d: [
        "user_id as employee_id", "ts as interval_start", "case when event_type = 'view' then null else event_type end as schedule_channel",
        f"case {d.k} % 5 when 0 then 'Vacation day' when 1 then 'sick' when 2 then 'Early' else 'Late' end as shift_name",
        f"{d.k} * 60 as duration_seconds", f"{d.k} * 6 as non_prod_seconds", "cast(ts as date) as day",
    ],
)
ADHERENCE = view(
    "events",
    lambda d: [
        "event_id as row_id", "user_id as wfm_id", "case when event_type = 'error' then 'Break' else 'Available' end as attribute", "ts as period_ltz",
        "case when user_id % 2 = 0 then 'America/Los_Angeles' else 'UTC' end as local_timezone", f"cast({d.k} * 7 as bigint) as in_adherence_seconds",
        f"cast(case when {d.k} % 10 = 0 then 0 else {d.k} * 10 end as bigint) as scheduled_seconds",
    ],
)


@register(
    "adherence_ratio",
    with_views(
        """
WITH j AS (
  SELECT a.*, e.full_name, e.team_code, e.is_bpo, e.is_advocate, e.city, e.manager, CASE local_timezone WHEN 'UTC' THEN period_ltz ELSE period_ltz + INTERVAL 8 HOUR END AS u
  FROM a LEFT JOIN e ON a.wfm_id = e.employee_id AND a.period_ltz BETWEEN e.start_date AND e.end_date WHERE attribute = 'Available')
SELECT j.* EXCLUDE (u, period_ltz), strftime(period_ltz, '%Y-%m-%d %H:%M:%S') AS period_ltz, strftime(u, '%Y-%m-%d %H:%M:%S') AS ts_utc, strftime(u, '%Y-%m-%d') AS date_utc,
  round(in_adherence_seconds / nullif(scheduled_seconds, 0), 6) AS adherence FROM j""",
        a=ADHERENCE, e=EMPLOYEES,
    ),
)
def adherence_ratio(spark, sf_dir):
    return rounded(workforce.adherence(frames(spark, sf_dir, adherence=ADHERENCE, employees=EMPLOYEES)), ["adherence"])


@register(
    "share_by_channel",
    with_views(
        """
WITH b AS (
  SELECT DISTINCT employee_id, day, schedule_channel, shift_name, sum(duration_seconds) OVER (PARTITION BY employee_id, day, schedule_channel) AS cs,
    sum(duration_seconds) OVER (PARTITION BY employee_id, day) AS ds FROM m WHERE day BETWEEN DATE '2024-01-02' AND DATE '2024-01-25')
SELECT employee_id, strftime(day, '%Y-%m-%d') AS day, schedule_channel, shift_name, CAST(cs AS bigint) AS channel_seconds, CAST(ds AS bigint) AS day_seconds,
  round(cs / nullif(ds, 0) * 100, 2) AS channel_pct,
  CAST(row_number() OVER (PARTITION BY employee_id, day ORDER BY schedule_channel DESC NULLS LAST, cs DESC, shift_name) AS int) AS place FROM b""",
        m=SCHEDULE,
    ),
)
def share_by_channel(spark, sf_dir):
    return workforce.schedule_shares(SCHEDULE.spark(spark, sf_dir), "2024-01-02", "2024-01-25")


@register(
    "share_of_total",
    """
SELECT l_returnflag, l_linestatus, round(CAST(sum(l_quantity) AS double), 2) AS part_sum, round(CAST(sum(sum(l_quantity)) OVER (PARTITION BY l_returnflag) AS double), 2) AS total_sum,
  round(sum(l_quantity) / sum(sum(l_quantity)) OVER (PARTITION BY l_returnflag) * 100, 2) AS share_pct FROM lineitem GROUP BY 1, 2""",
)
def share_of_total(spark, sf_dir):
    from ..operators.metrics import share_of_total as share

    items = load(spark, sf_dir, "lineitem")["lineitem"]
    return rounded(share(items, ["l_returnflag", "l_linestatus"], ["l_returnflag"], "l_quantity"), ["part_sum", "total_sum"], 2)


@register(
    "shift_hours",
    with_views(
        """
WITH b AS (SELECT DISTINCT CAST(call_start_time AS date) AS day, e.employee_id FROM cr JOIN e ON cr.agent_user_name = e.agent_id AND CAST(call_start_time AS date) BETWEEN e.start_date AND e.end_date)
SELECT m.employee_id, strftime(m.day, '%Y-%m-%d') AS day, shift_name, floor(sum(duration_seconds) / 36 + 0.5) / 100 AS scheduled_hours, floor(sum(non_prod_seconds) / 36 + 0.5) / 100 AS non_prod_hours
FROM m JOIN b ON m.employee_id = b.employee_id AND m.day = b.day GROUP BY m.employee_id, m.day, shift_name""",
        m=SCHEDULE, cr=CALLS, e=EMPLOYEES,
    ),
)
def shift_hours(spark, sf_dir):
    return workforce.shift_hours(frames(spark, sf_dir, schedule=SCHEDULE, call_records=CALLS, employees=EMPLOYEES))


@register(
    "schedule_grain",
    with_views("SELECT count(*) AS row_count, count(DISTINCT (day, employee_id)) AS distinct_keys FROM m WHERE day IS NOT NULL AND employee_id IS NOT NULL", m=SCHEDULE),
)
def schedule_grain(spark, sf_dir):
    return workforce.schedule_grain(SCHEDULE.spark(spark, sf_dir))


@register(
    "capacity_vs_plan",
    with_views(
        """
WITH b AS (SELECT day, count(DISTINCT CASE WHEN shift_name ILIKE '%vacation%' OR shift_name ILIKE '%sick%' OR shift_name ILIKE '%absence%' OR shift_name ILIKE '%bereavement%' THEN employee_id END) AS absent_employees,
  count(DISTINCT employee_id) AS total_employees FROM m GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS day, absent_employees, total_employees, (total_employees - absent_employees) * 15 AS actual_volume, total_employees * 15 AS forecasted_volume FROM b""",
        m=SCHEDULE,
    ),
)
def capacity_vs_plan(spark, sf_dir):
    return workforce.staffing_forecast(SCHEDULE.spark(spark, sf_dir))


# -- voice ----------------------------------------------------------------------------------------


@register(
    "multi_queue_agents",
    with_views(
        """
WITH b AS (SELECT CAST(call_start_time AS date) AS day, agent_user_name, event_type AS is_in_app_queue, count(contact_id) AS n
  FROM (SELECT *, system_endpoint IN ('view', 'click') AS event_type FROM m) WHERE agent_user_name IS NOT NULL GROUP BY 1, 2, 3),
k AS (SELECT *, count(*) OVER (PARTITION BY day, agent_user_name) AS kinds FROM b)
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(sum(CASE WHEN is_in_app_queue THEN n END) AS bigint) AS in_app_calls, CAST(sum(n) AS bigint) AS all_calls,
  round(sum(CASE WHEN is_in_app_queue THEN n END) / nullif(sum(n), 0) * 100, 2) AS in_app_pct FROM k WHERE kinds > 1 GROUP BY day""",
        m=CALLS,
    ),
)
def multi_queue_agents(spark, sf_dir):
    calls = CALLS.spark(spark, sf_dir).withColumn("is_in_app_queue", F.col("system_endpoint").isin("view", "click"))
    return voice.queue_switching(calls)


@register(
    "in_app_calls",
    with_views(
        """SELECT strftime(CAST(call_start_time AS date), '%Y-%m-%d') AS day, count(contact_id) AS calls FROM m
WHERE agent_user_name IS NOT NULL AND is_in_app_queue GROUP BY CAST(call_start_time AS date)""",
        m=CALLS,
    ),
)
def in_app_calls(spark, sf_dir):
    return voice.in_app_calls(CALLS.spark(spark, sf_dir))


# The rule of a lost call: whoever waited, was hardly talked to, and came in directly, as the last leg, or by a transfer not ended by the flow.
_LOST = """
legs AS (SELECT *, wait_start_time IS NOT NULL AS waited, coalesce(handle_time, 0) < 1 AS no_talk, lead(contact_id) OVER (PARTITION BY initial_contact_id ORDER BY call_start_time, contact_id) IS NULL AS last_leg,
  lead(initiation_method) OVER (PARTITION BY initial_contact_id ORDER BY call_start_time, contact_id) AS next_method FROM {rows}),
judged AS (SELECT *, coalesce(talk_time, 0) + coalesce(wrap_time, 0) + coalesce(hold_time, 0) AS handle_time_new, waited AND coalesce(
    (initiation_method = 'INBOUND' AND NOT is_handled AND NOT rejected_queued AND requested_callback IS NULL)
    OR (initiation_method IN ('TRANSFER', 'DISCONNECT', 'CALLBACK') AND (last_leg OR next_method IS NULL) AND no_talk)
    OR (initiation_method ILIKE 'transfer' AND no_talk AND lower(disconnect_reason) <> 'contact_flow_disconnect_reason'), false) AS lost FROM legs)"""


@register(
    "abandon_relogic",
    with_views(f"WITH {_LOST.format(rows='m')} SELECT contact_id, handle_time_new, lost AS is_abandoned_new FROM judged", m=CALLS),
)
def abandon_relogic(spark, sf_dir):
    return voice.abandon_relogic(CALLS.spark(spark, sf_dir)).select("contact_id", "handle_time_new", "is_abandoned_new")


@register(
    "voice_revalidation",
    with_views(
        f"""
WITH f AS (SELECT * FROM m WHERE queue_name = 'Queue 2' AND call_end_time >= TIMESTAMP '2024-01-01'), {_LOST.format(rows='f')}
SELECT strftime(CAST(call_end_time AS date), '%Y-%m-%d') AS day, count(*) FILTER (waited AND initiation_method = 'INBOUND') AS contacts_incoming,
  count(*) FILTER (handle_time_new > 0) AS contacts_handled_new, count(*) FILTER (is_handled) AS contacts_handled_current, count(*) FILTER (lost) AS contacts_abandoned
FROM judged GROUP BY CAST(call_end_time AS date)""",
        m=CALLS,
    ),
)
def voice_revalidation(spark, sf_dir):
    return voice.voice_revalidation(CALLS.spark(spark, sf_dir), queue="Queue 2")


V_PHONE = view("orders", lambda d: ["o_orderkey as case_id", "case o_orderstatus when 'F' then 'Phone' else 'Chat' end as origin", "o_orderdate as case_creation_date_time"])
V_LINES = view("lineitem", lambda d: ["case when l_quantity > 20 then l_orderkey else -1 - l_orderkey end as case_id"])


@register(
    "coverage_gap_weekly",
    with_views(
        """
WITH j AS (SELECT date_trunc('week', c.case_creation_date_time) AS w, c.case_id, r.case_id AS rc FROM c LEFT JOIN r ON c.case_id = r.case_id
  WHERE c.case_creation_date_time >= TIMESTAMP '1996-01-01' AND origin = 'Phone')
SELECT strftime(w, '%Y-%m-%d') AS week, count(DISTINCT CASE WHEN rc IS NULL THEN case_id END) AS missing, count(DISTINCT case_id) AS total,
  concat(CAST(CAST(round(count(DISTINCT CASE WHEN rc IS NULL THEN case_id END) / count(DISTINCT case_id) * 100) AS bigint) AS varchar), '%') AS missing_rate FROM j GROUP BY w""",
        c=V_PHONE, r=V_LINES,
    ),
)
def coverage_gap_weekly(spark, sf_dir):
    return voice.cases_without_call(frames(spark, sf_dir, support_cases=V_PHONE, call_records=V_LINES), since_year=1996)


@register(
    "null_key_gap_weekly",
    with_views(
        """SELECT strftime(date_trunc('week', call_start_time), '%Y-%m-%d') AS week, CAST(count_if(case_id IS NULL) AS bigint) AS missing, count(*) AS total,
  concat(CAST(CAST(round(count_if(case_id IS NULL) / count(*) * 100) AS bigint) AS varchar), '%') AS missing_rate FROM m
WHERE call_start_time >= TIMESTAMP '2023-01-01' AND initiation_method = 'INBOUND' AND talk_time > 5 GROUP BY date_trunc('week', call_start_time)""",
        m=CALLS,
    ),
)
def null_key_gap_weekly(spark, sf_dir):
    return voice.calls_without_case(CALLS.spark(spark, sf_dir))


# -- complaints -----------------------------------------------------------------------------------

S_COMPLAINTS = view(
    "orders",
    lambda d: [
        "o_orderkey as complaint_id", "case o_orderkey % 6 when 0 then 'Internal' when 1 then 'Regulatory' when 2 then 'Pre-Litigation' when 3 then 'BBB' when 4 then 'Global' else 'Internal' end as workflow",
        "case when o_orderkey % 50 = 0 then null else 'In Progress' end as complaint_status", "case when o_orderkey % 3 = 0 then null else 'Unit X' end as business_unit",
        "o_custkey as customer_token", "case when o_orderkey % 7 = 0 then null else o_orderkey % 4 = 0 end as is_central_team",
        f"{d.plus(d.stamp('2024-01-01'), 'o_orderkey % 20 * 86400')} as flagged_ts_utc", "o_custkey as last_modified_by_id",
        "case when o_orderkey % 4 = 0 then o_orderkey % 5 else o_custkey end as owner_id", "o_custkey + 3 as investigator_id",
        f"{d.plus('o_orderdate', '36000')} as created_ts_utc", "o_orderdate as received_ts_utc", f"{d.plus('o_orderdate', 'o_orderkey % 15 * 86400')} as acknowledged_ts_utc",
        f"case when o_orderkey % 9 = 0 then null else {d.plus('o_orderdate', 'o_orderkey % 31 * 86400')} end as closed_ts_utc",
        f"{d.plus('o_orderdate', 'o_orderkey % 23 * 86400')} as resolved_ts_utc", f"{d.plus('o_orderdate', 'o_orderkey % 19 * 86400 + 50000')} as investigated_ts_utc",
        f"{d.plus('o_orderdate', '20 * 86400')} as response_due_ts_utc", f"case when o_orderkey % 8 = 0 then null else {d.plus('o_orderdate', '18 * 86400')} end as external_response_sent_ts_utc",
        "case when o_orderkey % 4 = 0 then null else 'TX' end as customer_state", "case when o_orderkey % 5 = 0 then null else 'court' end as source_type", "'agency' as agency", "'portal' as portal",
        "o_orderkey % 2 = 0 as pushback", "o_orderkey % 3 = 0 as rejected_response",
    ],
)
_ANSWERED = "case when o_orderstatus = 'P' then -1 - o_orderkey else o_orderkey end as parent_id"
S_HISTORY = View(
    (
        ("orders", lambda d: [_ANSWERED, "'date_responded_in_bbb' as field", "'1999-05-06 10:00:00' as new_value", "o_orderdate as created_at_utc"]),
        ("orders", lambda d: [_ANSWERED, "'date_responded_in_bbb' as field", "'2000-01-02 00:00:00' as new_value", f"{d.plus('o_orderdate', 'o_orderkey % 3 * 100')} as created_at_utc"]),
    )
)
S_SPONSORED = view("customer", lambda d: ["case when c_mktsegment = 'BUILDING' then c_custkey else -1 - c_custkey end as dependent_customer_token"])
S_CARDS = view("events", lambda d: ["user_id as customer_token", "event_type as sponsoring_bank", "ts as created_at"])
S_QUEUES = view("region", lambda d: ["cast(r_regionkey as bigint) as queue_id", "r_name as queue_name"])
S_USERS = view("customer", lambda d: ["case when c_mktsegment = 'MACHINERY' then -1 - c_custkey else c_custkey end as id", "concat('user ', c_name) as name"])


def _bdays(a: str, b: str) -> str:
    """Weekdays in (a, b] by closed form on whole weeks and a remainder count."""
    n = f"date_diff('day', CAST({a} AS date), CAST({b} AS date))"
    return (
        f"(({n} // 7) * 5 + (SELECT count(*) FROM (VALUES (1), (2), (3), (4), (5), (6)) v(i) WHERE v.i <= {n} % 7 AND isodow(CAST({a} AS date) + CAST(({n} // 7) * 7 + v.i AS int)) < 6))"
    )


@register(
    "business_day_sla",
    with_views(
        f"""
WITH bb AS (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY created_at_utc DESC, new_value) AS rn FROM h WHERE field = 'date_responded_in_bbb'),
bk AS (SELECT *, row_number() OVER (PARTITION BY customer_token ORDER BY created_at DESC, sponsoring_bank) AS rn FROM cd),
b AS (
  SELECT c.* REPLACE (CASE WHEN workflow IN ('Internal', 'Regulatory', 'Pre-Litigation', 'BBB', 'Global') THEN coalesce(business_unit, 'House') ELSE business_unit END AS business_unit,
      CASE WHEN workflow IN ('Regulatory', 'Pre-Litigation', 'BBB') THEN true ELSE coalesce(is_central_team, false) END AS is_central_team),
    CAST(bb.new_value AS timestamp) AS bbb, bk.sponsoring_bank AS third_party_provider, sp.dependent_customer_token IS NOT NULL AS is_dependent_account,
    coalesce(CAST(ow.employee_id AS varchar), CAST(q.queue_id AS varchar)) AS owner_ref, coalesce(ow.full_name, q.queue_name) AS owner_name,
    coalesce(CAST(mo.employee_id AS varchar), CAST(u.id AS varchar)) AS modified_by_ref, coalesce(mo.full_name, u.name) AS modified_by_name, iv.full_name AS investigator_name
  FROM c LEFT JOIN e mo ON c.last_modified_by_id = mo.agent_id AND CAST(flagged_ts_utc AS date) BETWEEN mo.start_date AND mo.end_date
  LEFT JOIN e ow ON c.owner_id = ow.agent_id AND CAST(flagged_ts_utc AS date) BETWEEN ow.start_date AND ow.end_date
  LEFT JOIN e iv ON c.investigator_id = iv.agent_id AND CAST(flagged_ts_utc AS date) BETWEEN iv.start_date AND iv.end_date
  LEFT JOIN u ON c.last_modified_by_id = u.id LEFT JOIN q ON c.owner_id = q.queue_id
  LEFT JOIN bb ON bb.parent_id = c.complaint_id AND bb.rn = 1 AND c.created_ts_utc >= TIMESTAMP '1995-06-01' LEFT JOIN sp ON c.customer_token = sp.dependent_customer_token
  LEFT JOIN bk ON bk.customer_token = c.customer_token AND bk.rn = 1 WHERE complaint_status IS NOT NULL),
d AS (
  SELECT *, CASE WHEN workflow = 'Internal' THEN {_bdays('received_ts_utc', 'acknowledged_ts_utc')} END AS ack,
    CASE WHEN workflow <> 'Global' AND closed_ts_utc IS NOT NULL THEN {_bdays('received_ts_utc', 'closed_ts_utc')} END AS clo,
    CASE WHEN workflow = 'Internal' THEN 15 WHEN workflow <> 'Global' THEN {_bdays('received_ts_utc', 'response_due_ts_utc')} END AS thr FROM b),
f AS (
  SELECT *, CASE WHEN workflow = 'Internal' AND is_central_team THEN coalesce(ack <= 6, false) END AS iack,
    CASE WHEN workflow = 'Internal' AND NOT is_central_team THEN coalesce(clo <= 5, false) END AS ier FROM d)
SELECT complaint_id, workflow, business_unit, is_central_team, owner_ref, owner_name, modified_by_ref, modified_by_name, investigator_name, third_party_provider, is_dependent_account,
  workflow IN ('Regulatory', 'Pre-Litigation', 'BBB') AS is_external,
  CASE workflow WHEN 'Regulatory' THEN agency WHEN 'Pre-Litigation' THEN trim(concat(coalesce(customer_state, ''), ' ', coalesce(source_type, ''))) WHEN 'BBB' THEN portal END AS third_party_source,
  CASE workflow WHEN 'Internal' THEN false WHEN 'Regulatory' THEN pushback WHEN 'Pre-Litigation' THEN pushback WHEN 'BBB' THEN rejected_response END AS pushback,
  strftime(CASE WHEN workflow IN ('Regulatory', 'Pre-Litigation', 'BBB') THEN response_due_ts_utc END, '%Y-%m-%d %H:%M:%S') AS response_due,
  strftime(CASE WHEN workflow IN ('Regulatory', 'Pre-Litigation') THEN external_response_sent_ts_utc WHEN workflow = 'BBB' THEN bbb END, '%Y-%m-%d %H:%M:%S') AS external_response_sent,
  ack AS time_to_acknowledge_business_days, clo AS time_to_closure_business_days, CAST(thr AS bigint) AS response_sla_threshold, iack AS is_in_acknowledgement_sla, ier AS is_in_early_resolution_sla,
  CASE WHEN (workflow = 'Internal' AND NOT ier) OR workflow IN ('Regulatory', 'Pre-Litigation', 'BBB') THEN clo <= thr ELSE false END AS is_in_formal_response_sla,
  CASE WHEN workflow = 'Internal' THEN date_diff('day', created_ts_utc, resolved_ts_utc) WHEN workflow IN ('Regulatory', 'Pre-Litigation') THEN date_diff('day', received_ts_utc, investigated_ts_utc)
    WHEN workflow = 'BBB' THEN date_diff('day', received_ts_utc, bbb) END AS investigation_days FROM f""",
        c=S_COMPLAINTS, h=S_HISTORY, e=EMPLOYEES, u=S_USERS, q=S_QUEUES, sp=S_SPONSORED, cd=S_CARDS,
    ),
)
def business_day_sla(spark, sf_dir):
    t = frames(
        spark, sf_dir, complaints=S_COMPLAINTS, complaint_history=S_HISTORY, employees=EMPLOYEES, users=S_USERS, queue_catalog=S_QUEUES,
        sponsored_accounts=S_SPONSORED, card_issuance=S_CARDS,
    )
    out = complaints.complaints_sot(t, default_unit="House", bbb_since="1995-06-01")
    return out.select(
        "complaint_id", "workflow", "business_unit", "is_central_team", "owner_ref", "owner_name", "modified_by_ref", "modified_by_name", "investigator_name",
        "third_party_provider", "is_dependent_account", "is_external", "third_party_source", "pushback", "response_due", "external_response_sent",
        "time_to_acknowledge_business_days", "time_to_closure_business_days", "response_sla_threshold", "is_in_acknowledgement_sla",
        "is_in_early_resolution_sla", "is_in_formal_response_sla", "investigation_days",
    ).withColumn("external_response_sent", F.col("external_response_sent").cast("timestamp_ntz"))


@register(
    "business_days",
    f"""SELECT o_orderkey, CAST(CASE WHEN l_shipdate >= o_orderdate THEN {_bdays('o_orderdate', 'l_shipdate')} ELSE -{_bdays('l_shipdate', 'o_orderdate')} END AS bigint) AS days
FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS l_shipdate FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
)
def business_days(spark, sf_dir):
    t = load(spark, sf_dir, "orders", "lineitem")
    first = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("l_shipdate"))
    """Also for ranges of years and for reversed ones, whose count is negative."""
    return t["orders"].join(first, "o_orderkey").select("o_orderkey", business_days_between("o_orderdate", "l_shipdate").alias("days"))


# -- percentiles, buckets, shares -----------------------------------------------------------------


@register(
    "median_percentiles",
    """
SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.25), 4) AS p25, round(median(o_totalprice), 4) AS p50, round(quantile_cont(o_totalprice, 0.75), 4) AS p75,
  round(quantile_cont(o_totalprice, 0.95), 4) AS p95 FROM orders GROUP BY 1""",
)
def median_percentiles(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")["orders"]
    out = exact_percentiles(orders, ["o_orderpriority"], "o_totalprice", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95})
    return rounded(out, ["p25", "p50", "p75", "p95"], 4)


@register(
    "rolled_distinct_counts",
    """
WITH e AS (SELECT date_trunc('day', ts) AS day, event_type, user_id, value FROM events),
g AS (
  SELECT 'day' AS grain, day AS since, event_type, user_id, value FROM e
  UNION ALL SELECT 'month', date_trunc('month', day), event_type, user_id, value FROM e
  UNION ALL SELECT 'all', NULL, NULL, user_id, value FROM e)
SELECT grain, strftime(since, '%Y-%m-%d') AS since, event_type, count(DISTINCT user_id) AS people,
  count(DISTINCT CASE WHEN value > 100 THEN user_id END) AS people_above_100
FROM g GROUP BY grain, since, event_type""",
)
def rolled_distinct_counts(spark, sf_dir):
    """Distinct people of days, months and the whole, or-ed from bitmaps of hours; the second half of the month found its ids in two steps."""
    events = load(spark, sf_dir, "events")["events"]
    first = rollups.dense_ids(events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")), "user_id", "ts")
    ids = rollups.dense_ids(events, "user_id", "ts", known=first)
    flags = {"people": None, "people_above_100": F.col("value") > 100}
    rows = events.join(ids, "user_id").withColumn("hour", trunc("hour", "ts"))
    folder = work_folder(spark, "bitmaps")
    write(rollups.id_bitmaps(rows, ["hour", "event_type"], "num", flags), f"{folder}/hours")
    hours = spark.read.parquet(f"{folder}/hours")
    days = rollups.merge_bitmaps(hours, [trunc("day", "hour").alias("since"), "event_type"], list(flags))
    months = rollups.merge_bitmaps(days, [trunc("month", "since").alias("since"), "event_type"], list(flags))
    whole = rollups.merge_bitmaps(months, [F.lit(None).cast("timestamp_ntz").alias("since"), F.lit(None).cast("string").alias("event_type")], list(flags))
    out = [rollups.bitmap_counts(part.withColumn("grain", F.lit(g)), ["grain", "since", "event_type"], list(flags)) for g, part in (("day", days), ("month", months), ("all", whole))]
    return out[0].unionByName(out[1]).unionByName(out[2]).withColumn("since", F.date_format("since", "yyyy-MM-dd"))


@register(
    "rolled_percentiles",
    """
SELECT strftime(date_trunc('month', ts), '%Y-%m-%d') AS since, event_type, count(value) AS n, true AS p25, true AS p50, true AS p95
FROM events WHERE value IS NOT NULL GROUP BY 1, 2""",
)
def rolled_percentiles(spark, sf_dir):
    """Are the percentiles of months, merged from sketches of days, within a hundredth of the wanted rank?"""
    events = load(spark, sf_dir, "events")["events"]
    points = {"p25": 0.25, "p50": 0.5, "p95": 0.95}
    days = rollups.sketches(events.withColumn("day", trunc("day", "ts")), ["day", "event_type"], "value")
    months = rollups.merge_sketches(days, [trunc("month", "day").alias("since"), "event_type"])
    found = rollups.sketch_percentiles(months, points)
    rows = events.filter("value is not null").withColumn("since", trunc("month", "ts")).join(found, ["since", "event_type"])
    below = [F.count_if(F.col("value") < F.col(p)).alias(f"__lt_{p}") for p in points] + [F.count_if(F.col("value") <= F.col(p)).alias(f"__le_{p}") for p in points]
    ranks = rows.groupBy("since", "event_type", "n").agg(*below)
    near = [((F.col(f"__lt_{p}") <= (at + 0.01) * F.col("n")) & (F.col(f"__le_{p}") >= (at - 0.01) * F.col("n"))).alias(p) for p, at in points.items()]
    return ranks.select(F.date_format("since", "yyyy-MM-dd").alias("since"), "event_type", "n", *near)


def _case_sql(value: str, ranges) -> str:
    parts = []
    for lo, hi, label in ranges:
        cond = " AND ".join(([f"{value} >= {lo}"] if lo is not None else []) + ([f"{value} <= {hi}"] if hi is not None else []))
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


_K = "CAST(json_extract(props, '$.k') AS int)"


@register(
    "bucket_counts",
    f"""
SELECT {_case_sql(f'({_K} - 5)', c.WAIT_RANGES)} AS wait_bucket, {_case_sql('(floor(value) * 5)', c.CALLBACK_RANGES)} AS callback_bucket,
  {_case_sql('extract(hour FROM ts)', c.DAY_SLOTS_4)} AS slot4, {_case_sql('extract(hour FROM ts)', c.DAY_SLOTS_6)} AS slot6,
  {_case_sql('(floor(value) * 8000)', c.LIFETIME_RANGES)} AS life_bucket, count(*) AS n,
  CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 END AS sort_key, event_type FROM events GROUP BY ALL""",
)
def bucket_counts(spark, sf_dir):
    events = load(spark, sf_dir, "events")["events"]
    k = F.get_json_object("props", "$.k").cast("int")
    sort_key = c.case([(F.col("event_type") == name, F.lit(i + 1)) for i, name in enumerate(("signup", "view", "click"))])
    rows = events.select(
        c.bucketize(k - 5, c.WAIT_RANGES).alias("wait_bucket"), c.bucketize(F.floor("value") * 5, c.CALLBACK_RANGES).alias("callback_bucket"),
        c.hour_slot("ts").alias("slot4"), c.hour_slot("ts", c.DAY_SLOTS_6).alias("slot6"),
        c.bucketize(F.floor("value") * 8000, c.LIFETIME_RANGES).alias("life_bucket"), sort_key.alias("sort_key"), "event_type",
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@register(
    "percent_of_total",
    "SELECT o_orderpriority, count(DISTINCT o_orderkey) AS cases, round(count(DISTINCT o_orderkey) / sum(count(DISTINCT o_orderkey)) OVER (), 6) AS share FROM orders GROUP BY 1",
)
def percent_of_total_query(spark, sf_dir):
    from ..operators.metrics import distinct_counts

    orders = load(spark, sf_dir, "orders")["orders"]
    return percent_of_total(distinct_counts(orders, ["o_orderpriority"], "o_orderkey", {"cases": None}), "cases", "share", 6)


@register(
    "text_classes",
    """
SELECT CASE WHEN text ILIKE '%license%' OR text ILIKE '%copyright%' THEN 'legal' WHEN text ILIKE '%http%' THEN 'link' WHEN text ILIKE '%@%' THEN 'mail' ELSE source END AS class,
  count(*) AS docs, CAST(sum(n_chars) AS bigint) AS chars FROM documents GROUP BY 1""",
)
def text_classes(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")["documents"]
    rules = [c.TextRule("legal", ("%license%", "%copyright%")), c.TextRule("link", ("%http%",)), c.TextRule("mail", ("%@%",))]
    return docs.groupBy(c.classify("text", rules, F.col("source")).alias("class")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars")
    )


