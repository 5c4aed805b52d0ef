"""Streaming queries, run to the end of their input."""

from __future__ import annotations

from datetime import date

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..plans import cases, payments, sla
from ..streaming import sla as s
from ..streaming import stateful
from .base import CATALOG, CHATS, MESSAGING, View, register, with_views, work_folder
from .history import _PHONE, _STAY_VIEWS, _STAYS, CASE_HISTORY, PHONE_CASES, QUEUES, _stays
from .matching import _PAY_VIEWS, PAYMENT_AUDIT_SQL, _pay
from .rules import SLA
from .sla import _MIN, _QUEUE_FACT, START, STOP, rounded

# every id in two hours, days 10 to 14 of the month left out by moving them behind the others
def _moved(d, more: str) -> str:
    return d.plus("ts", f"{more} + case when extract(day from ts) between 10 and 14 then 30 * 86400 else 0 end")


STREAMED = View(
    (
        ("events", lambda d: ["event_id", "event_type", "value", f"{_moved(d, '0')} as ts"]),
        ("events", lambda d: ["event_id", "event_type", "value + 40 as value", f"{_moved(d, '3600')} as ts"]),
    )
)
_FLAGS = {
    "in_sla": lambda: (F.col("value") <= 120) & F.hour("ts").between(8, 17),
    "qualified": lambda: F.hour("ts").between(8, 17),
}
FILES = 4
_END = "2025-06-01"
#: Rows that one task writes into one file of a replay, about.
ROWS_PER_FILE = 1_000_000


def _flags():
    return {n: f() for n, f in _FLAGS.items()}


def _replay(spark, sf_dir, folder, end: bool = True, files_per_batch: int = 1):
    """The rows as a stream of several files, a tenth of them one file late; the last file holds one row without id that ends the time."""
    rows = STREAMED.spark(spark, sf_dir)
    at = F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 8) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    rows = rows.withColumn("part", F.least(at, F.lit(FILES - 1)))
    for i in range(FILES):
        rows.filter(F.col("part") == i).drop("part").coalesce(1).write.parquet(f"{folder}/in/{i}")
    if end:
        last = rows.drop("part").limit(1).select(
            F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("event_type"), "value", F.lit(_END).cast("timestamp_ntz").alias("ts")
        )
        last.coalesce(1).write.parquet(f"{folder}/in/{FILES}")
    return s.file_stream(spark, f"{folder}/in", files_per_batch=files_per_batch)


def _land(spark, parts, folder) -> int:
    """Write the parts one after the other, each as the same number of files, and return that number: so many files are a batch of the stream.

    A part is written by as many tasks as it has files.  The order of files is that of their times, so a part with fewer rows is filled up with files
    without any.
    """
    n = max(1, *(-(-part.count() // ROWS_PER_FILE) for part in parts))
    for i, part in enumerate(parts):
        part.repartition(n).write.parquet(f"{folder}/{i}")
        for k in range(n - len(spark.read.parquet(f"{folder}/{i}").inputFiles())):
            spark.createDataFrame([], part.schema).coalesce(1).write.parquet(f"{folder}/{i}/empty{k}")
    return n


_HOURS = """
WITH h AS (
  SELECT date_trunc('hour', ts) AS h{key}, count(DISTINCT event_id) AS handled,
    count(DISTINCT CASE WHEN value <= 120 AND extract(hour FROM ts) BETWEEN 8 AND 17 THEN event_id END) AS in_sla,
    count(DISTINCT CASE WHEN extract(hour FROM ts) BETWEEN 8 AND 17 THEN event_id END) AS qualified
  FROM e GROUP BY ALL)
"""


@register(
    "stream_sla",
    with_views(
        _HOURS.format(key=", event_type") + "SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS ts, event_type, handled, in_sla, qualified FROM h", e=STREAMED
    ),
)
def stream_sla(spark, sf_dir):
    root = work_folder(spark, "stream_sla")
    # a backlog: what lies there is one batch; the other entries take file by file
    hourly = s.stream_sla(_replay(spark, sf_dir, root, files_per_batch=FILES), "ts", "event_id", ["event_type"], _flags())
    s.run_to_end(hourly, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@register(
    "stream_alerts",
    with_views(
        _HOURS.format(key="")
        + """, p AS (SELECT h AS ts, handled, in_sla, qualified, round(in_sla / nullif(qualified, 0) * 100, 2) AS sla_pct FROM h),
l AS (SELECT *, lag(sla_pct) OVER (ORDER BY ts) AS prev_sla_pct FROM p)
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(ts, '%Y-%m-%d') AS day, handled, in_sla, qualified, sla_pct, prev_sla_pct,
  coalesce(prev_sla_pct - sla_pct >= 10, false) AS alert_drop, coalesce(handled > 15, false) AS alert_volume, coalesce(sla_pct < 25, false) AS alert_floor FROM l""",
        e=STREAMED,
    ),
)
def stream_alerts(spark, sf_dir):
    root = work_folder(spark, "stream_alerts")
    hourly = s.stream_sla(_replay(spark, sf_dir, root), "ts", "event_id", [], _flags(), closed="closed")
    stateful.append_to(stateful.stream_alerts(hourly, ceiling=15), f"{root}/alerts", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/alerts").withColumn("day", F.col("ts").cast("date"))


# of every id with remainder 3 one row comes behind all others; the rest is there a batch before, so the time has passed on
_STRAGGLERS = "event_id % 10 = 3"


@register(
    "stream_uncounted_rows",
    with_views(
        f"""WITH top AS (SELECT max(ts) AS last FROM e WHERE NOT ({_STRAGGLERS}))
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS ts, count(*) AS landed,
  count(*) FILTER (NOT gone) AS counted, count(*) FILTER (gone) AS late
FROM (SELECT ts, {_STRAGGLERS} AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= last - INTERVAL 7 DAY AS gone FROM e, top)
GROUP BY 1 HAVING count(*) FILTER (gone) > 0""",
        e=STREAMED,
    ),
)
def stream_uncounted_rows(spark, sf_dir):
    """Rows that came more than the lateness behind the newest one, per hour."""
    root = work_folder(spark, "stream_uncounted")
    rows = STREAMED.spark(spark, sf_dir)
    end = rows.limit(1).select(
        F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("event_type"), "value", F.lit(_END).cast("timestamp_ntz").alias("ts")
    )
    # the newest row again, so that batches lie between the others and the stragglers
    newest = rows.filter(f"not ({_STRAGGLERS})").orderBy(F.col("ts").desc()).limit(1).withColumns({"event_id": F.lit(None).cast("bigint"), "event_type": F.lit(None).cast("string")})
    batch = _land(spark, [rows.filter(f"not ({_STRAGGLERS})"), newest, newest, rows.filter(_STRAGGLERS)], f"{root}/in")
    # the last batch needs no more than its one row
    end.coalesce(1).write.parquet(f"{root}/in/4")
    events = s.file_stream(spark, f"{root}/in", files_per_batch=batch)
    hourly = s.stream_sla(events, "ts", "event_id", ["event_type"], _flags(), rows="rows")
    s.run_to_end(hourly, f"{root}/out", f"{root}/checkpoint")
    landed = spark.read.parquet(f"{root}/in/0", f"{root}/in/3")
    counted = spark.read.parquet(f"{root}/out").filter("event_type is not null")
    return s.uncounted_rows(landed, "ts", counted, "rows")


def _dealt(spark, rows, folder: str, ts: str, end: dict):
    """A table as a stream of several files, a tenth of the rows one file late; the last file holds one row that ends the time."""
    at = F.floor(F.datediff(ts, F.lit("2024-01-01").cast("date")) / 8) + F.when(F.pmod(F.xxhash64(*rows.columns), F.lit(10)) == 0, 1).otherwise(0)
    # read once: each part is counted and written
    rows = rows.withColumn("part", F.coalesce(F.least(F.greatest(at, F.lit(0)), F.lit(FILES - 1)), F.lit(0))).persist(StorageLevel.DISK_ONLY)
    batch = _land(spark, [rows.filter(F.col("part") == i).drop("part") for i in range(FILES)], folder)
    rows.unpersist()
    one = spark.range(1).select(*[F.lit(end.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.drop("part").schema.fields])
    one.coalesce(1).write.parquet(f"{folder}/{FILES}")
    return s.file_stream(spark, folder, files_per_batch=batch)


@register(
    "stream_queue_sla",
    with_views(_QUEUE_FACT + "SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts) FROM fact", m=MESSAGING, c=CATALOG, x=CHATS),
)
def stream_queue_sla(spark, sf_dir):
    """The hourly queue fact from a stream of touches and one of chats."""
    root = work_folder(spark, "stream_queue_sla")
    # the last row has a queue, as work without one is dropped before it could move the time
    end = {"touch_start_time": _END, "touch_assignment_time": _END, "queue_name": "Queue 0"}
    touches = _dealt(spark, MESSAGING.spark(spark, sf_dir), f"{root}/touches", "touch_start_time", end)
    chats = _dealt(
        spark, CHATS.spark(spark, sf_dir), f"{root}/chats", "chat_created_at",
        {"chat_created_at": _END, "chat_start_time": _END, "chat_record_type": SLA.record_types[0]},
    )
    t = {"messaging_touches": touches, "chat_escalations": chats, "queue_catalog": CATALOG.spark(spark, sf_dir)}
    out = {}
    for name, stream in sla.streams_of_queue_sla(t, SLA).items():
        s.run_to_end(stream, f"{root}/out/{name}", f"{root}/checkpoint/{name}")
        out[name] = spark.read.parquet(f"{root}/out/{name}")
    return rounded(sla.queue_sla_of_streams(out["messaging"], out["chat"], START, STOP, SLA), _MIN)


@register(
    "stream_queue_history",
    with_views(
        _STAYS
        + """SELECT * REPLACE (strftime(queue_start_time, '%Y-%m-%d %H:%M:%S') AS queue_start_time,
  strftime(queue_end_time, '%Y-%m-%d %H:%M:%S') AS queue_end_time) FROM stays""",
        **_STAY_VIEWS,
    ),
)
def stream_queue_history(spark, sf_dir):
    """Stays of cases in queues from a stream of changes and one of phone cases."""
    _, t = _stays(spark, sf_dir)
    root = work_folder(spark, "stream_queue_history")
    changes = _dealt(
        spark, CASE_HISTORY.spark(spark, sf_dir), f"{root}/changes", "created_date",
        {"created_date": _END, "source": "S1", "field": "owner", "new_value": 0, "case_id": -1},
    )
    phone = _dealt(spark, PHONE_CASES.spark(spark, sf_dir), f"{root}/phone", "created_at_utc", {"created_at_utc": _END, "origin": "Phone", "case_id": -1})
    moves = cases.case_moves({**t, "case_history": changes, "cases": phone}, source="S1", phone_queue=_PHONE)
    log = stateful.stream_stays(moves, "case_id", "queue_start_time", "queue_id", tie=cases.MOVE_TIES)
    stateful.append_to(log, f"{root}/log", f"{root}/checkpoint")
    stays = stateful.stays_of(spark.read.parquet(f"{root}/log"), moves, "queue_number", "queue_end_time").filter("case_id >= 0")
    return cases.case_queue_history(t, source="S1", phone_queue=_PHONE, stays=stays)


@register("stream_payment_match", with_views(PAYMENT_AUDIT_SQL, **_PAY_VIEWS))
def stream_payment_match(spark, sf_dir):
    """Reimbursements with their audit entry from a stream of payments and one of audit entries."""
    t, root = _pay(spark, sf_dir), work_folder(spark, "stream_payment_match")
    pays = _dealt(
        spark, t["payments"], f"{root}/payments", "created_at",
        {"created_at": _END, "payment_id": -1, "creation_mechanism": "REIMBURSEMENT", "sender_token": 1, "state": "PAID_OUT", "recipient_token": -1},
    )
    logs = _dealt(spark, t["audit_logs"], f"{root}/audits", "created_at", {"created_at": _END, "action_name": "reimburse", "entity_token": -1})
    left = payments.reimbursed(pays, sender_token=1, since="2024-01-03")
    # every batch looks its entries up there
    paid = payments.paid_cases(t).persist(StorageLevel.DISK_ONLY)
    right = payments.weighted_audits({**t, "audit_logs": logs}, paid)
    match = stateful.stream_match(left, right, prefer=payments.audit_preferred(), weight="__weight", lateness="9 days", **payments.AUDIT_MATCH)
    stateful.append_to(match, f"{root}/out", f"{root}/checkpoint", stateful.JOINS)
    paid.unpersist()
    return payments.match_reimbursements(t, sender_token=1, since="2024-01-03", best=spark.read.parquet(f"{root}/out"))


_DAYS = """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(DISTINCT event_id) AS handled,
  count(DISTINCT CASE WHEN value <= 120 AND extract(hour FROM ts) BETWEEN 8 AND 17 THEN event_id END) AS in_sla,
  count(DISTINCT CASE WHEN extract(hour FROM ts) BETWEEN 8 AND 17 THEN event_id END) AS qualified FROM e {where} GROUP BY 1, 2"""


def _reload(spark, sf_dir, name, ds):
    root = work_folder(spark, name)
    events = _replay(spark, sf_dir, root, end=False)
    s.stream_trailing_reload(events, "ts", "event_id", ["event_type"], _flags(), f"{root}/landing", f"{root}/facts", f"{root}/checkpoint", ds=ds)
    return root


@register("stream_trailing_reload", with_views(_DAYS.format(where=""), e=STREAMED))
def stream_trailing_reload(spark, sf_dir):
    """Every day, whatever the batches."""
    return spark.read.parquet(f"{_reload(spark, sf_dir, 'stream_reload', None)}/facts")


@register("stream_reload_run", with_views(_DAYS.format(where="WHERE CAST(ts AS date) >= DATE '2024-01-13'"), e=STREAMED))
def stream_reload_run(spark, sf_dir):
    """The run of a day: the seven days before it and later ones."""
    return spark.read.parquet(f"{_reload(spark, sf_dir, 'stream_run', date(2024, 1, 20))}/facts")


@register(
    "stream_late_rows",
    with_views("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows FROM e WHERE CAST(ts AS date) < DATE '2024-01-13' GROUP BY 1", e=STREAMED),
)
def stream_late_rows(spark, sf_dir):
    return s.late_rows(spark, f"{_reload(spark, sf_dir, 'stream_late', date(2024, 1, 20))}/landing", date(2024, 1, 20))
