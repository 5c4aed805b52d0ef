"""Late rows, repeated rows and restarts of the streaming jobs."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsgrain.registry.base import work_folder
from opsgrain.streaming import sla as s
from opsgrain.streaming import stateful

T0 = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, kind string, value double"


def files(spark, folder, batches):
    import time

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/f{i}.parquet")
        time.sleep(0.05)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").parquet(folder)


END = (None, T0 + timedelta(days=400), "a", 0.0)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def plain(spark, data):
    """The batch form of the counts."""
    from opsgrain.functions.dialect import trunc
    from opsgrain.operators.metrics import distinct_counts

    df = spark.createDataFrame(data, SCHEMA).withColumn("t", trunc("hour", "ts"))
    return distinct_counts(df, ["t", "kind"], "event_id", {"handled": None, "in_sla": F.col("value") <= 120})


# an id in two hours and twice in one (flag on the second row only), a late row, a gap of six days
DATA = [
    [(1, T0, "a", 500.0), (1, T0 + timedelta(minutes=9), "a", 1.0), (2, T0 + timedelta(hours=1), "b", 1.0)],
    [(1, T0 + timedelta(hours=1), "a", 500.0), (3, T0 + timedelta(days=6), "a", 500.0)],
    [(4, T0 + timedelta(days=2), "a", 1.0), (5, T0 + timedelta(days=6, hours=3), "a", 1.0)],
]


@pytest.mark.parametrize("batches", [DATA, [sum(DATA, [])], [[r] for r in sum(DATA, [])]])
def test_stream_equals_batch_however_files_are_dealt(spark, tmp_path, batches):
    stream = files(spark, str(tmp_path / "in"), [*batches, [END]])
    hourly = s.stream_sla(stream, "ts", "event_id", ["kind"], {"in_sla": F.col("value") <= 120})
    s.run_to_end(hourly, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = rows(spark.read.parquet(str(tmp_path / "out")), "ts", "kind", "handled", "in_sla")
    assert got == rows(plain(spark, sum(DATA, [])), "t", "kind", "handled", "in_sla")


def test_rows_beyond_the_lateness_do_not_count(spark, tmp_path):
    batches = [[(1, T0 + timedelta(days=30), "a", 1.0)], [(2, T0 + timedelta(days=31), "a", 1.0)], [(3, T0, "a", 1.0)], [END]]
    hourly = s.stream_sla(files(spark, str(tmp_path / "in"), batches), "ts", "event_id", ["kind"], {"in_sla": F.col("value") <= 120})
    s.run_to_end(hourly, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "ts") == [(T0 + timedelta(days=30),), (T0 + timedelta(days=31),)]


def alerts_of(spark, tmp_path, batches, keys, **options):
    stream = files(spark, str(tmp_path / "in"), [*batches, [END]])
    hourly = s.stream_sla(stream, "ts", "event_id", keys, {"in_sla": F.col("value") <= 120, "qualified": F.lit(True)}, closed="closed")
    stateful.append_to(stateful.stream_alerts(hourly, keys=keys, **options), str(tmp_path / "alerts"), str(tmp_path / "cp"))
    return spark.read.parquet(str(tmp_path / "alerts"))


@pytest.mark.parametrize("split", [True, False])
def test_alerts_see_the_hour_before_a_gap(spark, tmp_path, split):
    parts = [[(1, T0, "a", 1.0), (9, T0, "b", 1.0), (8, T0, None, 1.0)], [(2, T0 + timedelta(days=20), "a", 500.0)], [(3, T0 + timedelta(days=21), "a", 1.0), (7, T0 + timedelta(days=21), None, 500.0)]]
    got = alerts_of(spark, tmp_path, parts if split else [sum(parts, [])], ["kind"]).filter("handled > 0")
    assert rows(got.filter("kind is not null"), "kind", "ts", "sla_pct", "alert_drop") == [
        ("a", T0, 100.0, False), ("a", T0 + timedelta(days=20), 0.0, True), ("a", T0 + timedelta(days=21), 100.0, False), ("b", T0, 100.0, False)]
    prev = {(r["kind"], r["ts"]): r["prev_sla_pct"] for r in got.collect()}
    assert prev[("a", T0 + timedelta(days=20))] == 100.0 and prev[("b", T0)] is None
    assert prev[(None, T0)] is None and prev[(None, T0 + timedelta(days=21))] == 100.0


def test_silent_keys_are_forgotten(spark, tmp_path):
    # "b" goes on, so time passes; "a" is silent for longer than ten days, then for less
    parts = [[(1, T0, "a", 1.0), (2, T0, "b", 1.0)], [(3, T0 + timedelta(days=30), "b", 1.0)], [(4, T0 + timedelta(days=60), "b", 1.0)],
             [(5, T0 + timedelta(days=61), "a", 1.0)], [(6, T0 + timedelta(days=69), "a", 1.0)], [(7, T0 + timedelta(days=120), "b", 1.0)]]
    got = alerts_of(spark, tmp_path, parts, ["kind"], idle=timedelta(days=10))
    prev = {r["ts"]: r["prev_sla_pct"] for r in got.filter("kind = 'a' and handled > 0").collect()}
    assert prev == {T0: None, T0 + timedelta(days=61): None, T0 + timedelta(days=69): 100.0}


MOVES = "k int, at timestamp_ntz, q int, u int"


def move_files(spark, folder, batches):
    import time

    for i, part in enumerate(batches):
        spark.createDataFrame(part, MOVES).coalesce(1).write.parquet(f"{folder}/f{i}.parquet")
        time.sleep(0.05)
    return spark.readStream.schema(MOVES).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").parquet(folder)


@pytest.mark.parametrize("seed", [1, 2])
def test_stays_equal_the_batch_however_moves_are_dealt(spark, tmp_path, seed):
    from opsgrain.operators.history import compact_changes, to_intervals

    rng = random.Random(seed)
    moves = [(rng.choice([1, 2, 3, None]), T0 + timedelta(hours=rng.randint(0, 900), microseconds=rng.choice([0, 5])), rng.choice([1, 2, 10, None]), rng.choice([5, 9, None])) for _ in range(120)]
    moves += moves[:10]
    # dealt by time with a jitter below the lateness
    order = sorted(moves, key=lambda m: m[1] + timedelta(days=rng.random() * 6))
    cuts = sorted(rng.sample(range(len(order)), 4))
    batches = [order[a:b] for a, b in zip([0, *cuts], [*cuts, len(order)]) if order[a:b]]
    stream = move_files(spark, str(tmp_path / "in"), [*batches, [(-1, T0 + timedelta(days=400), 0, 0)]])
    log = stateful.stream_stays(stream, "k", "at", "q", tie=["q", "u"])
    stateful.append_to(log, str(tmp_path / "log"), str(tmp_path / "cp"))
    got = stateful.stays_of(spark.read.parquet(str(tmp_path / "log")), stream, "n", "until").filter("k > 0")
    plain = to_intervals(compact_changes(spark.createDataFrame(moves, MOVES), "k", "at", "q", tie=["q", "u"]), "k", "at", tie=["q", "u"], number="n", end="until")
    text = lambda df: sorted(str(tuple(r[c] for c in ("k", "n", "at", "q", "u", "until"))) for r in df.collect())
    assert text(got) == text(plain)
    assert plain.count() > 60


def test_keys_share_the_state_of_a_bucket(spark, tmp_path):
    """Python is called once per bucket and batch, not once per key: the state holds some rows per bucket, however many keys there are."""
    from opsgrain.operators.history import compact_changes, to_intervals

    rng = random.Random(3)
    moves = [(k, T0 + timedelta(hours=h + rng.randint(0, 30)), rng.choice([1, 2, None]), rng.choice([5, None])) for h in (0, 240, 480) for k in range(200) for _ in range(2)]
    batches = [moves[i : i + 400] for i in (0, 400, 800)]
    stream = move_files(spark, str(tmp_path / "in"), [*batches, [(-1, T0 + timedelta(days=400), 0, 0)]])
    log = stateful.stream_stays(stream, "k", "at", "q", tie=["q", "u"], buckets=2)
    done = stateful.append_to(log, str(tmp_path / "log"), str(tmp_path / "cp"))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in done.recentProgress if p["stateOperators"]) <= 20
    got = stateful.stays_of(spark.read.parquet(str(tmp_path / "log")), stream, "n", "until").filter("k >= 0")
    plain = to_intervals(compact_changes(spark.createDataFrame(moves, MOVES), "k", "at", "q", tie=["q", "u"]), "k", "at", tie=["q", "u"], number="n", end="until")
    text = lambda df: sorted(str(tuple(r[c] for c in ("k", "n", "at", "q", "u", "until"))) for r in df.collect())
    assert text(got) == text(plain)


def test_a_dealt_table_is_read_once(spark, tmp_path, monkeypatch):
    """The parts of a dealt table are counted and written out of one read, and hold all its rows."""
    from opsgrain.registry import streams

    rows = spark.range(500).selectExpr("id", "if(id % 50 = 0, null, timestampadd(HOUR, cast(id AS int), timestamp_ntz'2024-01-01 00:00:00')) AS ts")
    plans = []
    land = streams._land
    monkeypatch.setattr(streams, "_land", lambda spark, parts, folder: plans.extend(p._jdf.queryExecution().executedPlan().toString() for p in parts) or land(spark, parts, folder))
    streams._dealt(spark, rows, str(tmp_path / "in"), "ts", {"ts": "2025-06-01"})
    assert len(plans) == streams.FILES and all("InMemoryTableScan" in p for p in plans)
    assert sorted(r["id"] for r in spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "in")).filter("id is not null").collect()) == list(range(500))


@pytest.mark.parametrize("split", [True, False])
def test_stream_match_equals_the_scan(spark, tmp_path, split):
    from opsgrain.operators.match import tolerance_scan

    rng = random.Random(4)
    kind = "id int, k int, t timestamp_ntz, v int"
    side = lambda n: [(i, rng.choice([1, 2, None]), T0 + timedelta(minutes=rng.randint(0, 6000)), rng.randint(0, 3)) for i in range(n)]
    left, right = side(60), side(80)
    end = [(-1, 9, T0 + timedelta(days=400), 0)]
    streams = []
    for name, data in (("l", left), ("r", right)):
        data = sorted(data, key=lambda r: r[2])
        parts = [data[: len(data) // 2], data[len(data) // 2 :], end] if split else [data, end]
        for i, part in enumerate(parts):
            spark.createDataFrame(part, kind).coalesce(1).write.parquet(str(tmp_path / name / f"f{i}.parquet"))
        streams.append(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").parquet(str(tmp_path / name)))
    options = {"row_id": "id", "before_seconds": 7200, "after_seconds": 3600, "prefer": F.col("rv") > 1, "tie": ["rid"], "count": "n"}
    named = lambda df: df.select("k", F.col("id").alias("rid"), F.col("t").alias("rt"), F.col("v").alias("rv"))
    cols = {"hit": "rid", "hit_v": "rv"}
    match = stateful.stream_match(streams[0], named(streams[1]), "k", "t", "rt", cols, **options)
    s.run_to_end(match, str(tmp_path / "out"), str(tmp_path / "cp"))
    plain = tolerance_scan(spark.createDataFrame(left, kind), named(spark.createDataFrame(right, kind)), "k", "t", "rt", cols, **options)
    text = lambda df: sorted(str(tuple(r[c] for c in ("id", "hit", "hit_v", "n"))) for r in df.collect())
    assert text(spark.read.parquet(str(tmp_path / "out")).filter("id >= 0")) == text(plain)


def test_a_weighted_row_matches_like_the_rows_it_stands_for(spark, tmp_path):
    """One row per audit entry, with the number of payments of its case, finds and counts what all of them do; state goes to disk, in one store for a join."""
    from opsgrain.operators.match import tolerance_scan
    from opsgrain.plans import payments

    rng = random.Random(6)
    at = lambda: T0 + timedelta(minutes=rng.randint(0, 12000))
    pays = spark.createDataFrame([(i, rng.choice([1, 2, None]), at()) for i in range(40)], "payment_id long, customer_token long, created_at timestamp_ntz")
    number = lambda: rng.choice([None, "none", *[f"case {10000000 + i}" for i in range(6)]])
    logs = [(i % 50, rng.choice([1, 2, None]), at(), "a reimbursement" if i % 7 else "other", number(), f"u{i}") for i in range(70)]
    t = {
        "audit_logs": spark.createDataFrame(logs, "id long, entity_token long, created_at timestamp_ntz, action_name string, comment string, actor_uid string"),
        # a case with two numbers, a number of two cases, a case without an id, one without payments
        "support_cases": spark.createDataFrame([(0, "10000000", "a"), (0, "10000001", "a"), (1, "10000001", "b"), (2, "10000002", None), (None, "10000003", "c"), (5, "10000005", "d")], "case_id long, case_number string, origin string"),
        "case_payments": spark.createDataFrame([(0, 7, "T7"), (0, 3, "T3"), (0, 9, None), (1, 4, "T4"), (1, None, "T5"), (2, None, None), (2, None, None), (None, 8, None)], "case_id long, payment_id long, banking_token string"),
    }
    sides = {"pays": pays, "logs": t["audit_logs"]}
    ends = {"pays": [(-1, 9, T0 + timedelta(days=400))], "logs": [(-1, 9, T0 + timedelta(days=400), "reimburse", None, None)]}
    for name, df in sides.items():
        for i, part in enumerate([df, spark.createDataFrame(ends[name], df.schema)]):
            part.coalesce(1).write.parquet(str(tmp_path / name / str(i)))
    streams = {n: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / n)) for n, df in sides.items()}
    right = payments.weighted_audits({**t, "audit_logs": streams["logs"]}, payments.paid_cases(t))
    match = stateful.stream_match(streams["pays"], right, prefer=payments.audit_preferred(), weight="__weight", **payments.AUDIT_MATCH)
    done = stateful.append_to(match, str(tmp_path / "out"), str(tmp_path / "cp"), stateful.JOINS)
    plain = tolerance_scan(pays, payments.reimbursement_audits(t), prefer=payments.audit_preferred(), **payments.AUDIT_MATCH)
    got = spark.read.parquet(str(tmp_path / "out")).filter("payment_id >= 0")
    text = lambda df: sorted(str(tuple(r[c] for c in sorted(plain.columns))) for r in df.collect())
    assert text(got) == text(plain)
    assert max(r["__n_audit"] for r in plain.collect()) > 10 and payments.paid_cases(t).count() == 6
    assert any("rocksdb" in k.lower() for p in done.recentProgress for o in p["stateOperators"] for k in o["customMetrics"])
    assert spark.conf.get("spark.sql.streaming.join.stateFormatVersion", "2") == "2"
    assert "__rspan" in match._jdf.queryExecution().analyzed().toString()


def test_uncounted_rows(spark, tmp_path):
    batches = [[(1, T0 + timedelta(days=30), "a", 1.0)], [(2, T0 + timedelta(days=31), "a", 1.0)], [(6, T0 + timedelta(days=31), "a", 1.0)], [(3, T0, "a", 1.0), (4, T0, "b", 1.0), (5, T0 + timedelta(days=29), "a", 1.0)], [END]]
    stream = files(spark, str(tmp_path / "in"), batches)
    hourly = s.stream_sla(stream, "ts", "event_id", ["kind"], {"in_sla": F.col("value") <= 120}, rows="rows")
    s.run_to_end(hourly, str(tmp_path / "out"), str(tmp_path / "cp"))
    landed = spark.createDataFrame(sum(batches[:-1], []), SCHEMA)
    late = s.uncounted_rows(landed, "ts", spark.read.parquet(str(tmp_path / "out")), "rows")
    assert rows(late, "ts", "landed", "counted", "late") == [(T0, 2, 0, 2)]


@pytest.mark.parametrize("ds", [None, date(2024, 1, 12)])
@pytest.mark.parametrize("split", [True, False])
def test_reload_does_not_depend_on_the_batches(spark, tmp_path, split, ds):
    parts = [
        [(1, T0, "a", 1.0), (2, T0 + timedelta(days=9), "a", 1.0)],
        [(3, T0 + timedelta(days=8), "a", 1.0), (2, T0 + timedelta(days=9), "a", 1.0), (4, T0, "a", 1.0), (7, None, "a", 1.0)],
        [(5, T0 + timedelta(days=1), "a", 1.0)],
    ]
    stream = files(spark, str(tmp_path / "in"), parts if split else [sum(parts, [])])
    land, facts = str(tmp_path / "land"), str(tmp_path / "facts")
    s.stream_trailing_reload(stream, "ts", "event_id", ["kind"], {"ok": F.col("value") < 5}, land, facts, str(tmp_path / "cp"), ds=ds)
    got = {r["day"].day: r["handled"] for r in spark.read.parquet(facts).collect()}
    assert got == ({9: 1, 10: 1} if ds else {1: 2, 2: 1, 9: 1, 10: 1})
    assert spark.read.parquet(land).count() == 7
    late = {r["day"].day: r["rows"] for r in s.late_rows(spark, land, date(2024, 1, 12)).collect()}
    assert late == {1: 2, 2: 1}


def test_work_folder_follows_the_cluster_setting(spark):
    root = work_folder(spark, "x")
    old = spark.conf.get("spark.checkpoint.dir", None)
    assert root.startswith(old.rstrip("/") + "/x-") if old else "opsgrain-" in root


def test_batches_of_several_files_count_like_single_files(spark, tmp_path, monkeypatch):
    """A batch is as many files as tasks wrote, whatever is in them; a part with too few rows is filled up."""
    from opsgrain.registry import QUERIES, streams

    rows = spark.range(400).selectExpr(
        "id AS event_id", "timestampadd(HOUR, cast(id * 2 AS int), timestamp_ntz'2024-01-01 00:10:00') AS ts", "id % 9 AS user_id",
        "if(id % 2 = 0, 'view', 'click') AS event_type", "cast(id % 200 AS double) AS value", "concat('{\"k\": ', id % 100, '}') AS props",
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    run = lambda: sorted(map(tuple, QUERIES["stream_uncounted_rows"](spark, str(tmp_path)).collect()))
    one = run()
    sizes = []
    land = streams._land
    monkeypatch.setattr(streams, "_land", lambda *a: sizes.append(land(*a)) or sizes[-1])
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 250)
    assert one and run() == one and sizes == [3]
