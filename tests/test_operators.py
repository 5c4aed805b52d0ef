"""Operators on tiny hand-made tables."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsgrain.operators import classify as c
from opsgrain.operators import cover, joins
from opsgrain.operators import history as h
from opsgrain.operators import quality as q
from opsgrain.operators.calendar import calendar_spine, on_spine, relative_intervals
from opsgrain.operators.intervals import available_in_interval, prorate_to_intervals, slots_inside
from opsgrain.operators.joins import asof_dim, contains_join, exclude, fold_join, role_join, seen_before, state_at
from opsgrain.operators.metrics import (
    backlog_flag, confusion_rates, coverage_gap, distinct_counts, mixed_group_rows, share_of_total, side_by_side, threshold_alerts,
    trailing_ratio, with_totals,
)
from opsgrain.registry import rules


def at(text):
    return datetime.fromisoformat(text)


def test_spine_is_gap_free_and_half_open(spark):
    spine = calendar_spine(spark, "2024-02-28", date(2024, 3, 2), "day")
    assert [r["report_date"].day for r in spine.orderBy("interval_start").collect()] == [28, 29, 1]
    halves = calendar_spine(spark, "2024-03-10", "2024-03-11", "30 minutes")
    assert halves.count() == 48
    last = halves.orderBy(F.col("interval_start").desc()).first()
    assert last["interval_end"] == at("2024-03-11 00:00:00")
    months = calendar_spine(spark, "2023-11-01", "2024-03-01", "month")
    assert [r["interval_end"].month for r in months.orderBy("interval_start").collect()] == [12, 1, 2, 3]


def test_empty_interval_keeps_zero_counts(spark):
    facts = spark.createDataFrame([(at("2024-01-01 01:00:00"), 3, 1.5)], "h timestamp_ntz, n long, s double")
    rows = on_spine(calendar_spine(spark, "2024-01-01", "2024-01-01 03:00:00", "hour"), facts, "h", ["n"]).orderBy("interval_start").collect()
    assert [(r["n"], r["s"]) for r in rows] == [(0, None), (3, 1.5), (0, None)]


def test_relative_intervals(spark):
    spine = relative_intervals(calendar_spine(spark, "2024-01-01", "2024-01-03", "hour"), {"day_ago": 24})
    rows = {r["interval_start"]: r["day_ago"] for r in spine.collect()}
    assert rows[at("2024-01-02 05:00:00")] == at("2024-01-01 05:00:00") and rows[at("2024-01-01 05:00:00")] is None


def test_valid_version_by_day_or_by_instant(spark):
    fact = spark.createDataFrame([(1, 7, at("2024-01-31 15:00:00")), (2, None, at("2024-01-31 15:00:00"))], "id int, k int, t timestamp_ntz")
    dim = spark.createDataFrame(
        [(7, date(2024, 1, 1), date(2024, 1, 31), "a"), (7, date(2024, 1, 20), date(2024, 2, 9), "b")], "k int, start_date date, end_date date, city string"
    )
    by_day = asof_dim(fact, dim, "k", "t", {"city": "city"})
    assert sorted((r["id"], r["city"]) for r in by_day.filter("id = 1").collect()) == [(1, "a"), (1, "b")]
    by_instant = asof_dim(fact, dim, "k", "t", {"city": "city"}, by_date=False)
    assert [(r["id"], r["city"]) for r in by_instant.orderBy("id").collect()] == [(1, "b"), (2, None)]
    assert asof_dim(fact, dim, "k", "t", {"city": "city"}, how="inner").filter("id = 2").count() == 0


def test_join_shapes(spark):
    left = spark.createDataFrame([(1, "Queue A"), (2, "queue b"), (3, None)], "id int, q string")
    cat = spark.createDataFrame([("QUEUE A", "x")], "q string, team string")
    assert {r["id"]: r["team"] for r in fold_join(left, cat, "q", "q").collect()} == {1: "x", 2: None, 3: None}
    assert sorted(r["id"] for r in exclude(left, left.filter("id = 2"), ["id"]).collect()) == [1, 3]
    users = spark.createDataFrame([(1, "ann"), (2, "bob")], "uid int, name string")
    roles = role_join(role_join(spark.createDataFrame([(1, 2)], "made int, edited int"), users, "made", "uid", "m", ["name"]), users, "edited", "uid", "e", ["name"])
    assert tuple(roles.select("m_name", "e_name").first()) == ("ann", "bob")


def test_contains_join_is_closed_and_hashes(spark):
    points = spark.createDataFrame([(at("2024-01-01 00:30:00"),), (at("2024-01-01 02:00:00"),), (at("2024-01-01 05:00:00"),)], "p timestamp_ntz")
    spans = spark.createDataFrame(
        [(1, at("2024-01-01 00:30:00"), at("2024-01-01 02:00:00")), (2, at("2024-01-01 03:00:00"), at("2024-01-01 01:00:00")), (3, None, at("2024-01-01 01:00:00"))],
        "id int, s timestamp_ntz, e timestamp_ntz",
    )
    joined = contains_join(points, spans, "p", "s", "e", minutes=30, how="left")
    assert sorted((r["p"].hour, r["id"]) for r in joined.filter("id is not null").collect()) == [(0, 1), (2, 1)]
    assert joined.count() == 3
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()


def test_contains_join_of_long_and_open_intervals(spark):
    points = spark.createDataFrame([("a", at("2024-01-01 00:10:00")), ("a", at("2023-06-01 00:00:00")), ("b", at("2024-01-01 00:10:00")), (None, at("2024-01-01 00:10:00"))], "k string, p timestamp_ntz")
    spans = spark.createDataFrame(
        [("a", 1, at("2014-01-01 00:00:00"), at("2024-01-01 00:10:00")), ("a", 2, at("2024-01-01 00:10:01"), at("2024-01-01 00:20:00")),
         ("a", 3, at("2020-01-01 00:00:00"), at("9999-12-31 00:00:00")), ("b", 4, at("1960-01-01 00:00:00"), at("2024-01-01 00:10:00"))],
        "k string, id int, s timestamp_ntz, e timestamp_ntz",
    )
    for how, more in (("inner", []), ("left", [(None, at("2024-01-01 00:10:00"), None)])):
        joined = contains_join(points, spans, "p", "s", "e", minutes=30, keys=["k"], how=how)
        got = {(r["k"], r["p"], r["id"]) for r in joined.collect()}
        assert got == {("a", at("2024-01-01 00:10:00"), 1), ("a", at("2024-01-01 00:10:00"), 3), ("a", at("2023-06-01 00:00:00"), 1),
                       ("a", at("2023-06-01 00:00:00"), 3), ("b", at("2024-01-01 00:10:00"), 4), *more}
    rows = cover.with_cover(spans.withColumn("years", F.col("e") < at("2025-01-01 00:00:00")), cover.slice_tick("s", 30), cover.slice_tick("e", 30))
    assert {r["id"]: r["count"] for r in rows.groupBy("id").count().collect()}[1] < 50


def test_cover_is_the_interval(spark):
    rng = random.Random(1)
    rows = [(i, a, a + rng.choice([0, 1, 3, 17, 300, 175_320, 10**9])) for i in range(500) for a in [rng.randint(-(10**6), 10**6)]]
    held = cover.with_cover(spark.createDataFrame([*rows, (900, 5, 4), (901, None, 4)], "id int, a bigint, b bigint"), F.col("a"), F.col("b"))
    found = held.groupBy("id").agg(F.collect_list(F.struct("__rung", "__node")).alias("nodes")).collect()
    assert len(found) == 500
    for r in found:
        spans = sorted((node * 4**rung, (node + 1) * 4**rung) for rung, node in r["nodes"])
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:])) and (r["id"], spans[0][0], spans[-1][1] - 1) in rows
        if spans[-1][1] - spans[0][0] == 175_321:  # ten years of half hours
            assert len(spans) < 50


@pytest.mark.parametrize("by_date", [True, False])
def test_valid_version_beyond_the_broadcast(spark, by_date, monkeypatch):
    """Equal to the join on the key, without one in the plan; overlapping, open, reversed and null versions included."""
    rng = random.Random(3)
    day = lambda: date(2020, 1, 1) + timedelta(days=rng.randint(0, 2000))
    dim = [(rng.choice([1, 2, 3, None]), day(), rng.choice([day(), date(9999, 12, 31), None]), f"v{i}") for i in range(60)]
    midnight = lambda d: datetime(d.year, d.month, d.day, rng.choice([0, 0, 7]))
    fact = [(i, rng.choice([1, 2, 3, 4, None]), rng.choice([midnight(day()), None])) for i in range(300)]
    fact, dim = spark.createDataFrame(fact, "id int, k int, t timestamp_ntz"), spark.createDataFrame(dim, "k int, start_date date, end_date date, city string")
    for how in ("left", "inner"):
        small = asof_dim(fact, dim, "k", "t", {"city": "city"}, by_date=by_date, how=how)
        monkeypatch.setattr(joins, "broadcast_size", lambda df: False)
        large = asof_dim(fact, dim, "k", "t", {"city": "city"}, by_date=by_date, how=how)
        monkeypatch.undo()
        assert sorted(map(tuple, small.collect()), key=lambda r: (r[0], r[3] or "")) == sorted(map(tuple, large.collect()), key=lambda r: (r[0], r[3] or ""))
        plan = large._jdf.queryExecution().optimizedPlan().toString()
        assert all("<=" not in line and ">=" not in line for line in plan.splitlines() if "Join" in line)


def test_slots_inside_spans(spark):
    spans = spark.createDataFrame(
        [(1, at("2024-01-01 23:30:00"), at("2024-01-02 00:30:00")), (2, at("2024-01-02 00:01:00"), at("2024-01-02 00:29:00")), (3, at("2024-01-02 23:10:00"), at("9999-12-31 00:00:00")),
         (4, at("2024-01-03 00:00:00"), at("2024-01-03 09:00:00")), (5, at("2024-01-02 05:00:00"), at("2024-01-02 04:00:00")), (6, None, at("2024-01-02 04:00:00"))],
        "id int, s timestamp_ntz, e timestamp_ntz",
    )
    out = slots_inside(spans, "s", "e", "2024-01-02", "2024-01-03")
    assert sorted((r["id"], f"{r['interval_start']:%d %H:%M}", f"{r['interval_end']:%d %H:%M}") for r in out.collect()) == [
        (1, "02 00:00", "02 00:30"), (1, "02 00:30", "02 01:00"), (3, "02 23:30", "03 00:00")]


def test_state_and_first_seen(spark):
    sent = spark.createDataFrame([("c1", at("2024-01-02 00:00:00")), ("c2", at("2024-01-02 00:00:00"))], "case_id string, sent timestamp_ntz")
    log = spark.createDataFrame(
        [("c1", "a", at("2024-01-01 00:00:00")), ("c1", "b", at("2024-01-02 00:00:00")), ("c1", "c", at("2024-01-02 00:00:01"))],
        "case_id string, v string, t timestamp_ntz",
    )
    assert [tuple(r) for r in state_at(sent, log, "case_id", "sent", "t", {"v": "v"}).select("case_id", "v").collect()] == [("c1", "b")]
    out = seen_before(
        spark.createDataFrame([("k", 5), ("k", 2), (None, 9)], "k string, d int"), spark.createDataFrame([("k", 3), ("k", 8)], "k string, e int"), "k", "d", "e", "f"
    )
    assert sorted((r["d"], r["f"]) for r in out.collect()) == [(2, False), (5, True), (9, False)]


def test_distinct_counts_of_fanned_out_rows(spark):
    df = spark.createDataFrame(
        [("g", 1, True, 10), ("g", 1, False, 10), ("g", 2, None, None), ("g", None, True, 5), ("h", None, True, None)], "g string, id int, ok boolean, v int"
    )
    rows = {
        r["g"]: tuple(r)[1:]
        for r in distinct_counts(df, ["g"], "id", {"n": None, "ok_n": F.col("ok")}, sums={"s": F.col("v")}, avgs={"a": F.col("v")}).collect()
    }
    assert rows == {"g": (2, 1, 25, 25 / 3), "h": (0, 0, None, None)}
    assert distinct_counts(df.filter("false"), [], "id", {"n": None}).first()["n"] == 0


def test_backlog_and_alerts(spark):
    df = spark.createDataFrame([("2024-01-02", "2024-01-01", True), ("2024-01-01", "2024-01-01", False), ("2024-01-01", "2024-01-01", True), ("2024-01-01", "2024-01-01", None)], "a string, s string, h boolean")
    assert [r[0] for r in df.select(backlog_flag("a", "s", "h")).collect()] == [True, True, False, None]
    pct = spark.createDataFrame([(1, 50.0, 5), (2, 40.0, 20000), (3, None, None), (4, 24.0, 1)], "t int, pct double, n int")
    rows = threshold_alerts(pct, "t", "pct", "n").orderBy("t").collect()
    assert [(r["alert_drop"], r["alert_volume"], r["alert_floor"]) for r in rows] == [
        (False, False, False), (True, True, False), (False, False, False), (False, False, True)
    ]


def test_rates(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 1, 0), (3, 0, 1), (4, 0, 0), (5, None, 1)], "id int, t int, p int")
    plain = confusion_rates(df, [], F.col("t"), F.col("p")).first()
    by_id = confusion_rates(df, [], F.col("t"), F.col("p"), "id").first()
    assert (plain["tp"], plain["fn"], plain["fp"]) == (2, 1, 1) and (by_id["tp"], by_id["recall"]) == (1, 0.5)
    none = confusion_rates(df.filter("id = 4"), [], F.col("t"), F.col("p")).first()
    assert none["recall"] is None and none["precision"] is None
    months = spark.createDataFrame([(1, 1, 2), (2, 0, 0), (3, 3, 4), (4, 5, 6)], "m int, a int, b int")
    assert [r["r"] for r in trailing_ratio(months, "a", "b", "m", "r").orderBy("m").collect()] == [0.5, 0.5, 4 / 6, 8 / 10]


def test_totals_and_shares(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 3), (None, "x", 5)], "k string, c string, v int")
    assert sorted((r["v"], r["s"]) for r in with_totals(df, ["k"], {"s": ("sum", F.col("v"))}).collect()) == [(1, 4), (3, 4), (5, 5)]
    assert sorted((r["part_sum"], r["share_pct"]) for r in share_of_total(df, ["k", "c"], ["k"], "v").collect()) == [(1, 25.0), (3, 75.0), (5, 100.0)]
    kinds = spark.createDataFrame([("d", "a", True), ("d", "a", None), ("d", "b", True)], "d string, a string, kind boolean")
    assert mixed_group_rows(kinds, ["d", "a"], "kind").count() == 2
    one_row = side_by_side(df.agg(F.sum("v").alias("x")), df.agg(F.count("k").alias("y"))).first()
    assert tuple(one_row) == (9, 2)


def test_coverage_gap(spark):
    left = spark.createDataFrame([(1, "w"), (2, "w"), (2, "w"), (3, "w")], "id int, week string")
    right = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    row = coverage_gap(left, right, "id", F.col("week"), "wk").first()
    assert tuple(row) == ("w", 2, 3, "67%")


def test_queue_stays(spark):
    log = spark.createDataFrame(
        [("c", "A", 0), ("c", "A", 5), ("c", "B", 10), ("c", "A", 3000), ("d", "B", 1)], "case string, q string, m int"
    ).withColumn("t", F.timestamp_add("MINUTE", F.col("m"), F.lit("2024-01-01").cast("timestamp_ntz")))
    stays = h.to_intervals(h.compact_changes(log, "case", "t", "q"), "case", "t")
    rows = [(r["case"], r["q"], r["seq"], r["end_time"]) for r in stays.orderBy("case", "seq").collect()]
    assert [r[:3] for r in rows] == [("c", "A", 1), ("c", "B", 2), ("c", "A", 3), ("d", "B", 1)]
    assert rows[0][3] == at("2024-01-01 00:09:59") and rows[2][3] is None
    paths = sorted(tuple(r) for r in h.path_steps(stays, "case", "seq", "q").collect())
    assert paths == [("c", 1, "A", 0, 2, False), ("c", 2, "B", 1, 1, False), ("c", 3, "A", 2, 0, True), ("d", 1, "B", 0, 0, True)]
    total = h.elapsed_until(stays.withColumn("d", F.col("seq") * 10), "case", "t", "d").orderBy("case", "seq").collect()
    assert [r["elapsed_before"] for r in total] == [0, 10, 30, 0]


def test_transition_rules(spark):
    rows = [
        (1, None, None, "CS", "X", "FIRST QUEUE"), (2, "CS", "AUTO", "CS", "X", "OMNI"), (2, "CS", "A", "CS", "B", "INTERNAL TRANSFER"),
        (2, "RISK", "A", "RISK", "A", "INTERNAL TRANSFER"), (2, "RISK", "A", "RISK", "B", "EXTERNAL TRANSFER"),
        (2, "RISK", "ATO 1", "CS", "LOCK 2", "INTERNAL TRANSFER"), (2, "CS", "A", "RISK", "B", "EXTERNAL TRANSFER"),
    ]
    df = spark.createDataFrame(rows, "seq int, pk string, pn string, kind string, name string, want string")
    _, got = h.transition_type("kind", "name", F.col("pk"), F.col("pn"), F.col("seq"), auto_response="AUTO")
    assert df.filter(got != F.col("want")).count() == 0 and df.select(got.alias("g")).filter("g is null").count() == 0


def test_versions_and_lineage(spark):
    v = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d")], "k int, v int, x string")
    assert sorted(r["x"] for r in h.latest_version(v, ["k"], "v").collect()) == ["b", "c"]
    text = spark.createDataFrame([(1, '["a.b.c", "d.e.f", "a.b.c"]'), (2, "[]"), (3, None)], "j int, s string")
    rows = h.explode_lineage(text, "s", ["j"]).collect()
    assert sorted((r["j"], r["source_database_name"], r["source_table_name"]) for r in rows) == [(1, "a", "c"), (1, "d", "f")]


def test_pick_row_null_order_is_planned_as_group_limit(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", True, 2), ("k", False, 3)], "k string, good boolean, t int")
    best = h.pick_row(df, ["k"], [F.col("good").desc_nulls_first(), F.col("t")])
    assert best.first()["t"] == 1
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


SPANS = [
    ("one", "2024-01-01 10:05:00", "2024-01-01 10:20:00"), ("two", "2024-01-01 10:20:00", "2024-01-01 10:40:00"),
    ("five", "2024-01-01 10:10:00", "2024-01-01 12:10:00"), ("zero", "2024-01-01 10:30:00", "2024-01-01 10:30:00"),
    ("edge", "2024-01-01 10:00:00", "2024-01-01 10:30:00"), ("back", "2024-01-01 11:00:00", "2024-01-01 10:00:00"), ("open", "2024-01-01 11:00:00", None),
]


def test_proration(spark):
    df = spark.createDataFrame([(n, at(s), at(e) if e else None) for n, s, e in SPANS], "n string, s timestamp_ntz, e timestamp_ntz")
    got = prorate_to_intervals(df, "s", "e").groupBy("n").agg(F.count(F.lit(1)).alias("k"), F.sum("interval_seconds").alias("t")).collect()
    assert {r["n"]: (r["k"], r["t"]) for r in got} == {"one": (1, 900), "two": (2, 1200), "five": (5, 7200), "zero": (1, 0), "edge": (1, 1800)}
    compat = prorate_to_intervals(df.filter("n in ('five', 'edge')"), "s", "e", compat=True).groupBy("n").agg(F.sum("interval_seconds").alias("t"), F.count(F.lit(1)).alias("k"))
    # the old rule counts the middle of a long span up to its end, and touching intervals
    assert {r["n"]: (r["t"], r["k"]) for r in compat.collect()} == {"five": (1200 + 6000 + 4200 + 2400 + 600, 5), "edge": (1800, 3)}


def test_available_minutes(spark):
    i, e = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"), F.lit("2024-01-01 10:30:00").cast("timestamp_ntz")
    short, long = F.lit("2024-01-01 10:12:30").cast("timestamp_ntz"), F.lit("2024-01-01 11:00:00").cast("timestamp_ntz")
    row = spark.range(1).select(available_in_interval(i, e, short), available_in_interval(i, e, long), available_in_interval(i, e, e)).first()
    assert tuple(row) == (12, 30, 30)


def test_rules(spark):
    df = spark.createDataFrame([("US Banking", "Chat"), ("risk ato", "x"), ("none", "Chat"), ("none", None), (None, "Apparel"), ("none", "Email")], "q string, o string")
    got = [r[0] for r in df.select(c.classify("q", rules.QUEUES, c.origin_default("o"))).collect()]
    assert got == ["Banking", "ATO", "Messaging", "Messaging", "Apparel", "Email"]
    queues = spark.createDataFrame([("RDC_RETURNS_RARS",), ("rdc_returns_rars",), ("my_ATO_q",), ("x_idv",)], "q string")
    assert [r[0] for r in queues.select(c.classify("q", rules.assignments("Fraud"))).collect()] == [None, "Remote Deposit Capture", "ATO", "AR"]
    waits = spark.createDataFrame([(0,), (5,), (60,), (61,), (-1,), (None,)], "w int")
    assert [r[0] for r in waits.select(c.bucketize("w", c.WAIT_RANGES)).collect()] == ["00-5 secs", "00-5 secs", "56-60 secs", "60+ secs", None, None]


def test_incidents_and_unions(spark):
    df = spark.createDataFrame([(1, at("2024-01-01 10:00:00")), (2, at("2024-01-01 12:00:00")), (3, None)], "id int, t timestamp_ntz")
    rows = c.incident_windows(df, "t", [("a", "2024-01-01 09:00:00", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:00:00", "2024-01-01 11:00:00")]).collect()
    assert [(r["id"], r["incident_label"], r["incident_end"]) for r in rows] == [(1, "a", at("2024-01-01 10:00:00"))]
    a, b = spark.createDataFrame([(1, "x")], "k int, s string"), spark.createDataFrame([(1,), (1,)], "k int")
    schema = {"k": "bigint", "s": "string"}
    assert c.conformed_union([a, b], schema).count() == 3 and c.union_distinct([a, b], schema).count() == 2


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "b")], "k int, v string")
    assert tuple(q.key_uniqueness(df, ["k"]).first()) == (3, 2)
    assert q.duplicates(df, ["k"]).count() == 2
    assert {r["side"]: r["orphans"] for r in q.orphans(df, spark.createDataFrame([(2,), (9,)], "k int"), "k").collect()} == {"left": 1, "right": 1}
    assert q.null_rows(df, "k", "v").count() == 2
    assert {r["v"] for r in q.accepted_values(df, "v", ["a"]).collect()} == {None, "b"}
    rec = q.reconcile(df.filter("k = 1").distinct().withColumn("m", F.lit(5)), spark.createDataFrame([(1, 3), (2, 1)], "k int, m int"), ["k"], ["m"])
    assert sorted((r["k"], r["found_in"], r["m_diff"]) for r in rec.collect()) == [(1, "both", 2), (2, "only_b", None)]
    total = q.grand_total_check(spark.createDataFrame([(1,), (2,)], "n int"), spark.createDataFrame([(3,)], "n int"), ["n"]).first()
    assert total["matches"] is True


def test_pairs_of_key_and_day_are_not_repeated_per_rung(spark, monkeypatch):
    """Only the stretches in use ask every rung for covers; the days, of which there are far more, are shuffled once."""
    monkeypatch.setattr(joins, "broadcast_size", lambda df: False)
    fact = spark.createDataFrame([(i, 7, at("2024-01-31 15:00:00") + timedelta(days=i)) for i in range(700)], "id int, k int, t timestamp_ntz")
    dim = spark.createDataFrame(
        [(7, date(2024, 1, 1), date(2024, 12, 31), "a"), (7, date(2025, 1, 1), date(9999, 12, 31), "b")], "k int, start_date date, end_date date, city string"
    )
    out = asof_dim(fact, dim, "k", "t", {"city": "city"})
    assert [(r["city"], r["count"]) for r in out.groupBy("city").count().orderBy("city").collect()] == [("a", 336), ("b", 364)]
    # a folded list of rungs; a plain scan of the plan's text, as its rows are few here
    plan = out._jdf.queryExecution().optimizedPlan().toString().replace(" ", "")
    assert "0,1,2,3,4,5,6,7,8,9,10,11" not in plan and "sequence(0,11" not in plan and plan.count("__stretch") > 0


def test_dimension_is_sized_unpacked(spark, tmp_path):
    """A file below the broadcast limit whose rows in memory are far above it is not broadcast; a small one is."""
    users = spark.range(400_000).select(F.col("id").alias("u"), F.concat(F.lit("user "), F.col("id").cast("string")).alias("name"))
    users.write.parquet(str(tmp_path / "users"))
    users = spark.read.parquet(str(tmp_path / "users"))
    few = spark.createDataFrame([(1, 5)], "id int, user_id bigint")
    for dim, shape in ((users, "SortMergeJoin"), (users.filter("u < 3").localCheckpoint(), "")):
        out = few.join(joins.dim_side(dim), F.col("user_id") == F.col("u"), "left")
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert shape in plan and not (shape and "Build" + "Right" in plan) and out.count() == 1
