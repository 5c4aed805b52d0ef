"""The chunked scan against plain windows and brute force, with a hot key and NULLs."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from opsgrain.operators.match import match_with_tolerance, nearest_related
from opsgrain.operators.ordered import asof_lookup, ordered, time_chunk
from opsgrain.operators.percentiles import exact_percentiles, sliced

T0 = datetime(2024, 1, 1)


def rows(seed, n=600):
    """A third of the rows share one key; some keys, times and values are NULL."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        at = None if rnd.random() < 0.03 else T0 + timedelta(minutes=rnd.randrange(0, 12 * 1440, 7))
        out.append((i, key, at, None if rnd.random() < 0.3 else rnd.randrange(100)))
    return out


@pytest.mark.parametrize("step", ["hour", "day", "month"])
def test_same_as_plain_window(spark, step):
    df = spark.createDataFrame(rows(1), "id long, key string, at timestamp_ntz, v long")
    got = ordered(
        df, ["key"], ["at", "id"], time_chunk("at", step), lag={"prev": F.col("id")}, lead={"nxt": F.col("id")},
        last_seen={"seen": F.col("v")}, next_seen={"coming": F.col("v")}, running={"run": F.col("v")}, number="rn",
    )
    w = Window.partitionBy("key").orderBy(F.col("at").asc_nulls_first(), "id")
    whole = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns(
        {
            "prev": F.lag("id").over(w), "nxt": F.lead("id").over(w), "seen": F.last("v", True).over(whole),
            "coming": F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)), "run": F.sum("v").over(whole),
            "rn": F.row_number().over(w).cast("bigint"),
        }
    )
    cols = ["id", "prev", "nxt", "seen", "coming", "run", "rn"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()), key=lambda r: r[0])


def test_no_key_and_date_order(spark):
    df = spark.createDataFrame([(i, (T0 + timedelta(days=i % 5)).date()) for i in range(20)], "id long, d date")
    got = ordered(df, [], ["d", "id"], time_chunk("d", "day"), number="rn")
    expected = {r: n + 1 for n, r in enumerate(sorted(range(20), key=lambda i: (i % 5, i)))}
    assert {r["id"]: r["rn"] for r in got.collect()} == expected


def test_input_is_read_and_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows(2), "id long, key string, at timestamp_ntz, v long").write.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.read.parquet(path)
        got = ordered(df, ["key"], ["at", "id"], time_chunk("at"), lag={"prev": F.col("id")}).select("id", "prev")
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ReusedExchange" in plan
    assert plan.count("FileScan") == 1


def test_hot_key_is_spread_over_tasks(spark):
    """All rows share one key; no window partition sees more than a day of them."""
    n_days, per_day = 40, 50
    df = spark.range(n_days * per_day).select(
        F.lit("hot").alias("key"), F.col("id"),
        F.timestamp_add("HOUR", (F.col("id") % (n_days * 24)).cast("int"), F.lit(T0).cast("timestamp_ntz")).alias("at"),
    )
    chunks = df.groupBy("key", time_chunk("at")).count()
    assert chunks.agg(F.max("count")).first()[0] <= 3 * per_day
    got = ordered(df, ["key"], ["at", "id"], time_chunk("at"), number="rn")
    assert got.agg(F.max("rn"), F.countDistinct("rn")).first()[:] == (n_days * per_day, n_days * per_day)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("within", [None, 7200])
def test_asof_against_brute_force(spark, direction, within):
    rnd = random.Random(5)
    left = [(i, rnd.choice(["hot", "hot", "a", None]), T0 + timedelta(minutes=rnd.randrange(0, 5000))) for i in range(150)]
    left.append((999, "a", None))
    right = [(i, rnd.choice(["hot", "a", None]), T0 + timedelta(minutes=rnd.randrange(0, 5000))) for i in range(120)]
    right += [(500 + i, k, t) for i, (_, k, t) in enumerate(left[:20])]
    ldf = spark.createDataFrame(left, "id long, key string, at timestamp_ntz")
    rdf = spark.createDataFrame(right, "rid long, key string, rat timestamp_ntz")
    got = asof_lookup(ldf, rdf, ["key"], "at", "rat", {"hit": "rid"}, tie=["rid"], direction=direction, within_seconds=within)
    want = {}
    for i, k, t in left:
        ok = [
            (rt, rid) for rid, rk, rt in right
            if k is not None and t is not None and rk == k and (rt <= t if direction == "backward" else rt >= t)
            and (within is None or abs((rt - t).total_seconds()) <= within)
        ]
        pick = (max(ok) if direction == "backward" else min(ok)) if ok else None
        want[i] = pick and pick[1]
    assert {r["id"]: r["hit"] for r in got.collect()} == want


def test_tolerance_match_against_brute_force(spark):
    rnd = random.Random(9)
    left = [(i, "hot" if i % 3 else rnd.choice(["a", None]), T0 + timedelta(seconds=rnd.randrange(0, 400_000))) for i in range(200)]
    right = [(i, rnd.choice(["hot", "a"]), T0 + timedelta(seconds=rnd.randrange(0, 400_000)), rnd.random() < 0.4) for i in range(200)]
    right += [(1000 + i, k, t + timedelta(days=1), None) for i, (_, k, t) in enumerate(left[:30]) if k]
    ldf = spark.createDataFrame(left, "id long, key string, at timestamp_ntz")
    rdf = spark.createDataFrame(right, "rid long, key string, rat timestamp_ntz, good boolean")
    got = match_with_tolerance(
        ldf, rdf, "key", "at", "rat", {"hit": "rid"}, row_id="id", before_seconds=40_000, after_seconds=86_400, prefer=F.col("good"),
        tie=["rid"], count="n",
    )
    want = {}
    for i, k, t in left:
        ok = [
            (0 if g else 1, rt, rid) for rid, rk, rt, g in right
            if k is not None and rk == k and -40_000 <= (rt - t).total_seconds() <= 86_400
        ]
        want[i] = (min(ok)[2] if ok else None, len(ok) if k else None)
    assert {r["id"]: (r["hit"], r["n"]) for r in got.collect()} == want


@pytest.mark.parametrize("relation", ["any", "same", "different"])
def test_nearest_against_brute_force(spark, relation):
    rnd = random.Random(3)
    data = [
        (i, "hot" if i % 3 else rnd.choice(["a", "b"]), T0 + timedelta(hours=rnd.randrange(0, 900)), rnd.choice(["x", "x", "y", None]))
        for i in range(160)
    ]
    df = spark.createDataFrame(data, "id long, key string, at timestamp_ntz, tag string")
    got = {r["id"]: r[f"{relation}_days"] for r in nearest_related(df, "key", "id", "at", "tag", relation).collect()}
    for i, k, t, tag in data:
        near = [
            abs((o.date() - t.date()).days) for j, ok, o, ot in data
            if j != i and ok == k and (relation == "any" or (tag and ot and (tag == ot) == (relation == "same")))
        ]
        assert (abs(got[i]) if got[i] is not None else None) == (min(near) if near else None)


def test_percentiles_of_a_hot_group(spark):
    rnd = random.Random(4)
    data = [("hot", float(rnd.randrange(1000))) for _ in range(500)] + [("one", 7.0), (None, 1.0), (None, 2.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: (r["p50"], r["p95"]) for r in exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95}).collect()}
    want = {
        r["g"]: (r["a"], r["b"])
        for r in df.filter("v is not null").groupBy("g").agg(F.percentile("v", 0.5).alias("a"), F.percentile("v", 0.95).alias("b")).collect()
    }
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g])


def test_slices_of_a_heavy_tail_are_even(spark):
    """Log-normal values and one far outlier: no slice holds a large share, and the percentiles are exact."""
    df = spark.range(60_000).select(F.exp(F.randn(3) * 3).alias("v")).unionByName(spark.range(1).select(F.lit(3e9).alias("v")))
    df = spark.createDataFrame(df.toPandas())
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("c")).withColumn("g", F.lit(1))
    sizes = [r["count"] for r in sliced(counts, ["g"], "v", "c").groupBy("__piece").count().collect()]
    assert max(sizes) < 0.01 * sum(sizes) and len(sizes) > 200
    got = exact_percentiles(df, [], "v", {"a": 0.5, "b": 0.999}).first()
    want = df.agg(F.percentile("v", 0.5), F.percentile("v", 0.999)).first()
    assert tuple(got) == pytest.approx(tuple(want))


def test_totals_spread_a_hot_key_and_build_the_input_once(spark, tmp_path):
    from opsgrain.operators.metrics import percent_of_total, with_totals

    data = [("hot", i) for i in range(500)] + [("a", 1), ("a", None), (None, 5), (None, 6)]
    spark.createDataFrame(data, "k string, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = with_totals(df, ["k"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "n": ("count", F.col("v")), "l": ("min", F.col("v"))})
    got = {r["k"]: (r["s"], r["m"], r["n"], r["l"]) for r in out.collect()}
    assert got == {"hot": (sum(range(500)), 499, 500, 0), "a": (1, 1, 1, 1), None: (11, 6, 2, 5)} and out.count() == len(data)
    twice = with_totals(with_totals(df, ["k"], {"s": ("sum", F.col("v"))}), ["v"], {"n": ("count", F.lit(1))})
    for frame, scans in ((out, 1), (twice, 1), (percent_of_total(df, "v", "p"), 1)):
        assert scans_after_run(frame) == scans
    assert sum(r["p"] for r in percent_of_total(df, "v", "p").collect() if r["p"] is not None) == pytest.approx(1)


def scans_after_run(df):
    """Scans that ran: those below a reused exchange did not."""
    df._jdf.queryExecution().executedPlan()
    rows = df.collect()
    assert rows is not None
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"FileScan parquet", final))


def test_rows_that_cannot_match_are_spread(spark):
    """Nine tenths of the left rows have no key: the scan keeps them apart, and the result is that of the plain lookup."""
    rnd = random.Random(9)
    left = [(i, rnd.choice([None] * 9 + [1]), rnd.choice([None, rnd.randrange(90_000)])) for i in range(4000)]
    right = [(1, s, s) for s in range(0, 90_000, 700)] + [(None, 5, 5)]
    stamp = F.timestamp_add("SECOND", F.col("s"), F.lit("2024-01-01").cast("timestamp_ntz"))
    a = spark.createDataFrame(left, "i int, k int, s int").withColumn("t", stamp)
    b = spark.createDataFrame(right, "k int, s int, v int").withColumn("at", stamp).drop("s")
    out = asof_lookup(a, b, ["k"], "t", "at", {"v": "v"})
    got = {r["i"]: r["v"] for r in out.collect()}
    assert got == {i: s // 700 * 700 if k is not None and s is not None else None for i, k, s in left}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(xxhash64" in plan
