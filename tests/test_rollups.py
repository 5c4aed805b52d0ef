"""Facts that add up, and checks counted while rows pass."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsgrain.operators import quality as q
from opsgrain.operators import rollups
from opsgrain.sources import versions

T0 = datetime(2024, 1, 1)


def test_dense_ids_keep_their_numbers(spark):
    rows = [("a", T0), ("b", T0 + timedelta(hours=5)), ("a", T0 + timedelta(days=3)), (None, T0), ("c", T0 + timedelta(days=40)), ("d", T0)]
    df = spark.createDataFrame(rows, "id string, t timestamp_ntz")
    first = rollups.dense_ids(df, "id", "t")
    assert {r["id"]: r["num"] for r in first.collect()} == {"a": 0, "d": 1, "b": 2, "c": 3}
    more = spark.createDataFrame([("z", T0), ("a", T0), ("y", T0 + timedelta(days=1))], "id string, t timestamp_ntz")
    again = rollups.dense_ids(more, "id", "t", known=first)
    assert {r["id"]: r["num"] for r in again.collect()} == {"a": 0, "d": 1, "b": 2, "c": 3, "z": 4, "y": 5}
    assert rollups.dense_ids(df.limit(0), "id", "t").count() == 0
    assert {r["num"] for r in rollups.dense_ids(more, "id", "t", known=first.limit(0)).collect()} == {0, 1, 2}


def test_bitmaps_of_hours_make_those_of_days(spark):
    rng = random.Random(2)
    # numbers over several ranges, and their borders
    pool = [0, 1, 32767, 32768, 65535, 65536, *(rng.randrange(200_000) for _ in range(300))]
    rows = [(T0 + timedelta(hours=rng.randrange(72)), rng.choice("ab"), rng.choice([*pool, None]), rng.random() < 0.3) for _ in range(3000)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, k string, num bigint, hit boolean")
    flags = {"ids": None, "hits": F.col("hit")}
    hours = rollups.id_bitmaps(df, ["t", "k"], "num", flags)
    got = rollups.rolled_counts(hours, [F.to_date("t").alias("day"), "k"], list(flags))
    want = df.groupBy(F.to_date("t").alias("day"), "k").agg(F.count_distinct("num").alias("ids"), F.count_distinct(F.when(F.col("hit"), F.col("num"))).alias("hits"))
    key = lambda d: sorted((str(r["day"]), r["k"], r["ids"], r["hits"]) for r in d.collect())
    assert key(got) == key(want)
    # the rows behind the hours are not read again
    assert rollups.merge_bitmaps(hours.limit(0), ["k"], list(flags)).count() == 0


def test_sketches_merge_within_their_error(spark):
    value = F.exp(F.randn(3) * 2)
    df = spark.range(0, 300_000, 1, 8).select((F.col("id") % 31).cast("int").alias("day"), F.when(F.col("id") % 50 != 0, value).alias("v"))
    df = spark.createDataFrame(df.toPandas())  # random once
    days = rollups.sketches(df, ["day"], "v")
    points = {f"p{i}": i / 100 for i in (1, 5, 25, 50, 75, 95, 99)}
    for held, rows in ((rollups.merge_sketches(days, [F.lit("all").alias("of")]), df), (days.filter("day = 7"), df.filter("day = 7"))):
        got = rollups.sketch_percentiles(held, points).first()
        values = rows.filter("v is not null and not isnan(v)")
        n = values.count()
        assert got["n"] == n
        ranks = values.agg(*[(F.count_if(F.col("v") <= got[p]) / n).alias(p) for p in points]).first()
        worst = max(abs(ranks[p] - at) for p, at in points.items())
        print("rank error", worst)
        assert worst < 0.01
    assert rollups.sketches(df.limit(0), ["day"], "v").count() == 0


def watched(df):
    return q.Watch(
        df, {"nulls": q.any_null("v"), "bad": q.not_accepted("flag", ["x", "y"])}, keys=["k", "l"], distinct={"flags": (["flag"], F.col("k") > 1)}
    )


def test_checks_are_counted_by_the_write(spark, tmp_path):
    rows = [(1, 1, "x", 1.0), (1, 1, "x", 1.0), (2, 1, "y", None), (2, 2, "z", 1.0), (None, 2, None, 1.0), (None, 2, None, 1.0), *[(9, 9, "x", float(i)) for i in range(50)]]
    df = spark.createDataFrame(rows, "k int, l int, flag string, v double")
    watch = watched(df)
    assert watch.rows.columns == df.columns
    watch.rows.write.parquet(str(tmp_path / "fact"))
    assert watch.result == {"nulls": 1, "bad": 3, "rows": 54, "distinct_keys": 4, "duplicate_rows": 54, "flags": 3}
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "fact")).collect())) == sorted(map(str, df.collect()))
    empty = watched(df.limit(0))
    empty.rows.write.parquet(str(tmp_path / "none"))
    assert empty.result == {"nulls": 0, "bad": 0, "rows": 0, "distinct_keys": 0, "duplicate_rows": 0, "flags": 0}
    # one scan, whatever is counted
    assert watched(spark.read.parquet(str(tmp_path / "fact"))).rows._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 2


def test_a_gate_keeps_bad_rows_unpublished(spark, tmp_path):
    prod, kind = str(tmp_path / "prod"), "k int, l int, flag string, v double"

    def publish(rows):
        watch = watched(spark.createDataFrame(rows, kind))

        def gate():
            if watch.result["duplicate_rows"]:
                raise ValueError("keys are not unique")

        return versions.publish(watch.rows, prod, gate=gate)

    first = publish([(1, 1, "x", 1.0)])
    with pytest.raises(ValueError):
        publish([(1, 1, "x", 2.0), (1, 1, "x", 3.0)])
    assert versions.current_version(spark, prod) == first and versions.published(spark, prod).count() == 1
