"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import random
import zlib
from collections.abc import Sequence
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import rows_of, store, with_row_keys

#: Weights of the sources in order, share of all words that the mix takes, most times that a word may be taken.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: Documents that one task moves through the constraints at a time, on average.
SHARD_ROWS = 4096
_EPS = 1e-9


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``target`` for each row of ``sources`` (source, source_size): the words the mix takes of it.

    Sources by code point, null last, get the weights in turn and share ``share`` of all words; a target stops at ``most`` times its
    source's size and the excess is shared again by weight.  That fixed point is min(level * weight, cap): with the sources sorted by
    cap / weight, the level is the first one that does not reach its own source's cap.  One row per source, so the windows are small.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    each = F.array(*[F.lit(float(w)) for w in weights])
    out = sources.withColumn("weight", F.get(each, (F.row_number().over(order) - 1) % len(weights)))
    out = out.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(every) * F.lit(float(share))
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    out = out.withColumn("level", (budget - before) / weight)
    reached = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    out = out.withColumn("level", F.first(reached, ignorenulls=True).over(every))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("level") * F.col("weight"), F.col("cap")))
    return out.withColumn("target", target).drop("weight", "cap", "level")


def flight(chances: list[float], sizes: list[int], rng: random.Random) -> list[float]:
    """Flight phase: at most two chances stay between 0 and 1; the expected and the balanced totals are kept.

    Three undecided documents at a time have one direction that changes neither the number of documents nor of words; a
    step along it, to the one or the other side with the chance that keeps the expectation, decides at least one of them.
    """
    now = list(chances)
    held: list[int] = []
    for i in range(len(now)):
        if not _EPS < now[i] < 1 - _EPS:
            now[i] = float(round(now[i]))
            continue
        held.append(i)
        if len(held) < 3:
            continue
        a, b, c = held
        along = (sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a])
        if not any(along):
            along = (1, -1, 0)
        up = min((1 - now[k]) / v if v > 0 else now[k] / -v for k, v in zip(held, along) if v)
        down = min(now[k] / v if v > 0 else (1 - now[k]) / -v for k, v in zip(held, along) if v)
        step = up if rng.random() * (up + down) < down else -down
        for k, v in zip(held, along):
            now[k] += step * v
            if not _EPS < now[k] < 1 - _EPS:
                now[k] = float(round(now[k]))
        held = [k for k in held if 0 < now[k] < 1]
    return now


def landing(chances: list[float], sizes: list[int]) -> list[float]:
    """Decide the few chances that are left so that words, then documents, come nearest to what was expected."""
    left = [i for i, p in enumerate(chances) if 0 < p < 1]

    def miss(choice: tuple[int, ...]) -> tuple[float, float]:
        return (
            abs(sum((x - chances[i]) * sizes[i] for x, i in zip(choice, left))),
            abs(sum(x - chances[i] for x, i in zip(choice, left))),
        )

    out = list(chances)
    for i, x in zip(left, min(product((0, 1), repeat=len(left)), key=miss)):
        out[i] = float(x)
    return out


def _moved(part: pd.DataFrame, seed: str, last: bool) -> pd.DataFrame:
    part = part.sort_values(["doc_id", "size", "rid"], kind="stable", na_position="last")
    sizes = part["size"].tolist()
    now = flight(part["chance"].tolist(), sizes, random.Random(zlib.crc32(seed.encode("utf-8", "surrogatepass"))))
    if last:
        now = landing(now, sizes)
    return part.assign(chance=now)


def _flight_of(turn: int):
    """The flight of a shard, with random numbers of its own in every turn."""
    return lambda key, part: _moved(part, f"{key[0]}/{key[1]}" + (f"/{turn}" if turn else ""), False)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, shard_rows: int = SHARD_ROWS, rid: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (copies * size) of each row of ``docs`` (doc_id, text, source; ``rid`` names a
    text column that tells its rows, to be carried).

    A document of a source is expected target / source_size times.  The whole part of that is taken of all of them; of the rest, the cube
    method decides: within shards of a source the flight phase moves the chances along directions that keep the numbers of words and
    documents, until two are left in a shard; those of all shards go through it again, in shards as long as one would not hold
    them, and the last two of a source are decided by the landing.  So the words taken of a source differ from its target by less than its largest document.

    The shard of a document follows from its id and the random numbers from the shard, so that reruns agree.  A null text has size 0; a
    null source is a source, the last one; null ids are spread by their place.  Repeated rows are decided each on its own.  An empty
    table gives an empty result; other columns are not read.
    """
    key = F.col(rid) if rid else F.monotonically_increasing_id().cast("string")
    # ids as text: pandas would turn a column of numbers with nulls into floats
    base = docs.select(F.col("doc_id").cast("bigint").cast("string").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), key.alias("rid"))
    base = store(base, "sizes")
    sums = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sums = store(targets(sums, weights, share, most), "targets")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sums = sums.select(F.col("source").alias("of"), "source_size", "target", "docs", expected.alias("expected"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("docs") / shard_rows))
    chances = base.join(sums, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "rid", "source_size", "target",
        F.floor("expected").cast("bigint").alias("whole"),
        (F.col("expected") - F.floor("expected")).alias("chance"),
        F.pmod(F.xxhash64(F.coalesce("doc_id", "rid"), "size"), shards).alias("shard"), "docs",
    )
    still, decided, turn = (F.col("chance") > 0) & (F.col("chance") < 1), [], 0
    while True:
        flown = store(chances.groupBy("source", "shard").applyInPandas(_flight_of(turn), chances.schema), "flown")
        decided.append(flown.filter(~still))
        left = flown.filter(still)
        most = left.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        if most <= shard_rows:
            break
        # two documents at most are left of a shard; they go through the flight in shards again
        turn += 1
        known = F.ceil(F.col("docs") / shard_rows) * 2
        again = F.pmod(F.xxhash64(F.coalesce("doc_id", "rid"), "size", F.lit(turn)), F.greatest(F.lit(1), F.ceil(known / shard_rows)))
        chances = left.withColumn("shard", again).withColumn("docs", known)
    landed = left.groupBy("source").applyInPandas(lambda key, part: _moved(part, f"{key[0]}", True), left.schema)
    out = landed
    for part in decided:
        out = out.unionByName(part)
    out = out.withColumn("copies", F.col("whole") + F.round("chance").cast("bigint"))
    return out.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *([F.col("rid").alias(rid)] if rid else []),
    )


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken, with all their columns, whatever their names; cases as in ``mix``."""
    keyed = with_row_keys(docs)
    out = mix(keyed.select("row.doc_id", "row.text", "row.source", "rid"), weights, share, most, rid="rid").filter("copies > 0")
    return rows_of(keyed, out, "copies").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
