"""SimHash near-dedup by meet-in-the-middle ball hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .shared import components, forest, rows_of, store, with_row_keys

BITS, SEED = 64, 42
#: Words of a shingle and largest bit distance of a link.
SHINGLE, MAX_BITS = 4, 4
#: Shingles hashed at a time, so that a very long text needs bounded memory.
BLOCK = 1 << 16
#: Distinct fingerprints that share a prefix on average; further bits by which a prefix with too many is cut, again and again.
PREFIX_ROWS, CUT_BITS = 512, 6
#: A prefix with so many times the rows of an average one is cut.
HOT = 3
#: Variants that a task holds at a time.
HELD = 1 << 21


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint: a bit is 1 if set in over half the XXH64 hashes of the shingles; no words (or null): 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, and only \x20 \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))  # one past the space behind each word
    count = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for first in range(0, count, BLOCK):
        last = min(count, first + BLOCK)
        starts = [ends[i - 1] if i else 0 for i in range(first, last)]
        stops = ends[first + shingle - 1 : last + shingle - 1] or [len(joined) + 1]
        raw = b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(starts, stops)])
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1)
        for at in range(0, len(bits), 255):
            ones += bits[at : at + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(ones * 2 > count).view(">u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint of a text column as a signed bigint."""

    @pandas_udf(T.LongType())
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, shingle) for x in texts], dtype=np.uint64).view(np.int64))

    return prints(text)


def _masks(bits: int, most: int) -> list[list[int]]:
    """Masks over ``bits`` bits by the number of ones, up to ``most``."""
    return [[sum(1 << i for i in c) for c in combinations(range(bits), k)] for k in range(most + 1)]


def _collide(prints: np.ndarray, left: np.ndarray, free: int, radius: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges between fingerprints that share a variant whose bits above ``free`` are fixed; ``left``: flips still allowed.

    Cuts the variant space by its next bit until the variants of a part fit in memory.
    """
    size = [math.comb(free, k) for k in range(radius + 1)]
    total = sum(int((left >= k).sum()) * n for k, n in enumerate(size))
    if len(prints) < 2 or total == len(prints) == 0:
        return
    if total > HELD and free > 0:
        bit = (prints >> np.uint64(free - 1)) & np.uint64(1)
        for side in (0, 1):
            after = left - (bit != side)
            stays = after >= 0
            yield from _collide(prints[stays], after[stays], free - 1, radius, max_bits)
        return
    low = prints & np.uint64((1 << free) - 1)
    keys, who, room = [], [], []
    for k, masks in enumerate(_masks(free, radius)):
        at = np.flatnonzero(left >= k)
        masks = np.array(masks, dtype=np.uint64)
        keys.append((low[at][:, None] ^ masks).ravel())
        who.append(np.repeat(at, len(masks)))
        room.append(np.repeat(left[at] - k, len(masks)))
    keys, who, room = np.concatenate(keys), np.concatenate(who), np.concatenate(room)
    order = np.argsort(keys)
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    inside = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
    if not len(inside):
        return
    keys, who, room = keys[inside], who[order[inside]], room[order[inside]]
    # the member nearest to the variant is the hub of its bucket; a link is verified by its bit distance
    order = np.lexsort((prints[who], -room, keys))
    keys, who = keys[order], who[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    hub = who[np.flatnonzero(first)[np.cumsum(first) - 1]]
    a, b = prints[hub[~first]], prints[who[~first]]
    near = np.bitwise_count(a ^ b) <= max_bits
    yield a[near], b[near]


def _routes(distinct: DataFrame, radius: int) -> DataFrame:
    """(prefix, bits, left, fp): each fingerprint once for every prefix (its first ``bits`` bits) that its variants can have.

    A prefix whose variants would be more than ``HELD``, or whose rows are ``HOT`` times those of an average one, is cut by further
    bits, and those prefixes again, until all are small; with all bits fixed a prefix is one variant, which few different
    fingerprints can have.  So the largest group has a bound whatever the table, and only the rows that are cut are written.
    """
    n = distinct.count()
    bits = min(BITS, max(1, math.ceil(math.log2(max(2, n / PREFIX_ROWS)))))

    def flips(width: int) -> Column:
        """Each way to change at most ``radius`` of the last ``width`` bits of a prefix, and how many it changes."""
        return F.explode(F.array(*[F.struct(F.lit(m).cast("bigint").alias("m"), F.lit(k).alias("cost")) for k, ms in enumerate(_masks(width, radius)) for m in ms]))

    most = HOT * PREFIX_ROWS * sum(math.comb(bits, k) for k in range(radius + 1))
    now = distinct.select("fp", flips(bits).alias("r"))
    now = now.select("fp", F.shiftrightunsigned("fp", BITS - bits).bitwiseXOR(F.col("r.m")).alias("prefix"), (F.lit(radius) - F.col("r.cost")).alias("left"))
    done = None
    while True:
        variants = F.get(F.array(*[F.lit(sum(math.comb(BITS - bits, j) for j in range(k + 1))) for k in range(radius + 1)]), F.col("left"))
        loads = now.groupBy("prefix").agg(F.sum(variants).alias("load"), F.count("*").alias("rows"))
        hot = store(loads.filter((F.col("load") > HELD) | (F.col("rows") > most)).select("prefix"), "hot")
        cut = bits < BITS and not hot.isEmpty()
        calm = (now.join(hot, "prefix", "left_anti") if cut else now).select("fp", "prefix", "left", F.lit(bits).alias("bits"))
        done = calm if done is None else done.unionByName(calm)
        if not cut:
            return done
        more = min(CUT_BITS, BITS - bits)
        bits += more
        own = F.shiftrightunsigned("fp", BITS - bits).bitwiseAND(F.lit((1 << more) - 1).cast("bigint")).bitwiseXOR(F.col("r.m"))
        now = now.join(hot, "prefix").select("*", flips(more).alias("r")).filter("r.cost <= left")
        now = store(now.select("fp", F.shiftleft("prefix", more).bitwiseOR(own).alias("prefix"), (F.col("left") - F.col("r.cost")).alias("left")), "routes")


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) that connect all fingerprints (column fp, distinct) at ``max_bits`` or fewer differing bits.

    Every fingerprint stands for all its variants within half the distance.  A variant is dealt by its prefix: the fingerprint is
    sent once to each prefix that its variants can have, and the variants are made where they meet, so the shuffle carries a few
    dozen rows per fingerprint instead of thousands.  Prefixes with too many are cut by further bits until none is left.
    Members of a bucket are linked to the nearest one only, and a task returns a spanning forest, never all pairs.
    """
    radius = (max_bits + 1) // 2

    def bucket(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        prints, left = part["fp"].to_numpy().view(np.uint64), part["left"].to_numpy().astype(np.int64)
        found, held, us, vs = [], 0, [], []
        for a, b in _collide(prints, left, BITS - int(key[1]), radius, max_bits):
            us.append(a.view(np.int64))
            vs.append(b.view(np.int64))
            held += len(a)
            if held > HELD:
                found.append(forest(np.concatenate(us), np.concatenate(vs)))
                us, vs, held = [found[-1][0]], [found.pop()[1]], 0
        u, v = forest(np.concatenate(us), np.concatenate(vs)) if us else (np.empty(0, np.int64), np.empty(0, np.int64))
        return pd.DataFrame({"u": u, "v": v})

    return _routes(distinct, radius).groupBy("prefix", "bits").applyInPandas(bucket, "u bigint, v bigint").distinct()


def mark_near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, rid: str | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id and kept of each row of ``docs`` (doc_id, text; ``rid`` names a text column that tells its rows, to be carried).

    Texts are lower-cased (A-Z), cut into words at \\x20 and \\x09-\\x0D and hashed as word shingles, repeats included; a text with
    fewer words is one shingle.  Fingerprints at ``max_bits`` or fewer differing bits are linked; component_id is the smallest doc_id
    reachable.  Null, empty and blank texts have fingerprint 0 and link like any other.  Equal fingerprints are collapsed before
    the search, so copies cost nothing there.  A null doc_id is a document like any other and never names a component unless all
    its members are null.  One row of each component is kept: that of the smallest doc_id, any one if it repeats.
    An empty table gives an empty result; other columns are not read.
    """
    key = F.col(rid) if rid else F.monotonically_increasing_id().cast("string")
    prints = docs.select(F.col("doc_id").cast("bigint").alias("id"), fingerprints(F.col("text"), shingle).alias("fp"), key.alias("rid"))
    prints = store(prints, "fingerprints")
    # of a fingerprint: its first row, smallest doc_id first and null last
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("first")
    classes = store(prints.groupBy("fp").agg(first), "classes")
    found = components(links(classes.select("fp"), max_bits))
    roots = classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    roots = store(roots, "roots")
    best = store(roots.groupBy("root").agg(F.min("first").alias("best")), "best")
    roots = store(roots.join(best, "root").select("fp", "best"), "roots")  # tables, so that a hot fingerprint is split in the join
    return prints.join(roots.hint("merge"), "fp").select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("best.id").alias("component_id"),
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        *([F.col("rid").alias(rid)] if rid else []),
    )


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all their columns, whatever their names; cases as in ``mark_near_copies``."""
    keyed = with_row_keys(docs)
    marks = mark_near_copies(keyed.select("row.doc_id", "row.text", "rid"), shingle, max_bits, rid="rid")
    return rows_of(keyed, marks.filter("kept")).select("row.*")
