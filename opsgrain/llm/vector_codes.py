"""Compression of vectors into codes: one codebook per part of the vectors, refined by Ball k-means on whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, store

#: Parts of a vector, entries of a codebook, rounds of refinement, and whole numbers that 1.0 becomes.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Largest whole number of a component either way; squared distances of up to 64 such components stay within 64 bits.
LARGEST = 1 << 27
#: Vectors that a task compares at a time, and pairs of a part and a candidate that it holds at a time.
BLOCK_ROWS, PAIRS = 2048, 1 << 21

_STATE = "vec_id bigint, label string, x array<int>, code binary, error bigint, part int, entry int, place int, total bigint"


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the last axis; exact for whole numbers of 64 bits."""
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)


def nearest(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entry of ``book`` nearest to each point, by comparing all; ties to the lower index."""
    step = max(1, PAIRS // max(1, book.size))
    return np.concatenate([squares(points[i : i + step, None], book[None]).argmin(axis=1) for i in range(0, len(points), step)] or [np.empty(0, np.int64)])


class Balls:
    """The entries of a codebook as balls: which entries may be nearest to a point of ball i at squared distance D from its centre.

    By the triangle inequality entry j can be as near as i only if ``|c_i - c_j| <= 2 |p - c_i|``, in whole numbers
    ``gap(i, j) <= 4 D``.  So with the gaps of i in rising order

    * the neighbours of ball i are the entries with ``gap <= 4 R``, R the squared radius of the points at hand,
    * the stable core are the points with ``4 D`` below the first gap: they keep their entry and nothing is computed,
    * the gaps cut the rest of the ball into rings; a point in ring k is compared with the k nearest neighbours and no others.
    """

    def __init__(self, book: np.ndarray):
        self.book = book
        gaps = squares(book[:, None], book[None])
        np.fill_diagonal(gaps, np.iinfo(np.int64).max)
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)

    def neighbours(self, entry: int, radius: int) -> np.ndarray:
        """Entries whose half of the gap reaches into a ball of this squared radius, nearest first."""
        return self.order[entry, : np.searchsorted(self.gaps[entry], 4 * radius, side="right")]

    def assign(self, points: np.ndarray, old: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest entry, squared distance) of each point, given the entry that it had; ties to the lower index."""
        entry, away = old.copy(), squares(points, self.book[old])
        outside = np.flatnonzero(4 * away >= self.gaps[old, 0])  # the others lie in stable cores
        rings = np.zeros(len(outside), np.int64)
        for i in np.unique(old[outside]):
            mine = np.flatnonzero(old[outside] == i)
            near = self.neighbours(i, away[outside[mine]].max())
            rings[mine] = np.searchsorted(self.gaps[i, : len(near)], 4 * away[outside[mine]], side="right")
        ends = np.cumsum(rings)
        at = 0
        while at < len(outside):
            # as many points as have PAIRS candidates together
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
            some, size = outside[at:upto], rings[at:upto]
            first = np.cumsum(size) - size
            point = np.repeat(some, size)
            rank = np.arange(len(point)) - np.repeat(first, size)
            candidate = self.order[old[point], rank]
            gap = squares(points[point], self.book[candidate])
            best = np.minimum.reduceat(gap, first)
            ties = np.where(gap == np.repeat(best, size), candidate, len(self.book))
            low = np.minimum.reduceat(ties, first)
            better = (best < away[some]) | ((best == away[some]) & (low < old[some]))
            entry[some[better]], away[some[better]] = low[better], best[better]
            at = upto
        return entry, away


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray, sums: bool) -> Iterator[pa.RecordBatch]:
    """Rows with their new code and error; with ``sums`` a task ends with the sums and counts (place -1) of its parts by entry."""
    parts, entries, width = books.shape
    balls = [Balls(book) for book in books]
    totals, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
    names = [f.split()[0] for f in _STATE.split(", ")]
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            rows = batch.slice(at, BLOCK_ROWS)
            x = _matrix(rows["x"], parts * width).reshape(-1, parts, width)
            had = rows["code"].to_pylist()
            codes, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p in range(parts):
                points = np.ascontiguousarray(x[:, p])
                # before the first round there are no balls
                old = nearest(points, books[p]) if had[0] is None else np.fromiter((c[p] for c in had), np.int64, len(had))
                entry, away = balls[p].assign(points, old)
                codes[:, p], error = entry, error + away
                if sums:
                    counts[p] += np.bincount(entry, minlength=entries)
                    np.add.at(totals[p], entry, points)
            none = pa.nulls(len(x), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [rows["vec_id"], rows["label"], rows["x"], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), none, none, none, pa.nulls(len(x), pa.int64())], names
            )
    if sums and counts.any():
        p, e = np.nonzero(counts)
        values = np.concatenate([counts[p, e][:, None], totals[p, e]], axis=1)
        n = values.size
        columns = [np.repeat(p, width + 1), np.repeat(e, width + 1), np.tile(np.arange(-1, width), len(p))]
        empty = [pa.nulls(n, t) for t in (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.binary(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*empty, *(pa.array(c, pa.int32()) for c in columns), pa.array(values.ravel())], names)


def _state(table: DataFrame, books: np.ndarray, sums: bool, name: str) -> DataFrame:
    rows = table.filter("part is null").select("vec_id", "label", "x", "code")
    return store(rows.mapInArrow(lambda batches: _assigned(batches, books, sums), _STATE), name)


def _refined(books: np.ndarray, table: DataFrame) -> np.ndarray:
    """Each entry becomes the floor of the mean of its parts; unused entries stay.  What reaches the driver has the size of the codebooks."""
    sums = table.filter("part is not null").groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect()
    new, counts = books.copy(), {(r["part"], r["entry"]): r["total"] for r in sums if r["place"] < 0}
    for r in sums:
        if r["place"] >= 0:
            new[r["part"], r["entry"], r["place"]] = r["total"] // counts[r["part"], r["entry"]]
    return new


def whole_numbers(vector: Column, scale: int) -> Column:
    """Components as ``floor(scale * x)``, not beyond LARGEST either way."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int"))


def usable(vector: Column) -> Column:
    """Is a vector there and free of null and non-finite components?"""
    fine = F.size(vector) > 0
    fine = fine & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, x, code, error) for the rows of ``vectors`` (vec_id, embedding, label), and the codebooks (part, entry, place in the part).

    The components become whole numbers and each vector is cut into ``parts`` equal parts.  A codebook starts as the parts of the
    ``entries`` (256 at most) rows of smallest vec_id (null last, then by components); a round assigns every part to its nearest entry
    and moves each entry to the floor of its parts' mean; at the end parts are assigned once more.  ``code`` has a byte per part, ``error`` is the
    sum of the squared distances, all of it exact.  The first assignment compares with all entries, later ones go by balls (``Balls``).

    Rows whose vector is null or empty or holds a null or non-finite component are dropped, and those whose length is no multiple of
    ``parts`` or another than that of most other rows (ties: the shorter).  Repeated rows count each; with fewer rows than ``entries``
    the codebooks are shorter; an empty table gives an empty result and codebooks without entries.  Other columns are not read.

    Every pass reads rows from a written table and has no shuffle but that of the sums, one row per task, part, entry and place.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte per part: 1 to 256 entries")
    rows = vectors.filter(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), whole_numbers(F.col("embedding"), scale).alias("x")
    )
    rows = store(rows.filter(F.size("x") % parts == 0).withColumns({"code": F.lit(None).cast("binary"), "part": F.lit(None).cast("int")}), "codes")
    lengths = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(2).collect()
    dim = lengths[0]["dim"] if lengths else parts
    if len(lengths) > 1:
        rows = store(rows.filter(F.size("x") == dim), "codes")
    order = [F.col("vec_id").asc_nulls_last(), F.col("x").asc()]
    start = np.array([r["x"] for r in rows.orderBy(*order).limit(entries).collect()], np.int64)
    books = start.reshape(-1, parts, dim // parts).transpose(1, 0, 2).copy()
    spark, table = vectors.sparkSession, rows
    for last in [False] * rounds + [True]:
        new = _state(table, books, not last, "codes")
        if not last:
            books = _refined(books, new)
        discard(spark, table)
        table = new
    return table.select("vec_id", "label", "x", "code", "error"), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows with the same label, nulls together.  Labels are summed before they are joined."""
    sums = store(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "errors").withColumnRenamed("label", "of")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimals by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def decoded(code: bytes, books: np.ndarray) -> np.ndarray:
    """The vector (in whole numbers) that a code stands for."""
    return np.concatenate([books[p, e] for p, e in enumerate(code)])
