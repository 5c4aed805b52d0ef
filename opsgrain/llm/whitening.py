"""Whitening of embeddings: covariance by block matrices, eigenvectors of the small matrix, projection by block matrices."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from .shared import discard, shared_folder, store
from .vector_codes import usable

#: Components that are returned; whole numbers that 1.0 becomes and what is added; rows of a block.
COMPONENTS, SCALE, SHIFT, BLOCK_ROWS = 32, 64, 1_000_000, 256
#: Most whole numbers either way before the shift.
LARGEST = 1 << 40
#: Blocks that a task multiplies if there are tasks enough, most tasks of a projection, and blocks of one matrix: a table with more
#: is worked off in several matrices, so that neither a task nor the driver's list of blocks grows with the table.
BLOCKS_A_TASK, TASKS, CHUNK_BLOCKS = 16, 64, 65536

#: A dense matrix as MLlib stores it; written as such a struct, a column is read back as a matrix without passing through Python.
_MATRIX = "struct<type:tinyint,numRows:int,numCols:int,colPtrs:array<int>,rowIndices:array<int>,values:array<double>,isTransposed:boolean>"
_DENSE = pa.struct(
    [("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())), ("rowIndices", pa.list_(pa.int32())),
     ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_())]
)


@dataclass(frozen=True)
class Whitening:
    """``eigenvalues`` (falling), their share of the trace, ``matrix`` (dimension x component) that whitens a centred row, ``real``:
    which components have variance, and ``error``: largest absolute entry of the whitened rows' covariance minus the identity."""

    rows: int
    eigenvalues: np.ndarray
    explained: np.ndarray
    matrix: np.ndarray
    real: np.ndarray
    error: float | None


def product(left: BlockMatrix, right: BlockMatrix, middle: int) -> BlockMatrix:
    """``left`` times ``right`` with the middle dimension's blocks dealt over ``middle`` tasks per block of the result.

    Without that split one task would get every row block of a transposed product.
    """
    wrapped = left._java_matrix_wrapper
    return BlockMatrix(wrapped.call("multiply", right._java_matrix_wrapper._java_model, middle), left.rowsPerBlock, right.colsPerBlock)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transposed matrix times matrix; a small square matrix."""
    middle = max(1, -(-blocks.numRowBlocks // BLOCKS_A_TASK))
    return product(blocks.transpose(), blocks, middle).toLocalMatrix().toArray()


@dataclass(frozen=True)
class Blocks:
    """A table (block from 0, rows, matrix, ...) in the shared folder: block matrices of ``block_rows`` x ``width``, the last rows zero
    where a block has fewer.  ``count`` blocks."""

    spark: SparkSession
    path: str
    kind: str
    count: int
    block_rows: int
    width: int

    @property
    def table(self) -> DataFrame:
        """With the matrix as a struct."""
        return self.spark.read.schema(self.kind).parquet(self.path)

    def chunks(self, partitions: int | None = None) -> Iterator[tuple[int, BlockMatrix]]:
        """First block and matrix of each part of the table, dealt over so many partitions if given."""
        schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("matrix", MatrixUDT())])
        matrices = self.spark.read.schema(schema).parquet(self.path)
        for first in range(0, self.count, CHUNK_BLOCKS):
            n = min(CHUNK_BLOCKS, self.count - first)
            some = matrices.filter((F.col("block") >= first) & (F.col("block") < first + n))
            place = F.struct((F.col("block") - first).cast("bigint").alias("i"), F.lit(0).cast("bigint").alias("j"))
            blocks = some.select(place.alias("place"), "matrix")
            blocks = blocks.repartition(partitions) if partitions else blocks
            made = callMLlibFunc("createBlockMatrix", blocks, self.block_rows, self.width, n * self.block_rows, self.width)
            matrix = BlockMatrix(made, self.block_rows, self.width).persist(StorageLevel.MEMORY_AND_DISK)
            yield first, matrix
            made.blocks().unpersist(False)

    def discard(self) -> None:
        """Delete the table; nothing may read it any more."""
        discard(self.spark, self.table)

    def scatter(self) -> np.ndarray:
        return sum((scatter(m) for _, m in self.chunks()), np.zeros((self.width, self.width)))


def keep_blocks(df: DataFrame, kind: str, count: int, block_rows: int, width: int, name: str) -> Blocks:
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return Blocks(df.sparkSession, path, kind, count, block_rows, width)


def dense(values: np.ndarray, block_rows: int) -> pa.StructArray:
    """One matrix of the rows ``values``, filled with zeros up to ``block_rows``."""
    full = np.zeros((block_rows, values.shape[1]))
    full[: len(values)] = values
    # row after row, as MLlib writes a transposed matrix
    one = [pa.array([x], t) for x, t in ((1, pa.int8()), (block_rows, pa.int32()), (values.shape[1], pa.int32()), (None, pa.list_(pa.int32())), (None, pa.list_(pa.int32())))]
    held = pa.ListArray.from_arrays(pa.array([0, full.size], pa.int32()), pa.array(full.ravel()))
    return pa.StructArray.from_arrays([*one, held, pa.array([True])], fields=list(_DENSE))


def rows_in(matrix: pa.StructScalar, rows: int) -> np.ndarray:
    """The first ``rows`` rows of a dense matrix."""
    values, shape = matrix["values"].values.to_numpy(), (matrix["numRows"].as_py(), matrix["numCols"].as_py())
    return (values.reshape(shape) if matrix["isTransposed"].as_py() else values.reshape(shape[::-1]).T)[:rows]


def whole_numbers(vector: Column, scale: int, shift: int) -> Column:
    """``floor(scale * c) + shift``, not beyond LARGEST either way before the shift."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))) + shift)


def indexed(rows: DataFrame) -> DataFrame:
    """``index`` from 0 without gaps: the place in its file of a written table, behind the rows of the files before."""
    placed = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    files = placed.groupBy("file").agg(F.count("*").alias("rows"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return placed.join(files, "file").withColumn("index", F.col("before") + F.col("place")).drop("file", "place", "before")


def deviation(x: Column, n: int, sums: list[int], largest: int) -> Column:
    """Sum over dimensions of ``(n * x - sum) ** 2``, exact; null where it does not fit a long.  ``largest``: of all |n * x - sum|."""
    most = len(sums) * largest**2
    if most >= 10**38:
        return F.lit(None).cast("bigint")
    kind = "bigint" if most < 1 << 63 else "decimal(38,0)"
    gaps = F.zip_with(x, F.array(*[F.lit(s).cast(kind) for s in sums]), lambda a, s: (a.cast(kind) * F.lit(n) - s).cast(kind))
    total = F.aggregate(gaps, F.lit(0).cast(kind), lambda sofar, g: (sofar + g * g).cast(kind))
    return total if kind == "bigint" else total.try_cast("bigint")


def packed_blocks(rows: DataFrame, n: int, mean: np.ndarray, block_rows: int) -> Blocks:
    """Centred rows of ``rows`` (index, vec_id, deviation, x) in the order of the index, with their ids and deviations."""

    def pack(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by("index")
        x = part["x"].combine_chunks().flatten().to_numpy().reshape(part.num_rows, len(mean))
        lists = [pa.array([part[name].to_pylist()], pa.list_(pa.int64())) for name in ("vec_id", "deviation")]
        numbers = [pa.array([key[0].as_py()], pa.int32()), pa.array([part.num_rows], pa.int32())]
        return pa.table([*numbers, *lists, dense(x - mean, block_rows)], ["block", "rows", "ids", "deviations", "matrix"])

    kind = f"block int, rows int, ids array<bigint>, deviations array<bigint>, matrix {_MATRIX}"
    dealt = rows.withColumn("block", F.floor(F.col("index") / block_rows).cast("int"))
    return keep_blocks(dealt.groupBy("block").applyInArrow(pack, kind), kind, -(-n // block_rows), block_rows, len(mean), "centred")


def projected(packed: Blocks, matrix: np.ndarray) -> Blocks:
    """The rows of ``packed`` times ``matrix``.

    The grid of such a product has as many tasks as the root of the number of partitions of its sides, so the right side, one block, is dealt
    over the square of the tasks that are wanted.
    """
    one = [(0, (1, *matrix.shape, None, None, matrix.ravel(order="F").tolist(), False))]
    right = packed.spark.createDataFrame(one, f"block int, matrix {_MATRIX}").coalesce(1)
    right = keep_blocks(right, f"block int, matrix {_MATRIX}", 1, *matrix.shape, "directions")
    parts = []
    for first, left in packed.chunks():
        tasks = min(TASKS, -(-left.numRowBlocks // BLOCKS_A_TASK))
        _, directions = next(right.chunks(tasks**2))
        done = product(left, directions, 1)
        blocks = callMLlibFunc("getMatrixBlocks", done._java_matrix_wrapper._java_model).toDF("place", "matrix")
        blocks = blocks.select((F.col("place")["_1"] + first).cast("int").alias("block"), "matrix")
        parts.append(keep_blocks(blocks, f"block int, matrix {_MATRIX}", left.numRowBlocks, packed.block_rows, matrix.shape[1], "projected"))
    out = parts[0].table
    for part in parts[1:]:
        out = out.unionByName(part.table)
    kind = f"block int, rows int, ids array<bigint>, deviations array<bigint>, matrix {_MATRIX}"
    whole = keep_blocks(packed.table.drop("matrix").join(out, "block"), kind, packed.count, packed.block_rows, matrix.shape[1], "white")
    for part in (right, *parts):
        part.discard()
    return whole


def unpacked(batches: Iterator[pa.RecordBatch], real: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per vector from (rows, ids, deviations, matrix); components that are not real become null."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, deviations = batch["ids"][i].values, batch["deviations"][i].values
            values = rows_in(batch["matrix"][i], len(ids))
            flat = pa.array(np.ascontiguousarray(values).ravel(), mask=~np.tile(real, len(ids)))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * len(real), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([ids, deviations, rows], ["vec_id", "deviation", "whitened"])


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, Whitening | None]:
    """(vec_id, deviation, whitened: array of ``components`` doubles) of the rows of ``vectors`` (vec_id, embedding), and the model.

    The components become whole numbers x; the fit list is all remaining rows.  Rows are centred, indexed into blocks and multiplied
    with their transpose; the eigenvectors of that small matrix, each over the root of its eigenvalue, whiten the rows by a second
    product.  Components are numbered by falling eigenvalue, at most as many as dimensions; the sign of an eigenvector is such that its
    largest entry is positive.  ``deviation`` is the sum over dimensions of ``(n * x - sum) ** 2``, exact, null beyond a long
    (for all rows where such sums could pass 38 digits).

    Rows whose vector is null or empty or holds a null or non-finite component are dropped, and those of another length than
    most rows (ties: the shorter).  A component whose variance is zero but for rounding whitens to null.  Repeated rows count each; null ids
    stay; an empty table gives an empty result and no model.  Other columns are not read.

    A task holds a few blocks of ``block_rows`` rows; what reaches the driver is one square matrix of the dimension, sums and extremes by
    dimension, and the list of the blocks of one matrix.
    """
    spark, kind = vectors.sparkSession, "vec_id bigint, deviation bigint, whitened array<double>"
    rows = vectors.filter(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), whole_numbers(F.col("embedding"), scale, shift).alias("x")
    )
    rows = store(rows, "whole")
    lengths = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(2).collect()
    if not lengths:
        return spark.createDataFrame([], kind), None
    dim, n = lengths[0]["dim"], lengths[0]["count"]
    if len(lengths) > 1:
        rows = store(rows.filter(F.size("x") == dim), "whole")
    each = rows.select(F.posexplode("x").alias("d", "value")).groupBy("d")
    each = {r["d"]: r for r in each.agg(F.sum("value").alias("sum"), F.min("value").alias("low"), F.max("value").alias("high")).collect()}
    sums = [each[d]["sum"] for d in range(dim)]
    largest = max(max(abs(n * each[d][end] - each[d]["sum"]) for end in ("low", "high")) for d in range(dim))
    mean = np.array([s / n for s in sums])
    kept = indexed(rows).select("index", "vec_id", deviation(F.col("x"), n, sums, largest).alias("deviation"), "x")
    packed = packed_blocks(kept, n, mean, block_rows)
    discard(spark, rows)
    covariance = packed.scatter() / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    take = min(components, dim)
    top = directions[:, :take]
    top = top * np.where(top[np.abs(top).argmax(axis=0), np.arange(take)] < 0, -1.0, 1.0)
    real = values[:take] > dim * np.finfo(float).eps * max(values[0], 0.0)
    matrix = np.where(real, top / np.sqrt(np.where(real, values[:take], 1.0)), 0.0)
    white = projected(packed, matrix)
    packed.discard()
    out = white.table.select("ids", "deviations", "matrix").mapInArrow(lambda batches: unpacked(batches, real), kind)
    trace = float(np.trace(covariance))
    explained = values[:take] / trace if trace else np.full(take, np.nan)
    return out, Whitening(n, values[:take], explained, matrix, real, identity_error(white, n, real))


def identity_error(white: Blocks, n: int, real: np.ndarray) -> float | None:
    """Largest absolute entry of the covariance of whitened blocks minus the identity; components without variance are left out."""
    if not real.any():
        return None
    width, block_rows = white.width, white.block_rows

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for matrix in batch["matrix"]:
                total += rows_in(matrix, block_rows).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total)], ["d", "total"])

    sums = white.table.select("matrix").mapInArrow(summed, "d int, total double").groupBy("d").agg(F.sum("total").alias("total"))
    mean = np.array([r["total"] for r in sums.orderBy("d").collect()]) / n

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = dense(rows_in(batch["matrix"][i], batch["rows"][i].as_py()) - mean, block_rows)
                yield pa.RecordBatch.from_arrays([batch["block"].slice(i, 1), matrix], ["block", "matrix"])

    kind = f"block int, matrix {_MATRIX}"
    again = keep_blocks(white.table.select("block", "rows", "matrix").mapInArrow(centred, kind), kind, white.count, block_rows, width, "recentred")
    error = float(np.abs(again.scatter() / n - np.eye(width))[np.ix_(real, real)].max())
    again.discard()
    return error
