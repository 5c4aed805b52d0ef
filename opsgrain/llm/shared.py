"""Tables and checkpoints in the folder that driver and executors share, and connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; one of its own only where that is unset and the master is local, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            root = known.get()
        elif not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        else:
            root = tempfile.mkdtemp(prefix="llm-")
            spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint whole rows: computed once, and kept in the shared folder as long as a plan refers to them."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def with_row_keys(docs: DataFrame) -> DataFrame:
    """``row`` (the whole row) and ``rid``, a text that tells each row from every other one whenever the plan runs.

    Rows read straight from Parquet files are told by file and place, so nothing is written and the files can be read again for
    the rows that an operator keeps.  Rows of any other plan are checkpointed with a number.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() == "LogicalRelation" and "parquet" in plan.toString().lower() and "_metadata" not in docs.columns:
        return docs.select(whole, F.concat_ws("#", "_metadata.file_path", F.col("_metadata.row_index").cast("string")).alias("rid"))
    return cut(docs.select(whole, F.monotonically_increasing_id().cast("string").alias("rid")))


def rows_of(keyed: DataFrame, marks: DataFrame, *more: str) -> DataFrame:
    """The rows of ``keyed`` whose rid is in ``marks``, as ``row``, with further columns of ``marks``."""
    return keyed.join(marks.select("rid", *more).hint("merge"), "rid").select("row", *more)


def discard(spark: SparkSession, table: DataFrame) -> None:
    """Delete a table of ``store`` that no later plan reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) with node != root for the graph of the edges u-v; the root is the smallest node reachable.

    Keeps what is connected and leaves fewer rows than nodes, so a dense group never leaves a task as pairs.
    """
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, up := label[label]):
            label = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v: bigint, not null); the root is the smallest node reachable.

    Alternates large stars and small stars: each round is two aggregations with map-side minimum and two joins whose large side
    may be split at run time, so a hub needs no single task.  Every round is written to the shared folder and the one before is
    deleted; the number of rounds grows with the logarithm of the longest chain.  An empty input gives an empty result.
    """
    spark = edges.sparkSession

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = store(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the minima are written, so that run-time skew splitting can cut the edges of a hub in the join
        least = store(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = store(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        lower = store(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(lower, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = store(small.unionByName(lower.withColumnRenamed("m", "v")).distinct(), "edges")
        after = state(new)
        for old in (now, least, large, lower):
            discard(spark, old)
        now = new
        if after == before:
            break
        before = after
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
