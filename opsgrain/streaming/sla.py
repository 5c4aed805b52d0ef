"""Streaming forms of the hourly facts and of the trailing reload."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dialect import ntz, trunc
from ..operators.metrics import distinct_counts
from ..sources.tables import reload_start, write

LATENESS = "7 days"


def file_stream(spark: SparkSession, directory: str, name: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Parquet files below a folder as a stream; the schema comes from a batch read."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name)
    schema = reader.parquet(directory).schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", name)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.parquet(directory)


def windowed_counts(
    events: DataFrame, ts: str, row_id: str, keys: Sequence[str], flags: Mapping[str, Column | None], *, sums: Mapping[str, Column] | None = None,
    window: str = "1 hour", lateness: str = LATENESS, rows: str | None = None,
) -> DataFrame:
    """``span`` (a window), keys, distinct ids with each flag, sums over the rows and, if named, the number of rows.

    Distinct aggregates do not exist on streams, so the flags of an id are or-ed per window first and the ids counted then: two
    aggregations over the same windows, like ``distinct_counts`` on tables.  The state is one row per id of an open window and
    one per open window.  Windows come out when the watermark passes them; a row without an id adds to no count of ids.
    """
    sums = dict(sums or {})
    timed = events.withColumn("__at", F.col(ts).cast("timestamp")).withWatermark("__at", lateness)
    marks = [F.max(F.when(F.lit(True) if c is None else c, 1).otherwise(0)).alias(f"__f_{n}") for n, c in flags.items()]
    marks += [F.sum(c).alias(f"__s_{n}") for n, c in sums.items()]
    ids = timed.groupBy(F.window("__at", window), *keys, row_id).agg(F.count(row_id).alias("__seen"), F.count(F.lit(1)).alias("__rows"), *marks)
    seen = F.col("__seen") > 0
    out = [F.sum(F.when(seen, F.col(f"__f_{n}")).otherwise(0)).alias(n) for n in flags] + [F.sum(f"__s_{n}").alias(n) for n in sums]
    out += [F.sum("__rows").alias(rows)] if rows else []
    return ids.groupBy(F.window("window", window).alias("span"), *keys).agg(*out)


def stream_sla(
    events: DataFrame, ts: str, row_id: str, keys: Sequence[str], flags: Mapping[str, Column], *, window: str = "1 hour", lateness: str = LATENESS,
    rows: str | None = None, closed: str | None = None,
) -> DataFrame:
    """Distinct ids per window and key with flag counts; late rows count for ``lateness`` (see ``windowed_counts``).

    ``closed`` names an event time of the windows, for stateful steps behind.
    """
    out = windowed_counts(events, ts, row_id, keys, {"handled": None, **flags}, window=window, lateness=lateness, rows=rows)
    event = [F.window_time("span").alias(closed)] if closed else []
    return out.select(ntz(F.col("span.start")).alias("ts"), *keys, "handled", *flags, *([rows] if rows else []), *event)


def stream_entering_handled(
    entering: DataFrame, handled: DataFrame, came: str, done: str, keys: Sequence[str], on: str, *, entering_id: str, handled_id: str,
    flags: Mapping[str, Column | None], sums: Mapping[str, Column], lateness: str = LATENESS,
) -> DataFrame:
    """Arrivals per hour and ``keys`` with the work of the same hour and ``on``: two streams by their own times, aggregated, then joined.

    An outer join of windows: an hour of arrivals comes out when the watermark of both streams has passed it, with NULLs where nothing
    was handled.  A NULL in ``on`` joins nothing, so such work is dropped early and does not move the watermark.  ``entering_rows`` counts the rows behind the arrivals.
    """
    arrivals = windowed_counts(entering, came, entering_id, keys, {"entering_touches": None}, lateness=lateness, rows="entering_rows")
    work = windowed_counts(handled, done, handled_id, [on], flags, sums=sums, lateness=lateness)
    work = work.select(F.col("span").alias("__span"), F.col(on).alias("__on"), *flags, *sums)
    out = arrivals.join(work, (F.col("span") == F.col("__span")) & (F.col(on) == F.col("__on")), "left")
    return out.select(ntz(F.col("span.start")).alias("ts"), *keys, "entering_touches", "entering_rows", *flags, *sums)


def uncounted_rows(landed: DataFrame, ts: str, counted: DataFrame, rows: str, window: str = "hour") -> DataFrame:
    """Rows per window that came after the watermark had passed it: ``landed`` and ``counted`` rows, and their difference ``late``.

    ``landed`` is the table of what arrived, ``counted`` the result of a stream with its number of rows.  A stream drops such rows; here
    are the windows that a reload has to build again, and how much is missing in them.
    """
    came = landed.filter(F.col(ts).isNotNull()).groupBy(trunc(window, ts).alias("ts")).agg(F.count(F.lit(1)).alias("landed"))
    known = counted.groupBy("ts").agg(F.sum(rows).alias("counted"))
    out = came.join(known, "ts", "left").withColumn("counted", F.coalesce("counted", F.lit(0)))
    return out.withColumn("late", F.col("landed") - F.col("counted")).filter("late > 0")


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all closed windows to parquet files and stop when the input is used up."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_trailing_reload(
    events: DataFrame, ts: str, row_id: str, keys: Sequence[str], flags: Mapping[str, Column], landing: str, facts_path: str, checkpoint: str, *,
    ds: date | None = None, days: int = 7,
) -> StreamingQuery:
    """Daily facts rebuilt for the days that a batch touches.

    Rows land partitioned by (day, batch); the facts of the touched days are computed again from all their landed rows and replace those
    partitions only.  With a run date ``ds`` days older than ``days`` before it are not rebuilt (``late_rows`` counts what came for
    them); without one every day is.  The cut follows from the run date alone, so the tables do not depend on how the rows are
    dealt over batches.  Rows without a time land and belong to no day.
    """
    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows = rows.withColumns({"day": F.col(ts).cast("date"), "batch": F.lit(batch_id)})
        write(rows, landing, partition_by=["day", "batch"])
        landed = spark.read.schema(rows.schema).parquet(landing)
        span = landed if ds is None else landed.filter(F.col("day") >= F.lit(str(reload_start(ds, days))).cast("date"))
        touched = span.filter(F.col("batch") == batch_id).select("day").distinct()
        again = span.join(touched, "day", "left_semi")
        facts = distinct_counts(again, ["day", *keys], row_id, {"handled": None, **flags})
        write(facts, facts_path, partition_by=["day"])

    query = events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def late_rows(spark: SparkSession, landing: str, ds: date, days: int = 7) -> DataFrame:
    """Landed rows per day that a run of ``ds`` leaves out of the facts."""
    late = spark.read.parquet(landing).filter(F.col("day") < F.lit(str(reload_start(ds, days))).cast("date"))
    return late.groupBy("day").agg(F.count(F.lit(1)).alias("rows"))
