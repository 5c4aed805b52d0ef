"""Streams with state of their own per key: alerts against the hour before, stays from a change log, matches within a tolerance."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.dialect import ntz, safe_ratio
from ..operators.metrics import alert_flags
from ..operators.ordered import epoch_micros

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Settings of a query that joins streams: one store for the four tables of a join's state, and no count of its rows, which reads before each write.
JOINS = {"spark.sql.streaming.join.stateFormatVersion": "3", "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


@contextmanager
def state_on_disk(spark: SparkSession, conf: Mapping[str, str] | None = None) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which state of own kinds needs, with the settings ``conf``; the session's settings come back."""
    wanted = {_PROVIDER: _ROCKS, **(conf or {})}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def append_to(stream: DataFrame, path: str, checkpoint: str, conf: Mapping[str, str] | None = None) -> StreamingQuery:
    """Append the rows of a stream to parquet files, each exactly once, and stop when the input is used up."""
    with state_on_disk(stream.sparkSession, conf):
        query = (
            stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return query


# -- alerts ------------------------------------------------------------------------------------


class _HourBefore(StatefulProcessor):
    """One value per key: the percentage of its last hour.  A timer forgets a key that has been silent for ``idle``."""

    def __init__(self, idle: timedelta, columns: Sequence[str]):
        self.idle, self.columns = int(idle.total_seconds() * 1000), [*columns, "prev_sla_pct"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "sla_pct double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        hours = pd.concat(list(rows)).sort_values("ts")
        known = self.last.get() if self.last.exists() else None
        hours["prev_sla_pct"] = hours["sla_pct"].shift(1)
        if known is not None:
            hours.iloc[0, hours.columns.get_loc("prev_sla_pct")] = known[0]
        pct, ended = hours["sla_pct"].iloc[-1], hours["ts"].iloc[-1]
        self.last.update((None if pd.isna(pct) else float(pct),))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(ended.value // 1_000_000 + self.idle)
        yield hours[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_alerts(
    hourly: DataFrame, *, keys: Sequence[str] = (), drop: float = 10, floor: float = 25, ceiling: float = 12000, idle: timedelta = timedelta(days=400)
) -> DataFrame:
    """The hours of ``hourly`` with their percentage, that of the hour before and the alerts.

    ``hourly`` is a stream of closed hours (``stream_sla``) with ts, handled, in_sla, qualified and an event time.  Windows close in order, so the
    hour before is the last one seen of the key, in this batch or in the state, which is one number per key.  A
    key without an hour for ``idle`` is forgotten, and its next hour has none before it.
    """
    event = next(f.name for f in hourly.schema.fields if "spark.watermarkDelayMs" in (f.metadata or {}))
    cols = ["ts", *keys, "handled", "in_sla", "qualified"]
    rated = hourly.select(*cols, F.col(event).alias("__event")).withColumn("sla_pct", safe_ratio("in_sla", "qualified", 100, 2).cast("double"))
    # NULL is a key like any other
    rated = rated.withColumn("__key", F.to_json(F.struct(*keys)) if keys else F.lit(""))
    kinds = ", ".join(f"`{c}` {rated.schema[c].dataType.simpleString()}" for c in [*cols, "sla_pct"])
    out = rated.groupBy("__key").transformWithStateInPandas(
        statefulProcessor=_HourBefore(idle, [*cols, "sla_pct"]), outputStructType=f"{kinds}, prev_sla_pct double", outputMode="Append", timeMode="EventTime"
    )
    return alert_flags(out, "sla_pct", "handled", drop=drop, floor=floor, ceiling=ceiling)


# -- stays -------------------------------------------------------------------------------------


def _packed(rows: pd.DataFrame, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(pa.Table.from_pandas(rows, schema=schema, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(parts: Sequence[bytes], schema: pa.Schema) -> pd.DataFrame:
    tables = [pa.ipc.open_stream(bytes(p)).read_all() for p in parts]
    return (pa.concat_tables(tables) if tables else schema.empty_table()).to_pandas()


class _Stays(StatefulProcessor):
    """Per bucket of keys: the rows that an earlier one may still precede, and the open stay (number, value, start, row) of each key.

    Both are kept as packed tables, and all keys of a bucket are worked off together: a call and its round trips to the state cost some
    milliseconds, whatever is in them.
    """

    def __init__(self, ties: int, gap: int):
        self.order, self.gap = ["at", *[f"tie{i}" for i in range(ties)], "held"], gap
        kinds = {"key": pa.string(), "at": pa.int64(), **dict.fromkeys(self.order[1:-1], pa.float64()), "held": pa.string(), "value": pa.string()}
        self.waiting = pa.schema(kinds)
        self.stays = pa.schema({"key": pa.string(), "number": pa.int64(), "value": pa.string(), "at": pa.int64(), "held": pa.string()})

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "rows binary")
        self.open = handle.getValueState("open", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [(_packed(part[self.waiting.names], self.waiting),) for part in rows]
        return self.release(new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self.release([], timerValues.getCurrentWatermarkInMs())

    def release(self, new: list[tuple[bytes]], watermark: int) -> Iterator[pd.DataFrame]:
        """Work off the rows before the watermark, in order."""
        held = _unpacked([r[0] for r in [*self.pending.get(), *new]], self.waiting)
        sure = held["at"] < watermark * 1000
        wait = held[~sure]
        if not sure.any():
            if new:
                self.pending.appendList(new)
        elif len(wait):
            self.pending.put([(_packed(wait, self.waiting),)])
        else:
            self.pending.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(wait):
            self.handle.registerTimer(int(wait["at"].min()) // 1000 + 1)
        if sure.any():
            yield self.log(held[sure])

    def log(self, moves: pd.DataFrame) -> pd.DataFrame:
        """The stays that ``moves`` end and begin; the last one of each key stays open."""
        known = _unpacked([self.open.get()[0]] if self.open.exists() else [], self.stays)
        touched = known["key"].isin(moves["key"])
        # the open stay of a key is the row before its moves
        rows = pd.concat([known[touched].assign(begins=0), moves.assign(begins=1)], ignore_index=True)
        rows = rows.sort_values(["key", "begins", *self.order], na_position="first", ignore_index=True)
        again = (rows["key"] == rows["key"].shift()) & rows["value"].notna() & (rows["value"] == rows["value"].shift())
        rows = rows[~again].reset_index(drop=True)
        stay = rows.groupby("key")
        rows["number"] = (stay["number"].transform("first").fillna(1) + stay.cumcount()).astype("int64")
        rows["until"] = rows["at"].astype("Int64").groupby(rows["key"]).shift(-1) - self.gap
        last = rows["until"].isna()
        self.open.update((_packed(pd.concat([known[~touched], rows.loc[last, known.columns]], ignore_index=True), self.stays),))
        return rows.loc[~last | (rows["begins"] == 1), ["key", "number", "held", "until"]]

    def close(self) -> None:
        pass


_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def stream_stays(
    moves: DataFrame, key: str, ts: str, value: str, *, tie: Sequence[str] = (), lateness: str = "7 days", gap_seconds: int = 1, buckets: int = 512
) -> DataFrame:
    """A log of stays from a stream of moves: a row when a stay begins and one when it ends (``stays_of`` makes the table of it).

    The change points are those of ``compact_changes`` and the ends those of ``to_intervals``, however the moves are dealt over batches: a move waits in
    the state of its key until the watermark has passed it, then it is worked off in order of time and ``tie`` (numbers).  Besides the
    waiting rows the state of a key is its open stay.  Moves later than ``lateness`` do not count.

    Keys share ``buckets`` by their hash, and Python is called once per bucket and batch.  A batch reads and writes the state of the buckets it touches,
    and a bucket has to fit a Python worker: more keys, or small batches over many keys, want more buckets.  A checkpoint keeps its number.
    """
    known = moves.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    rows = known.select(
        F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).alias("bucket"),
        F.col(key).cast("string").alias("key"),
        F.col(ts).cast("timestamp").alias("event"),
        epoch_micros(F.col(ts)).alias("at"),
        *[F.col(t).cast("double").alias(f"tie{i}") for i, t in enumerate(tie)],
        F.to_json(F.struct(*moves.columns), _JSON).alias("held"),
        F.col(value).cast("string").alias("value"),
    )
    return rows.withWatermark("event", lateness).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_Stays(len(tie), gap_seconds * 1_000_000),
        outputStructType="key string, number bigint, held string, until bigint", outputMode="Append", timeMode="EventTime",
    )


def stays_of(log: DataFrame, moves: DataFrame, number: str, end: str) -> DataFrame:
    """The stays of a log of ``stream_stays``: the columns of ``moves`` with the number of the stay and its end, NULL while it is open."""
    rows = log.groupBy("key", "number").agg(F.max("until").alias("until"), F.any_value("held").alias("held"))
    held = F.from_json("held", moves.schema.simpleString(), _JSON)
    return rows.select(held.alias("row"), F.col("number").cast("int").alias(number), ntz(F.timestamp_micros("until")).alias(end)).select("row.*", number, end)


# -- matches -----------------------------------------------------------------------------------


def stream_match(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, cols: Mapping[str, str], *, row_id: str, before_seconds: int,
    after_seconds: int, prefer: Column | None = None, tie: Sequence[str] = (), count: str | None = None, weight: str | None = None, lateness: str = "1 day",
) -> DataFrame:
    """``tolerance_scan`` on streams: ``row_id``, ``cols`` and ``count`` of the best right row within the tolerance of each left row.

    An interval join of both streams, whose state goes back as far as tolerance and lateness reach and no further, then the best
    pair per left row, which comes out when the watermark has passed it.  Left rows without a match come out with NULLs; those with a NULL key
    or time do not.  ``weight`` names a column of ``right`` with the number of rows that a row counts for.

    Rows meet by key and stretch of time, so that a left row is held against the rows near it and not against all rows of its key: a stretch is as long as
    the tolerance, a left row is in the two that its tolerance touches, a right row in one.
    """
    good = F.lit(True) if prefer is None else F.coalesce(prefer, F.lit(False))
    span = max(1, before_seconds + after_seconds) * 1_000_000
    stretch = lambda ts, seconds: F.floor((epoch_micros(F.col(ts)) + F.lit(seconds * 1_000_000)) / F.lit(span))
    lefts = left.filter(F.col(key).isNotNull() & F.col(left_ts).isNotNull()).select(
        F.col(key).alias("__key"), F.col(row_id).alias("__id"), F.col(left_ts).cast("timestamp").alias("__at"),
        F.explode(F.sequence(stretch(left_ts, -before_seconds), stretch(left_ts, after_seconds))).alias("__span"),
    )
    rank = [F.when(good, 0).otherwise(1).alias("good"), F.col(right_ts).alias("ts"), *[F.col(t).alias(f"tie{i}") for i, t in enumerate(tie)]]
    rights = right.filter(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(key).alias("__rkey"), F.col(right_ts).cast("timestamp").alias("__rat"), stretch(right_ts, 0).alias("__rspan"),
        (F.lit(1) if weight is None else F.col(weight)).cast("bigint").alias("__w"),
        F.struct(*rank, *[F.col(src).alias(f"__{out}") for out, src in cols.items()]).alias("__hit"),
    )
    near = F.expr(f"__rkey = __key and __rspan = __span and __rat >= __at - interval {before_seconds} seconds and __rat <= __at + interval {after_seconds} seconds")
    pairs = lefts.withWatermark("__at", lateness).join(rights.withWatermark("__rat", lateness), near, "left")
    best = pairs.groupBy("__at", "__id").agg(F.min("__hit").alias("__hit"), F.coalesce(F.sum("__w"), F.lit(0)).alias("__n"))
    found = [F.col("__hit")[f"__{out}"].alias(out) for out in cols]
    return best.select(F.col("__id").alias(row_id), *found, *([F.col("__n").alias(count)] if count else []))
