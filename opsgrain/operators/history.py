"""Change logs: change points, stays, paths, event pairs, first and latest rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dialect import add, datediff_boundary
from .metrics import with_totals
from .ordered import asof_lookup, ordered, time_chunk


def compact_changes(df: DataFrame, key: str, ts: str, value: str, tie: Sequence[str] = (), chunk: str = "day") -> DataFrame:
    """Drop rows whose value equals that of the row before (change points stay).

    A NULL value never equals anything, so NULL rows stay, as a plain comparison does.
    """
    out = ordered(
        df.filter(F.col(key).isNotNull()), [key], [ts, *tie], time_chunk(ts, chunk), lag={"__before": F.col(value)}
    )
    same = F.coalesce(F.col(value) == F.col("__before"), F.lit(False))
    return out.filter(~same).drop("__before")


def to_intervals(
    df: DataFrame,
    key: str,
    ts: str,
    *,
    tie: Sequence[str] = (),
    number: str = "seq",
    end: str = "end_time",
    gap_seconds: int = 1,
    chunk: str = "day",
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Number the rows of a key and close each at the next start minus ``gap_seconds``.

    ``carry`` adds values of the previous row under the given names.
    """
    out = ordered(
        df,
        [key],
        [ts, *tie],
        time_chunk(ts, chunk),
        lead={"__next": F.col(ts)},
        lag=carry,
        number=number,
    )
    return out.withColumn(end, add("second", -gap_seconds, "__next")).drop("__next")


def path_steps(df: DataFrame, key: str, seq: str, value: str) -> DataFrame:
    """The path of a key as rows (key, step, value, prior_steps, later_steps, is_last).

    The prior and the later path of a step are the rows of the key with a smaller and a larger step, so the size of the result is
    that of the input; as text in every row it would grow with the square of a key's rows.  Steps count 1, 2, ... per key.
    """
    last = with_totals(df.select(key, seq, value), [key], {"__last": ("max", F.col(seq))})
    return last.select(
        key, F.col(seq).alias("step"), F.col(value).alias("value"), (F.col(seq) - 1).cast("bigint").alias("prior_steps"),
        (F.col("__last") - F.col(seq)).cast("bigint").alias("later_steps"), (F.col(seq) == F.col("__last")).alias("is_last"),
    )


def transition_type(
    kind: str | Column,
    name: str | Column,
    prev_kind: Column,
    prev_name: Column,
    seq: Column,
    *,
    auto_response: str,
    same_kind: str = "CS",
    same_name: str = "RISK",
    related: Sequence[str] = ("ATO", "LOCK"),
) -> tuple[Column, Column]:
    """(from_kind, transfer_kind) of a move between queues; the first rule that holds decides."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    name = F.col(name) if isinstance(name, str) else name
    from_kind = F.when(prev_name == auto_response, "OMNI").when(seq == 1, "FIRST QUEUE").otherwise(prev_kind)

    def mentions(text: Column) -> Column:
        out = F.lit(False)
        for word in related:
            out = out | text.contains(word)
        return out

    transfer = (
        F.when(from_kind.isin("FIRST QUEUE", "OMNI"), from_kind)
        .when((from_kind == same_kind) & (kind == prev_kind), "INTERNAL TRANSFER")
        .when((from_kind == same_name) & (name == prev_name), "INTERNAL TRANSFER")
        .when(mentions(name) & mentions(prev_name), "INTERNAL TRANSFER")
        .otherwise("EXTERNAL TRANSFER")
    )
    return from_kind, transfer


def elapsed_until(
    df: DataFrame, key: str, ts: str, duration: str, out: str = "elapsed_before", tie: Sequence[str] = (), chunk: str = "day"
) -> DataFrame:
    """Sum of the durations of all earlier rows of the key (0 on the first)."""
    total = ordered(df, [key], [ts, *tie], time_chunk(ts, chunk), running={"__run": F.coalesce(F.col(duration), F.lit(0))})
    return total.withColumn(out, F.col("__run") - F.coalesce(F.col(duration), F.lit(0))).drop("__run")


def field_to_columns(df: DataFrame, keys: Sequence[str], field: str, value: str, fields: Mapping[str, str]) -> DataFrame:
    """MAX(value) of each named field as a column, one row per key."""
    return (
        df.filter(F.col(field).isin(*fields.values()))
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col(field) == f, F.col(value))).alias(out) for out, f in fields.items()])
    )


def pivot_max(df: DataFrame, keys: Sequence[str], field: str, value: str, values: Sequence[str]) -> DataFrame:
    """PIVOT (MAX(value) FOR field IN (values)); groups without any listed field stay."""
    return df.groupBy(*keys).pivot(field, list(values)).agg(F.max(value))


def event_duration(
    df: DataFrame, keys: Sequence[str], event: str, ts: str, start_event: str, end_event: str, out: str = "duration_seconds"
) -> DataFrame:
    """Latest start and end event per key and the seconds between; keys without either stay."""
    def latest(name: str) -> Column:
        return F.max(F.when(F.col(event) == name, F.col(ts)))

    both = df.groupBy(*keys).agg(latest(start_event).alias("start_ts"), latest(end_event).alias("end_ts"))
    return both.withColumn(out, datediff_boundary("second", "start_ts", "end_ts"))


def pair_events(
    starts: DataFrame, ends: DataFrame, keys: Sequence[str], start_ts: str, end_ts: str, cols: Mapping[str, str], tie: Sequence[str] = ()
) -> DataFrame:
    """Each start with the next end of the same key at or after it, and the seconds between.

    Starts without an end are left out.  Linear in the rows of a key; with one start and one
    end per key this is the plain self join on the key.
    """
    out = asof_lookup(starts, ends, keys, start_ts, end_ts, {**cols, "__end": end_ts}, tie=tie, direction="forward")
    out = out.filter(F.col("__end").isNotNull())
    return out.withColumn("duration_seconds", datediff_boundary("second", start_ts, "__end")).drop("__end")


def pick_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    ROW_NUMBER() = 1 is planned as a group limit, so each map task sends at most one row
    per key and a hot key costs no more than a cold one.  Write null order explicitly.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def nulls_last(*columns: str) -> list[Column]:
    """Ranks that put NULL behind every value in an ascending comparison."""
    return [c for name in columns for c in (F.col(name).isNull(), F.col(name))]


def first_and_count(df: DataFrame, keys: Sequence[str], rank: Sequence[Column], count: str) -> DataFrame:
    """First row per key by ascending ranks, and the number of rows of the key, out of one aggregate with a map-side combine."""
    rest = [F.col(c) for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)]))
    return df.groupBy(*keys).agg(best.alias("__first"), F.count(F.lit(1)).alias(count)).select(*keys, "__first.*", count)


def first_event(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    return pick_row(df, keys, [F.col(ts).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie]])


def latest_event(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    return pick_row(df, keys, [F.col(ts).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie]])


def latest_version(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """All rows that carry the highest version of their key (ties stay)."""
    top = df.groupBy(*keys).agg(F.max(version).alias("__top"))
    return df.join(top, list(keys), "inner").filter(F.col(version) == F.col("__top")).drop("__top").select(*df.columns)


def explode_lineage(df: DataFrame, list_text: str, keep: Sequence[str] = (), prefix: str = "source") -> DataFrame:
    """Text like ``["a.b.c", "d.e.f"]`` -> distinct rows with address and its three parts."""
    names = F.from_json(F.col(list_text), "array<string>")
    return split_address(df.select(*keep, F.explode(names).alias("__a")), "__a", keep, prefix)


def split_address(df: DataFrame, address: str, keep: Sequence[str] = (), prefix: str = "target") -> DataFrame:
    """Three-part table address -> distinct (address, database, schema, table)."""
    a = F.col(address)

    def part(n: int) -> Column:
        return F.split_part(a, F.lit("."), F.lit(n))

    return df.select(
        *keep,
        a.alias(f"{prefix}_table_address"),
        part(1).alias(f"{prefix}_database_name"),
        part(2).alias(f"{prefix}_schema_name"),
        part(3).alias(f"{prefix}_table_name"),
    ).distinct()
