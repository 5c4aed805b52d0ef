"""Service-level, volume and rate metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dialect import col, percent_text, safe_ratio
from .ordered import spread_totals


def distinct_counts(
    df: DataFrame,
    keys: Sequence[str],
    row_id: str,
    flags: Mapping[str, Column | None],
    *,
    sums: Mapping[str, Column] | None = None,
    avgs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """COUNT(DISTINCT id) and several COUNT(DISTINCT CASE WHEN flag THEN id END) per group.

    Rows first shrink to one per (group, id) with the flags or-ed together, then the flags
    are summed.  Both steps combine on the map side and the first one spreads a hot group
    over its ids; the multi-distinct plan would copy each row once per flag instead.
    A flag of ``None`` counts all ids.  ``sums``/``avgs`` are over the rows, not the ids.
    """
    sums, avgs = dict(sums or {}), dict(avgs or {})
    present = F.col(row_id).isNotNull()
    first = [
        F.max(F.when(present & (F.lit(True) if c is None else c), 1).otherwise(0)).alias(f"__f_{n}")
        for n, c in flags.items()
    ]
    first += [F.sum(c).alias(f"__s_{n}") for n, c in sums.items()]
    for n, c in avgs.items():
        first += [F.sum(c).alias(f"__as_{n}"), F.count(c).alias(f"__ac_{n}")]
    second = [F.coalesce(F.sum(f"__f_{n}"), F.lit(0)).cast("bigint").alias(n) for n in flags]
    second += [F.sum(f"__s_{n}").alias(n) for n in sums]
    second += [safe_ratio(F.sum(f"__as_{n}"), F.sum(f"__ac_{n}")).alias(n) for n in avgs]
    return df.groupBy(*keys, row_id).agg(*first).groupBy(*keys).agg(*second)


def backlog_flag(assigned: str | Column, started: str | Column, in_hours: str | Column) -> Column:
    """Handled on another day than it arrived, or arrived out of hours."""
    return (col(assigned).cast("date") != col(started).cast("date")) | ~col(in_hours)


def concurrency(lifetime: str | Column, handle: str | Column) -> Column:
    return safe_ratio(lifetime, handle)


def sla_metrics(
    df: DataFrame,
    keys: Sequence[str],
    row_id: str,
    *,
    in_sla: Column,
    qualified: Column | None = None,
    handled: Column | None = None,
    extra: Mapping[str, Column | None] | None = None,
    sums: Mapping[str, Column] | None = None,
    avgs: Mapping[str, Column] | None = None,
    scale: float = 100,
    digits: int | None = None,
) -> DataFrame:
    """handled, in_sla, qualified and sla_pct per group."""
    out = distinct_counts(
        df, keys, row_id, {"handled": handled, "in_sla": in_sla, "qualified": qualified, **(extra or {})}, sums=sums, avgs=avgs
    )
    return out.withColumn("sla_pct", safe_ratio("in_sla", "qualified", scale, digits))


def entering_handled(entering: DataFrame, handled: DataFrame, on: Sequence[str]) -> DataFrame:
    """Volume by arrival, left joined to work by handling time.  Both sides are aggregates."""
    return entering.join(handled, list(on), "left")


def trailing_ratio(df: DataFrame, num: str, den: str, order: str, out: str, n: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """Ratio of the sums over the last ``n`` rows.  ``df`` is one row per period."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, safe_ratio(F.sum(num).over(w), F.sum(den).over(w)))


def confusion_rates(df: DataFrame, keys: Sequence[str], truth: Column, pred: Column, row_id: str | None = None) -> DataFrame:
    """tp, fn, fp, recall and precision; counts rows, or distinct ids when ``row_id`` is given."""
    cells = {"tp": (truth == 1) & (pred == 1), "fn": (truth == 1) & (pred == 0), "fp": (truth == 0) & (pred == 1)}
    if row_id is None:
        out = df.groupBy(*keys).agg(*[F.count(F.when(c, 1)).alias(n) for n, c in cells.items()])
    else:
        out = distinct_counts(df, keys, row_id, cells)
    return out.withColumns(
        {
            "recall": safe_ratio("tp", F.col("tp") + F.col("fn")),
            "precision": safe_ratio("tp", F.col("tp") + F.col("fp")),
        }
    )


def expected_rate(alert_rate: str | Column, precision: str | Column, recall: str | Column) -> Column:
    return safe_ratio(col(alert_rate) * col(precision), recall)


def threshold_alerts(
    df: DataFrame,
    ts: str,
    pct: str,
    volume: str,
    *,
    drop: float = 10,
    floor: float = 25,
    ceiling: float = 12000,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Previous value of ``pct`` and three alerts; a NULL comparison raises none.

    ``df`` holds one row per interval (and key), so the window is over a bounded calendar.
    """
    df = df.withColumn(f"prev_{pct}", F.lag(pct).over(Window.partitionBy(*keys).orderBy(ts)))
    return alert_flags(df, pct, volume, drop=drop, floor=floor, ceiling=ceiling)


def alert_flags(df: DataFrame, pct: str, volume: str, *, drop: float = 10, floor: float = 25, ceiling: float = 12000) -> DataFrame:
    """The three alerts of rows that know the previous value of ``pct``; a NULL comparison raises none."""

    def sure(cond: Column) -> Column:
        return F.coalesce(cond, F.lit(False))

    return df.withColumns(
        {
            "alert_drop": sure(F.col(f"prev_{pct}") - F.col(pct) >= drop),
            "alert_volume": sure(F.col(volume) > ceiling),
            "alert_floor": sure(F.col(pct) < floor),
        }
    )


def with_totals(df: DataFrame, keys: Sequence[str], totals: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Add aggregates ("sum", "max", "min" or "count", column) of the row's group, as ``agg() OVER (PARTITION BY keys)`` does.

    The rows of a group are spread over salts that are summed up, so a hot group is never gathered in one task, and rows
    and sums come out of one shuffle, so the input is built once.  NULL keys form a group.
    """
    return spread_totals(df, keys, totals)


def share_of_total(df: DataFrame, part_keys: Sequence[str], total_keys: Sequence[str], value: str, digits: int = 2) -> DataFrame:
    """One row per part: its sum, the sum of the wider group and the share in percent.

    The wider sums are built from the part sums, so the base rows are shuffled once.
    """
    parts = df.groupBy(*part_keys).agg(F.sum(value).alias("part_sum"))
    out = with_totals(parts, total_keys, {"total_sum": ("sum", F.col("part_sum"))})
    return out.withColumn("share_pct", safe_ratio("part_sum", "total_sum", 100, digits))


def percent_of_total(df: DataFrame, measure: str, out: str, digits: int | None = None) -> DataFrame:
    """Share of each result row in the sum over all result rows."""
    total = with_totals(df, [], {"__total": ("sum", F.col(measure))})
    return total.withColumn(out, safe_ratio(measure, "__total", 1, digits)).drop("__total")


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One-row aggregates laid into one row.

    The rows are stacked with NULLs for the columns of the others and folded, so nothing is
    joined.
    """
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def mixed_group_rows(df: DataFrame, keys: Sequence[str], kind: str, minimum: int = 2) -> DataFrame:
    """Rows of groups that hold at least ``minimum`` kinds (NULL is a kind).  One row per kind expected."""
    totals = with_totals(df, keys, {"__kinds": ("count", F.lit(1))})
    return totals.filter(F.col("__kinds") >= minimum).drop("__kinds")


def coverage_gap(left: DataFrame, right: DataFrame, key: str, by: Column, by_name: str) -> DataFrame:
    """Distinct left ids without a right row, per period, with the rate as text."""
    known = right.select(F.col(key).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
    joined = left.withColumn(by_name, by).join(known, F.col(key) == F.col("__k"), "left")
    out = distinct_counts(joined, [by_name], key, {"missing": F.col("__k").isNull(), "total": None})
    return with_rate(out)


def null_key_gap(df: DataFrame, key: str, by: Column, by_name: str) -> DataFrame:
    """Rows whose reference key is NULL, per period."""
    out = df.groupBy(by.alias(by_name)).agg(
        F.count_if(F.col(key).isNull()).alias("missing"), F.count(F.lit(1)).alias("total")
    )
    return with_rate(out)


def with_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("missing_rate", percent_text(safe_ratio("missing", "total", 100)))
