"""Data-quality checks; each returns a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import datediff_boundary, full_match
from .metrics import with_totals
from .ordered import ordered


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows against distinct keys.  Rows with a NULL in the key are left out of both."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return (
        df.filter(present)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("distinct_keys"))
    )


def duplicates(df: DataFrame, keys: Sequence[str], min_count: int = 2) -> DataFrame:
    """All rows of keys that occur at least ``min_count`` times, with the count."""
    return with_totals(df, keys, {"key_count": ("count", F.lit(1))}).filter(F.col("key_count") >= min_count)


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys that occur on one side only, counted per side."""
    a = left.select(F.col(key)).filter(F.col(key).isNotNull()).distinct()
    b = right.select(F.col(key)).filter(F.col(key).isNotNull()).distinct()
    only_left = a.join(b, key, "left_anti").agg(F.count(F.lit(1)).alias("orphans")).withColumn("side", F.lit("left"))
    only_right = b.join(a, key, "left_anti").agg(F.count(F.lit(1)).alias("orphans")).withColumn("side", F.lit("right"))
    return only_left.union(only_right).select("side", "orphans")


def any_null(*cols: str) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def null_rows(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where any of the columns is NULL."""
    return df.filter(any_null(*cols))


def not_accepted(column: str, allowed: Sequence) -> Column:
    """Is the value outside the allowed list, or NULL?"""
    return F.coalesce(~F.col(column).isin(*allowed), F.lit(True))


def row_report(df: DataFrame, checks: Mapping[str, Column], distinct: Mapping[str, tuple[Sequence[str], Column]] | None = None) -> DataFrame:
    """One row: rows that fail each check, and the number of distinct combinations (columns, condition on the rows).

    All of it comes out of one pass: rows shrink to one per combination of the listed columns first.
    """
    distinct = dict(distinct or {})
    cols = list(dict.fromkeys(c for names, _ in distinct.values() for c in names))
    first = [F.count_if(c).alias(n) for n, c in checks.items()] + [F.max(F.when(w, 1)).alias(n) for n, (_, w) in distinct.items()]
    combos = df.groupBy(*cols).agg(*first)
    second = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in checks]
    for n, (names, _) in distinct.items():
        second.append(F.count_distinct(F.when(F.col(n) == 1, F.struct(*names))).alias(n))
    return combos.agg(*second)


def key_report(df: DataFrame, keys: Sequence[str], parent: DataFrame, parent_key: str) -> DataFrame:
    """One row about the key of ``df`` and its reference ``keys[0]`` to ``parent``, out of one pass over each.

    rows and distinct_keys (rows with a NULL in the key left out), duplicate_rows, without_child (parent keys that no row has) and
    without_parent (references that the parent does not have).
    """
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).withColumn("__whole", present)
    per_ref = per_key.groupBy(keys[0]).agg(
        F.sum(F.when(F.col("__whole"), F.col("__n"))).alias("__rows"), F.count_if("__whole").alias("__keys"),
        F.sum(F.when(F.col("__n") > 1, F.col("__n"))).alias("__twice"),
    )
    known = parent.select(F.col(parent_key).alias("__p")).filter(F.col("__p").isNotNull()).distinct()
    both = per_ref.join(known, F.col(keys[0]) == F.col("__p"), "full")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return both.agg(
        zero("__rows").alias("rows"), zero("__keys").alias("distinct_keys"), zero("__twice").alias("duplicate_rows"),
        F.count_if(F.col(keys[0]).isNull() & F.col("__p").isNotNull()).alias("without_child"),
        F.count_if(F.col(keys[0]).isNotNull() & F.col("__p").isNull()).alias("without_parent"),
    )


class Watch:
    """Checks that are counted while rows pass: use ``rows`` in place of the table, for instance in its write, then read ``result``.

    No scan of its own: the counts are Spark's observed metrics of the query that writes the rows.  ``checks`` count the rows that fail;
    ``distinct`` counts combinations (columns, condition), meant for columns of few values, as they are held in one set.  With
    ``keys`` the rows pass one shuffle by key, spread over salts, and rows, distinct_keys (rows with a NULL in the key left out) and
    duplicate_rows are counted too.
    """

    def __init__(
        self, df: DataFrame, checks: Mapping[str, Column], *, keys: Sequence[str] = (), distinct: Mapping[str, tuple[Sequence[str], Column]] | None = None
    ):
        self._seen = Observation()
        metrics = [F.count_if(c).alias(n) for n, c in checks.items()]
        metrics += [F.size(F.collect_set(F.when(w, F.to_json(F.struct(*names))))).cast("bigint").alias(n) for n, (names, w) in (distinct or {}).items()]
        passing = df
        if keys:
            passing = key_places(df, keys)
            present = ~any_null(*keys)
            metrics += [
                F.count_if(present).alias("rows"),
                F.count_if(present & (F.col("__place") == 1)).alias("distinct_keys"),
                F.count_if(F.col("__of") > 1).alias("duplicate_rows"),
            ]
        self.rows = passing.observe(self._seen, *metrics).select(*df.columns)

    @property
    def result(self) -> dict[str, int]:
        """The counts; waits for the first query that reads ``rows``."""
        return self._seen.get

    def report(self, spark: SparkSession) -> DataFrame:
        """The counts as (check_name, value) rows."""
        return spark.createDataFrame(sorted(self.result.items()), "check_name string, value bigint")


def key_places(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their place among the rows of their key (``__place``, from 1) and the number of those (``__of``)."""
    spread = F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]), F.lit(16))
    return ordered(df, keys, [], spread, totals={"__of": ("count", F.lit(1))}, number="__place")


def as_rows(report: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """A one-row report as (check_name, value) rows."""
    pairs = F.array(*[F.struct(F.lit((names or {}).get(c, c)).alias("n"), F.col(c).cast("bigint").alias("v")) for c in report.columns])
    return report.select(F.explode(pairs).alias("x")).select(F.col("x.n").alias("check_name"), F.col("x.v").alias("value"))


def distinct_values(df: DataFrame, cols: Sequence[str], where: Column | None = None) -> DataFrame:
    return (df if where is None else df.filter(where)).select(*cols).distinct()


def accepted_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Values outside the allowed list with their row counts; NULL is reported too."""
    return df.filter(not_accepted(column, allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Full join of two sources on the key with both values and their difference."""
    left = a.select(*keys, *[F.col(m).alias(f"{m}_a") for m in measures], F.lit(True).alias("__a"))
    right = b.select(*keys, *[F.col(m).alias(f"{m}_b") for m in measures], F.lit(True).alias("__b"))
    joined = left.join(right, list(keys), "full")
    side = F.when(F.col("__b").isNull(), "only_a").when(F.col("__a").isNull(), "only_b").otherwise("both")
    return joined.select(
        *keys,
        side.alias("found_in"),
        *[c for m in measures for c in (F.col(f"{m}_a"), F.col(f"{m}_b"), (F.col(f"{m}_a") - F.col(f"{m}_b")).alias(f"{m}_diff"))],
    )


def grand_total_check(detail: DataFrame, total: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One row per measure: sum of the detail, ungrouped total, equal or not.

    Both sides are one row, so laying them side by side costs nothing.
    """
    summed = detail.agg(*[F.sum(m).alias(m) for m in measures])

    def long(df: DataFrame, name: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias(name)) for m in measures])
        return df.select(F.explode(pairs).alias("p")).select("p.*")

    joined = long(summed, "detail_sum").join(long(total, "total"), "measure", "full")
    return joined.withColumn("matches", F.col("detail_sum").eqNullSafe(F.col("total")))


def conservation_check(parts: DataFrame, whole: DataFrame, key: str, part_value: str, whole_value: str) -> DataFrame:
    """Keys whose parts do not add up to the whole."""
    summed = parts.groupBy(key).agg(F.sum(part_value).alias("part_sum"))
    base = whole.groupBy(key).agg(F.sum(whole_value).alias("whole_sum"))
    return base.join(summed, key, "left").filter(~F.col("part_sum").eqNullSafe(F.col("whole_sum")))


def computed_vs_stored(df: DataFrame, start: str, end: str, stored: str, unit: str = "second") -> DataFrame:
    """Duration recomputed from the timestamps beside the stored one."""
    return df.withColumn("computed", datediff_boundary(unit, start, end)).withColumn(
        "difference", F.col("computed") - F.col(stored)
    )


def validate_patterns(df: DataFrame, column: str, patterns: Mapping[str, str]) -> DataFrame:
    """One boolean column per named pattern, matched against the whole text."""
    return df.withColumns({name: full_match(column, p) for name, p in patterns.items()})


# Accepted formats.
FORMATS = {
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,4}",
}
