"""Scans, schema contracts and table lifecycle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dialect import whole_number


def load(spark: SparkSession, directory: str, *names: str) -> dict[str, DataFrame]:
    """Named parquet tables of a directory as DataFrames."""
    return {n: spark.read.parquet(f"{directory}/{n}.parquet") for n in names}


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by its one- to three-part name."""
    return spark.table(name)


def resolve_source(tables: Mapping[str, DataFrame], routes: Mapping[str, str], tenant: str, default: str) -> DataFrame:
    """The DataFrame a tenant may read; chosen before planning."""
    return tables[routes.get(tenant, default)]


def since(df: DataFrame, ts: str, day: str) -> DataFrame:
    """Fixed date cut as a range on the raw column, so it reaches the scan."""
    return df.filter(F.col(ts) >= F.lit(day).cast("timestamp_ntz"))


def in_years(df: DataFrame, ts: str, first: int, last: int | None = None) -> DataFrame:
    """``YEAR(ts) BETWEEN first AND last`` as a pushed-down range."""
    out = df.filter(F.col(ts) >= F.lit(f"{first}-01-01").cast("timestamp_ntz"))
    return out if last is None else out.filter(F.col(ts) < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz"))


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """The first rows; of an ordered output each task keeps its first ``n`` only."""
    return df.limit(n)


def ordered_output(df: DataFrame, *order: tuple[str, str, str], place: str | None = None) -> DataFrame:
    """The rows sorted by (column, "asc" or "desc", NULLs "first" or "last"); the sort is by ranges over all tasks.

    ``place`` numbers the rows of a report; a report has one row per group, so that its numbering is a small step.
    """
    keys = [getattr(F.col(c), f"{way}_nulls_{nulls}")() for c, way, nulls in order]
    if place:
        df = df.withColumn(place, F.row_number().over(Window.orderBy(*keys)))
    return df.orderBy(*keys)


def lookup(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Rows of the given keys; NULL in the list matches nothing."""
    return df.filter(F.col(key).isin(*[v for v in values if v is not None]))


def describe(df: DataFrame) -> list[tuple[str, str, str | None]]:
    """(column, type, comment) of a DataFrame."""
    return [(f.name, f.dataType.simpleString(), f.metadata.get("comment")) for f in df.schema.fields]


def profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, rows, nulls, distinct_values) of every column, out of one pass.

    A row gives one (column, value) pair per column; pairs are counted with a map-side combine, so no column is gathered.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v")) for i, (c, _, _) in enumerate(describe(df))])
    values = df.select(F.explode(pairs).alias("x")).groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("data_type")) for c, kind, _ in describe(df)])
    out = values.groupBy("i").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.count("v").alias("distinct_values")
    )
    return out.select(F.get(names, F.col("i"))["column_name"].alias("column_name"), F.get(names, F.col("i"))["data_type"].alias("data_type"), "rows", "nulls", "distinct_values")


_KINDS = {k.typeName(): k() for k in (T.StringType, T.DateType, T.DoubleType, T.BooleanType, T.TimestampNTZType, T.LongType)}


def schema(*fields: tuple[str, str | T.DataType, str]) -> T.StructType:
    """Contract from (name, type or simple type name, comment)."""
    out = T.StructType()
    for name, kind, comment in fields:
        out = out.add(T.StructField(name, _KINDS[kind] if isinstance(kind, str) else kind, True, {"comment": comment}))
    return out


def conform(df: DataFrame, contract: T.StructType, positional: bool = False) -> DataFrame:
    """Cast and order the columns of ``df`` by the contract (by name, or by position)."""
    if positional and len(df.columns) != len(contract.fields):
        raise ValueError(f"{len(df.columns)} columns for {len(contract.fields)} fields")
    cols = []
    for i, f in enumerate(contract.fields):
        src = F.col(f"`{df.columns[i]}`") if positional else F.col(f"`{f.name}`")
        have = df.schema[df.columns[i] if positional else f.name].dataType
        if isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0 and isinstance(have, (T.DoubleType, T.FloatType)):
            src = whole_number(src)
        cols.append(src.cast(f.dataType).alias(f.name, metadata=f.metadata))
    return df.select(*cols)


def empty(spark: SparkSession, contract: T.StructType) -> DataFrame:
    return spark.createDataFrame([], contract)


def create_if_absent(spark: SparkSession, path: str, contract: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``; an empty one with the columns of the contract if there is none."""
    try:
        return spark.read.format(fmt).schema(contract).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    empty(spark, contract).write.format(fmt).save(path)
    return spark.read.format(fmt).schema(contract).load(path)


def write(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), fmt: str = "parquet", full_refresh: bool = False
) -> None:
    """Create-or-replace (``overwrite``) or insert (``append``) as a file table.

    With ``partition_by`` only the partitions present in ``df`` are replaced (dynamic
    overwrite), or the whole table with ``full_refresh``.  Rows of a partition value are brought together first, so that it does not
    end in one small file per task; the rebalance splits a value that is too large for one.
    """
    if not partition_by:
        df.write.mode(mode).format(fmt).save(path)
        return
    together = df.hint("rebalance", *[F.col(c) for c in partition_by])
    extent = "static" if full_refresh else "dynamic"
    together.write.mode(mode).format(fmt).option("partitionOverwriteMode", extent).partitionBy(*partition_by).save(path)


def reload_start(ds: date, days: int = 7) -> date:
    return ds - timedelta(days=days)


def trailing_filter(ts: str | Column, ds: date, days: int = 7, full: bool = False, as_of: date | None = None) -> Column:
    """Rows a run of day ``ds`` rebuilds: the last ``days`` days, or all up to today on a full run."""
    at = F.col(ts) if isinstance(ts, str) else ts
    if full:
        end = as_of or ds
        return at < F.lit(str(end + timedelta(days=1))).cast("timestamp_ntz")
    return at >= F.lit(str(reload_start(ds, days))).cast("timestamp_ntz")


def trailing_reload(
    existing: DataFrame, fresh: DataFrame, ts: str, ds: date, days: int = 7, full: bool = False, as_of: date | None = None
) -> DataFrame:
    """Delete the trailing days from ``existing`` and put the fresh rows of that span in.

    Rows without a time are in no span: existing ones stay, as a DELETE leaves them, and fresh ones are not inserted.
    """
    stale = F.coalesce(trailing_filter(ts, ds, days, full, as_of), F.lit(False))
    return existing.filter(~stale).unionByName(fresh.filter(stale))


def reload_partitions(fresh: DataFrame, path: str, ts: str, ds: date, days: int = 7, day_col: str = "ds") -> None:
    """Same on a table partitioned by day: only the trailing partitions are rewritten.

    The write is idempotent: a run repeated after a lost executor or driver gives the same
    table, and older partitions are never read.
    """
    span = fresh.filter(trailing_filter(ts, ds, days)).withColumn(day_col, F.col(ts).cast("date"))
    write(span, path, "overwrite", [day_col])


def update_where(df: DataFrame, pred: Column, values: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE: rows where the predicate is not true keep their values."""
    return df.withColumns({c: F.when(pred, v).otherwise(F.col(c)) for c, v in values.items()})


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def add_column(df: DataFrame, name: str, kind: str = "string") -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(kind))


def text_times(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, for reports compared across engines."""
    out = {}
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind == "date":
            out[f.name] = F.date_format(F.col(f.name), "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            out[f.name] = F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(out) if out else df
