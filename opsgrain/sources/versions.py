"""Published tables: a version is a list of partition folders, so a run copies only the partitions that it rewrites.

Below the folder of a table:

* ``data/__v=<version>/<partitions>``: what each version wrote;
* ``versions/<version>``: its partitions, each with the version that wrote it, the partition columns and the schema;
* ``CURRENT``: the name of the published version, replaced by one rename.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import UTC, date, datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .tables import reload_start, trailing_filter, write

_CURRENT, _NULL = "CURRENT", "__HIVE_DEFAULT_PARTITION__"


class ChangedMeanwhile(RuntimeError):
    """Another version was published since this one began."""


@dataclass(frozen=True)
class Version:
    """``folders``: partition path (empty for a table without partitions) to the version that wrote it."""

    name: str
    partition_by: list[str]
    fmt: str
    schema: str
    folders: dict[str, str]


class _Store:
    """Small files of the store that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.conf, self.gateway = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self.files = self.hadoop.Path(path).getFileSystem(self.conf)

    def read(self, path: str) -> str | None:
        at = self.hadoop.Path(path)
        if not self.files.exists(at):
            return None
        stream = self.files.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        out = self.files.create(self.hadoop.Path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def rename(self, old: str, new: str) -> None:
        """Replace ``new`` at once."""
        context = self.hadoop.FileContext.getFileContext(self.files.getUri(), self.conf)
        options = self.gateway.new_array(self.hadoop.Options.Rename, 1)
        options[0] = self.gateway.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(self.hadoop.Path(old), self.hadoop.Path(new), options)

    def names(self, path: str, folders: bool) -> list[str]:
        at = self.hadoop.Path(path)
        if not self.files.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self.files.listStatus(at) if s.isDirectory() == folders)

    def delete(self, path: str) -> None:
        self.files.delete(self.hadoop.Path(path), True)


def _partitions(store: _Store, root: str, depth: int) -> list[str]:
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}".lstrip("/") for f in found for n in store.names(f"{root}/{f}".rstrip("/"), True) if "=" in n]
    return found


def values_of(folder: str) -> dict[str, str | None]:
    """Partition columns of a partition path, as text."""
    pairs = (part.partition("=") for part in folder.split("/") if part)
    return {unquote(name): None if value == _NULL else unquote(value) for name, _, value in pairs}


def current_version(spark: SparkSession, production: str) -> str | None:
    """Name of the published version, or None."""
    return _Store(spark, production).read(f"{production}/{_CURRENT}")


def version(spark: SparkSession, production: str, name: str | None = None) -> Version:
    """The version of that name, or the published one."""
    store = _Store(spark, production)
    name = name or store.read(f"{production}/{_CURRENT}")
    if name is None:
        raise FileNotFoundError(f"nothing is published at {production}")
    text = store.read(f"{production}/versions/{name}")
    if text is None:
        raise FileNotFoundError(f"{production} has no version {name}")
    return Version(**json.loads(text))


def _schema(held: Version) -> T.StructType:
    return T.StructType.fromJson(json.loads(held.schema))


def _columns(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def publish(
    df: DataFrame, production: str, partition_by: Sequence[str] = (), fmt: str = "parquet", keep: int = 2,
    replaces: Callable[[Mapping[str, str | None]], bool] | None = None, gate: Callable[[], None] | None = None,
) -> str:
    """Publish ``df`` as the new version of the production table; returns the version.

    Without ``replaces`` the version is ``df``.  With it, it is ``df`` and the partitions of the published version for whose values
    ``replaces`` is not true; those are taken over by name, and neither read nor copied.  A partition that both have is the new one.

    The files and the list are written first; then the pointer file is replaced by a rename, which readers see all at once or not
    at all.  A failure before that leaves the published version as it was, and a version that another run published meanwhile is not
    lost: the run that comes second fails.  ``gate`` is called when the files are written (``operators.quality.Watch`` has counted the rows by
    then); if it raises, nothing is published.  ``keep`` versions stay, for readers that opened the one before; folders that
    none of them names are deleted.
    """
    spark, store = df.sparkSession, _Store(df.sparkSession, production)
    name = f"v-{datetime.now(UTC):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    before = current_version(spark, production)
    held = version(spark, production, before) if before and replaces else None
    if held and (held.partition_by, held.fmt, _columns(_schema(held))) != (list(partition_by), fmt, _columns(df.schema)):
        raise ValueError("partitions can be taken over only from a version of the same columns, partitions and format")
    root = f"{production}/data/__v={name}"
    write(df, root, "overwrite", partition_by, fmt, full_refresh=True)
    try:
        if gate:
            gate()
    except Exception:
        store.delete(root)
        raise
    folders = {f: v for f, v in held.folders.items() if not replaces(values_of(f))} if held else {}
    folders |= dict.fromkeys(_partitions(store, root, len(partition_by)), name)
    store.write(f"{production}/versions/{name}", json.dumps(asdict(Version(name, list(partition_by), fmt, df.schema.json(), folders))))
    draft = f"{production}/.{_CURRENT}-{name}"
    store.write(draft, name)
    if current_version(spark, production) != before:
        for left in (draft, f"{production}/versions/{name}", root):
            store.delete(left)
        raise ChangedMeanwhile(production)
    store.rename(draft, f"{production}/{_CURRENT}")
    expire(spark, production, keep)
    return name


def reload_published(
    fresh: DataFrame, production: str, ts: str, ds: date, days: int = 7, day_col: str = "ds", keep: int = 2
) -> str:
    """The run of day ``ds`` on a published table with a partition per day: the trailing days are those of ``fresh``, older ones stay.

    Writes the trailing partitions only; days of the span that ``fresh`` does not have are gone, as after a DELETE and INSERT.  Rows
    without a time are in no span: published ones stay, fresh ones are not inserted.
    """
    start = str(reload_start(ds, days))
    span = fresh.filter(trailing_filter(ts, ds, days))
    span = span.withColumn(day_col, span[ts].cast("date"))
    return publish(span, production, [day_col], keep=keep, replaces=lambda p: p[day_col] is not None and p[day_col] >= start)


def published(spark: SparkSession, production: str, name: str | None = None) -> DataFrame:
    """The published version of a table, or one by name."""
    held = version(spark, production, name)
    schema = _schema(held)
    if not held.folders:
        return spark.createDataFrame([], schema)
    data = f"{production}/data"
    paths = [f"{data}/__v={v}/{f}".rstrip("/") for f, v in held.folders.items()]
    return spark.read.format(held.fmt).schema(schema).option("basePath", data).load(paths).select(*[f"`{c}`" for c in schema.names])


def expire(spark: SparkSession, production: str, keep: int = 2, leftovers: timedelta | None = None) -> list[str]:
    """Forget all but the last ``keep`` versions and delete what only they name; returns the versions that are gone.

    ``leftovers`` also deletes data of versions that were begun longer ago than that and never published.
    """
    store, current = _Store(spark, production), current_version(spark, production)
    known = store.names(f"{production}/versions", False)
    known = [v for v in known if v.startswith("v-")]
    # a version that is not the published one and newer was not published yet
    done = [v for v in known if current is not None and v <= current]
    gone = done[: max(0, len(done) - keep)]
    kept = [version(spark, production, v) for v in known if v not in gone]
    named = {(v, f) for k in kept for f, v in k.folders.items()}
    stale = {(v, f) for g in gone for f, v in version(spark, production, g).folders.items()} - named
    whole = {v for v, _ in stale} - {v for v, _ in named}
    for v in whole:
        store.delete(f"{production}/data/__v={v}")
    for v, f in sorted(stale):
        if v not in whole:
            store.delete(f"{production}/data/__v={v}/{f}")
    for v in gone:
        store.delete(f"{production}/versions/{v}")
    if leftovers is not None:
        least = f"v-{datetime.now(UTC) - leftovers:%Y%m%d%H%M%S%f}"
        written = [n.removeprefix("__v=") for n in store.names(f"{production}/data", True)]
        for v in written:
            if v < least and v not in known and v not in {x for x, _ in named}:
                store.delete(f"{production}/data/__v={v}")
    return gone
