"""Ordered per-key work that survives hot keys.

A plain ``Window.partitionBy(key).orderBy(ts)`` puts all rows of a key into one task, so a
key with a third of the table decides the run time of the job.  Here the rows of a key are
first cut into chunks along the order (a day, a month, a value range).  The window runs per
(key, chunk); what crosses a chunk border (previous row, next row, last seen value, running
total, row number) is carried by one summary row per chunk.  The summary is built with a
map-side aggregate, and only it is ordered per key.

The result is exactly that of the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dialect import epoch

_CHUNK = "__chunk"
_BEFORE_ALL = -(2**62)
#: Parts over which rows of a NULL key or time are spread where they cannot match anyway.
_SALTS = 256

STEP_SECONDS = {"minute": 60, "hour": 3600, "day": 86400, "week": 604800, "month": 2592000, "year": 31536000}


def time_chunk(ts: str | Column, step: str = "day") -> Column:
    """Chunk number of a date or timestamp; grows with the time."""
    return F.floor(epoch(ts) / STEP_SECONDS[step])


def _sortable(df: DataFrame, taken: Sequence[str]) -> list[str]:
    """Remaining columns that can be sorted on."""
    return [f.name for f in df.schema.fields if f.name not in taken and "map<" not in f.dataType.simpleString()
            and "variant" not in f.dataType.simpleString()]


def _plain_value(dtype: T.DataType) -> Column:
    """Some non-NULL value of a type."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    return F.lit("0").cast(dtype)


def _never_null(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """The keys as columns that cannot be NULL, and a flag for rows that had one.

    Joins on nullable keys make Spark filter NULLs on one branch only, which would end the
    sharing of the shuffle; and NULL keys would lose their carried values.
    """
    if not keys:
        return {}
    out = {f"__k_{k}": F.coalesce(F.col(k), _plain_value(df.schema[k].dataType)) for k in keys}
    out["__k_null"] = F.concat(*[F.when(F.col(k).isNull(), "1").otherwise("0") for k in keys])
    return out


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    *,
    lag: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    last_seen: Mapping[str, Column] | None = None,
    next_seen: Mapping[str, Column] | None = None,
    running: Mapping[str, Column] | None = None,
    totals: Mapping[str, tuple[str, Column]] | None = None,
    number: str | None = None,
) -> DataFrame:
    """Add window columns over (keys, order ascending, NULLs first).

    ``chunk`` must not fall when the order rises; ``order`` should be total.
    ``lag``/``lead`` take the value of the neighbouring row, ``last_seen``/``next_seen`` the
    nearest non-NULL value up to / from the current row, ``running`` the sum up to and
    including the current row, ``totals`` an aggregate ("sum", "max", "min" or "count", column) of the whole key, ``number`` the row
    number.  NULL is a key like any other.
    Filter on a key before the call: a filter on the result does not reach the scan.

    The rows are read by two branches, the windows and the chunk summary.  Both sort by all
    columns (the ones behind ``order`` only break ties, which also makes a re-run task give
    the same rows), so both need the same shuffle of the same columns, and Spark runs it and
    everything below it once (ReusedExchange).  Chains of these calls therefore grow
    linearly.
    """
    lag, lead = dict(lag or {}), dict(lead or {})
    last_seen, next_seen, running, totals = dict(last_seen or {}), dict(next_seen or {}), dict(running or {}), dict(totals or {})

    def pack(cols: Mapping[str, Column]) -> Column:
        return F.struct(*[c.alias(n) for n, c in cols.items()])

    # every window argument becomes a plain column below the shuffle
    safe = _never_null(df, keys)
    args = {**safe, _CHUNK: F.coalesce(chunk.cast("bigint"), F.lit(_BEFORE_ALL))}
    if lag:
        args["__v_lag"] = pack(lag)
    if lead:
        args["__v_lead"] = pack(lead)
    whole = {n: c for n, (_, c) in totals.items()}
    for kind, cols in (("seen", last_seen), ("next", next_seen), ("run", running), ("tot", whole)):
        args.update({f"__v_{kind}_{n}": c for n, c in cols.items()})
    base = df.withColumns(args)

    group = [*safe, _CHUNK]
    sort = [*order, *_sortable(base, [*group, *order])]
    part = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in sort])
    upto = part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*group).orderBy(*[F.col(c).desc_nulls_last() for c in sort])
    down_to = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # inside the chunk, and one summary row per (key, chunk) ------------------------------
    place = F.col("__num")
    inner: dict[str, Column] = {"__num": F.row_number().over(part)}
    edge: list[Column] = []
    if lag:
        inner["__lag"] = F.lag("__v_lag").over(part)
        edge.append(F.max_by("__v_lag", place).alias("__e_last"))
    if lead:
        inner["__lead"] = F.lead("__v_lead").over(part)
        edge.append(F.min_by("__v_lead", place).alias("__e_first"))
    for n in last_seen:
        v = F.col(f"__v_seen_{n}")
        inner[f"__seen_{n}"] = F.last(v, ignorenulls=True).over(upto)
        edge.append(F.max_by(v, F.when(v.isNotNull(), place)).alias(f"__e_seen_{n}"))
    for n in next_seen:
        v = F.col(f"__v_next_{n}")
        inner[f"__next_{n}"] = F.last(v, ignorenulls=True).over(down_to)
        edge.append(F.min_by(v, F.when(v.isNotNull(), place)).alias(f"__e_next_{n}"))
    for n in running:
        inner[f"__run_{n}"] = F.sum(f"__v_run_{n}").over(upto)
        edge.append(F.max_by(f"__run_{n}", place).alias(f"__e_run_{n}"))
    merge = {"sum": (F.sum, F.sum), "max": (F.max, F.max), "min": (F.min, F.min), "count": (F.count, F.sum)}
    # every row has a number; asking for it in both branches keeps the window, and with it the shuffle that they share
    numbered = place > 0
    edge += [merge[kind][0](F.when(numbered, F.col(f"__v_tot_{n}"))).alias(f"__e_tot_{n}") for n, (kind, _) in totals.items()]
    edge.append(F.max(place).cast("bigint").alias("__e_num"))

    # across chunks ----------------------------------------------------------------------
    over = Window.partitionBy(*safe).orderBy(_CHUNK)
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*safe).orderBy(F.col(_CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried: list[Column] = []
    if lag:
        carried.append(F.lag("__e_last").over(over).alias("__c_lag"))
    if lead:
        carried.append(F.lead("__e_first").over(over).alias("__c_lead"))
    for n in last_seen:
        carried.append(F.last(f"__e_seen_{n}", ignorenulls=True).over(before).alias(f"__c_seen_{n}"))
    for n in next_seen:
        carried.append(F.last(f"__e_next_{n}", ignorenulls=True).over(after).alias(f"__c_next_{n}"))
    for n in running:
        carried.append(F.sum(f"__e_run_{n}").over(before).alias(f"__c_run_{n}"))
    carried += [merge[kind][1](f"__e_tot_{n}").over(Window.partitionBy(*safe)).alias(f"__c_tot_{n}") for n, (kind, _) in totals.items()]
    if number:
        carried.append(F.sum("__e_num").over(before).alias("__c_num"))

    ends = {n: c for n, c in inner.items() if n == "__num" or n.startswith("__run_")}
    summary = base.withColumns(ends).groupBy(*group).agg(*edge).select(*group, *carried)
    joined = base.withColumns(inner).join(summary, group, "left")

    # both levels together ---------------------------------------------------------------
    out: dict[str, Column] = {}
    for kind, cols in (("lag", lag), ("lead", lead)):
        if cols:
            near, far = F.col(f"__{kind}"), F.col(f"__c_{kind}")
            for n in cols:
                out[n] = F.when(near.isNotNull(), near[n]).otherwise(far[n])
    for n in last_seen:
        out[n] = F.coalesce(f"__seen_{n}", f"__c_seen_{n}")
    for n in next_seen:
        out[n] = F.coalesce(f"__next_{n}", f"__c_next_{n}")
    for n in running:
        here, carry = F.col(f"__run_{n}"), F.col(f"__c_run_{n}")
        out[n] = F.when(here.isNotNull() & carry.isNotNull(), here + carry).otherwise(F.coalesce(here, carry))
    for n in totals:
        out[n] = F.when(numbered, F.col(f"__c_tot_{n}"))
    if number:
        out[number] = F.col("__num") + F.coalesce(F.col("__c_num"), F.lit(0))
    return joined.select(*[F.col(c) for c in df.columns if c not in out], *[c.alias(n) for n, c in out.items()])


def spread_totals(df: DataFrame, keys: Sequence[str], totals: Mapping[str, tuple[str, Column]], salts: int = 16) -> DataFrame:
    """Add aggregates of the row's key: the chunk is a hash of the row, so a hot key is spread and the input is built once.

    Without keys the aggregate is over all rows; the summary then has one row per salt.
    """
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _sortable(df, [])]), F.lit(salts if keys else 16 * salts))
    return ordered(df, keys, [], spread, totals=totals)


def fill_forward(df, keys, order, chunk, cols: Sequence[str]) -> DataFrame:
    """Replace NULLs by the last seen value of the key."""
    return ordered(df, keys, order, chunk, last_seen={c: F.col(c) for c in cols})


def asof_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    cols: Mapping[str, str],
    *,
    tie: Sequence[str] = (),
    direction: str = "backward",
    closed: bool = True,
    offset_seconds: int = 0,
    within_seconds: int | None = None,
    chunk: str = "day",
) -> DataFrame:
    """Nearest right row before (``backward``) or after (``forward``) each left row.

    Both sides are stacked and scanned once along the time, so no pairs are made: a key with
    a million rows on each side costs two million rows, not 10^12.  ``offset_seconds`` moves
    the probe time, ``within_seconds`` drops matches further away than that, ``tie`` orders
    right rows of the same time (the last one wins backward, the first one forward).
    Every left row is kept; unmatched ones (and NULL keys or times) get NULLs.  Rows that cannot match pass through spread over salts
    below all times, so however many there are, no task gathers them.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(direction)
    backward = direction == "backward"
    # rank inside one timestamp: right rows come before the probe when they may match it
    right_rank = 0 if closed == backward else 2
    probe = epoch_micros(F.col(left_ts)) + F.lit(offset_seconds * 1_000_000)
    tie_cols = [f"__tie{i}" for i in range(len(tie))]
    dtypes = {f.name: f.dataType for f in right.schema.fields}
    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & F.col(k).isNotNull()

    hit = F.struct(F.col(right_ts).alias("__ts"), *[F.col(src).alias(out) for out, src in cols.items()])
    hit_type = right.select(hit.alias("h")).schema["h"].dataType
    lefts = left.select(
        *left.columns,
        probe.alias("__at"),
        F.lit(1).alias("__rank"),
        *[F.lit(None).cast(dtypes[t]).alias(c) for t, c in zip(tie, tie_cols)],
        F.lit(None).cast(hit_type).alias("__hit"),
    )
    usable = key_ok & F.col("__at").isNotNull()
    rights = right.filter(key_ok & F.col(right_ts).isNotNull()).select(
        *[F.col(k) if k in keys else F.lit(None).cast(left.schema[k].dataType).alias(k) for k in left.columns],
        epoch_micros(F.col(right_ts)).alias("__at"),
        F.lit(right_rank).alias("__rank"),
        *[F.col(t).alias(c) for t, c in zip(tie, tie_cols)],
        hit.alias("__hit"),
    )
    stacked = lefts.unionByName(rights)
    step = STEP_SECONDS[chunk] * 1_000_000
    seen = {"__hit": F.col("__hit")}
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _sortable(stacked, ["__hit"])]), F.lit(_SALTS))
    at_key = F.lit(True)
    for k in keys:
        at_key = at_key & F.col(k).isNotNull()
    filled = ordered(
        stacked,
        keys,
        ["__at", "__rank", *tie_cols],
        F.when(at_key & F.col("__at").isNotNull(), F.floor(F.col("__at") / step)).otherwise(F.lit(_BEFORE_ALL) + salt),
        **({"last_seen": seen} if backward else {"next_seen": seen}),
    ).filter(F.col("__rank") == 1)
    found = F.when(usable, F.col("__hit"))
    if within_seconds is not None:
        gap = epoch_micros(F.col("__hit")["__ts"]) - F.col("__at")
        gap = -gap if backward else gap
        found = F.when(usable & (gap <= F.lit(within_seconds * 1_000_000)), F.col("__hit"))
    return filled.select(*left.columns, *[found[out].alias(out) for out in cols])


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))
