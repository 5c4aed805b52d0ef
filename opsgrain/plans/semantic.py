"""Semantic views: named dimensions and measures over a table, and period comparison."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import PACIFIC, add, col, datediff_boundary, ntz, safe_ratio, time_of_day, time_slice, trunc, trunc_date
from ..operators.classify import case
from ..operators.metrics import side_by_side, with_totals
from ..operators.percentiles import exact_percentiles

# -- timeframes -------------------------------------------------------------------------------

_TIMEFRAMES: Mapping[str, Callable[[Column], Column]] = {
    "raw": lambda t: t,
    "time": lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss"),
    "time_of_day": lambda t: F.date_format(t, "HH:mm"),
    "clock": time_of_day,
    "minute": lambda t: trunc("minute", t),
    "minute15": lambda t: time_slice(t, 15),
    "minute30": lambda t: time_slice(t, 30),
    "hour": lambda t: trunc("hour", t),
    "hour_of_day": lambda t: F.hour(t),
    "date": lambda t: t.cast("date"),
    "day_of_week": lambda t: F.date_format(t, "EEEE"),
    "day_of_week_index": lambda t: F.weekday(t),
    "day_of_year": lambda t: F.dayofyear(t),
    "week": lambda t: trunc_date("week", t),
    "week_of_year": lambda t: F.weekofyear(t),
    "month": lambda t: trunc_date("month", t),
    "quarter": lambda t: trunc_date("quarter", t),
    "year": lambda t: F.year(t),
}
# Parameter value -> timeframe; anything else is the date.
GRANULARITY = {
    "minute30": "minute30",
    "Hour": "hour",
    "Day": "date",
    "Week": "week",
    "Month": "month",
    "Quarter": "quarter",
    "Year": "year",
}


def timeframe(ts: str | Column, name: str) -> Column:
    if name not in _TIMEFRAMES:
        raise ValueError(f"unknown timeframe {name!r}")
    return _TIMEFRAMES[name](col(ts))


def by_granularity(ts: str | Column, value: str | None) -> Column:
    """Timeframe picked by a parameter value."""
    return timeframe(ts, GRANULARITY.get(value or "Day", "date"))


def timeframes(prefix: str, ts: str, names: Sequence[str] = tuple(_TIMEFRAMES)) -> dict[str, Callable[[Mapping], Column]]:
    """One dimension per timeframe, named ``<prefix>_<timeframe>``."""
    return {f"{prefix}_{n}": (lambda params, n=n: timeframe(ts, n)) for n in names}


# -- measures -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Measure:
    """kind: flag (distinct ids where a condition holds), sum, average, min, max, count,
    percentile, number (over other measures) or share (of the total over all rows)."""

    kind: str
    expr: Callable[[], Column] | None = None
    row_id: str | None = None
    needs: tuple[str, ...] = ()
    combine: Callable[..., Column] | None = None
    point: float | None = None


def distinct(row_id: str, cond: Callable[[], Column] | None = None) -> Measure:
    return Measure("flag", cond, row_id)


def total(expr: Callable[[], Column]) -> Measure:
    return Measure("sum", expr)


def average(expr: Callable[[], Column]) -> Measure:
    return Measure("average", expr)


def lowest(expr: Callable[[], Column]) -> Measure:
    return Measure("min", expr)


def highest(expr: Callable[[], Column]) -> Measure:
    return Measure("max", expr)


def rows() -> Measure:
    return Measure("count")


def percentile(expr: Callable[[], Column], point: float) -> Measure:
    return Measure("percentile", expr, point=point)


def median(expr: Callable[[], Column]) -> Measure:
    return percentile(expr, 0.5)


def number(combine: Callable[..., Column], *needs: str) -> Measure:
    return Measure("number", needs=needs, combine=combine)


def ratio(num: str, den: str, scale: float = 1) -> Measure:
    return number(lambda a, b: safe_ratio(a, b, scale), num, den)


def share(of: str) -> Measure:
    return Measure("share", needs=(of,))


@dataclass(frozen=True)
class View:
    """Named dimensions and measures; ``query`` compiles a choice of them to one DataFrame."""

    name: str
    dimensions: Mapping[str, Callable[[Mapping], Column]]
    measures: Mapping[str, Measure]
    sets: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def query(
        self, df: DataFrame, dims: Sequence[str], measures: Sequence[str], *, filters: Sequence[Column] = (), params: Mapping | None = None
    ) -> DataFrame:
        """Filtered rows grouped by the dimensions with the measures.

        All distinct counts over the same id, sums, averages, minima, maxima and row counts
        come out of one two-step aggregate: first per (dimensions, id), then per dimensions.
        Further ids and the percentiles are extra aggregates joined on the dimensions.
        """
        params = params or {}
        for f in filters:
            df = df.filter(f)
        needed = self._needed(measures)
        base = df.withColumns({f"__d_{d}": self.dimensions[d](params) for d in dims})
        keys = [f"__d_{d}" for d in dims]
        ids = list(dict.fromkeys(m.row_id for m in needed.values() if m.kind == "flag")) or [None]
        parts = []
        for i, row_id in enumerate(ids):
            mine = {
                n: m for n, m in needed.items()
                if (m.kind == "flag" and m.row_id == row_id) or (i == 0 and m.kind in ("sum", "average", "min", "max", "count"))
            }
            if mine:
                parts.append(_two_step(base, keys, row_id, mine))
        wanted = {n: m for n, m in needed.items() if m.kind == "percentile"}
        if wanted:
            parts.append(_percentiles(base, keys, wanted))
        out = parts[0] if parts else base.select(*keys).distinct()
        for p in parts[1:]:
            out = _join_same(out, p, keys)
        for level in _levels(needed):
            out = out.withColumns(
                {n: m.combine(*[F.col(x) for x in m.needs]) for n, m in level.items() if m.kind == "number"}
            )
            shares = {n: m.needs[0] for n, m in level.items() if m.kind == "share"}
            if shares:
                out = with_totals(out, [], {f"__t_{n}": ("sum", F.col(x)) for n, x in shares.items()})
                out = out.withColumns({n: safe_ratio(x, f"__t_{n}") for n, x in shares.items()}).drop(*[f"__t_{n}" for n in shares])
        return out.select(*[F.col(f"__d_{d}").alias(d) for d in dims], *measures)

    def detail(self, df: DataFrame, name: str, *, filters: Sequence[Column] = (), params: Mapping | None = None) -> DataFrame:
        """Rows behind a number: the columns of a named set."""
        for f in filters:
            df = df.filter(f)
        out = []
        for c in self.sets[name]:
            if c in self.measures:
                continue
            out.append(self.dimensions[c](params or {}).alias(c) if c in self.dimensions else F.col(c))
        return df.select(*out)

    def _needed(self, names: Sequence[str]) -> dict[str, Measure]:
        found: dict[str, Measure] = {}

        def visit(n: str, path: tuple[str, ...]) -> None:
            if n in path:
                raise ValueError(f"measure {n!r} refers to itself")
            if n not in self.measures:
                raise ValueError(f"unknown measure {n!r}")
            for x in self.measures[n].needs:
                visit(x, (*path, n))
            found.setdefault(n, self.measures[n])

        for n in names:
            visit(n, ())
        return found


def _levels(needed: Mapping[str, Measure]) -> list[dict[str, Measure]]:
    """Measures over measures, in steps: each step needs only what earlier steps made."""
    depth: dict[str, int] = {}
    # ``needed`` lists what a measure refers to before the measure
    for n, m in needed.items():
        depth[n] = 1 + max(depth[x] for x in m.needs) if m.needs else 0
    deepest = max(depth.values(), default=0)
    return [{n: m for n, m in needed.items() if depth[n] == d} for d in range(1, deepest + 1)]


def _two_step(base: DataFrame, keys: Sequence[str], row_id: str | None, measures: Mapping[str, Measure]) -> DataFrame:
    first, second = [], []
    for n, m in measures.items():
        if m.kind == "flag":
            cond = F.lit(True) if m.expr is None else m.expr()
            first.append(F.max(F.when(F.col(row_id).isNotNull() & cond, 1).otherwise(0)).alias(n))
            second.append(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n))
        elif m.kind == "count":
            first.append(F.count(F.lit(1)).alias(n))
            second.append(F.coalesce(F.sum(n), F.lit(0)).alias(n))
        elif m.kind == "average":
            e = m.expr()
            first += [F.sum(e).alias(f"__s_{n}"), F.count(e).alias(f"__c_{n}")]
            second.append(safe_ratio(F.sum(f"__s_{n}"), F.sum(f"__c_{n}")).alias(n))
        else:
            fn = {"sum": F.sum, "min": F.min, "max": F.max}[m.kind]
            first.append(fn(m.expr()).alias(n))
            second.append(fn(n).alias(n))
    inner = base.groupBy(*keys, row_id) if row_id else base.groupBy(*keys)
    return inner.agg(*first).groupBy(*keys).agg(*second)


def _percentiles(base: DataFrame, keys: Sequence[str], wanted: Mapping[str, Measure]) -> DataFrame:
    """Percentiles of several expressions in one pass: a row gives one value per expression."""
    exprs = list(dict.fromkeys(m.expr for m in wanted.values()))
    values = F.array(*[F.struct(F.lit(i).alias("e"), e().cast("double").alias("v")) for i, e in enumerate(exprs)])
    rows = base.select(*keys, F.explode(values).alias("__x")).select(*keys, F.col("__x.e").alias("__expr"), F.col("__x.v").alias("__value"))
    points = {f"__p{k}": p for k, p in enumerate(dict.fromkeys(m.point for m in wanted.values()))}
    place = {p: n for n, p in points.items()}
    found = exact_percentiles(rows, [*keys, "__expr"], "__value", points)
    return found.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__expr") == exprs.index(m.expr), F.col(place[m.point]))).alias(n) for n, m in wanted.items()]
    )


def _join_same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join two aggregates of the same rows; a NULL dimension value joins itself."""
    if not keys:
        return side_by_side(a, b)
    renamed = b.withColumnsRenamed({k: f"{k}__r" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{k}__r"))
    return a.join(renamed, cond, "left").drop(*[f"{k}__r" for k in keys])


def pick(choices: Mapping[str, str], value: str | None, default: str | None = None) -> str:
    """Field behind a parameter value; only listed values are allowed."""
    if value in choices:
        return choices[value]
    if default is None:
        raise ValueError(f"value {value!r} is not allowed")
    return default


# -- period over period ---------------------------------------------------------------------------

CURRENT, PREVIOUS, OUTSIDE = "Current Period", "Previous Period", "Not In Range"
_EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Period:
    """The chosen period and the one of equal length before it."""

    start: datetime
    end: datetime

    @staticmethod
    def from_filter(
        start: date | None, end: date | None, as_of: datetime, *, mode: str = "clock", tz: str = PACIFIC, open_end: str = "today"
    ) -> Period:
        """Bounds from a date filter; an open start is 1970-01-01.

        An open end is the day of ``as_of``, or 1970-01-01 with ``open_end="epoch"``.
        ``clock`` puts the time of day of ``as_of`` on the dates, ``local_date`` moves that
        instant from UTC to ``tz`` and keeps the date, ``rollover`` takes a day off the start
        between 0 and 8 o'clock UTC and leaves the end as given.
        """
        def bound(d: date | None, default: datetime, is_start: bool) -> datetime:
            if d is None:
                return default
            at = datetime(d.year, d.month, d.day)
            if mode == "clock":
                return at + timedelta(hours=as_of.hour, minutes=as_of.minute, seconds=as_of.second)
            if mode == "local_date":
                stamp = at + timedelta(hours=as_of.hour, minutes=as_of.minute, seconds=as_of.second)
                local = stamp.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(tz))
                return datetime(local.year, local.month, local.day)
            if mode == "rollover":
                return at - timedelta(days=1) if is_start and 0 <= as_of.hour <= 8 else at
            raise ValueError(mode)

        today = datetime(as_of.year, as_of.month, as_of.day)
        return Period(bound(start, _EPOCH, True), bound(end, _EPOCH if open_end == "epoch" else today, False))

    @property
    def seconds(self) -> int:
        return int((self.end - self.start).total_seconds())

    @property
    def days(self) -> int:
        return (self.end.date() - self.start.date()).days

    @property
    def previous_start(self) -> datetime:
        return self.start - timedelta(seconds=self.seconds)

    @property
    def previous_end(self) -> date:
        return (self.start - timedelta(days=1)).date()

    @staticmethod
    def _lit(value: datetime) -> Column:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")

    def bucket(self, ts: str | Column, labels: tuple[str, str, str] = (CURRENT, PREVIOUS, OUTSIDE)) -> Column:
        """Half-open test: start <= ts < end, and the same one period earlier."""
        t = ntz(ts)
        return (
            F.when((t >= self._lit(self.start)) & (t < self._lit(self.end)), labels[0])
            .when((t >= self._lit(self.previous_start)) & (t < self._lit(self.start)), labels[1])
            .otherwise(labels[2])
        )

    def in_either(self, ts: str | Column) -> Column:
        """Rows of either period, as a range the scan can use."""
        t = col(ts)
        return (t >= self._lit(self.previous_start)) & (t < self._lit(self.end))

    def position(self, ts: str | Column, granularity: str | None = "Day", from_zero: bool = False) -> Column:
        """Number of the day (from 1), hour or half hour (from 0) inside the row's period.

        The period test is closed here, so a row exactly at the start counts as current.
        ``from_zero`` starts days at 0 too.
        """
        t = ntz(ts)

        def count(origin: datetime) -> Column:
            o = self._lit(origin)
            if granularity == "minute30":
                return datediff_boundary("minute", o, t) / 30
            if granularity == "Hour":
                return datediff_boundary("hour", o, t).cast("double")
            return (datediff_boundary("day", o, t) + (0 if from_zero else 1)).cast("double")

        return F.when(t.between(self._lit(self.start), self._lit(self.end)), count(self.start)).when(
            t.between(self._lit(self.previous_start), self._lit(self.start)), count(self.previous_start)
        )

    def aligned(self, ts: str | Column, granularity: str | None = "Day", onto_previous: bool = False, exact: bool = False) -> Column:
        """Time of the row moved onto the axis of the current period.

        Hours and half hours are numbered from 0 but shifted like numbers from 1, so they land
        one step early; ``exact=True`` corrects that.  Fractions of a step are rounded.
        """
        origin = self._lit(self.previous_start if onto_previous else self.start)
        n = self.position(ts, granularity)
        step = n - 1
        if granularity == "minute30":
            step = n if exact else step
            return add("minute", F.round(step * 30).cast("int"), origin)
        if granularity == "Hour":
            step = n if exact else step
            return add("hour", F.round(step).cast("int"), origin)
        return add("day", step.cast("int"), origin)

    def axis(self, ts: str | Column, granularity: str | None = "Day", exact: bool = False) -> Column:
        """``aligned`` cut to the granularity: the grouping column of a comparison."""
        return by_granularity(self.aligned(ts, granularity, exact=exact), granularity)

    @property
    def current_label(self) -> str:
        return f"{self.start.isoformat(sep=' ')} to {(self.end - timedelta(days=1)).date().isoformat()}"

    @property
    def previous_label(self) -> str:
        return f"{self.previous_start.date().isoformat()} to {self.previous_end.isoformat()}"

    def label(self, ts: str | Column) -> Column:
        """Text of the row's period, NULL outside both."""
        b = self.bucket(ts)
        return case([(b == CURRENT, self.current_label), (b == PREVIOUS, self.previous_label)])


def pop_compare(
    view: View, df: DataFrame, ts: str, period: Period, granularity: str, measures: Sequence[str], *, exact: bool = False, dims: Sequence[str] = ()
) -> DataFrame:
    """Both periods on one axis: (axis, period, dims) with the measures."""
    wide = View(
        view.name,
        {
            **view.dimensions,
            "axis": lambda params: period.axis(ts, granularity, exact),
            "period": lambda params: period.bucket(ts),
        },
        view.measures,
    )
    return wide.query(df, ["axis", "period", *dims], measures, filters=[period.in_either(ts)])
