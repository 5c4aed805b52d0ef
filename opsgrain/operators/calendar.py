"""Calendar spines."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import add, ntz

STEPS = {
    "month": "interval 1 month",
    "day": "interval 1 day",
    "hour": "interval 1 hour",
    "30 minutes": "interval 30 minutes",
}
_PER_DAY = {"month": 1 / 28, "day": 1, "hour": 24, "30 minutes": 48}
# a spine is broadcast only while it is surely small (about 100 bytes a row)
BROADCAST_ROWS = 100_000


def _stamp(value: date | datetime | str) -> datetime:
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return value


def calendar_spine(spark: SparkSession, start, stop, step: str = "hour", broadcast: bool = True) -> DataFrame:
    """Gap-free intervals from ``start`` (included) to ``stop`` (left out).

    Columns ``interval_start``, ``interval_end``, ``report_date``.  The number of rows
    follows from the arguments alone, so it is known before the plan runs.
    """
    start, stop = _stamp(start), _stamp(stop)
    size = ((stop - start).total_seconds() / 86400 + 1) * _PER_DAY[step]
    width = F.expr(STEPS[step])
    spine = (
        spark.range(1)
        .select(F.explode(F.sequence(F.lit(start).cast("timestamp"), F.lit(stop).cast("timestamp"), width)).alias("t"))
        .filter(F.col("t") < F.lit(stop).cast("timestamp"))
        .select(ntz("t").alias("interval_start"))
    )
    unit, amount = {"month": ("month", 1), "day": ("day", 1), "hour": ("hour", 1), "30 minutes": ("minute", 30)}[step]
    spine = spine.select(
        "interval_start",
        add(unit, amount, "interval_start").alias("interval_end"),
        F.col("interval_start").cast("date").alias("report_date"),
    )
    return F.broadcast(spine) if broadcast and size <= BROADCAST_ROWS else spine


def on_spine(spine: DataFrame, facts: DataFrame, fact_ts: str, counts: list[str] | None = None) -> DataFrame:
    """Spine LEFT JOIN already aggregated facts; the listed counts become 0 in empty intervals."""
    joined = spine.join(facts, spine["interval_start"] == facts[fact_ts], "left").drop(fact_ts)
    return joined.fillna(0, subset=counts) if counts else joined


def relative_intervals(spine: DataFrame, steps: dict[str, int]) -> DataFrame:
    """Earlier interval of the same spine, e.g. ``{"one_day_ago": 24, "one_week_ago": 168}``.

    The spine is a bounded calendar, so the single-partition window over it stays small.
    """
    from pyspark.sql import Window

    w = Window.orderBy("interval_start")
    return spine.withColumns({name: F.lag("interval_start", n).over(w) for name, n in steps.items()})
