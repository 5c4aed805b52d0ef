from . import calendar, classify, cover, history, intervals, joins, match, metrics, ordered, percentiles, quality, rollups

__all__ = [
    "calendar", "classify", "cover", "history", "intervals", "joins", "match", "metrics", "ordered", "percentiles", "quality", "rollups",
]
