"""Operations analytics on PySpark: SLA facts, queue history, period comparison."""

__version__ = "0.1.0"
