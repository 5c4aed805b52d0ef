from . import dates, dialect

__all__ = ["dates", "dialect"]
