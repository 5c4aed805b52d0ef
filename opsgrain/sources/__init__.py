from . import tables

__all__ = ["tables"]
