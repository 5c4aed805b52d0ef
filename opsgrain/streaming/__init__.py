from . import sla, stateful

__all__ = ["sla", "stateful"]
