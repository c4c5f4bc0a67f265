"""Column-expression helpers (all built-in, JVM-side expressions)."""

from triplake.functions.numeric import half_up_avg, half_up_ratio, half_up_sum
from triplake.functions.joins import count_if

__all__ = ["half_up_avg", "half_up_ratio", "half_up_sum", "count_if"]
