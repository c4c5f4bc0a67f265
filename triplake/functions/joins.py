"""Predicate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true; a null condition does not count."""
    return F.count_if(F.coalesce(cond, F.lit(False)))
