"""triplake: a Spark-native lakehouse for ride lifecycle events.

Layers: Bronze (parsed, cleaned events), Silver (daily city metrics and hourly
demand), RAW (ride grain), Gold (star schema) plus data-quality checks, BI
measures and load verification. Every stage is a DataFrame plan.
"""

from triplake.config import LakeConfig

__all__ = ["LakeConfig"]
