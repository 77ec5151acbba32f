"""Counting operators (partial + final hash aggregation, one shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Row count per key as BIGINT; Spark combines map-side before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
