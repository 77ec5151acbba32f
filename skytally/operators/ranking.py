"""Global ordering operators: full ranking, top-n and bottom-n.

``top_n``/``bottom_n`` plan as TakeOrderedAndProject: every partition keeps its
own n best rows and only those reach the final merge, so no full sort happens.

``global_rank`` numbers every row of a total order without a partition-less
window (which would pull the whole input into one task): a range-partitioned
sort spreads the rows over many tasks, each row gets its position inside its
partition, and a table with one row per partition turns those into global
ranks. The sorted, tagged rows are checkpointed to the session's checkpoint
directory first, so the per-partition sizes and the rows they are applied to
come from the same materialisation even if executors are lost and tasks rerun.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.session import checkpoint_root


def _orders(by: str, key: str, descending: bool) -> list[Column]:
    primary = F.col(by).desc() if descending else F.col(by).asc()
    return [primary, F.col(key).asc()]


def top_n(df: DataFrame, n: int = 10, by: str = "popularity", key: str = "id") -> DataFrame:
    """The n rows with the highest ``by``; ties go to the smaller ``key``."""
    return df.orderBy(*_orders(by, key, True)).limit(n)


def bottom_n(df: DataFrame, n: int = 10, by: str = "popularity", key: str = "id") -> DataFrame:
    """The n rows with the lowest ``by``; ties go to the smaller ``key``."""
    return df.orderBy(*_orders(by, key, False)).limit(n)


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """``rank_col`` (BIGINT, 1-based) = position of each row in ``order``.

    ``order`` must be a total order (end it with a unique key) for ranks to be
    deterministic.
    """
    checkpoint_root(df.sparkSession)
    cols = df.columns
    tagged = (df.orderBy(*order)
              .select(*cols, F.spark_partition_id().alias("_part"),
                      F.monotonically_increasing_id().alias("_pos"))
              .checkpoint(eager=True))
    # One row per partition: a proven bound, so the window and broadcast are small.
    parts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", "_first",
                           F.coalesce(F.sum("_cnt").over(before), F.lit(0)).cast("bigint").alias("_offset"))
    ranked = tagged.join(F.broadcast(offsets), "_part")
    rank = (F.col("_offset") + F.col("_pos") - F.col("_first") + F.lit(1)).cast("bigint")
    return ranked.select(rank.alias(rank_col), *cols)


def rank_by_count(counts: DataFrame, by: str = "popularity", key: str = "id") -> DataFrame:
    """``rank, key, by`` with the highest count first and ties by key."""
    return global_rank(counts, _orders(by, key, True))
