"""Per-group top-k over counted items, and its packed list form.

``top_k_per_group`` is a ``row_number`` window filtered to ``<= k``; Spark
plans it with a partial WindowGroupLimit before the shuffle, so every map task
ships at most k rows per group. A hub group holding a third of all rows costs
the same as any other group after that cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_K = 10


def top_k_per_group(counts: DataFrame, group_cols: list[str], item_col: str = "item",
                    n_col: str = "n", k: int = DEFAULT_K) -> DataFrame:
    """``group_cols..., item, n, rank`` for the k largest ``n`` of each group.

    Ties are broken by the smaller item, so results are deterministic.
    """
    w = Window.partitionBy(*group_cols).orderBy(F.col(n_col).desc(), F.col(item_col).asc())
    ranked = counts.select(*group_cols, item_col, n_col, F.row_number().over(w).alias("rank"))
    kept = ranked.where(F.col("rank") <= k)
    return kept.select(*group_cols, F.col(item_col).alias("item"), F.col(n_col).alias("n"),
                       F.col("rank").cast("bigint").alias("rank"))


def pack_top_k(top_k: DataFrame, group_cols: list[str]) -> DataFrame:
    """``group_cols..., items ARRAY<STRING>`` of ``"item,n"``, worst first, best last.

    Input is already cut to k rows per group, so each collected list is bounded.
    """
    entries = F.sort_array(F.collect_list(F.struct("rank", "item", "n")), asc=False)
    items = F.transform(entries, lambda e: F.concat(e["item"], F.lit(","), e["n"].cast("string")))
    return top_k.groupBy(*group_cols).agg(items.alias("items"))
