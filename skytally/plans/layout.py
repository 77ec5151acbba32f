"""Result rows in the attribute layout of the original result tables.

Counts become ``(Id, Popularity)``; top-10 lists become ``(Airport,
CarriersList)`` where the list holds ``"item,n"`` strings, worst first and
best last, and a route is keyed by its ``origin,dest`` text. Useful when
existing consumers read those tables; the native layout keeps real columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: attribute names of the original result tables ---
ORIGINAL_COUNT_COLUMNS = ("Id", "Popularity")
ORIGINAL_LIST_COLUMNS = ("Airport", "CarriersList")
ORIGINAL_ITINERARY_COLUMNS = ("Id", "CarriersList")
# --- end of fixed values ---


def counts_layout(counts: DataFrame) -> DataFrame:
    """``id, popularity`` -> ``Id, Popularity``."""
    key, value = ORIGINAL_COUNT_COLUMNS
    return counts.select(F.col("id").alias(key), F.col("popularity").alias(value))


def lists_layout(packed: DataFrame, group_cols: list[str]) -> DataFrame:
    """``group..., items`` -> ``Airport, CarriersList`` (a multi-column group is joined with ``,``)."""
    key, value = ORIGINAL_LIST_COLUMNS
    group = F.col(group_cols[0]) if len(group_cols) == 1 else F.concat_ws(",", *group_cols)
    return packed.select(group.alias(key), F.col("items").alias(value))


def itineraries_layout(best: DataFrame) -> DataFrame:
    """Best itineraries -> ``Id, CarriersList``: key ``date,x,y,z``, list of ``"flight,delay"`` per leg."""
    key, value = ORIGINAL_ITINERARY_COLUMNS
    leg = [F.concat_ws(",", F.col(f"flight{i}").cast("string"), F.col(f"delay{i}").cast("string")) for i in (1, 2)]
    return best.select(F.concat_ws(",", F.date_format("flight_date", "yyyy-MM-dd"), "x", "y", "z").alias(key), F.array(*leg).alias(value))


def top_itineraries_layout(top: DataFrame) -> DataFrame:
    """Ranked itineraries -> ``Id, CarriersList``: ``"flight,delay"`` of both legs of each pair, best pair first."""
    key, value = ORIGINAL_ITINERARY_COLUMNS
    leg = [F.concat_ws(",", F.col(f"flight{i}").cast("string"), F.col(f"delay{i}").cast("string")) for i in (1, 2)]
    entries = F.array_sort(F.collect_list(F.struct("rank", F.array(*leg).alias("legs"))))   # k entries at most
    packed = top.groupBy("flight_date", "x", "y", "z").agg(F.flatten(F.transform(entries, lambda e: e["legs"])).alias(value))
    return packed.select(F.concat_ws(",", F.date_format("flight_date", "yyyy-MM-dd"), "x", "y", "z").alias(key), value)
