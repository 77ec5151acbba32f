"""The user-facing queries, each a function of a DataFrame with one ``line`` column.

Counting parts (``*_counts``, ``airport_popularity``, ``carrier_on_time_arrivals``,
``route_day_stats``) are streaming-safe: the same function is used on a
``readStream`` frame. Ranking parts (global rank, per-group top-k, itinerary
join) run on batch frames, or per micro-batch on the counted state.

"Top" always means the highest number of on-time flights.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.operators import (
    airport_ids,
    best_itineraries as _best_itineraries,
    bottom_n,
    count_by,
    itinerary_counts as _itinerary_counts,
    legs,
    on_time_records,
    pack_top_k,
    rank_by_count,
    top_itineraries as _top_itineraries,
    top_k_per_group,
    top_n,
)
from skytally.operators.topk import DEFAULT_K


# ---- Q1.1 airport popularity -------------------------------------------------

def airport_popularity(lines: DataFrame) -> DataFrame:
    """``id, popularity``: flights that start or end at each airport."""
    return count_by(airport_ids(lines), ["id"], "popularity")


def airports_ranked(lines: DataFrame) -> DataFrame:
    """``rank, id, popularity`` for every airport, busiest first."""
    return rank_by_count(airport_popularity(lines))


def top10_airports(lines: DataFrame, n: int = 10) -> DataFrame:
    return top_n(airport_popularity(lines), n)


def bottom10_airports(lines: DataFrame, n: int = 10) -> DataFrame:
    return bottom_n(airport_popularity(lines), n)


# ---- Q1.2 carriers by on-time arrivals --------------------------------------

def carrier_on_time_arrivals(lines: DataFrame) -> DataFrame:
    """``id, popularity``: on-time arrivals per carrier."""
    r = on_time_records(lines).where(F.col("arr_on_time"))
    return count_by(r.select(F.col("carrier").alias("id")), ["id"], "popularity")


def carriers_ranked(lines: DataFrame) -> DataFrame:
    return rank_by_count(carrier_on_time_arrivals(lines))


def top10_carriers(lines: DataFrame, n: int = 10) -> DataFrame:
    return top_n(carrier_on_time_arrivals(lines), n)


# ---- Q2.x grouped top-10 -----------------------------------------------------

@dataclass(frozen=True)
class GroupedRanking:
    """Which on-time flag to count, what to group by and what to rank."""

    group: tuple[tuple[str, str], ...]  # (source column, output name)
    item: str                           # source column ranked inside each group
    flag: str                           # "dep_on_time" or "arr_on_time"

    @property
    def group_cols(self) -> list[str]:
        return [out for _, out in self.group]


CARRIERS_BY_AIRPORT = GroupedRanking((("origin", "airport"),), "carrier", "dep_on_time")
DESTINATIONS_BY_AIRPORT = GroupedRanking((("origin", "airport"),), "dest", "dep_on_time")
CARRIERS_BY_ROUTE = GroupedRanking((("origin", "origin"), ("dest", "dest")), "carrier", "arr_on_time")


def grouped_counts(lines: DataFrame, spec: GroupedRanking) -> DataFrame:
    """``group..., item, n`` on-time counts. A blank item cannot be ranked and is left out."""
    r = on_time_records(lines).where(F.col(spec.flag) & (F.col(spec.item) != ""))
    keyed = r.select(*[F.col(src).alias(out) for src, out in spec.group], F.col(spec.item).alias("item"))
    return count_by(keyed, spec.group_cols + ["item"], "n")


def grouped_top_k(lines: DataFrame, spec: GroupedRanking, k: int = DEFAULT_K) -> DataFrame:
    return top_k_per_group(grouped_counts(lines, spec), spec.group_cols, "item", "n", k)


def packed_top_k(lines: DataFrame, spec: GroupedRanking, k: int = DEFAULT_K) -> DataFrame:
    """``group..., items``: the k entries as ``"item,n"`` strings, worst first."""
    return pack_top_k(grouped_top_k(lines, spec, k), spec.group_cols)


def top10_carriers_by_airport(lines: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    return grouped_top_k(lines, CARRIERS_BY_AIRPORT, k)


def top10_destinations_by_airport(lines: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    return grouped_top_k(lines, DESTINATIONS_BY_AIRPORT, k)


def top10_carriers_by_route(lines: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    return grouped_top_k(lines, CARRIERS_BY_ROUTE, k)


# ---- Q3.2 two-leg itineraries ------------------------------------------------

def itinerary_counts(lines: DataFrame) -> DataFrame:
    """``flight_date, x, y, z, n, best`` from seven-field itinerary lines."""
    return _itinerary_counts(legs(lines))


def best_itineraries(lines: DataFrame) -> DataFrame:
    """``flight_date, x, y, z, flight1, flight2, delay1, delay2, total_delay`` from itinerary lines."""
    return _best_itineraries(legs(lines))


def itinerary_top10(lines: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """``flight_date, x, y, z, rank`` and the flights, delays and total of each itinerary's k best pairs."""
    return _top_itineraries(legs(lines), k)
