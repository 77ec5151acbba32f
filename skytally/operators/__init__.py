"""DataFrame operators: parsing, counting, ranking, grouped top-k, itineraries."""

from skytally.operators.counts import count_by
from skytally.operators.itinerary import (
    best_from_stats,
    best_itineraries,
    connect,
    itinerary_counts,
    leg_union,
    route_day_best,
    route_day_stats,
    top_from_best,
    top_itineraries,
)
from skytally.operators.parse import (
    LEG_JOB,
    ON_TIME_JOBS,
    REASONS,
    airport_ids,
    classify,
    flat_map_fields,
    legs,
    on_time_records,
    records,
    rejects,
    strict,
)
from skytally.operators.ranking import bottom_n, global_rank, rank_by_count, top_n
from skytally.operators.topk import pack_top_k, top_k_per_group

__all__ = [
    "LEG_JOB",
    "ON_TIME_JOBS",
    "REASONS",
    "airport_ids",
    "best_from_stats",
    "best_itineraries",
    "bottom_n",
    "classify",
    "connect",
    "count_by",
    "flat_map_fields",
    "global_rank",
    "itinerary_counts",
    "leg_union",
    "legs",
    "on_time_records",
    "pack_top_k",
    "rank_by_count",
    "records",
    "rejects",
    "route_day_best",
    "route_day_stats",
    "strict",
    "top_from_best",
    "top_itineraries",
    "top_k_per_group",
    "top_n",
]
