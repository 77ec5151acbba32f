"""Two-leg itineraries: X->Y on day d, then Y->Z on day d+2.

Pairs of flights are never materialised. Both the pair count and the best
(lowest total arrival delay) pair of an itinerary (d, X, Y, Z) factor into one
independent statistic per leg:

* count(pairs)  = n(d, X, Y) * n(d+2, Y, Z)
* min(a + b)    = min_a + min_b, and the best pair, ordered by
  (total, flight1, flight2), is the best first leg by (delay, flight) joined
  with the best second leg by (delay, flight);
* the k best pairs are among the pairs of the i-th best first and the j-th best
  second leg with i * j <= k: each such pair has i * j - 1 others before it.

So legs are first reduced to one row per (date, origin, dest) route-day, and
only those rows are joined, on (connecting airport, date + gap). A hub airport
that sees a third of all flights contributes one row per route per day to the
join, not one per flight; the join output is the result itself.

Floating point: addition is monotone in each operand, so the smallest pair sum
is exactly ``min_a + min_b``. Picking the pair by (min_a, smallest flight) and
(min_b, smallest flight) assumes no other pair rounds to the same sum, which
holds for delays written in minutes with a few decimals. Pair counts are
BIGINT products; under ANSI mode an overflow fails loudly instead of wrapping.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skytally.functions import shift_days
from skytally.functions.dates import CONNECTION_GAP_DAYS


def leg_union(legs: DataFrame, gap_days: int = CONNECTION_GAP_DAYS) -> DataFrame:
    """Each flight as a first leg keyed (date, dest) and a second leg keyed (date - gap, origin).

    Columns: d, via, leg (1 or 2). One scan, one explode.
    """
    first = F.struct(F.col("flight_date").alias("d"), F.col("dest").alias("via"), F.lit(1).alias("leg"))
    second = F.struct(shift_days("flight_date", -gap_days).alias("d"), F.col("origin").alias("via"),
                      F.lit(2).alias("leg"))
    return legs.select(F.explode(F.array(first, second)).alias("u")).select("u.d", "u.via", "u.leg")


ROUTE_DAY_KEYS = ("flight_date", "origin", "dest")


def route_day_stats(legs: DataFrame, best_flight: bool = True, streaming: bool = False) -> DataFrame:
    """Per (flight_date, origin, dest): ``n`` flights and the best one.

    ``best_flight=True``: ``best`` = struct(delay, flight) of the lowest delay and,
    among its flights, the smallest number. In batch two hash aggregates: the
    smallest flight per distinct delay first, then the lowest delay of that much
    smaller table. A stream can aggregate once only, so ``streaming=True`` takes
    the minimum of the struct (sort-based, over one trigger's rows).
    ``best_flight=False``: only ``min_delay``, enough for pair counts and best totals.
    """
    if not best_flight:
        return legs.groupBy(*ROUTE_DAY_KEYS).agg(F.count(F.lit(1)).alias("n"), F.min("arr_delay").alias("min_delay"))
    if streaming:
        best = F.min(F.struct(F.col("arr_delay").alias("delay"), F.col("flight").alias("flight"))).alias("best")
        return legs.groupBy(*ROUTE_DAY_KEYS).agg(F.count(F.lit(1)).alias("n"), best)
    per_delay = legs.groupBy(*ROUTE_DAY_KEYS, "arr_delay").agg(F.count(F.lit(1)).alias("m"), F.min("flight").alias("flight"))
    per_day = per_delay.groupBy(*ROUTE_DAY_KEYS).agg(
        F.sum("m").alias("n"), F.min("arr_delay").alias("delay"), F.min_by("flight", "arr_delay").alias("flight"))
    return per_day.select(*ROUTE_DAY_KEYS, "n", F.struct("delay", "flight").alias("best"))


def connect(stats: DataFrame, gap_days: int = CONNECTION_GAP_DAYS, second: DataFrame | None = None) -> DataFrame:
    """Join first-leg route-days to second-leg route-days on (via airport, date + gap).

    Every statistic column ``c`` comes out as ``c1`` (first leg) and ``c2``
    (second leg). With ``second=None`` both sides are the same aggregate. The
    null checks each side's join keys would get from constraint inference are
    stated once, up front, so the two sides stay identical plans and the
    aggregate's shuffle is computed once and reused (ReusedExchange) instead of
    parsing every line twice.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return df.where(F.col("flight_date").isNotNull() & shift_days("flight_date", gap_days).isNotNull()
                        & F.col("origin").isNotNull() & F.col("dest").isNotNull())

    stat_cols = [c for c in stats.columns if c not in ROUTE_DAY_KEYS]
    first_src = keyed(stats)
    second_src = first_src if second is None else keyed(second)
    first = first_src.select(
        F.col("flight_date"), F.col("origin").alias("x"), F.col("dest").alias("y"),
        shift_days("flight_date", gap_days).alias("d2"), *[F.col(c).alias(c + "1") for c in stat_cols])
    second_side = second_src.select(
        F.col("flight_date").alias("d2"), F.col("origin").alias("y"), F.col("dest").alias("z"),
        *[F.col(c).alias(c + "2") for c in stat_cols])
    return first.join(second_side, ["y", "d2"])


def itinerary_counts(legs: DataFrame, gap_days: int = CONNECTION_GAP_DAYS) -> DataFrame:
    """``flight_date, x, y, z, n, best``: number of leg pairs and lowest total arrival delay."""
    c = connect(route_day_stats(legs, best_flight=False), gap_days)
    return c.select(
        "flight_date", "x", "y", "z",
        (F.col("n1") * F.col("n2")).alias("n"),
        (F.col("min_delay1") + F.col("min_delay2")).alias("best"),
    )


def best_itineraries(legs: DataFrame, gap_days: int = CONNECTION_GAP_DAYS) -> DataFrame:
    """``flight_date, x, y, z, flight1, flight2, delay1, delay2, total_delay`` of each itinerary's best pair."""
    return best_from_stats(route_day_stats(legs), gap_days)


def best_from_stats(stats: DataFrame, gap_days: int = CONNECTION_GAP_DAYS,
                    second: DataFrame | None = None) -> DataFrame:
    """Same as ``best_itineraries`` but from already aggregated route-day rows (used by streams).

    ``second`` (optional) takes the second legs from another route-day frame.
    """
    c = connect(stats, gap_days, second)
    return c.select(
        "flight_date", "x", "y", "z",
        F.col("best1.flight").alias("flight1"),
        F.col("best2.flight").alias("flight2"),
        F.col("best1.delay").alias("delay1"),
        F.col("best2.delay").alias("delay2"),
        (F.col("best1.delay") + F.col("best2.delay")).alias("total_delay"),
    )


def route_day_best(legs: DataFrame, k: int) -> DataFrame:
    """Per (flight_date, origin, dest): ``best``, its k best different flights as (delay, flight) in that order.

    The k best are cut before and after the shuffle, so a route-day ships k rows per task however many
    flights it has, and no list is longer than k. Lines repeated for one flight count once.
    """
    own = Window.partitionBy(*ROUTE_DAY_KEYS).orderBy("arr_delay", "flight")
    flights = legs.groupBy(*ROUTE_DAY_KEYS, "arr_delay", "flight").agg(F.count(F.lit(1)).alias("m"))
    top = flights.withColumn("i", F.row_number().over(own)).where(F.col("i") <= k)
    entry = F.struct(F.col("arr_delay").alias("delay"), F.col("flight").alias("flight"))
    return top.groupBy(*ROUTE_DAY_KEYS).agg(F.array_sort(F.collect_list(entry)).alias("best"))


def top_from_best(route_days: DataFrame, k: int, gap_days: int = CONNECTION_GAP_DAYS) -> DataFrame:
    """``flight_date, x, y, z, rank, flight1, flight2, delay1, delay2, total_delay``: each itinerary's k best
    pairs, by total, then by the first and the second leg's (delay, flight), from ``route_day_best`` rows.

    Two lists of k entries are merged into at most k * (1 + 1/2 + .. + 1/k) candidates, a batch of joined rows
    at a time. The lists are in order, so a stable sort of the candidates (i, j) by total is the order wanted.
    """
    keys = ["flight_date", "x", "y", "z"]
    c = connect(route_days, gap_days).select(*keys, "best1", "best2")
    entry = c.schema["best1"].dataType.elementType
    delay, flight = entry["delay"].dataType, entry["flight"].dataType
    schema = StructType([*[c.schema[name] for name in keys], StructField("rank", LongType()), StructField("flight1", flight),
                         StructField("flight2", flight), StructField("delay1", delay), StructField("delay2", delay),
                         StructField("total_delay", delay)])
    cells = [(i, j) for i in range(k) for j in range(k) if (i + 1) * (j + 1) <= k]

    def merged(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        places = np.array(cells).T
        for batch in batches:
            legs = [batch.column("best1"), batch.column("best2")]
            starts = [x.offsets.to_numpy()[:-1] for x in legs]
            delays, flights = ([x.values.field(name) for x in legs] for name in ("delay", "flight"))
            has, total = True, 0
            for x, start, own, place in zip(legs, starts, delays, places, strict=True):
                there = place < np.diff(x.offsets.to_numpy())[:, None]
                has = has & there
                total = total + own.to_numpy(zero_copy_only=False)[np.where(there, start[:, None] + place, start[:, None])]
            order = np.lexsort((total, ~has), axis=-1)[:, :k]
            kept = np.take_along_axis(has, order, axis=-1)
            row, rank = np.nonzero(kept)
            one, two = (pa.array(start[row] + place[order[kept]]) for start, place in zip(starts, places, strict=True))
            row = pa.array(row)
            d1, d2 = delays[0].take(one), delays[1].take(two)
            yield pa.RecordBatch.from_arrays([*[batch.column(name).take(row) for name in keys], pa.array(rank + 1, pa.int64()),
                                              flights[0].take(one), flights[1].take(two), d1, d2, pc.add(d1, d2)], names=schema.names)

    return c.mapInArrow(merged, schema)


def top_itineraries(legs: DataFrame, k: int = 10, gap_days: int = CONNECTION_GAP_DAYS) -> DataFrame:
    """Each itinerary's k best pairs of flights; see ``top_from_best``."""
    # one shuffle that both sides of the join read (it is the second side's own); else flights are cut and listed for each
    return top_from_best(route_day_best(legs, k).repartition("origin", "flight_date"), k, gap_days)
