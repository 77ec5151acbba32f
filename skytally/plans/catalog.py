"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every entry derives its lines from the supplied tables with Spark and runs
over all of them. ``stream_*`` and ``sink_*`` entries replay the lines through
the streaming runners (several micro-batches, ``availableNow``) and return
the final result table, which must equal the batch answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from skytally.operators import LEG_JOB, rejects
from skytally.plans import diagnostics as D
from skytally.plans import queries as Q
from skytally.plans import layout as L
from skytally.sources import defect_itinerary_lines, defect_on_time_lines, itinerary_lines, on_time_lines
from skytally.streaming import runner as R
from skytally.streaming.accounts import Accounts, accounted
from skytally.streaming.changelog import compact, newest_batch, read_latest
from skytally.streaming.replay import replay

Query = Callable[[SparkSession, str], DataFrame]

def _five(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(on_time_lines(spark, sf_dir))


def _seven(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(itinerary_lines(spark, sf_dir))


def _five_defects(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(defect_on_time_lines(spark, sf_dir))


def _seven_defects(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(defect_itinerary_lines(spark, sf_dir))


def _iso_dates(df: DataFrame) -> DataFrame:
    """Registry output only: DATE columns as ``yyyy-MM-dd`` text, so the comparison with the
    oracle does not depend on how a client library represents dates."""
    return df.select(*[F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, DateType)
                       else F.col(f.name) for f in df.schema.fields])


def _dated(query: Query) -> Query:
    return lambda spark, sf_dir: _iso_dates(query(spark, sf_dir))


def _joined_items(df: DataFrame, group_cols: list[str]) -> DataFrame:
    return df.select(*group_cols, F.array_join("items", "|").alias("items"))


def _joined_list(df: DataFrame) -> DataFrame:
    return df.select("Id", F.array_join("CarriersList", "|").alias("CarriersList"))


def _packed(spec: Q.GroupedRanking) -> Query:
    return _five(lambda lines: _joined_items(Q.packed_top_k(lines, spec), spec.group_cols))


def _pair_counts(lines: DataFrame) -> DataFrame:
    c = Q.grouped_counts(lines, Q.CARRIERS_BY_AIRPORT)
    return c.select(F.col("airport").alias("origin"), F.col("item").alias("carrier"), "n")


def _compacted(spark: SparkSession, base: str) -> DataFrame:
    """The log's first half as one batch of another table, and the younger batches on top of it."""
    half = newest_batch(spark, f"{base}/table") // 2
    compact(spark, f"{base}/table", f"{base}/compacted", upto=half)
    return read_latest(spark, f"{base}/table", base=f"{base}/compacted")


def _stream(name: str, start_fn, lines_fn=on_time_lines,
            post: Callable[[DataFrame], DataFrame] | None = None, read=None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = replay(spark, lines_fn(spark, sf_dir), start_fn, name, read=read)
        return post(out) if post else out
    return run


def _stream_rejects(job: str, lines_fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return replay(spark, lines_fn(spark, sf_dir), lambda lines, table, ckpt, trigger: R.reject_stream(lines, job, table, ckpt, trigger),
                      "stream-rejects", read=lambda s, base: s.read.parquet(f"{base}/table"))
    return run


def _line_accounts(job: str, lines_fn) -> Query:
    """What the triggers' observed metrics say about the lines, summed."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        started = []

        def job_stream(lines, table, ckpt, trigger):
            started.append(R.grouped_top_k_stream(accounted(lines, job), Q.CARRIERS_BY_ROUTE, table, ckpt, trigger, mode="update"))
            return started[0]

        replay(spark, lines_fn(spark, sf_dir), job_stream, "stream-accounts")
        accounts = Accounts()
        for progress in started[0].recentProgress:
            accounts.add(progress)
        return accounts.total(spark)
    return run


def _state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts as the stream's checkpoint holds them, on disk and with a changelog."""
    with R.state_on_disk(spark):
        return replay(spark, on_time_lines(spark, sf_dir),
                      lambda lines, table, ckpt, trigger: R.carrier_on_time_stream(lines, table, ckpt, trigger, mode="update"),
                      "stream-state", read=lambda s, base: R.read_state_counts(s, f"{base}/checkpoint"))


def _grouped_stream(spec: Q.GroupedRanking, **kw):
    return lambda lines, table, ckpt, trigger: R.grouped_top_k_stream(lines, spec, table, ckpt, trigger, **kw)


def queries() -> dict[str, Query]:
    return {
        # parsing layer
        "split_fields": _five(D.split_summary),
        "arity_histogram": _five(D.arity_histogram),
        "numeric_delays": _five(D.numeric_delays),
        "on_time_flags": _five(D.on_time_flags),
        # the same over lines with planted defects of every kind
        "defect_split_fields": _five_defects(D.split_summary),
        "defect_airport_popularity": _five_defects(Q.airport_popularity),
        "defect_carrier_on_time_arrivals": _five_defects(Q.carrier_on_time_arrivals),
        "defect_top10_carriers_by_airport": _five_defects(Q.top10_carriers_by_airport),
        "defect_itinerary_best": _dated(_seven_defects(Q.best_itineraries)),
        "reject_summary": _five_defects(D.reject_summary),
        "leg_reject_summary": _seven_defects(D.leg_reject_summary),
        "rejected_lines": _five_defects(D.all_rejects),
        "rejected_legs": _seven_defects(lambda lines: rejects(lines, LEG_JOB)),
        "stream_rejects": _stream_rejects("carriers-by-route", defect_on_time_lines),
        "stream_leg_rejects": _stream_rejects(LEG_JOB, defect_itinerary_lines),
        # Q1.1 airports
        "airport_popularity": _five(Q.airport_popularity),
        "airports_ranked": _five(Q.airports_ranked),
        "top10_airports": _five(Q.top10_airports),
        "bottom10_airports": _five(Q.bottom10_airports),
        # Q1.2 carriers
        "carrier_on_time_arrivals": _five(Q.carrier_on_time_arrivals),
        "carriers_ranked": _five(Q.carriers_ranked),
        "top10_carriers": _five(Q.top10_carriers),
        # Q2.x grouped top-10
        "pair_counts": _five(_pair_counts),
        "top10_carriers_by_airport": _five(Q.top10_carriers_by_airport),
        "top10_destinations_by_airport": _five(Q.top10_destinations_by_airport),
        "top10_carriers_by_route": _five(Q.top10_carriers_by_route),
        "packed_top10_carriers_by_airport": _packed(Q.CARRIERS_BY_AIRPORT),
        "packed_top10_destinations_by_airport": _packed(Q.DESTINATIONS_BY_AIRPORT),
        "packed_top10_carriers_by_route": _packed(Q.CARRIERS_BY_ROUTE),
        # Q3.2 itineraries
        "date_parse": _dated(_seven(D.date_parse_summary)),
        "date_shift": _dated(_seven(D.date_shift_summary)),
        "leg_union": _dated(_seven(D.leg_union_counts)),
        "itinerary_legs": _dated(_seven(Q.itinerary_counts)),
        "itinerary_best": _dated(_seven(Q.best_itineraries)),
        "itinerary_top10": _dated(_seven(Q.itinerary_top10)),
        "itinerary_top10_layout": _seven(lambda lines: _joined_list(L.top_itineraries_layout(Q.itinerary_top10(lines)))),
        "defect_itinerary_top10": _dated(_seven_defects(Q.itinerary_top10)),
        # streaming replays: final table == batch answer
        "stream_airport_popularity": _stream("stream-airports", R.airport_popularity_stream),
        "stream_airports_ranked": _stream(
            "stream-airports-ranked",
            lambda lines, table, ckpt, trigger: R.airport_popularity_stream(lines, table, ckpt, trigger,
                                                                            ranked=True)),
        "stream_top10_airports": _stream(
            "stream-top10-airports",
            lambda lines, table, ckpt, trigger: R.airport_popularity_stream(lines, table, ckpt, trigger, top=10)),
        "stream_carrier_on_time": _stream("stream-carriers", R.carrier_on_time_stream),
        "stream_top10_carriers": _stream(
            "stream-top10-carriers",
            lambda lines, table, ckpt, trigger: R.carrier_on_time_stream(lines, table, ckpt, trigger, top=10)),
        "stream_top10_carriers_by_airport": _stream("stream-carriers-by-airport",
                                                    _grouped_stream(Q.CARRIERS_BY_AIRPORT)),
        "stream_top10_destinations_by_airport": _stream("stream-destinations-by-airport",
                                                        _grouped_stream(Q.DESTINATIONS_BY_AIRPORT)),
        "stream_top10_carriers_by_route": _stream("stream-carriers-by-route",
                                                  _grouped_stream(Q.CARRIERS_BY_ROUTE)),
        "stream_top10_carriers_by_route_update": _stream(
            "stream-carriers-by-route-update", _grouped_stream(Q.CARRIERS_BY_ROUTE, mode="update")),
        "stream_itinerary": _dated(_stream(
            "stream-itinerary",
            lambda lines, table, ckpt, trigger: R.itinerary_stream(lines, table, ckpt, trigger, mode="complete"),
            lines_fn=itinerary_lines)),
        "stream_itinerary_update": _dated(_stream(
            "stream-itinerary-update", R.itinerary_stream, lines_fn=itinerary_lines)),
        "itinerary_layout": _seven(lambda lines: _joined_list(L.itineraries_layout(Q.best_itineraries(lines)))),
        "stream_line_accounts": _line_accounts("carriers-by-route", defect_on_time_lines),
        "stream_state_counts": _state_counts,
        # change logs in update mode, several micro-batches
        "stream_airports_ranked_update": _stream(
            "stream-airports-ranked-update",
            lambda lines, table, ckpt, trigger: R.airport_popularity_stream(lines, table, ckpt, trigger, mode="update", ranked=True),
            read=lambda spark, base: R.read_ranked(spark, f"{base}/table", checkpoint=f"{base}/checkpoint")),
        "stream_top10_carriers_by_airport_update": _stream(
            "stream-carriers-by-airport-update", _grouped_stream(Q.CARRIERS_BY_AIRPORT, mode="update")),
        "stream_top10_destinations_by_airport_update": _stream(
            "stream-destinations-by-airport-update", _grouped_stream(Q.DESTINATIONS_BY_AIRPORT, mode="update")),
        "stream_carriers_compacted": _stream(
            "stream-carriers-compacted", lambda lines, table, ckpt, trigger: R.carrier_on_time_stream(lines, table, ckpt, trigger, mode="update"),
            read=_compacted),
        "sink_upsert_counts": _stream(
            "sink-counts",
            lambda lines, table, ckpt, trigger: R.airport_popularity_stream(lines, table, ckpt, trigger,
                                                                            mode="update")),
        "sink_upsert_lists": _stream(
            "sink-lists", _grouped_stream(Q.CARRIERS_BY_AIRPORT, mode="update", layout="packed"),
            post=lambda df: _joined_items(df, ["airport"])),
    }
