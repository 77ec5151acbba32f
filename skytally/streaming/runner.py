"""Streaming versions of the queries.

Counting runs as a Structured Streaming aggregation (state in the checkpoint,
no key ever expires, the same as a running total per key). Ranking, per-group
top-k and the itinerary join run per micro-batch inside ``foreachBatch`` on the
aggregation's output (``streaming.changelog`` has the tables):

* ``mode="complete"``: every trigger emits the full counted table (the
  original jobs re-emitted all keys every batch) and the result is written as
  a new snapshot.
* ``mode="update"``: only keys whose count changed are emitted and appended to
  a log; what a trigger costs follows what it changed, not the size of the
  table. Readers merge the log: newest value per key, highest items per group.

Triggers: ``{"processingTime": "2 seconds"}`` in production, ``{"availableNow":
True}`` for replays and tests.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skytally.operators import (
    best_from_stats,
    legs,
    rank_by_count,
    rejects,
    route_day_stats,
    top_k_per_group,
    top_n,
)
from skytally.operators.topk import DEFAULT_K
from skytally.plans import queries as Q
from skytally.session import checkpoint_root
from skytally.sources.lines import TRIGGER_SECONDS
from skytally.streaming.changelog import (
    BATCH,
    DEFAULT_KEEP_VERSIONS,
    append_batch,
    change_sink,
    check_table_matches_checkpoint,
    history,
    ranking_sink,
    show_rows,
    snapshot_sink,
    arranged,
    keyed,
    read_latest,
)

DEFAULT_TRIGGER = {"processingTime": f"{TRIGGER_SECONDS} seconds"}


#: State on the executors' disks instead of their memory; a trigger uploads its changes, not all files.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession):
    """Queries started inside keep their state in RocksDB with a changelog (a query keeps the setting it was first started with)."""
    old = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_state_counts(spark: SparkSession, checkpoint: str, value: str = "popularity", batch_id: int | None = None) -> DataFrame:
    """A count stream's running counts, key columns and ``value``, read from its checkpoint: as of the newest
    committed batch, or of ``batch_id``. The stream may be stopped; nothing is recounted."""
    reader = spark.read.format("statestore").option("path", checkpoint)
    state = (reader if batch_id is None else reader.option("batchId", batch_id)).load()
    return state.select("key.*", F.col("value.count").alias(value))


def start(stream_df: DataFrame, sink, checkpoint: str, output_mode: str = "complete",
          trigger: dict | None = None, query_name: str | None = None,
          tables: tuple[str, ...] = ()) -> StreamingQuery:
    """Start ``stream_df`` into the foreachBatch ``sink``; ``tables`` are the result tables it writes."""
    for table in tables:
        check_table_matches_checkpoint(stream_df.sparkSession, table, checkpoint)
    w = (stream_df.writeStream.outputMode(output_mode).foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER)))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def _then(first, post):
    if post is None:
        return first
    if first is None:
        return post
    return lambda df: post(first(df))


def _count_stream(counts: DataFrame, table: str, checkpoint: str, trigger: dict | None, mode: str, ranked: bool,
                  top: int | None, post, keep_versions: int | None, show: int) -> StreamingQuery:
    if mode not in ("complete", "update"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "update":
        if top is not None:
            raise ValueError("top-n is cut from every key each batch: use mode='complete', or read_ranked(..., top=n)")
        if ranked and post is not None:
            raise ValueError("ranks are given when the log is read: use it without a layout")
        # a layout works row by row, and its first column is the key
        key = "id" if post is None else post(counts).columns[0]
        sink = change_sink(table, [key], post, show)
    else:
        if top is not None and ranked:
            raise ValueError("top-n or a full ranking, not both")
        arrange = (lambda df: top_n(df, top)) if top is not None else rank_by_count if ranked else None
        sink = snapshot_sink(table, _then(arrange, post), keep_versions, show)
    return start(counts, sink, checkpoint, mode, trigger, tables=(table,))


def airport_popularity_stream(lines: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
                              mode: str = "complete", ranked: bool = False, top: int | None = None, post=None,
                              keep_versions: int | None = DEFAULT_KEEP_VERSIONS, show: int = 0) -> StreamingQuery:
    """Running ``id, popularity`` per airport into ``table``.

    ``ranked=True`` adds the global ``rank`` (in update mode the log holds the counts and ``read_ranked`` gives
    the ranks); ``top=n`` keeps only the n busiest; ``post`` reshapes the rows (e.g.
    ``plans.layout.counts_layout``); ``show=n`` prints n rows per trigger.
    """
    return _count_stream(Q.airport_popularity(lines), table, checkpoint, trigger, mode, ranked, top, post, keep_versions, show)


def carrier_on_time_stream(lines: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
                           mode: str = "complete", ranked: bool = False, top: int | None = None, post=None,
                           keep_versions: int | None = DEFAULT_KEEP_VERSIONS, show: int = 0) -> StreamingQuery:
    """Running ``id, popularity`` of on-time arrivals per carrier into ``table``."""
    return _count_stream(Q.carrier_on_time_arrivals(lines), table, checkpoint, trigger, mode, ranked, top, post, keep_versions, show)


def read_ranked(spark: SparkSession, table: str, top: int | None = None, **at) -> DataFrame:
    """``rank, id, popularity`` of an update-mode counts table (``at``: as in ``read_latest``), or its first ``top``.

    The log holds each trigger's changed counts; the order is made when it is asked for, by a range sort.
    """
    counts = read_latest(spark, table, **at)
    return rank_by_count(counts) if top is None else top_n(counts, top)


def grouped_top_k_stream(lines: DataFrame, spec: Q.GroupedRanking, table: str, checkpoint: str,
                         trigger: dict | None = None, k: int = DEFAULT_K, mode: str = "complete", layout: str = "long",
                         keep_versions: int | None = DEFAULT_KEEP_VERSIONS, show: int = 0) -> StreamingQuery:
    """Running per-group top-k into ``table``.

    ``layout``: ``long`` rows with their rank, ``packed`` lists, or ``original`` (the original table's attributes).
    In update mode a trigger appends the k highest of each group's changed items, and ``read_latest`` merges
    them to the same rows.
    """
    group = spec.group_cols
    counts = Q.grouped_counts(lines, spec)
    if mode == "complete":
        sink = snapshot_sink(table, lambda df: arranged(top_k_per_group(df, group, "item", "n", k), group, layout), keep_versions, show)
    elif mode == "update":
        sink = ranking_sink(table, group, k, layout, show)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return start(counts, sink, checkpoint, mode, trigger, tables=(table,))


ROUTE_DAY_KEYS = ["flight_date", "origin", "dest"]
ITINERARY_KEYS = ["flight_date", "x", "y", "z"]
FEW_DAYS = 64   # of a trigger, read one by one; of more, the range that they span


def _near_days(changes: DataFrame, gap_days: int):
    """A filter on ``flight_date``: the days of ``changes``, and those ``gap_days`` before and after."""
    days = [r[0] for r in changes.select("flight_date").distinct().limit(FEW_DAYS + 1).collect()]
    if len(days) > FEW_DAYS:
        lo, hi = changes.agg(F.date_sub(F.min("flight_date"), gap_days), F.date_add(F.max("flight_date"), gap_days)).first()
        return F.col("flight_date").between(lo, hi)
    step = timedelta(days=gap_days)
    return F.col("flight_date").isin(sorted({d + k * step for d in days for k in (-1, 0, 1)}))


def itinerary_stream(lines: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
                     gap_days: int = 2, mode: str = "update", route_days_table: str | None = None, post=None,
                     keep_versions: int | None = DEFAULT_KEEP_VERSIONS, show: int = 0) -> StreamingQuery:
    """Best two-leg itineraries over all legs seen so far.

    The streaming state is one row per (date, origin, dest) route-day, so legs
    that arrive in different micro-batches still connect, however late.

    * ``mode="update"``: a trigger emits the route-days that got flights. Those whose best flight
      changed are appended to ``route_days_table``, and the itineraries that have one of them as
      first or second leg to ``table``. A best flight only ever gets better, so the newest row of a
      route-day, and of an itinerary, is its lowest. Only the days around the changed ones are read:
      files whose dates lie elsewhere are skipped by their statistics.
    * ``mode="complete"``: every trigger joins all route-days and writes the whole
      result, like the original jobs; its cost grows with all that was ever seen.

    ``post`` reshapes the rows (e.g. ``plans.layout.itineraries_layout``); its first column is then the key.
    """
    stats = route_day_stats(legs(lines), streaming=True)
    if mode == "complete":
        checkpoint_root(lines.sparkSession)
        # from files: a second use of the batch in a join is a plan that its cache doesn't serve, and runs the state stage again
        arrange = _then(lambda s: best_from_stats(s.checkpoint(), gap_days), post)
        return start(stats, snapshot_sink(table, arrange, keep_versions, show), checkpoint, "complete", trigger, tables=(table,))
    if mode != "update":
        raise ValueError(f"unknown mode {mode!r}")
    rd_table = route_days_table or table.rstrip("/") + "_route_days"
    spark = lines.sparkSession      # the stream's own copy of it makes plans that don't adapt to their sizes

    def near_changes(batch_df: DataFrame, batch_id: int):
        """Append the route-days that this trigger made better to their table; returns a filter for the days around.

        The batch is joined here once, and what follows reads files: a second use of it in a join is a plan
        that its cache doesn't serve, and restores and saves the state again.
        """
        emitted = batch_df.select(*ROUTE_DAY_KEYS, "best").persist()
        try:
            if not batch_id:
                append_batch(emitted, rd_table, batch_id)
                return F.lit(True)
            near = _near_days(emitted, gap_days)
            known = history(batch_df.sparkSession, rd_table, upto=batch_id - 1).where(near)
            old = known.groupBy(*ROUTE_DAY_KEYS).agg(F.min("best").alias("old"))
            better = emitted.join(old, ROUTE_DAY_KEYS, "left").where(F.col("old").isNull() | (F.col("best") < F.col("old")))
            append_batch(better.drop("old"), rd_table, batch_id)
            return near
        finally:
            emitted.unpersist()

    def update_sink(batch_df: DataFrame, batch_id: int) -> None:
        near = near_changes(batch_df, batch_id)
        known = history(spark, rd_table, upto=batch_id).where(near)
        now = known.groupBy(*ROUTE_DAY_KEYS).agg(F.min("best").alias("best"), F.max(BATCH).alias(BATCH)).persist()
        try:
            every = now.drop(BATCH)
            if batch_id == 0:
                affected = best_from_stats(every, gap_days)
            else:
                # a changed first leg with any second one, and an unchanged first leg with a changed second one
                changed, unchanged = now.where(F.col(BATCH) == batch_id).drop(BATCH), now.where(F.col(BATCH) < batch_id).drop(BATCH)
                as_first = best_from_stats(changed, gap_days, second=every)
                affected = as_first.unionByName(best_from_stats(unchanged, gap_days, second=changed))
            affected = post(affected) if post is not None else affected
            keys = ITINERARY_KEYS if post is None else affected.columns[:1]
            append_batch(keyed(affected, keys), table, batch_id)
            if show:
                show_rows(spark.read.parquet(f"{table.rstrip('/')}/{BATCH}={batch_id}").select("key.*", "value.*"), batch_id, show)
        finally:
            now.unpersist()

    return start(stats, update_sink, checkpoint, "update", trigger, tables=(table, rd_table))


def reject_stream(lines: DataFrame, job: str, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the lines that ``job`` cannot use, with their reason, to the Parquet folder ``path``."""
    return (rejects(lines, job).writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER)).start())


def top_n_stream(counts: DataFrame, n: int = 10, by: str = "popularity", key: str = "id") -> DataFrame:
    """Top-n of a streaming count (complete mode only), e.g. for a console sink."""
    return top_n(counts, n, by, key)


def console_top10(counts: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """Print the ten highest counts every trigger (the original jobs' print())."""
    return (top_n_stream(counts).writeStream.outputMode("complete").format("console")
            .option("numRows", 10).option("truncate", "false")
            .trigger(**(trigger or DEFAULT_TRIGGER)).start())
