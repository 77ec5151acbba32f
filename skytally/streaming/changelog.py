"""Result tables written from ``foreachBatch``: plain Parquet folders, read by what their rows say.

* **Change log** (update mode), ``<table>/batch=N/part-*``: each micro-batch appends the rows that it changed,
  as a struct ``key`` and a struct ``value``. The current table is the newest value per key. A trigger reads
  nothing and writes its changes, in as many tasks as they have partitions.
* **Ranking log** (update mode), the same folders with ``key`` (the group), ``item``, ``n``, ``k`` and
  ``layout``: at most k rows per touched group and trigger. Counts only grow, so whatever is among a group's k
  highest was among the k highest of the trigger that last changed it, and the highest n of an item is its
  newest: a maximum and a top-k at reading give the ranking, ties included, without the counts of the others.
* **Snapshot** (complete mode), ``<table>/slot=s/part-*``: each micro-batch is the whole table, written over the
  oldest of ``keep`` slots with its ``batch`` as a column. The current table is the rows of the highest one.

A replayed batch overwrites its own folder, so the sinks are idempotent under foreachBatch's at-least-once
delivery; write errors fail the query. With a ``checkpoint``, readers take batches that the stream has
committed only; without one, also what is being written now. A log is shortened by an ordinary job:
``compact`` writes its current rows as one batch of another table, which can be read in place of all
older batches (``base``), or go on as the stream's table after a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.operators import pack_top_k, top_k_per_group
from skytally.plans import layout as L

BATCH = "batch"
SLOT = "slot"
ONCE = -1                     # the "batch" of a batch job's rows
DEFAULT_KEEP_VERSIONS = 10    # slots of a snapshot table
LAYOUTS = ("long", "packed", "original")

BatchTransform = Callable[[DataFrame], DataFrame]


# --------------------------------------------------------------------- reading

def _folder(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet folder, or None if there is none (yet)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def last_committed(spark: SparkSession, checkpoint: str) -> int | None:
    """The newest batch that the stream of this checkpoint has committed."""
    try:
        log = spark.read.text(f"{checkpoint.rstrip('/')}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    name = log.metadataColumn("_metadata")["file_name"]
    return log.select(name.alias("f")).where(F.col("f").rlike("^[0-9]+$")).agg(F.max(F.col("f").cast("long"))).first()[0]


def history(spark: SparkSession, table: str, upto: int | None = None, base: str | None = None) -> DataFrame:
    """All rows of a table with their ``batch``, up to one batch.

    ``base``: a compacted copy; only younger batches are then read from ``table`` itself.
    """
    found = _folder(spark, table)
    if found is None:
        raise FileNotFoundError(f"no rows under {table}")
    if base is not None:
        old = spark.read.parquet(base)
        last = old.agg(F.max(BATCH)).first()[0]
        if last is not None:
            found = found.where(F.col(BATCH) > last).unionByName(old)
    return found if upto is None else found.where(F.col(BATCH) <= upto)


def newest(rows: DataFrame) -> DataFrame:
    """``key`` and its newest ``value``."""
    return rows.groupBy("key").agg(F.max_by("value", BATCH).alias("value"))


def highest(rows: DataFrame) -> DataFrame:
    """A ranking log's rows merged: group columns, item, n, rank."""
    group = rows.schema["key"].dataType.names
    k = rows.agg(F.max("k")).first()[0] or 0    # the same in every row
    merged = rows.groupBy("key", "item").agg(F.max("n").alias("n"))
    return top_k_per_group(merged.select("key.*", "item", "n"), group, k=k)


def is_ranking(rows: DataFrame) -> bool:
    return {"key", "item", "n", "k"} <= set(rows.columns)


def arranged(top: DataFrame, group: list[str], layout: str) -> DataFrame:
    """Long rows, one list per group, or the original table's attributes."""
    if layout == "long":
        return top.select(*group, "item", "n", "rank")
    packed = pack_top_k(top, group)
    return packed if layout == "packed" else L.lists_layout(packed, group)


def read_latest(spark: SparkSession, table: str, checkpoint: str | None = None, upto: int | None = None,
                base: str | None = None) -> DataFrame:
    """The table's current rows, whatever its kind; or as of the batch ``upto``."""
    if checkpoint is not None:
        done = last_committed(spark, checkpoint)
        if done is None:
            raise FileNotFoundError(f"{checkpoint} has no committed batch")
        upto = done if upto is None else min(upto, done)
    rows = history(spark, table, upto, base)
    if SLOT in rows.columns:
        last = rows.agg(F.max(BATCH)).first()[0]
        return rows.where(F.col(BATCH) == F.lit(last)).drop(BATCH, SLOT)
    if is_ranking(rows):
        first = rows.select("layout").first()   # the same in every row
        return arranged(highest(rows), rows.schema["key"].dataType.names, first[0] if first else "long")
    return newest(rows).select("key.*", "value.*")


def newest_batch(spark: SparkSession, table: str) -> int | None:
    rows = _folder(spark, table)
    return rows.agg(F.max(BATCH)).first()[0] if rows is not None else None


def check_table_matches_checkpoint(spark: SparkSession, table: str, checkpoint: str) -> None:
    """Refuse a table of another run: batch numbers are the checkpoint's.

    A fresh checkpoint would start again at 0 under the other run's rows, and one that has committed
    batches would go on without the rows of a table that is gone.
    """
    done, rows = last_committed(spark, checkpoint), _folder(spark, table)
    if done is None and rows is not None:
        last = rows.agg(F.max(BATCH)).first()[0]
        if last is not None and last != 0:     # batch 0 may have been written just before a failure
            raise ValueError(f"{table} already holds rows of another run; use a new table path, "
                             f"or restart with the checkpoint that wrote it")
    if done is not None and rows is None:
        raise ValueError(f"{checkpoint} has committed batches, but {table} holds none: rows would be missing")


# --------------------------------------------------------------------- writing

def append_batch(rows: DataFrame, table: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{table.rstrip('/')}/{BATCH}={int(batch_id)}")


def keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """(key, value) structs of a change log."""
    return df.select(F.struct(*keys).alias("key"), F.struct(*[c for c in df.columns if c not in keys]).alias("value"))


def write_snapshot(df: DataFrame, table: str, batch_id: int, keep: int = DEFAULT_KEEP_VERSIONS) -> None:
    """``df`` is the whole table; it takes the place of the oldest of ``keep`` snapshots."""
    slot = max(0, batch_id) % max(1, keep)
    df.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{table.rstrip('/')}/{SLOT}={slot}")


def write_once(df: DataFrame, table: str) -> None:
    """A batch job's result in a table of its own; replaces an earlier batch job's, never a stream's."""
    rows = _folder(df.sparkSession, table)
    if rows is not None and (SLOT not in rows.columns or not rows.where(F.col(BATCH) != ONCE).isEmpty()):
        raise ValueError(f"{table} belongs to a stream; write batch results to a table of their own")
    write_snapshot(df, table, ONCE)


def compact(spark: SparkSession, table: str, target: str, upto: int | None = None) -> None:
    """Write a log's current rows to ``target`` as its one batch: an ordinary job, beside the stream or instead of it."""
    rows = history(spark, table, upto)
    last = rows.agg(F.max(BATCH)).first()[0]
    if last is None:
        return
    if is_ranking(rows):
        group = rows.schema["key"].dataType.names
        fixed = rows.agg(F.max("k"), F.max("layout")).first()
        out = highest(rows).select(F.struct(*group).alias("key"), "item", "n", F.lit(fixed[0]).alias("k"), F.lit(fixed[1]).alias("layout"))
    else:
        out = newest(rows)
    append_batch(out, target, last)


# ----------------------------------------------------------------------- sinks

def show_rows(df: DataFrame, batch_id: int, rows: int) -> None:
    """Print ``rows`` rows of what a batch wrote, like a console sink, from the same run."""
    if rows:
        print(f"-------------------------------------------\nBatch: {batch_id}")
        df.show(rows, truncate=False)


def snapshot_sink(table: str, transform: BatchTransform | None = None, keep: int | None = DEFAULT_KEEP_VERSIONS, show: int = 0):
    """foreachBatch function for complete-mode output. ``show``: also print so many rows."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        # several passes over the batch (range sort, self-join, print) must not run its state stage again
        cached = batch_df.persist()
        try:
            out = transform(cached) if transform else cached
            write_snapshot(out, table, batch_id, keep or DEFAULT_KEEP_VERSIONS)
            show_rows(out, batch_id, show)
        finally:
            cached.unpersist()
    return sink


def change_sink(table: str, keys: list[str], transform: BatchTransform | None = None, show: int = 0):
    """foreachBatch function for update-mode output: appends the changed rows, keyed on ``keys``."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        changes = transform(batch_df) if transform else batch_df
        if not show:
            append_batch(keyed(changes, keys), table, batch_id)
            return
        cached = changes.persist()
        try:
            append_batch(keyed(cached, keys), table, batch_id)
            show_rows(cached, batch_id, show)
        finally:
            cached.unpersist()
    return sink


def ranking_sink(table: str, group: list[str], k: int, layout: str = "long", show: int = 0):
    """foreachBatch function for running counts (group, item, n) in update mode: the k highest changed items per group."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        top = top_k_per_group(batch_df, group, "item", "n", k)
        out = top.select(F.struct(*group).alias("key"), "item", "n", F.lit(k).alias("k"), F.lit(layout).alias("layout"))
        append_batch(out, table, batch_id)
        if show:
            show_rows(batch_df.sparkSession.read.parquet(f"{table.rstrip('/')}/{BATCH}={batch_id}").select("key.*", "item", "n"), batch_id, show)
    return sink
