"""Exact deduplication as a stateful stream.

Each document becomes a feed row (digest of its text without ASCII blanks, code points, id, content
locator). A Structured Streaming query keeps, per digest and without expiry, the row that stays and
the number of copies, in RocksDB state on the executors' disks with its log in the checkpoint. Partial
aggregation runs before the shuffle, so a text repeated in a third of all rows costs one row per task.
Digests seen more than once are hits, and the hits' full texts are compared; texts that differ under
one digest are told apart by the text itself.

Defined results: a null text counts as empty, and all empty texts are equal. The row with the most code
points stays, then the smallest id (null last), then the first content locator, so of rows repeated with
the same id exactly one stays. An empty table gives an empty result. Other columns are neither read nor
returned, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import common as C
from skytally.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # many small stores: no disk space set aside per store, and commits write what changed
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), C.BLANK + "+", "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def running_groups(feed: DataFrame) -> DataFrame:
    """Per digest: the row that stays and the number of rows. Works on a stream and on a table."""
    best = F.min(F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("no_id"), "id", "file", "row"))
    return feed.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("size"))


def stream_groups(feed: DataFrame, table: str, checkpoint: str):
    """Start the stateful query: after each trigger, ``table``/batch=N holds the groups it changed."""
    spark = feed.sparkSession

    def save(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{table}/batch={batch}")

    old = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        return (running_groups(feed).writeStream.outputMode("update").foreachBatch(save)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def collided(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests of hits under which full texts differ: (digest).

    A bitmap of the hits' digests, of a fixed size, picks the rows; when it is crowded more rows pass,
    none is missed. Smallest and largest text per digest are combined before the shuffle.
    """
    picked = C.maybe_in(texts, ["digest"], groups.where(F.col("size") > 1))
    ends = picked.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
    return ends.where(F.col("lo") != F.col("hi")).select("digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", in_files: bool = False,
                digest: Callable[[Column], Column] = sha256, triggers: int = 3) -> DataFrame:
    """One row per document: id, file, row, digest, keep_id, group_size, kept.

    ``in_files``: ``docs`` is an unchanged read of Parquet files, whose rows the locator can point at;
    otherwise the rows are written to the shared folder first. ``triggers``: the feed is taken in
    about so many micro-batches.
    """
    spark = docs.sparkSession
    rows = C.located(docs, id_col, text_col, in_files)
    texts = rows.select("id", "file", "row", F.length(F.coalesce("text", F.lit(""))).alias("points"),
                        normalized(F.col("text")).alias("norm")).withColumn("digest", digest(F.col("norm")))
    feed_path = scratch_path(spark, "llm-dedup-feed")
    feed_rows = texts.select("digest", F.col("points").cast("long").alias("points"), "id", "file", "row")
    feed_rows.write.parquet(feed_path)
    schema = feed_rows.schema
    feed = spark.read.schema(schema).parquet(feed_path)
    n_files = max(1, len(feed.inputFiles()))

    table = scratch_path(spark, "llm-dedup-groups")
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max(1, -(-n_files // max(1, triggers)))).parquet(feed_path))
    empty = running_groups(feed.limit(0))
    empty.write.parquet(f"{table}/batch=-1")
    stream_groups(stream, table, scratch_path(spark, "llm-dedup-state")).awaitTermination()

    changes = spark.read.option("basePath", table).schema(empty.schema.add("batch", "long")).parquet(table)
    groups = C.materialize(changes.groupBy("digest").agg(
        F.max_by(F.struct("best", "size"), "batch").alias("g")).select("digest", "g.best", "g.size"), "dedup-latest")
    clash = C.materialize(collided(texts, groups), "dedup-clash")
    keep = [F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
            (F.col("best.file").eqNullSafe(F.col("file")) & F.col("best.row").eqNullSafe(F.col("row"))).alias("kept")]
    if clash.isEmpty():
        return feed.join(groups, "digest").select("id", "file", "row", "digest", *keep)
    # texts that share a digest and differ: the text is the key
    plain = feed.join(groups, "digest").join(clash, "digest", "left_anti").select("id", "file", "row", "digest", *keep)
    odd = C.materialize(texts.join(clash, "digest", "left_semi"), "dedup-odd")
    by_text = odd.groupBy("norm").agg(
        F.min(F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("no_id"), "id", "file", "row")).alias("best"),
        F.count(F.lit(1)).alias("size"))
    return plain.union(odd.join(by_text, "norm").select("id", "file", "row", "digest", *keep))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (an unchanged read of Parquet files) that stay, all columns."""
    return C.without_rows(docs, exact_dedup(docs, id_col, text_col, in_files=True).where(~F.col("kept")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(C.read_documents(spark, sf_dir), in_files=True)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP10_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256,
                  row_number() OVER () AS r
           FROM documents),
     w AS (SELECT *, row_number() OVER k AS rank, first_value(doc_id) OVER k AS keep_id,
                  count(*) OVER (PARTITION BY text_sha256) AS group_size
           FROM t WINDOW k AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST, r))
SELECT doc_id, keep_id, group_size, rank = 1 AS kept, text_sha256 FROM w
"""
