"""Line sources and the line writer used to replay data as a stream.

Every source yields a DataFrame with exactly one STRING column, ``line``, so the
batch and streaming paths share all transformation code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values ---
# Ingest limits of the original deployment: 100 000 records/s per receiver and a
# 2 second batch, i.e. at most 200 000 records per micro-batch.
RECORDS_PER_SECOND = 100_000
TRIGGER_SECONDS = 2
RECORDS_PER_TRIGGER = RECORDS_PER_SECOND * TRIGGER_SECONDS
# --- end of fixed values ---


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of text files (one line per record)."""
    return spark.read.text(path).select(F.col("value").alias("line"))


def byte_size(text: str | int) -> int:
    """Bytes of ``"512m"``, ``"2g"``, ``"64k"`` or a plain number."""
    text = str(text).strip().lower()
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[-1:], 1)
    return int(text[:-1] if unit > 1 else text) * unit


def file_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1,
                     clean_source: str | None = None, archive_dir: str | None = None,
                     max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Streaming replay of a directory of text files, ``max_files_per_trigger`` at a time
    (``None``: all there are), or up to ``max_bytes_per_trigger`` ("512m") instead.

    New files are picked up in modification-time order; the final result of
    every query in this package does not depend on that order.
    ``clean_source="archive"`` (with ``archive_dir``) or ``"delete"`` lets Spark
    move or remove files once their batch is committed, so a long-running feed
    does not accumulate processed input.
    """
    reader = spark.readStream
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", byte_size(max_bytes_per_trigger))
    elif max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source is not None:
        if clean_source not in ("archive", "delete"):
            raise ValueError("clean_source must be 'archive' or 'delete'")
        if clean_source == "archive" and not archive_dir:
            raise ValueError("clean_source='archive' needs archive_dir")
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.text(path).select(F.col("value").alias("line"))


def kafka_options(bootstrap_servers: str, topics: str | list[str], starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None, group_id_prefix: str | None = None) -> dict[str, str]:
    """Options for the Kafka source.

    ``topics`` may be a comma list or a Python list (multi-topic subscribe).
    Start defaults to ``latest`` (newest offsets, as an old high-level consumer
    with no reset setting). ``max_offsets_per_trigger`` caps the whole query's
    trigger; there is no cap by default. For the original rate per receiver pass
    ``RECORDS_PER_TRIGGER`` times the number of topic partitions.
    ``min_partitions`` plays the part of "threads per topic".
    """
    subscribe = topics if isinstance(topics, str) else ",".join(topics)
    subscribe = ",".join(t.strip() for t in subscribe.split(",") if t.strip())
    if not subscribe:
        raise ValueError("at least one topic is required")
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": subscribe,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions is not None:
        opts["minPartitions"] = str(int(min_partitions))
    if group_id_prefix:
        opts["groupIdPrefix"] = group_id_prefix
    return opts


def kafka_line_stream(spark: SparkSession, bootstrap_servers: str, topics: str | list[str],
                      **kwargs) -> DataFrame:
    """Kafka messages as lines: the value is kept, the key is dropped.

    Needs the ``spark-sql-kafka`` connector on the classpath (not bundled here).
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(bootstrap_servers, topics, **kwargs))
    try:
        raw = reader.load()
    except Exception as e:  # noqa: BLE001  (the data source is resolved on load)
        if "kafka" in str(e).lower() and ("find data source" in str(e).lower()
                                          or "DATA_SOURCE_NOT_FOUND" in str(e)):
            raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the classpath "
                               "(e.g. --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>)") from e
        raise
    return raw.select(F.col("value").cast("string").alias("line"))


def write_lines(lines: DataFrame, path: str, records_per_file: int | None = RECORDS_PER_TRIGGER) -> str:
    """Write lines as text files of at most ``records_per_file`` lines each (``None``: one per task).

    Paired with ``file_line_stream(max_files_per_trigger=1)`` this bounds every
    micro-batch the way the original per-receiver rate cap did. The write is
    parallel (one or more files per task); nothing goes through the driver.
    """
    (lines.select("line").write.mode("overwrite")
     .option("maxRecordsPerFile", int(records_per_file or 0)).text(path))
    return path
