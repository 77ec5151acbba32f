"""Replay lines through a streaming query and read back its result table.

Lines are written (by Spark, in parallel) as text files under the session's
shared checkpoint folder, then consumed in a fixed number of micro-batches with
an ``availableNow`` trigger, the way a feeder pushes one file after another.
Used by tests, the query registry and the benchmark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skytally.session import scratch_path
from skytally.sources.lines import file_line_stream, write_lines
from skytally.streaming.changelog import read_latest

StartFn = Callable[[DataFrame, str, str, dict], StreamingQuery]


# Replays run in about so many micro-batches at any input size.
REPLAY_TRIGGERS = 4


def run_available(spark: SparkSession, input_path: str, work_dir: str, start_fn: StartFn,
                  max_files_per_trigger: int | None = 1, progress: list | None = None) -> DataFrame:
    """Run ``start_fn`` over the files in ``input_path`` until all are consumed.

    The result table and the checkpoint go under ``work_dir``. If ``progress``
    is a list, the query's per-trigger progress reports are appended to it.
    """
    stream = file_line_stream(spark, input_path, max_files_per_trigger)
    q = start_fn(stream, f"{work_dir}/table", f"{work_dir}/checkpoint", {"availableNow": True})
    q.awaitTermination()
    if progress is not None:
        progress.extend(q.recentProgress)
    return read_latest(spark, f"{work_dir}/table")


def replay(spark: SparkSession, lines: DataFrame, start_fn: StartFn, name: str, triggers: int = REPLAY_TRIGGERS,
           read=None) -> DataFrame:
    """Write ``lines`` as text files, stream them in about ``triggers`` micro-batches, drop the copy, return the table.

    ``read(spark, work_dir)`` returns another result than the table.
    """
    base = scratch_path(spark, name)
    src = f"{base}/input"
    # as many files as there are shuffle partitions, and enough for that many triggers
    n = max(triggers, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write_lines(lines.repartition(n), src, records_per_file=None)
    files = len(spark.read.text(src).inputFiles())
    stream = file_line_stream(spark, src, max(1, -(-files // triggers)))
    q = start_fn(stream, f"{base}/table", f"{base}/checkpoint", {"availableNow": True})
    q.awaitTermination()
    out = read(spark, base) if read else read_latest(spark, f"{base}/table")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(src)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return out
