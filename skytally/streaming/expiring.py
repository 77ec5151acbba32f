"""Itineraries as a stream-stream join whose state expires (an alternative to ``runner.itinerary_stream``).

Two queries. ``gate_late_legs`` reads the lines and parts the legs by event time: a leg more than ``delay_days``
older than the newest flight date seen so far, its own trigger included, goes to ``late`` with a reason, the
others to ``accepted``. ``expiring_itineraries`` reads ``accepted``: per day and route the best flight, emitted
once the watermark has passed the day, and a join of these rows with those of ``gap_days`` later, with
watermarks on both sides, in append mode. Its watermark never passes the gate's limit, so it drops no leg that
the gate let through, and no leg is lost unreported.

State is bounded by the days between the watermark and the newest date, and ``gap_days`` more for the join; an
itinerary is written once and is final, at the earliest ``gap_days`` + ``delay_days`` after its first leg. One line
with a date far in the future makes everything else late: use ``runner.itinerary_stream``, which keeps all
route-days, where dates can't be trusted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from skytally.functions.dates import CONNECTION_GAP_DAYS
from skytally.operators import legs
from skytally.streaming.changelog import append_batch, history, write_snapshot
from skytally.streaming.runner import DEFAULT_TRIGGER, start

DELAY_DAYS = 1
LEG = StructType([StructField("flight_date", DateType()), StructField("flight", LongType()), StructField("origin", StringType()),
                  StructField("dest", StringType()), StructField("arr_delay", DoubleType())])


def gate_late_legs(lines: DataFrame, accepted: str, late: str, checkpoint: str, delay_days: int = DELAY_DAYS,
                   trigger: dict | None = None) -> StreamingQuery:
    """Append each trigger's legs to ``accepted``, or to ``late`` with ``reason``; lines that are no legs are left to the rejects."""
    clock = accepted.rstrip("/") + "_clock"     # one row per trigger, of the last few: the newest date so far

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        batch = batch_df.persist()
        try:
            newest = batch.agg(F.max("flight_date").alias("newest"))
            if batch_id:
                newest = newest.union(history(spark, clock, upto=batch_id - 1).select("newest")).agg(F.max("newest").alias("newest"))
            value = newest.first()[0]
            write_snapshot(spark.createDataFrame([(value,)], "newest date"), clock, batch_id)
            limit = F.lit(value).cast("date")
            in_time = F.coalesce(F.col("flight_date") >= F.date_sub(limit, delay_days), F.lit(False))
            append_batch(batch.where(in_time), accepted, batch_id)
            append_batch(batch.where(~in_time).withColumn("reason", F.lit("late")), late, batch_id)
        finally:
            batch.unpersist()

    return start(legs(lines), sink, checkpoint, "append", trigger, tables=(accepted, late))


def expiring_itineraries(spark: SparkSession, accepted: str, table: str, checkpoint: str, gap_days: int = CONNECTION_GAP_DAYS,
                         delay_days: int = DELAY_DAYS, trigger: dict | None = None) -> StreamingQuery:
    """Append final best itineraries, as ``best_itineraries`` has them, to the Parquet folder ``table``."""
    def route_days() -> DataFrame:
        flights = spark.readStream.schema(LEG).parquet(accepted).withColumn("at", F.col("flight_date").cast("timestamp"))
        best = F.min(F.struct(F.col("arr_delay").alias("delay"), F.col("flight").alias("flight"))).alias("best")
        return (flights.withWatermark("at", f"{delay_days} days").groupBy(F.window("at", "1 day"), "flight_date", "origin", "dest")
                .agg(best).withColumn("at", F.window_time("window")))

    first, second = route_days(), route_days()
    one = first.select(F.col("at").alias("t1"), "flight_date", F.date_add("flight_date", gap_days).alias("d2"),
                       F.col("origin").alias("x"), F.col("dest").alias("y"), F.col("best").alias("best1"))
    two = second.select(F.col("at").alias("t2"), F.col("flight_date").alias("day"), F.col("origin").alias("via"),
                        F.col("dest").alias("z"), F.col("best").alias("best2"))
    # the days are compared as dates; the time range, wide enough for clock changes, tells Spark what can go
    apart = (F.col("t2") >= F.col("t1") + F.expr(f"INTERVAL {24 * gap_days - 2} HOURS")) & (
        F.col("t2") <= F.col("t1") + F.expr(f"INTERVAL {24 * gap_days + 2} HOURS"))
    pairs = one.join(two, (F.col("y") == F.col("via")) & (F.col("d2") == F.col("day")) & apart)
    out = pairs.select("flight_date", "x", "y", "z", F.col("best1.flight").alias("flight1"), F.col("best2.flight").alias("flight2"),
                       F.col("best1.delay").alias("delay1"), F.col("best2.delay").alias("delay2"),
                       (F.col("best1.delay") + F.col("best2.delay")).alias("total_delay"))
    return (out.writeStream.format("parquet").outputMode("append").option("path", table)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER)).start())
