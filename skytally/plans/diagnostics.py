"""Summaries of the parsing layer: how lines split, which fields are numeric,
which lines are rejected and why, how dates parse and shift.

Each is a single scan plus one partial/final aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions import field, format_date, is_numeric_literal, parse_date, shift_days
from skytally.functions.dates import CONNECTION_GAP_DAYS
from skytally.operators import (
    LEG_JOB,
    ON_TIME_JOBS,
    classify,
    count_by,
    flat_map_fields,
    leg_union,
    legs,
    on_time_records,
    records,
)
from skytally.operators.parse import LEG_FIELDS, ON_TIME_FIELDS, line_reason


def split_summary(lines: DataFrame) -> DataFrame:
    """``n_fields, f0, f1, f2, n``: lines by arity and first three fields."""
    rec = records(lines).select(F.size("f").cast("bigint").alias("n_fields"),
                                field("f", 0).alias("f0"), field("f", 1).alias("f1"), field("f", 2).alias("f2"))
    return count_by(rec, ["n_fields", "f0", "f1", "f2"])


def arity_histogram(lines: DataFrame) -> DataFrame:
    """``n_fields, n``."""
    return count_by(records(lines).select(F.size("f").cast("bigint").alias("n_fields")), ["n_fields"])


def numeric_delays(lines: DataFrame) -> DataFrame:
    """``which, is_numeric, n`` over the two delay fields of five-field lines."""
    both = F.array(
        F.struct(F.lit("dep").alias("which"), is_numeric_literal(field("f", 3)).alias("is_numeric")),
        F.struct(F.lit("arr").alias("which"), is_numeric_literal(field("f", 4)).alias("is_numeric")),
    )
    rows = records(lines).select(F.inline(F.when(F.size("f") == ON_TIME_FIELDS, both)))
    return count_by(rows, ["which", "is_numeric"])


def on_time_flags(lines: DataFrame) -> DataFrame:
    """``dep_on_time, arr_on_time, n`` over five-field lines."""
    return count_by(on_time_records(lines).select("dep_on_time", "arr_on_time"), ["dep_on_time", "arr_on_time"])


def reject_summary(lines: DataFrame) -> DataFrame:
    """``job, reason, n`` over five-field lines (``ok`` included): one scan, every job's reason per line."""
    rec = records(lines)
    each = F.array(*[F.struct(F.lit(j).alias("job"), line_reason(j).alias("reason")) for j in ON_TIME_JOBS])
    return count_by(rec.select(F.inline(each)), ["job", "reason"])


def leg_reject_summary(lines: DataFrame) -> DataFrame:
    """``reason, n`` for itinerary lines (``ok`` included)."""
    return count_by(classify(lines, LEG_JOB).select("reason"), ["reason"])


def all_rejects(lines: DataFrame) -> DataFrame:
    """``job, line, n_fields, reason``: what each of the five-field jobs rejects."""
    rec = records(lines, keep_line=True)
    each = F.array(*[F.struct(F.lit(j).alias("job"), line_reason(j).alias("reason")) for j in ON_TIME_JOBS])
    hits = rec.select("line", F.size("f").cast("bigint").alias("n_fields"), F.inline(F.filter(each, lambda x: x["reason"] != "ok")))
    return hits.select("job", "line", "n_fields", "reason")


def date_parse_summary(lines: DataFrame) -> DataFrame:
    """``d_raw, d, n``: raw date field of seven-field lines and its strict parse (NULL if invalid)."""
    rows = flat_map_fields(records(lines), F.size("f") == LEG_FIELDS,
                           [field("f", 0).alias("d_raw"), parse_date(field("f", 0)).alias("d")])
    return count_by(rows, ["d_raw", "d"])


def date_shift_summary(lines: DataFrame, gap_days: int = CONNECTION_GAP_DAYS) -> DataFrame:
    """``d, shifted, formatted, n``: valid dates moved back by the connection gap."""
    d = flat_map_fields(records(lines), F.size("f") == LEG_FIELDS,
                        [parse_date(field("f", 0)).alias("d")]).where(F.col("d").isNotNull())
    shifted = d.select("d", shift_days("d", -gap_days).alias("shifted"))
    return count_by(shifted.select("d", "shifted", format_date("shifted").alias("formatted")),
                    ["d", "shifted", "formatted"])


def leg_union_counts(lines: DataFrame, gap_days: int = CONNECTION_GAP_DAYS) -> DataFrame:
    """``d, via, leg, n``: flights as first legs (date, dest) and second legs (date - gap, origin)."""
    u = leg_union(legs(lines), gap_days).select("d", "via", F.col("leg").cast("bigint").alias("leg"))
    return count_by(u, ["d", "via", "leg"])
