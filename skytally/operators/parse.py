"""Line parsing: records, typed on-time rows, itinerary legs, and reject routing.

Rows are never silently lost: for every job a line is either used or has a
reason against it (``classify``, ``rejects``); ``strict`` fails on such a line
instead. The query operators keep only the rows they can use, as the original jobs did.

Plan shape. The quote-aware split is computed once per line in a projection.
Keeping or dropping a line is then a flatMap (a generator that emits 0 or 1
typed rows), not a ``Filter``: Catalyst pushes a Filter below the projection
by substituting the split expression into the predicate, which would split
every line once per predicate term. A generator is a barrier to that, and it
also fuses "filter + project" into one operator, like the original flatMap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions import (
    field,
    is_numeric_literal,
    is_on_time,
    parse_date,
    to_delay,
    with_fields,
)

ON_TIME_FIELDS = 5
LEG_FIELDS = 7
MIN_AIRPORT_FIELDS = 3  # airport popularity only needs origin and destination

# The jobs that read five-field lines and the one that reads seven-field legs.
ON_TIME_JOBS = ("airports", "carriers", "carriers-by-airport", "destinations-by-airport", "carriers-by-route")
LEG_JOB = "itineraries"


def _f() -> Column:
    return F.col("f")


def _n() -> Column:
    return F.size(F.col("f"))


def records(lines: DataFrame, line_col: str = "line", keep_line: bool = False) -> DataFrame:
    """``f ARRAY<STRING>`` (and the original ``line`` if asked) for every line.

    A missing line (e.g. a Kafka message without a value) splits like an empty
    line: one empty field, so it is rejected as ``short``, never taken as valid.
    """
    line = F.coalesce(F.col(line_col), F.lit(""))
    if keep_line:
        return with_fields(lines.select(F.col(line_col).alias("line"), line.alias("_text")), "_text", keep=["line"])
    return with_fields(lines.select(line.alias("_text")), "_text", keep=[])


def flat_map_fields(rec: DataFrame, keep: Column, out: list[Column]) -> DataFrame:
    """Emit ``struct(out...)`` for rows where ``keep`` holds, nothing otherwise.

    ``keep`` and ``out`` may reference the ``f`` column of ``records``.
    """
    return rec.select(F.inline(F.when(keep, F.array(F.struct(*out)))))


def on_time_records(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Typed five-field rows with on-time flags; other arities are dropped.

    Columns: carrier, origin, dest, dep_delay, arr_delay, dep_on_time, arr_on_time.
    A delay that is not a numeric literal is NULL and never on time.
    """
    typed = flat_map_fields(records(lines, line_col), _n() == ON_TIME_FIELDS, [
        field(_f(), 0).alias("carrier"),
        field(_f(), 1).alias("origin"),
        field(_f(), 2).alias("dest"),
        to_delay(field(_f(), 3)).alias("dep_delay"),
        to_delay(field(_f(), 4)).alias("arr_delay"),
    ])
    return typed.select("*", is_on_time("dep_delay").alias("dep_on_time"),
                        is_on_time("arr_delay").alias("arr_on_time"))


def line_reason(job: str) -> Column:
    """Why ``job`` cannot use a line (``ok`` if it can), first match wins.

    A line is either used by the job or rejected, never both: the airport counts
    take every line with three fields, blank ids included; the other jobs need
    five fields and the one delay they look at; a ranking needs a non-blank item.
    A late flight is a usable line.
    """
    n = _n()
    ok = F.lit("ok")
    short = F.when(n < MIN_AIRPORT_FIELDS, F.lit("short"))
    if job == "airports":
        return short.otherwise(ok)
    if job == LEG_JOB:
        return (F.when(n != LEG_FIELDS, F.lit("arity"))
                .when(parse_date(field(_f(), 0)).isNull(), F.lit("bad_date"))
                .when(_flight_number().isNull(), F.lit("bad_flight"))
                .when((field(_f(), 2) == "") | (field(_f(), 3) == ""), F.lit("blank_airport"))
                .when(~is_numeric_literal(field(_f(), 6)), F.lit("bad_arr_delay"))
                .otherwise(ok))
    delay, why, item = {
        "carriers": (4, "bad_arr_delay", None),
        "carriers-by-airport": (3, "bad_dep_delay", 0),
        "destinations-by-airport": (3, "bad_dep_delay", 2),
        "carriers-by-route": (4, "bad_arr_delay", 0),
    }[job]
    reason = short.when(n != ON_TIME_FIELDS, F.lit("arity")).when(~is_numeric_literal(field(_f(), delay)), F.lit(why))
    if item is not None:
        reason = reason.when(field(_f(), item) == "", F.lit("blank_key"))
    return reason.otherwise(ok)


#: The reasons that ``line_reason`` can give, per job.
REASONS = {
    "airports": ("short",),
    "carriers": ("short", "arity", "bad_arr_delay"),
    "carriers-by-airport": ("short", "arity", "bad_dep_delay", "blank_key"),
    "destinations-by-airport": ("short", "arity", "bad_dep_delay", "blank_key"),
    "carriers-by-route": ("short", "arity", "bad_arr_delay", "blank_key"),
    LEG_JOB: ("arity", "bad_date", "bad_flight", "blank_airport", "bad_arr_delay"),
}


def classify(lines: DataFrame, job: str, line_col: str = "line") -> DataFrame:
    """Every line with ``n_fields`` and the first ``reason`` against it in ``job`` (or ``ok``)."""
    rec = records(lines, line_col, keep_line=True)
    return rec.select("line", _n().cast("bigint").alias("n_fields"), line_reason(job).alias("reason"))


def rejects(lines: DataFrame, job: str, line_col: str = "line") -> DataFrame:
    """``line, n_fields, reason`` of the lines that ``job`` cannot use. Works on streams."""
    reason = line_reason(job)
    return flat_map_fields(records(lines, line_col, keep_line=True), reason != "ok",
                           [F.col("line"), _n().cast("bigint").alias("n_fields"), reason.alias("reason")])


def strict(lines: DataFrame, job: str, line_col: str = "line") -> DataFrame:
    """``lines``, failing on the first one that ``job`` cannot use."""
    rec = records(lines, line_col, keep_line=True)
    reason = line_reason(job)
    failed = F.raise_error(F.concat(F.lit(f"{job}: "), reason, F.lit(": "), F.coalesce("line", F.lit("NULL"))))
    return rec.select(F.when(reason == "ok", F.col("line")).otherwise(failed).alias(line_col))


def airport_ids(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``id``: origin and destination of every line with at least three fields (one generator)."""
    ends = F.array(field(_f(), 1), field(_f(), 2))
    return records(lines, line_col).select(F.explode(F.when(_n() >= MIN_AIRPORT_FIELDS, ends)).alias("id"))


def _flight_number() -> Column:
    """The flight number as BIGINT; NULL unless the field is all digits that fit."""
    f = field(_f(), 1)
    return F.when(f.rlike(r"\A\d+\z"), f.try_cast("bigint"))


def legs(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Valid itinerary legs: flight_date DATE, flight BIGINT, origin, dest, arr_delay DOUBLE.

    Valid = seven fields, strict date, a flight number, non-blank airports, numeric arrival delay.
    """
    typed = flat_map_fields(records(lines, line_col), _n() == LEG_FIELDS, [
        parse_date(field(_f(), 0)).alias("flight_date"),
        _flight_number().alias("flight"),
        field(_f(), 2).alias("origin"),
        field(_f(), 3).alias("dest"),
        to_delay(field(_f(), 6)).alias("arr_delay"),
    ])
    return typed.where(F.col("flight_date").isNotNull() & F.col("flight").isNotNull() & (F.col("origin") != "")
                       & (F.col("dest") != "") & F.col("arr_delay").isNotNull())
