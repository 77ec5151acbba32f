"""Column expressions for comma-separated flight lines.

Everything here is built from built-in Spark functions with generated code, so
no Python touches a row and no line leaves whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: these must stay exactly as they are for results to match ---
# A comma separates two fields iff an even number of double quotes follows it on
# the line; quotes are kept inside the field values.
QUOTE = '"'
COMMA = ","
# A delay is usable only if the whole field is this numeric literal.
NUMERIC_LITERAL = r"[-+]?\d*\.?\d+"
# A flight is on time when its delay in minutes is strictly below this.
ON_TIME_THRESHOLD = 15.0
# --- end of fixed values ---

# A comma and the field after it, in a line with an even number of quotes. Possessive, so neither does it
# go back nor does a field of many quoted parts need a deep stack.
QUOTED_FIELD = r',([^,"]*+(?:"[^"]*+"[^,"]*+)*+)'

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_trailing_separators(line: Column | str) -> Column:
    """Drop the run of commas at the end of a line.

    Every trailing comma is a separator (no quote follows it), and the split
    keeps no trailing empty fields, so removing the run first gives the same
    fields while letting Spark's ``split`` (which keeps trailing empties) be used.
    """
    return F.rtrim(_col(line), F.lit(COMMA))


def split_fields(line: Column | str) -> Column:
    """``ARRAY<STRING>``: the fields of a line, linear in its length and inside whole-stage codegen.

    A line without quotes is split at its commas. One with an even number of quotes is read from the left:
    a field is a run of other characters and whole quoted parts. In one with an odd number the first quote
    closes what the line began inside of, so the line is read with a quote in front, which the first field loses again.
    """
    c = trim_trailing_separators(line)
    odd = F.length(F.translate(c, QUOTE, "")) % 2 != F.length(c) % 2
    whole = F.regexp_extract_all(F.concat(F.lit(COMMA), c), F.lit(QUOTED_FIELD), 1)
    inside = F.regexp_extract_all(F.concat(F.lit(COMMA + QUOTE), c), F.lit(QUOTED_FIELD), 1)
    first = F.array(F.substring(inside[0], F.lit(2), F.length(inside[0])))
    return (F.when(F.instr(c, QUOTE) == 0, F.split(c, COMMA, -1)).when(~odd, whole)
            .otherwise(F.concat(first, F.slice(inside, 2, F.size(inside)))))


def with_fields(lines: DataFrame, line: Column | str, out: str = "f", keep: list[str] | None = None) -> DataFrame:
    """Quote-aware split of ``line`` into ``out ARRAY<STRING>``, with the ``keep`` columns (default: all)."""
    keep = lines.columns if keep is None else keep
    return lines.select(*keep, split_fields(line).alias(out))


def field(fields: Column | str, index: int) -> Column:
    """Field by 0-based position; NULL when the line is too short."""
    return F.get(_col(fields), index)


def is_numeric_literal(value: Column | str) -> Column:
    """True iff the whole string is a numeric literal (never NULL)."""
    return F.coalesce(_col(value).rlike(r"\A" + NUMERIC_LITERAL + r"\z"), F.lit(False))


def to_delay(value: Column | str) -> Column:
    """Delay in minutes as DOUBLE, NULL unless the field is a numeric literal.

    ``try_cast`` alone would also take ``1e5``, ``NaN`` or padded numbers.
    """
    v = _col(value)
    return F.when(is_numeric_literal(v), v.try_cast("double"))


def is_on_time(delay: Column | str, threshold: float = ON_TIME_THRESHOLD) -> Column:
    """Strictly below the threshold; early (negative) counts as on time. Never NULL."""
    return F.coalesce(_col(delay) < F.lit(threshold), F.lit(False))
