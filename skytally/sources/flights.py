"""Flight lines derived from the supplied TPC-H style tables.

No flight table ships with the test data, so every input line is derived from
``lineitem`` and its dimensions (the derivation is written down in FIXTURES.md
section 2 and mirrored by the DuckDB oracle). Production input is text lines
from files or Kafka (``skytally.sources.lines``); this module only produces the
same kind of lines from the tables, with Spark, so the work grows with them.

Plan shape: Catalyst broadcasts the two nation lookups by their size; the
order->customer->nation and supplier->nation lookups are reduced to two narrow
key maps before they meet ``lineitem``, so ``lineitem`` is only joined to
two-column frames and its scan reads just the seven columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.sources.tables import read_table

def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: carrier, airports, integer delays, date, flight number."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    lineitem = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"])

    origin_by_supplier = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
                          .select("s_suppkey", F.col("n_name").alias("origin")))
    dest_by_order = (orders.join(customer, orders.o_custkey == customer.c_custkey)
                     .join(nation, customer.c_nationkey == nation.n_nationkey)
                     .select("o_orderkey", F.col("n_name").alias("dest")))

    joined = (lineitem
              .join(dest_by_order, lineitem.l_orderkey == dest_by_order.o_orderkey)
              .join(origin_by_supplier, lineitem.l_suppkey == origin_by_supplier.s_suppkey)
              .join(part, lineitem.l_partkey == part.p_partkey))
    qty = F.col("l_quantity").cast("int")
    return joined.select(
        F.col("p_brand").alias("carrier_raw"),
        "origin",
        "dest",
        (qty - 20).alias("dep_i"),
        (qty - 23 + F.col("l_linenumber")).alias("arr_i"),
        F.col("l_shipdate").cast("date").alias("flight_date"),
        F.col("l_orderkey").alias("flight_num"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_returnflag").alias("rf"),
    )


def _minutes(c: str) -> F.Column:
    return F.concat(F.col(c).cast("string"), F.lit(".00"))


def _carrier() -> F.Column:
    # line number 1 gets a quoted carrier that contains a comma
    return F.when(F.col("ln") == 1, F.concat(F.lit('"'), F.col("carrier_raw"), F.lit(', Inc"'))) \
        .otherwise(F.col("carrier_raw"))


def on_time_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-field on-time lines ``carrier,origin,dest,dep_delay,arr_delay`` (column ``line``).

    Planted defects: ``NA`` delays, blank arrival delay (4 fields after the
    trailing blank is dropped) and short 3-field lines.
    """
    f = flights(spark, sf_dir)
    ln, rf = F.col("ln"), F.col("rf")
    carrier = _carrier()
    dep = F.when((ln == 5) & (rf == "A"), F.lit("NA")).otherwise(_minutes("dep_i"))
    arr = (F.when(ln == 7, F.lit("")).when((ln == 4) & (rf == "N"), F.lit("NA"))
           .otherwise(_minutes("arr_i")))
    line = (F.when((ln == 6) & (rf == "R"), F.concat_ws(",", carrier, "origin", "dest"))
            .otherwise(F.concat_ws(",", carrier, "origin", "dest", dep, arr)))
    return f.select(line.alias("line"))


def itinerary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-field itinerary lines ``date,flight,origin,dest,carrier,dep_delay,arr_delay``.

    Planted defects: an impossible date and a blank arrival delay.
    """
    f = flights(spark, sf_dir)
    ln, rf = F.col("ln"), F.col("rf")
    date_s = F.when((ln == 2) & (rf == "A"), F.lit("1999-02-31")).otherwise(F.col("flight_date").cast("string"))
    arr = F.when(ln == 7, F.lit("")).otherwise(_minutes("arr_i"))
    line = F.concat_ws(",", date_s, F.col("flight_num").cast("string"), "origin", "dest",
                       _carrier(), _minutes("dep_i"), arr)
    return f.select(line.alias("line"))


# Defects planted by flight number, one kind per remainder.
DEFECT_EVERY = 23


def _defects(line: F.Column, kinds: list[F.Column]) -> F.Column:
    kind = F.pmod(F.col("flight_num") * 7 + F.col("ln"), F.lit(DEFECT_EVERY))
    out = F.when(kind == 0, kinds[0])
    for i, k in enumerate(kinds[1:], start=1):
        out = out.when(kind == i, k)
    return out.otherwise(line)


def defect_on_time_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-field lines of which about a third are broken, in every way a line can be.

    By remainder: blank carrier, blank origin, blank destination, two fields, an empty line, an unbalanced
    quote, separators' marker characters inside quotes and outside, a blank before a delay, four and six fields.
    """
    carrier, dep, arr = F.col("carrier_raw"), _minutes("dep_i"), _minutes("arr_i")
    mark = F.concat(carrier, F.lit("\x1f\x1e1"))
    return flights(spark, sf_dir).select(_defects(F.concat_ws(",", _carrier(), "origin", "dest", dep, arr), [
        F.concat_ws(",", F.lit(""), "origin", "dest", dep, arr),
        F.concat_ws(",", carrier, F.lit(""), "dest", dep, arr),
        F.concat_ws(",", carrier, "origin", F.lit(""), dep, F.lit("NA")),
        F.concat_ws(",", carrier, "origin"),
        F.lit(""),
        F.concat_ws(",", F.concat(carrier, F.lit('"')), "origin", "dest", dep, arr),
        F.concat_ws(",", F.concat(F.lit('"'), mark, F.lit(', Inc"')), "origin", "dest", dep, arr),
        F.concat_ws(",", mark, "origin", "dest", F.concat(F.lit(" "), dep), arr),
        F.concat_ws(",", carrier, "origin", "dest", dep, F.lit("")),
        F.concat_ws(",", carrier, "origin", "dest", dep, arr, F.lit("x")),
    ]).alias("line"))


def defect_itinerary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-field lines of which about a third are broken: blank airports, a flight number that is none,
    a delay that is none, an impossible date, a missing field, a quote in the carrier."""
    date, flight = F.col("flight_date").cast("string"), F.col("flight_num").cast("string")
    carrier, dep, arr = F.col("carrier_raw"), _minutes("dep_i"), _minutes("arr_i")
    return flights(spark, sf_dir).select(_defects(F.concat_ws(",", date, flight, "origin", "dest", _carrier(), dep, arr), [
        F.concat_ws(",", date, flight, F.lit(""), "dest", carrier, dep, arr),
        F.concat_ws(",", date, flight, "origin", F.lit(""), carrier, dep, arr),
        F.concat_ws(",", date, F.concat(F.lit("AA"), flight), "origin", "dest", carrier, dep, arr),
        F.concat_ws(",", date, flight, "origin", "dest", carrier, dep, F.lit("NA")),
        F.concat_ws(",", F.lit("1999-02-31"), flight, "origin", "dest", carrier, dep, arr),
        F.concat_ws(",", date, flight, "origin", "dest", carrier, dep),
        F.concat_ws(",", date, flight, "origin", "dest", F.concat(F.lit('"'), carrier, F.lit('\x1f, "')), dep, arr),
        F.concat_ws(",", date, flight, "origin", "dest", F.lit(""), dep, F.lit("")),
    ]).alias("line"))
