"""Splitting, numeric literals, on-time flags and rejects on hand-written lines."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE, rows
from skytally.functions import is_numeric_literal, to_delay, with_fields
from skytally.operators import ON_TIME_JOBS, classify, legs, on_time_records, rejects, strict
from skytally.plans import queries as Q
from skytally.sources import defect_itinerary_lines, defect_on_time_lines

# The edge table: (line, number of fields after the quote-aware split)
EDGE = [
    ("AA,ATL,ORD,-3.00,4.00", 5),
    ("AA,ATL,ORD,14.99,15.00", 5),
    ("AA,ATL,ORD,-3.00,", 4),
    ("AA,ATL,ORD,,4.00", 5),
    ('"A, Inc",ATL,ORD,1,2', 5),
    ('A"A,ATL,ORD,1,2', 5),
    (",ATL,ORD,1,2", 5),
    ("AA,ATL,ORD,.5,+3", 5),
    ("AA,ATL,ORD,12.,1e1", 5),
    ("AA,ATL,ORD,NA,2", 5),
    ("AA,ATL,ORD,1,2\r", 5),
    ("AA,ATL,ORD,1,2,3", 6),
    ("AA,ATL", 2),
    ("", 1),
]


# A comma is a separator if an even number of double quotes follows it.
SEPARATOR = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def java_split(line: str) -> list[str]:
    """Look-ahead split, trailing empty strings removed."""
    if not re.search(SEPARATOR, line):
        return [line]
    parts = re.split(SEPARATOR, line)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


AWKWARD = [
    'a,"b,c",d', 'a,"b,c,d', '"""",x', 'x,"",y,', 'a,,b,,', ',,,', ',a', '"a,b"c,d"e,f"',
    'a"b,c"d,e', 'no quotes at all', '"', '",', ',"', 'a,b,"c,"', 'x\x1fy,"z,w"',
]


def test_split_matches_lookahead_semantics(lines_df):
    lines = [x for x, _ in EDGE] + AWKWARD
    got = {r["line"]: list(r["f"]) for r in with_fields(lines_df(lines), "line").collect()}
    for line in lines:
        expected = java_split(line)
        if expected == []:  # only commas: Java gives 0 fields, we give one empty field
            assert got[line] == [""], line
        else:
            assert got[line] == expected, line


def test_split_of_random_lines_and_of_many_quoted_parts(lines_df):
    import random

    pick = random.Random(2)
    lines = sorted({"".join(pick.choices('",ab\x1f\x1e 1', k=pick.randrange(14))) for _ in range(3000)})
    got = {r["line"]: list(r["f"]) for r in with_fields(lines_df(lines).repartition(4), "line").collect()}
    for line in lines:
        assert got[line] == (java_split(line) or [""]), repr(line)
    long = ['"a,b"' * 50_000 + ",x", 'q"' + '"a,b",' * 20_000 + "y", "," * 50_000 + '"' + "," * 50_000]
    sizes = {r["line"]: r["n"] for r in with_fields(lines_df(long), "line").select("line", F.size("f").alias("n")).collect()}
    assert [sizes[x] for x in long] == [2, 20_001, 1]


def test_arity(lines_df):
    got = {r["line"]: r["n"] for r in with_fields(lines_df([x for x, _ in EDGE]), "line").select(
        "line", F.size("f").alias("n")).collect()}
    for line, n in EDGE:
        assert got[line] == n, line


@pytest.mark.parametrize("value,ok", [
    ("-3.00", True), (".5", True), ("+3", True), ("12", True), ("12.", False), ("1e5", False),
    ("NaN", False), ("", False), (" 1", False), ('"2"', False), ("2\r", False), ("15.00\n", False),
    ("--1", False), ("1.2.3", False),
])
def test_numeric_literal(lines_df, value, ok):
    r = lines_df([value]).select(is_numeric_literal("line").alias("ok"), to_delay("line").alias("d")).first()
    assert r["ok"] is ok
    assert (r["d"] is not None) is ok


def test_on_time_strict_threshold(lines_df):
    r = on_time_records(lines_df(["AA,ATL,ORD,14.99,15.00", "AA,ATL,ORD,-20,15"]))
    assert rows(r, "dep_on_time", "arr_on_time") == [(True, False), (True, False)]


def test_edge_airport_popularity(lines_df):
    got = rows(Q.airport_popularity(lines_df([x for x, _ in EDGE])))
    assert got == [("ATL", 12), ("ORD", 12)]


def test_edge_failfast(lines_df):
    with pytest.raises(Exception, match="airports: short"):
        Q.airport_popularity(strict(lines_df([x for x, _ in EDGE]), "airports")).collect()
    ok = Q.airport_popularity(strict(lines_df(["AA,ATL,ORD"]), "airports"))
    assert rows(ok) == [("ATL", 1), ("ORD", 1)]


def test_edge_carriers_on_time_arrivals(lines_df):
    got = rows(Q.carrier_on_time_arrivals(lines_df([x for x, _ in EDGE])))
    assert got == sorted([("AA", 4), ('"A, Inc"', 1), ('A"A', 1), ("", 1)])


def test_edge_grouped(lines_df):
    lines = lines_df([x for x, _ in EDGE])
    assert rows(Q.top10_carriers_by_airport(lines)) == sorted([
        ("ATL", "AA", 4, 1), ("ATL", '"A, Inc"', 1, 2), ("ATL", 'A"A', 1, 3)])
    assert rows(Q.top10_destinations_by_airport(lines)) == [("ATL", "ORD", 7, 1)]
    assert rows(Q.top10_carriers_by_route(lines)) == sorted([
        ("ATL", "ORD", "AA", 4, 1), ("ATL", "ORD", '"A, Inc"', 1, 2), ("ATL", "ORD", 'A"A', 1, 3)])


def test_ties_keep_ten_smallest(lines_df):
    lines = [f"C{i:02d},ATL,ORD,1,1" for i in range(12, 0, -1)]
    got = rows(Q.top10_carriers_by_airport(lines_df(lines)))
    assert [r[1] for r in got] == [f"C{i:02d}" for i in range(1, 11)]
    assert [r[3] for r in sorted(got, key=lambda r: r[3])] == list(range(1, 11))


def test_packed_worst_first(lines_df):
    lines = ["B,ATL,ORD,1,1"] * 3 + ["A,ATL,ORD,1,1"] * 5 + ["C,ATL,ORD,1,1"]
    packed = Q.packed_top_k(lines_df(lines), Q.CARRIERS_BY_AIRPORT).first()
    assert list(packed["items"]) == ["C,1", "B,3", "A,5"]


def test_rejects_reasons(lines_df):
    lines = lines_df([x for x, _ in EDGE])
    got = {job: {r["line"]: r["reason"] for r in classify(lines, job).collect()} for job in ON_TIME_JOBS}
    for job in ON_TIME_JOBS:
        assert got[job]["AA,ATL"] == "short" and got[job][""] == "short"
        assert got[job]["AA,ATL,ORD,-3.00,4.00"] == "ok"
        assert got[job]["AA,ATL,ORD,-3.00,"] == ("ok" if job == "airports" else "arity")
        assert rejects(lines, job).count() == sum(1 for v in got[job].values() if v != "ok")
    blank = {job: got[job][",ATL,ORD,1,2"] for job in ON_TIME_JOBS}
    assert blank == {"airports": "ok", "carriers": "ok", "carriers-by-airport": "blank_key",
                     "destinations-by-airport": "ok", "carriers-by-route": "blank_key"}
    assert got["carriers-by-airport"]["AA,ATL,ORD,NA,2"] == "bad_dep_delay" and got["carriers"]["AA,ATL,ORD,NA,2"] == "ok"
    assert got["carriers-by-route"]["AA,ATL,ORD,1,2\r"] == "bad_arr_delay" and got["destinations-by-airport"]["AA,ATL,ORD,1,2\r"] == "ok"


@pytest.mark.parametrize("job,used", [
    ("airports", lambda df: Q.airport_popularity(df).agg(F.sum("popularity") / 2)),
    ("carriers", lambda df: on_time_records(df).where("arr_delay IS NOT NULL").agg(F.count("*"))),
    ("carriers-by-airport", lambda df: on_time_records(df).where("dep_delay IS NOT NULL AND carrier <> ''").agg(F.count("*"))),
    ("destinations-by-airport", lambda df: on_time_records(df).where("dep_delay IS NOT NULL AND dest <> ''").agg(F.count("*"))),
    ("carriers-by-route", lambda df: on_time_records(df).where("arr_delay IS NOT NULL AND carrier <> ''").agg(F.count("*"))),
    ("itineraries", lambda df: legs(df).agg(F.count("*"))),
])
def test_each_line_is_used_or_rejected(spark, job, used):
    make = defect_itinerary_lines if job == "itineraries" else defect_on_time_lines
    lines = make(spark, SF_SMOKE).cache()
    assert used(lines).first()[0] + rejects(lines, job).count() == lines.count()


def test_flight_number_must_be_one(lines_df):
    lines = lines_df(["2008-03-01,AA7,ATL,ORD,AA,1.00,2.00", "2008-03-01,5,ATL,ORD,AA,1.00,2.00",
                      "2008-03-03,9,ORD,SFO,AA,1.00,2.00", "2008-03-03,99999999999999999999,ORD,SFO,AA,1.00,1.00"])
    assert rows(classify(lines, "itineraries"), "reason") == [("bad_flight",), ("bad_flight",), ("ok",), ("ok",)]
    assert [(r["flight1"], r["flight2"], r["delay1"], r["delay2"]) for r in Q.best_itineraries(lines).collect()] == [(5, 9, 2.0, 2.0)]


@pytest.mark.parametrize("mark", ["", "\x1f", "\x1e1\x1f\x1e"])
def test_split_is_linear_in_the_line(lines_df, mark):
    """16 000 quoted fields: quadratic work took minutes, a look-ahead pattern overflowed the stack."""
    import time

    line = ",".join(f'"a{mark},{i}"' for i in range(16_000)) + ",end"
    df = with_fields(lines_df([line]), "line", keep=[])
    df.collect()  # compiled and warm
    began = time.perf_counter()
    got = df.first()["f"]
    assert time.perf_counter() - began < 2
    assert len(got) == 16_001 and got[0] == f'"a{mark},0"' and got[-2:] == [f'"a{mark},15999"', "end"]


def test_legs_validity(lines_df):
    lines = [
        "2008-03-01,10,ATL,ORD,AA,1.00,2.00",
        "2008-02-31,11,ATL,ORD,AA,1.00,2.00",  # impossible date
        "2008-03-01,12,,ORD,AA,1.00,2.00",     # blank origin
        "2008-03-01,13,ATL,ORD,AA,1.00,",      # blank arrival -> 6 fields
        "2008-03-01,14,ATL,ORD,AA,1.00,NA",    # non-numeric arrival
        '2008-03-01,15,ATL,ORD,"A, Inc",1.00,-2.50',
    ]
    got = rows(legs(lines_df(lines)), "flight", "arr_delay")
    assert got == [(10, 2.0), (15, -2.5)]


def test_missing_line_is_a_short_reject(spark):
    df = spark.createDataFrame([(None,), ("AA,ATL,ORD,1,2",)], "line string")
    assert rows(classify(df, "carriers"), "reason") == [("ok",), ("short",)]
    assert rows(Q.airport_popularity(df)) == [("ATL", 1), ("ORD", 1)]
    assert on_time_records(df).count() == 1


def test_split_property_random_lines(lines_df):
    """Random lines over an alphabet rich in separators and quotes, one Spark job."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    collected: list[str] = []

    @settings(max_examples=400, database=None, suppress_health_check=list(HealthCheck))
    @given(st.one_of(st.text(alphabet='ab,"\x1f\x1e01 ', max_size=24), st.text(alphabet='a,"\x1f', min_size=200, max_size=600)))
    def gather(s):
        collected.append(s)

    gather()
    got = {r["line"]: list(r["f"]) for r in with_fields(lines_df(collected), "line").collect()}
    for line in collected:
        expected = java_split(line)
        assert got[line] == (expected if expected != [] else [""]), repr(line)


def test_numeric_literal_property(lines_df):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from skytally.functions.text import NUMERIC_LITERAL

    collected: list[str] = []

    @settings(max_examples=400, database=None, suppress_health_check=list(HealthCheck))
    @given(st.text(alphabet="0123456789.+-e \r\n", max_size=8))
    def gather(s):
        collected.append(s)

    gather()
    full = re.compile(NUMERIC_LITERAL, re.ASCII)
    got = {r["line"]: r["ok"] for r in lines_df(collected).select(
        "line", is_numeric_literal("line").alias("ok")).collect()}
    for v in collected:
        assert got[v] == bool(full.fullmatch(v)), repr(v)


def test_every_reason_is_planted(spark):
    from skytally.plans import diagnostics as D

    got = {(r["job"], r["reason"]) for r in D.reject_summary(defect_on_time_lines(spark, SF_SMOKE)).collect()}
    assert {reason for _, reason in got} == {"short", "arity", "bad_dep_delay", "bad_arr_delay", "blank_key", "ok"}
    legs_got = {r["reason"] for r in D.leg_reject_summary(defect_itinerary_lines(spark, SF_SMOKE)).collect()}
    assert legs_got == {"arity", "bad_date", "bad_flight", "blank_airport", "bad_arr_delay", "ok"}
