"""Physical plan checks: one parse per line, WindowGroupLimit, no pair blow-up, no Python on the data path."""

import contextlib
import io

import pytest

from conftest import SF_SMOKE
from skytally.plans import catalog
from skytally.plans import queries as Q
from skytally.sources import itinerary_lines, on_time_lines

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical(df):
    text = plan(df, "formatted")
    return text.split("\n\n")[0]  # the operator tree


def test_split_evaluated_once_and_in_generated_code(spark):
    df = Q.top10_carriers_by_airport(on_time_lines(spark, SF_SMOKE))
    optimized = plan(df, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    cut = [x for x in optimized.splitlines() if "regexp_extract_all" in x]
    assert len(cut) == 1 and cut[0].count("instr(") == 1 and "lambdafunction" not in optimized
    lines = lines_df_of(spark)
    project = physical(lines).splitlines()
    assert any("* Project" in x for x in project)     # the star: whole-stage codegen


def lines_df_of(spark):
    from skytally.functions import with_fields
    return with_fields(spark.read.parquet(f"{SF_SMOKE}/region.parquet").selectExpr("r_name AS line"), "line")


def test_itinerary_best_is_hash_aggregated(spark):
    assert "SortAggregate" not in physical(Q.best_itineraries(itinerary_lines(spark, SF_SMOKE)))


def test_grouped_top_k_uses_window_group_limit(spark):
    tree = physical(Q.top10_carriers_by_route(on_time_lines(spark, SF_SMOKE)))
    assert tree.count("WindowGroupLimit") == 2  # partial before the shuffle, final after


@pytest.mark.parametrize("fn", [Q.itinerary_counts, Q.best_itineraries])
def test_itinerary_join_is_an_equi_join_on_aggregates(spark, fn):
    tree = physical(fn(itinerary_lines(spark, SF_SMOKE)))
    assert "CartesianProduct" not in tree and "NestedLoopJoin" not in tree
    assert "HashJoin" in tree or "SortMergeJoin" in tree
    # both join sides come from the route-day aggregate (sort-based: its buffer is a struct)
    join_inputs = tree.split("Join")[1]
    assert join_inputs.count("Aggregate") >= 2


def test_top10_is_take_ordered(spark):
    tree = physical(Q.top10_airports(on_time_lines(spark, SF_SMOKE)))
    assert "TakeOrderedAndProject" in tree


@pytest.mark.parametrize("name", [k for k in catalog.queries() if not k.startswith(("stream_", "sink_"))])
def test_no_python_on_data_path(spark, name):
    df = catalog.queries()[name](spark, SF_SMOKE)
    text = plan(df, "formatted")
    assert not any(p in text for p in PY_NODES), name


def test_scan_prunes_columns(spark):
    text = plan(Q.airport_popularity(on_time_lines(spark, SF_SMOKE)), "formatted")
    lineitem_scan = [blk for blk in text.split("\n\n") if "lineitem.parquet" in blk][0]
    assert "l_extendedprice" not in lineitem_scan and "l_comment" not in lineitem_scan


@pytest.mark.parametrize("fn", [Q.itinerary_counts, Q.best_itineraries])
def test_itinerary_aggregate_computed_once(spark, fn):
    """Both join sides share one route-day aggregate: its shuffle is reused, lines are parsed once."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan shows reuse directly
    try:
        tree = physical(fn(itinerary_lines(spark, SF_SMOKE)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in tree
    assert tree.count("Generate") == 1  # lines are parsed once


def test_ten_best_flights_are_cut_once(spark):
    """Both join sides read one shuffle of route-days: flights are ranked and listed once, not once for each leg."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tree = physical(Q.itinerary_top10(itinerary_lines(spark, SF_SMOKE)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tree.count("Window (") == 1 and tree.count("Generate") == 1


@pytest.mark.parametrize("fn", [Q.airport_popularity, Q.carrier_on_time_arrivals, Q.top10_carriers_by_airport,
                                Q.top10_destinations_by_airport, Q.top10_carriers_by_route])
def test_counts_combine_map_side(spark, fn):
    """Partial aggregation before the first shuffle: a hot key ships one row per task."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(fn(on_time_lines(spark, SF_SMOKE)), "formatted")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "partial_count" in text
    tree = text.split("\n\n")[0].splitlines()
    shuffles = [i for i, line in enumerate(tree)
                if "Exchange (" in line and "BroadcastExchange" not in line and "ReusedExchange" not in line]
    assert shuffles
    # the deepest hash shuffle reads from the partial aggregate, not from the parsed rows
    assert "HashAggregate" in tree[shuffles[-1] + 1]
