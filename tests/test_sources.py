"""The derived line fixture matches the numbers documented in FIXTURES.md (sf0.01)."""

from pyspark.sql import functions as F

from conftest import rows
from skytally.plans import diagnostics as D
from skytally.plans import queries as Q
from skytally.sources import flights, itinerary_lines, on_time_lines

SF = "/root/testdata/sf0.01"


def test_on_time_fixture_shape(spark):
    lines = on_time_lines(spark, SF).cache()
    assert lines.count() == 60_000
    assert rows(D.arity_histogram(lines)) == [(3, 2929), (4, 8598), (5, 48473)]
    assert Q.airport_popularity(lines).count() == 25
    assert Q.carrier_on_time_arrivals(lines).count() == 50
    lines.unpersist()


def test_fixture_reads_only_needed_columns(spark):
    f = flights(spark, SF)
    assert f.columns == ["carrier_raw", "origin", "dest", "dep_i", "arr_i", "flight_date", "flight_num", "ln", "rf"]
    assert dict(f.dtypes)["flight_date"] == "date"


def test_itinerary_fixture_has_planted_bad_dates(spark):
    lines = itinerary_lines(spark, SF)
    assert lines.where(F.col("line").startswith("1999-02-31,")).count() > 0
    assert lines.count() == 60_000
