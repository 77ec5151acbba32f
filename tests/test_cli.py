"""The command-line entry runs the jobs on files, as a stream or a batch."""

import pytest

from conftest import SF_SMOKE, rows
from skytally.__main__ import JOBS, build_parser, run
from skytally.plans import queries as Q
from skytally.session import scratch_path
from skytally.sources import itinerary_lines, on_time_lines, text_lines, write_lines
from skytally.streaming.changelog import read_latest
from skytally.streaming.runner import read_ranked


@pytest.fixture(scope="module")
def line_dir(spark):
    path = scratch_path(spark, "t-cli-lines")
    write_lines(on_time_lines(spark, SF_SMOKE).coalesce(1), path, records_per_file=2500)
    return path


def test_stream_job_from_files(spark, line_dir):
    base = scratch_path(spark, "t-cli")
    run(spark, ["carriers-by-airport", "--files", line_dir, "--table", base + "/t", "--checkpoint", base + "/c",
                "--available-now", "--mode", "update"])
    assert rows(read_latest(spark, base + "/t")) == rows(Q.top10_carriers_by_airport(text_lines(spark, line_dir)))


def test_batch_job_replaces_its_own_result(spark, line_dir):
    base = scratch_path(spark, "t-cli-batch")
    run(spark, ["airports", "--batch", line_dir, "--table", base])
    run(spark, ["airports", "--batch", line_dir, "--table", base])
    assert rows(read_latest(spark, base)) == rows(Q.airport_popularity(text_lines(spark, line_dir)))


def test_arguments():
    assert set(JOBS) == {"airports", "carriers", "carriers-by-airport", "destinations-by-airport",
                         "carriers-by-route", "itineraries"}
    a = build_parser().parse_args(["carriers-by-route", "--kafka", "b:9092",
                                   "--topics", "x,y", "--table", "t", "--checkpoint", "c"])
    assert a.max_per_trigger is None and a.trigger_seconds == 2
    assert a.starting_offsets == "latest" and a.group is None
    b = build_parser().parse_args(["airports", "--kafka", "b:9092", "--topics", "x", "--group", "g1",
                                   "--starting-offsets", "earliest", "--table", "t", "--checkpoint", "c"])
    assert (b.group, b.starting_offsets) == ("g1", "earliest")
    with pytest.raises(SystemExit):
        build_parser().parse_args(["airports", "--table", "t"])  # no source


def test_original_layout_batch_and_stream(spark, line_dir):
    base = scratch_path(spark, "t-cli-orig")
    counts = run(spark, ["airports", "--batch", line_dir, "--table", base + "/a", "--original-layout"])
    assert counts.columns == ["Id", "Popularity"]
    assert rows(counts) == rows(Q.airport_popularity(text_lines(spark, line_dir)))

    routes = run(spark, ["carriers-by-route", "--batch", line_dir, "--table", base + "/r", "--original-layout"])
    assert routes.columns == ["Airport", "CarriersList"]
    first = routes.first()
    assert first["Airport"].count(",") >= 1                       # "origin,dest"
    ns = [int(x.rsplit(",", 1)[1]) for x in first["CarriersList"]]
    assert ns == sorted(ns) and len(ns) <= 10                     # worst first, best last

    run(spark, ["carriers-by-airport", "--files", line_dir, "--table", base + "/s", "--checkpoint", base + "/c",
                "--available-now", "--original-layout"])
    streamed = read_latest(spark, base + "/s")
    batch = run(spark, ["carriers-by-airport", "--batch", line_dir, "--table", base + "/b", "--original-layout"])
    norm = lambda df: sorted((r["Airport"], tuple(r["CarriersList"])) for r in df.collect())
    assert norm(streamed) == norm(batch)
    for mode in ("complete", "update"):
        run(spark, ["airports", "--files", line_dir, "--table", base + f"/u-{mode}", "--checkpoint", base + f"/cu-{mode}",
                    "--available-now", "--original-layout", "--mode", mode])
        assert rows(read_latest(spark, base + f"/u-{mode}")) == rows(counts)
    run(spark, ["carriers-by-airport", "--files", line_dir, "--table", base + "/su", "--checkpoint", base + "/csu",
                "--available-now", "--original-layout", "--mode", "update"])
    assert norm(read_latest(spark, base + "/su")) == norm(batch)


def test_ranked_top_print_and_rejects(spark, line_dir, capsys):
    base = scratch_path(spark, "t-cli-ranked")
    lines = text_lines(spark, line_dir)
    run(spark, ["airports", "--files", line_dir, "--table", base + "/r", "--checkpoint", base + "/cr", "--available-now",
                "--ranked", "--rejects", base + "/bad", "--bytes-per-trigger", "200k"])
    assert rows(read_latest(spark, base + "/r"), "rank", "id") == rows(Q.airports_ranked(lines), "rank", "id")
    from skytally.operators import rejects
    assert spark.read.parquet(base + "/bad").count() == rejects(lines, "airports").count()
    run(spark, ["airports", "--files", line_dir, "--table", base + "/ru", "--checkpoint", base + "/cru", "--available-now",
                "--ranked", "--mode", "update", "--account", "--state-on-disk"])
    assert rows(read_ranked(spark, base + "/ru"), "rank", "id") == rows(Q.airports_ranked(lines), "rank", "id")
    run(spark, ["carriers", "--files", line_dir, "--table", base + "/t", "--checkpoint", base + "/ct", "--available-now",
                "--top", "3", "--print", "2"])
    assert rows(read_latest(spark, base + "/t")) == rows(Q.top10_carriers(lines, 3))
    assert "Batch: 0" in capsys.readouterr().out
    assert rows(run(spark, ["carriers", "--batch", line_dir, "--table", base + "/b", "--ranked"]), "rank", "id") == rows(
        Q.carriers_ranked(lines), "rank", "id")
    with pytest.raises(SystemExit):
        run(spark, ["airports", "--batch", line_dir, "--table", base + "/t"])  # the stream's table
    with pytest.raises(SystemExit):
        run(spark, ["airports", "--batch", line_dir, "--table", base + "/ru"])  # a stream's log
    with pytest.raises(Exception, match="arity"):
        run(spark, ["carriers", "--batch", line_dir, "--table", base + "/f", "--failfast"])


def test_itineraries_layout_and_print(spark, capsys):
    base = scratch_path(spark, "t-cli-itin")
    src = base + "/in"
    write_lines(itinerary_lines(spark, SF_SMOKE).coalesce(1), src, records_per_file=3000)
    run(spark, ["itineraries", "--files", src, "--table", base + "/t", "--checkpoint", base + "/c", "--available-now",
                "--original-layout", "--print"])
    batch = run(spark, ["itineraries", "--batch", src, "--table", base + "/b", "--original-layout"])
    norm = lambda df: sorted((r["Id"], tuple(r["CarriersList"])) for r in df.collect())
    assert norm(read_latest(spark, base + "/t")) == norm(batch)
    assert "CarriersList" in capsys.readouterr().out
