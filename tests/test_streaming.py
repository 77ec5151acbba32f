"""Streaming replays end equal to the batch answer; restarts resume; sinks are idempotent."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE, rows
from skytally.plans import queries as Q
from skytally.session import scratch_path
from skytally.sources import itinerary_lines, kafka_options, on_time_lines, text_lines, write_lines
from skytally.streaming import runner as R
from skytally.streaming.replay import run_available
from skytally.streaming.changelog import change_sink, compact, last_committed, newest_batch, ranking_sink, read_latest, snapshot_sink, write_once


@pytest.fixture(scope="module")
def five(spark):
    path = scratch_path(spark, "t-lines5")
    write_lines(on_time_lines(spark, SF_SMOKE).coalesce(1), path)
    return text_lines(spark, path).cache()


@pytest.fixture(scope="module")
def seven(spark):
    path = scratch_path(spark, "t-lines7")
    write_lines(itinerary_lines(spark, SF_SMOKE).coalesce(1), path)
    return text_lines(spark, path).cache()


def split_into_files(spark, lines, k, name):
    n = lines.count()
    path = scratch_path(spark, name) + "/input"
    write_lines(lines.coalesce(1), path, records_per_file=-(-n // k))
    return path


def run(spark, input_path, start_fn):
    return run_available(spark, input_path, scratch_path(spark, "t-run"), start_fn)


@pytest.mark.parametrize("k", [1, 3, 7])
def test_airport_popularity_stream_equals_batch(spark, five, k):
    src = split_into_files(spark, five, k, f"t-air-{k}")
    got = run(spark, src, R.airport_popularity_stream)
    assert rows(got) == rows(Q.airport_popularity(five))


@pytest.mark.parametrize("k", [1, 3, 7])
def test_packed_top10_update_mode_equals_batch(spark, five, k):
    src = split_into_files(spark, five, k, f"t-packed-{k}")
    start = lambda s, t, c, tr: R.grouped_top_k_stream(s, Q.CARRIERS_BY_AIRPORT, t, c, tr,
                                                       mode="update", layout="packed")
    got = run(spark, src, start)
    expected = Q.packed_top_k(five, Q.CARRIERS_BY_AIRPORT)
    norm = lambda df: sorted((r["airport"], tuple(r["items"])) for r in df.collect())
    assert norm(got) == norm(expected)


def test_grouped_streams_complete_mode(spark, five):
    src = split_into_files(spark, five, 3, "t-grouped")
    for spec, batch in ((Q.DESTINATIONS_BY_AIRPORT, Q.top10_destinations_by_airport),
                        (Q.CARRIERS_BY_ROUTE, Q.top10_carriers_by_route)):
        got = run(spark, src, lambda s, t, c, tr, spec=spec: R.grouped_top_k_stream(s, spec, t, c, tr))
        assert rows(got) == rows(batch(five))


def test_update_mode_counts_and_ranked_complete(spark, five):
    src = split_into_files(spark, five, 3, "t-carriers")
    upd = run(spark, src, lambda s, t, c, tr: R.carrier_on_time_stream(s, t, c, tr, mode="update"))
    assert rows(upd) == rows(Q.carrier_on_time_arrivals(five))
    ranked = run(spark, src, lambda s, t, c, tr: R.carrier_on_time_stream(s, t, c, tr, ranked=True))
    assert rows(ranked, "rank", "id", "popularity") == rows(Q.carriers_ranked(five), "rank", "id", "popularity")


def test_itinerary_stream_matches_across_batches(spark, seven):
    src = split_into_files(spark, seven, 4, "t-itin")
    got = run(spark, src, R.itinerary_stream)
    assert rows(got) == rows(Q.best_itineraries(seven))


def test_restart_resumes_from_checkpoint(spark, five):
    parts = five.randomSplit([1.0, 1.0, 1.0], seed=11)
    base = scratch_path(spark, "t-restart")
    src, work = base + "/input", base + "/work"
    write_lines(parts[0].coalesce(1), src)
    parts[1].coalesce(1).write.mode("append").text(src)
    first = run_available(spark, src, work, R.airport_popularity_stream)
    v1 = newest_batch(spark, work + "/table")
    assert rows(first) == rows(Q.airport_popularity(parts[0].unionByName(parts[1])))
    parts[2].coalesce(1).write.mode("append").text(src)
    second = run_available(spark, src, work, R.airport_popularity_stream)
    assert newest_batch(spark, work + "/table") > v1
    assert rows(second) == rows(Q.airport_popularity(five))


def test_change_log_is_idempotent_and_keeps_its_history(spark):
    table = scratch_path(spark, "t-upsert")
    sink = change_sink(table, ["id"])
    b0 = spark.createDataFrame([("A", 1), ("B", 2)], "id string, popularity long")
    b1 = spark.createDataFrame([("B", 5), ("C", 1), (None, 3)], "id string, popularity long")
    sink(b0, 0)
    sink(b1, 1)
    sink(b1, 1)  # replayed batch
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert key(read_latest(spark, table)) == [("A", 1), ("B", 5), ("C", 1), (None, 3)]
    assert rows(read_latest(spark, table, upto=0)) == [("A", 1), ("B", 2)]
    sink(b0.where(F.col("id") == "A").withColumn("popularity", F.lit(7).cast("long")), 2)
    sink(b0.limit(0), 3)  # a trigger without changes
    assert key(read_latest(spark, table)) == [("A", 7), ("B", 5), ("C", 1), (None, 3)]
    with pytest.raises(FileNotFoundError):
        read_latest(spark, table + "-none")


def test_kafka_options():
    opts = kafka_options("k1:9092,k2:9092", "flights, more ,", min_partitions=4, max_offsets_per_trigger=200_000)
    assert opts["subscribe"] == "flights,more"
    assert opts["startingOffsets"] == "latest"
    assert opts["maxOffsetsPerTrigger"] == "200000"
    assert opts["minPartitions"] == "4"
    assert kafka_options("k:1", ["a", "b"]).get("maxOffsetsPerTrigger") is None  # no cap unless asked for
    with pytest.raises(ValueError):
        kafka_options("k:1", " , ")


def test_processing_time_trigger_runs_until_stopped(spark, five):
    """2 s style triggers: new files are picked up while the query runs; stop() ends it."""
    parts = five.randomSplit([1.0, 1.0], seed=5)
    base = scratch_path(spark, "t-proc")
    src = base + "/input"
    write_lines(parts[0].coalesce(1), src)
    from skytally.sources import file_line_stream
    q = R.airport_popularity_stream(file_line_stream(spark, src), base + "/table", base + "/ckpt",
                                    {"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        assert rows(read_latest(spark, base + "/table")) == rows(Q.airport_popularity(parts[0]))
        parts[1].coalesce(1).write.mode("append").text(src)
        q.processAllAvailable()
        assert rows(read_latest(spark, base + "/table")) == rows(Q.airport_popularity(five))
        assert q.isActive
    finally:
        q.stop()
    assert not q.isActive


def test_sink_errors_fail_the_query(spark, five):
    src = split_into_files(spark, five, 1, "t-fail")
    base = scratch_path(spark, "t-fail-run")

    def broken(batch_df):
        return batch_df.select(F.raise_error(F.lit("sink exploded")).alias("y"))

    from skytally.sources import file_line_stream
    from skytally.plans.queries import airport_popularity
    q = R.start(airport_popularity(file_line_stream(spark, src)), snapshot_sink(base + "/table", broken),
                base + "/ckpt", "complete", {"availableNow": True})
    with pytest.raises(Exception, match="sink exploded"):
        q.awaitTermination(300)
    assert newest_batch(spark, base + "/table") is None


def test_top_n_stream_memory_sink(spark, five):
    src = split_into_files(spark, five, 2, "t-top")
    from skytally.sources import file_line_stream
    counts = Q.airport_popularity(file_line_stream(spark, src))
    q = (R.top_n_stream(counts, 3).writeStream.outputMode("complete").format("memory")
         .queryName("t_top3").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = [(r["id"], r["popularity"]) for r in spark.sql("SELECT * FROM t_top3").collect()]
    expected = [(r["id"], r["popularity"]) for r in Q.top10_airports(five, 3).collect()]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_itinerary_modes_equal_batch(spark, seven, mode):
    src = split_into_files(spark, seven, 4, f"t-itin-{mode}")
    got = run(spark, src, lambda s, t, c, tr: R.itinerary_stream(s, t, c, tr, mode=mode))
    assert rows(got) == rows(Q.best_itineraries(seven))


def test_a_mistyped_far_date_loses_nothing(spark):
    """A leg dated 2099 in the first file does not make later legs late."""
    base = scratch_path(spark, "t-2099")
    for i, lines in enumerate([["2099-01-01,1,A,B,X,0,1.00"], ["2008-03-01,2,A,B,X,0,1.00"], ["2008-03-03,3,B,C,X,0,1.00"]]):
        df = spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1)
        df.write.mode("append").text(base + "/input")
    got = run_available(spark, base + "/input", base, R.itinerary_stream)
    assert [(r["x"], r["y"], r["z"], r["flight1"], r["flight2"]) for r in got.collect()] == [("A", "B", "C", 2, 3)]


def test_reject_stream_and_results_cover_every_line(spark):
    from skytally.sources import defect_itinerary_lines
    lines = defect_itinerary_lines(spark, SF_SMOKE)
    path = scratch_path(spark, "t-rejects")
    write_lines(lines.coalesce(1), path + "/input", 2000)
    from skytally.sources import file_line_stream
    q = R.reject_stream(file_line_stream(spark, path + "/input"), "itineraries", path + "/rejects", path + "/ckpt", {"availableNow": True})
    q.awaitTermination()
    from skytally.operators import legs
    got = spark.read.parquet(path + "/rejects")
    assert got.count() + legs(lines).count() == lines.count()
    assert {r["reason"] for r in got.select("reason").distinct().collect()} == {
        "arity", "bad_date", "bad_flight", "blank_airport", "bad_arr_delay"}


def test_file_order_does_not_matter(spark, five):
    """Files are consumed in modification-time order; any order gives the same final table."""
    import glob
    import os
    import random

    from skytally.session import local_path

    src = split_into_files(spark, five, 5, "t-order")
    files = sorted(glob.glob(os.path.join(local_path(src), "part-*")))
    assert len(files) == 5
    order = list(range(len(files)))
    random.Random(13).shuffle(order)
    for rank, i in enumerate(order):
        os.utime(files[i], (1_000_000 + rank * 100, 1_000_000 + rank * 100))
    start = lambda s, t, c, tr: R.grouped_top_k_stream(s, Q.CARRIERS_BY_ROUTE, t, c, tr, mode="update")
    got = run(spark, src, start)
    assert rows(got) == rows(Q.top10_carriers_by_route(five))


def test_kafka_source_needs_connector(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        from skytally.sources import kafka_line_stream
        kafka_line_stream(spark, "localhost:1", "flights")


def test_old_snapshots_are_overwritten(spark):
    import glob

    from skytally.session import local_path

    table = scratch_path(spark, "t-prune")
    sink = snapshot_sink(table, keep=3)
    for i in range(6):
        sink(spark.createDataFrame([("A", i)], "id string, popularity long"), i)
        assert rows(read_latest(spark, table)) == [("A", i)]
    assert len(glob.glob(local_path(table) + "/slot=*")) == 3
    assert rows(read_latest(spark, table, upto=4)) == [("A", 4)]
    with pytest.raises(ValueError, match="belongs to a stream"):
        write_once(spark.createDataFrame([("A", 1)], "id string, popularity long"), table)


def counts(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id string, popularity long")


def test_a_log_can_be_read_over_a_compacted_copy(spark):
    """Older batches may go once they are compacted; a restarted stream may go on in the copy."""
    import shutil

    from skytally.session import local_path

    table = scratch_path(spark, "t-compact")
    sink = change_sink(table, ["id"])
    for i in range(6):
        sink(counts(spark, ("a", i), (f"k{i}", i)), i)
    want = sorted([("a", 5)] + [(f"k{i}", i) for i in range(6)])
    compact(spark, table, table + "-3", upto=3)
    assert rows(read_latest(spark, table, base=table + "-3")) == want
    for i in range(4):
        shutil.rmtree(f"{local_path(table)}/batch={i}")
    assert rows(read_latest(spark, table, base=table + "-3")) == want
    assert rows(read_latest(spark, table)) != want
    change_sink(table + "-3", ["id"])(counts(spark, ("a", 9)), 4)
    assert rows(read_latest(spark, table + "-3")) == sorted([("a", 9)] + [(f"k{i}", i) for i in range(4)])


def test_ranking_log_equals_batch_after_every_trigger(spark):
    """Random running counts with many ties: the log alone gives each trigger's top-k."""
    import random
    from collections import Counter

    pick = random.Random(4)
    table, k, state = scratch_path(spark, "t-monotone"), 3, Counter()
    sink = ranking_sink(table, ["g"], k)
    for batch in range(8):
        changed = set()
        for _ in range(pick.choice((0, 5, 40))):
            key = (pick.choice("xyz") if pick.random() < 0.8 else None, f"i{pick.randrange(9)}")
            state[key] += pick.choice((1, 1, 2))
            changed.add(key)
        sink(spark.createDataFrame([(*key, state[key]) for key in changed], "g string, item string, n long"), batch)
        want = [(g, i, n, r + 1) for g0 in {g for g, _ in state} for r, (n, g, i) in enumerate(
            sorted(((n, g, i) for (g, i), n in state.items() if g == g0), key=lambda t: (-t[0], t[2]))[:k])]
        got = [tuple(r) for r in read_latest(spark, table).select("g", "item", "n", "rank").collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        written = spark.read.parquet(f"{table}/batch={batch}")
        assert written.count() <= k * len({g for g, _ in changed})   # nothing else is written, nothing read
    compact(spark, table, table + "-all")
    assert sorted(map(tuple, read_latest(spark, table + "-all").select("g", "item", "n", "rank").collect()), key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError):
        ranking_sink(table, ["g"], k, "wide")


def test_readers_can_keep_to_committed_batches(spark, five):
    import os

    from skytally.session import local_path

    src = split_into_files(spark, five, 3, "t-committed")
    work = scratch_path(spark, "t-committed-run")
    run_available(spark, src, work, lambda s, t, c, tr: R.carrier_on_time_stream(s, t, c, tr, mode="update"))
    table, checkpoint = work + "/table", work + "/checkpoint"
    last = newest_batch(spark, table)
    assert last_committed(spark, checkpoint) == last
    os.remove(f"{local_path(checkpoint)}/commits/{last}")
    assert rows(read_latest(spark, table, checkpoint)) == rows(read_latest(spark, table, upto=last - 1)) != rows(read_latest(spark, table))
    ranked = R.read_ranked(spark, table)
    assert rows(ranked, "rank", "id", "popularity") == rows(Q.carriers_ranked(five), "rank", "id", "popularity")
    assert rows(R.read_ranked(spark, table, top=3)) == rows(Q.top10_carriers(five, 3))
    with pytest.raises(ValueError, match="would be missing"):
        R.carrier_on_time_stream(text_stream(spark, src), work + "/gone", checkpoint, {"availableNow": True}, mode="update")


def test_state_holds_the_running_counts_after_a_restart(spark, five):
    """RocksDB state with a changelog: the checkpoint's counts are the table's, before and after a restart."""
    parts = five.randomSplit([1.0, 1.0], seed=3)
    base = scratch_path(spark, "t-state")
    src, work = base + "/input", base + "/work"
    start = lambda s, t, c, tr: R.carrier_on_time_stream(s, t, c, tr, mode="update")
    for part in parts:
        part.coalesce(1).write.mode("append").text(src)
        with R.state_on_disk(spark):
            table = run_available(spark, src, work, start)
        assert rows(R.read_state_counts(spark, work + "/checkpoint"), "id", "popularity") == rows(table, "id", "popularity")
    assert rows(table) == rows(Q.carrier_on_time_arrivals(five))
    first = R.read_state_counts(spark, work + "/checkpoint", batch_id=0)
    assert rows(first, "id", "popularity") == rows(Q.carrier_on_time_arrivals(parts[0]), "id", "popularity")
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "false") == "false"


def test_accounts_add_up_per_trigger(spark):
    from pyspark.sql import Observation

    from skytally.operators import ON_TIME_JOBS, REASONS, rejects
    from skytally.sources import defect_on_time_lines
    from skytally.streaming.accounts import Accounts, accounted

    lines = defect_on_time_lines(spark, SF_SMOKE).cache()
    n = lines.count()
    src = split_into_files(spark, lines, 3, "t-accounts")
    queries = []

    def start(s, t, c, tr):
        queries.append(R.grouped_top_k_stream(accounted(s, "carriers-by-airport"), Q.CARRIERS_BY_AIRPORT, t, c, tr, mode="update"))
        return queries[-1]

    got = run(spark, src, start)
    assert rows(got) == rows(Q.top10_carriers_by_airport(lines))      # the numbers change nothing
    accounts = Accounts()
    for p in queries[0].recentProgress:
        accounts.add(p)
    assert len(accounts.triggers) == 3 and sum(t["lines"] for _, t in accounts.triggers) == n
    for _, t in accounts.triggers:
        assert t["lines"] == sum(v for k, v in t.items() if k != "lines")
    for job in (*ON_TIME_JOBS, "itineraries"):
        seen = Observation("t")
        assert accounted(lines, job, seen).count() == n
        want = {r["reason"]: r["count"] for r in rejects(lines, job).groupBy("reason").count().collect()}
        assert {k: v for k, v in seen.get.items() if k in REASONS[job] and v} == want
        assert seen.get["used"] == n - sum(want.values())


def text_stream(spark, src):
    from skytally.sources import file_line_stream
    return file_line_stream(spark, src)


def test_itinerary_triggers_read_and_write_what_changes(spark):
    """On a feed ordered by date a trigger writes the itineraries around its days; unchanged best flights write nothing."""
    from skytally.streaming.changelog import history

    src, base = scratch_path(spark, "t-ordered") + "/in", scratch_path(spark, "t-ordered-run")
    q = lambda: R.itinerary_stream(text_stream(spark, src), base + "/t", base + "/c", {"availableNow": True}).awaitTermination()
    days = ["2008-01-%02d" % d for d in range(1, 9)]
    for day in days:
        lines = [f"{day},{n},{o},{t},X,0,{n}.00" for n in (3, 5) for o, t in (("A", "B"), ("B", "C"), ("C", "A"))]
        spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.mode("append").text(src)
        q()
    assert rows(read_latest(spark, base + "/t")) == rows(Q.best_itineraries(text_lines(spark, src)))
    by_batch = {r["batch"]: r["count"] for r in history(spark, base + "/t").groupBy("batch").count().collect()}
    assert by_batch == {b: 3 for b in range(2, 8)}
    spark.createDataFrame([("2008-01-03,9,A,B,X,0,50.00",)], "line string").coalesce(1).write.mode("append").text(src)
    q()     # a later, worse flight
    spark.createDataFrame([("2008-01-05,9,B,C,X,0,-50.00",)], "line string").coalesce(1).write.mode("append").text(src)
    q()     # a better second leg of the 3rd, and first leg towards the 7th
    by_batch = {r["batch"]: r["count"] for r in history(spark, base + "/t").groupBy("batch").count().collect()}
    assert by_batch.get(8, 0) == 0 and by_batch[9] == 2
    assert rows(read_latest(spark, base + "/t")) == rows(Q.best_itineraries(text_lines(spark, src)))


def test_ranked_stream_runs_its_state_stage_once(spark, five):
    """The batch is kept while the range sort samples and sorts it: one read per trigger."""
    src = split_into_files(spark, five, 1, "t-once")
    progress: list = []
    run_available(spark, src, scratch_path(spark, "t-once-run"),
                  lambda s, t, c, tr: R.airport_popularity_stream(s, t, c, tr, ranked=True), progress=progress)
    batch = [p for p in progress if p["numInputRows"] > 0]
    assert [p["numInputRows"] for p in batch] == [five.count()]
    assert batch[0]["stateOperators"][0]["numRowsUpdated"] == Q.airport_popularity(five).count()


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_itinerary_stream_runs_its_state_stage_once(spark, mode):
    """However often a trigger's sink uses the route-days, each is restored and saved once."""
    src, base = scratch_path(spark, "t-itin-once") + "/in", scratch_path(spark, "t-itin-once-run")
    for delay in (30, 20, 40):
        lines = [f"2008-01-0{d},{d}{delay},{o},{t},X,0,{delay}.00" for d in range(1, 7) for o, t in (("A", "B"), ("B", "C"))]
        spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.mode("append").text(src)
    progress: list = []
    got = run_available(spark, src, base, lambda s, t, c, tr: R.itinerary_stream(s, t, c, tr, mode=mode), progress=progress)
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in progress if p["numInputRows"] > 0] == [12, 12, 12]
    assert rows(got) == rows(Q.best_itineraries(text_lines(spark, src)))


def test_console_top10_runs(spark, five, capsys):
    src = split_into_files(spark, five, 2, "t-console")
    from skytally.sources import file_line_stream
    q = R.console_top10(Q.airport_popularity(file_line_stream(spark, src)), {"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    assert q.lastProgress["numInputRows"] > 0


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_replayed_last_batch_leaves_result_unchanged(spark, five, mode):
    """Crash after the sink wrote but before the commit: Spark re-runs the batch with the same id."""
    import os

    from skytally.session import local_path

    src = split_into_files(spark, five, 3, f"t-replay-{mode}")
    work = scratch_path(spark, f"t-replay-run-{mode}")
    start = lambda s, t, c, tr: R.grouped_top_k_stream(s, Q.CARRIERS_BY_AIRPORT, t, c, tr,
                                                       mode=mode, layout="packed")
    first = rows(run_available(spark, src, work, start))
    last = newest_batch(spark, work + "/table")
    commits = os.path.join(local_path(work + "/checkpoint"), "commits")
    os.remove(os.path.join(commits, str(last)))
    crc = os.path.join(commits, f".{last}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    progress: list = []
    again = rows(run_available(spark, src, work, start, progress=progress))
    assert [p["batchId"] for p in progress if p["numInputRows"] > 0] == [last]  # the batch really re-ran
    assert again == first
    norm = lambda rs: sorted((a, tuple(i)) for a, i in rs)
    expected = [(r["airport"], r["items"]) for r in Q.packed_top_k(five, Q.CARRIERS_BY_AIRPORT).collect()]
    assert norm(again) == norm(expected)


def test_fresh_checkpoint_on_used_table_is_refused(spark, five):
    src = split_into_files(spark, five, 2, "t-guard")
    base = scratch_path(spark, "t-guard-run")
    from skytally.sources import file_line_stream
    q = R.airport_popularity_stream(file_line_stream(spark, src), base + "/table", base + "/ckpt1",
                                    {"availableNow": True})
    q.awaitTermination(300)
    with pytest.raises(ValueError, match="another run"):
        R.airport_popularity_stream(file_line_stream(spark, src), base + "/table", base + "/ckpt2",
                                    {"availableNow": True})
    # the checkpoint that wrote the table may restart on it
    q = R.airport_popularity_stream(file_line_stream(spark, src), base + "/table", base + "/ckpt1",
                                    {"availableNow": True})
    q.awaitTermination(300)
    assert rows(read_latest(spark, base + "/table")) == rows(Q.airport_popularity(five))


def test_processed_files_are_archived(spark, five):
    """cleanSource=archive: Spark moves each file away once its batch is committed."""
    import glob
    import os
    import time

    from skytally.session import local_path
    from skytally.sources import file_line_stream

    src = split_into_files(spark, five, 3, "t-archive")
    base = scratch_path(spark, "t-archive-run")
    archive = base + "/archive"
    q = R.airport_popularity_stream(file_line_stream(spark, src, clean_source="archive", archive_dir=archive),
                                    base + "/table", base + "/ckpt", {"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        assert rows(read_latest(spark, base + "/table")) == rows(Q.airport_popularity(five))
        # files of committed batches are moved when a later batch starts; give the next trigger time
        for _ in range(20):
            if len(glob.glob(os.path.join(local_path(src), "part-*"))) <= 1:
                break
            time.sleep(1)
        assert len(glob.glob(os.path.join(local_path(src), "part-*"))) <= 1
        assert glob.glob(os.path.join(local_path(archive), "**", "part-*"), recursive=True)
    finally:
        q.stop()
    with pytest.raises(ValueError):
        file_line_stream(spark, src, clean_source="archive")


def test_replay_runs_the_same_number_of_triggers_at_any_size(spark):
    import os

    from skytally.session import local_path
    from skytally.streaming.replay import REPLAY_TRIGGERS, replay

    for sf in (SF_SMOKE, "/root/testdata/sf0.01"):
        seen = {}

        def read(s, base, seen=seen):
            seen["base"] = base
            return [r[0] for r in s.read.parquet(base + "/table").select("batch").distinct().collect()]

        got = replay(spark, on_time_lines(spark, sf), R.airport_popularity_stream, "t-triggers", read=read)
        assert len(got) == REPLAY_TRIGGERS
        assert not os.path.exists(local_path(seen["base"] + "/input"))  # the copy is gone


def test_scratch_needs_a_shared_folder_off_local():
    from skytally.session import checkpoint_root

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


@pytest.fixture
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_expiring_itineraries_keep_little_state_and_report_late_legs(spark, few_partitions):
    from skytally.streaming.expiring import expiring_itineraries, gate_late_legs

    base = scratch_path(spark, "t-expiring")
    src = base + "/in"
    now = {"availableNow": True}
    state = []
    days = [f"2008-01-{d:02d}" for d in range(1, 12)]
    for k, day in enumerate(days):
        lines = [f"{day},{n},{o},{t},X,0,{n}.00" for n in (3, 5) for o, t in (("A", "B"), ("B", "C"), ("C", "A"))]
        if k == 4:
            lines += [f"{days[3]},1,A,B,X,0,-9.00"]           # a day late: in time
        if k == 7:
            lines += [f"{days[2]},1,A,B,X,0,-9.00", "no leg"]  # a week late
        spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.mode("append").text(src)
        gate_late_legs(text_stream(spark, src), base + "/accepted", base + "/late", base + "/c1", trigger=now).awaitTermination()
        if k % 2:
            continue
        q = expiring_itineraries(spark, base + "/accepted", base + "/table", base + "/c2", trigger=now)
        q.awaitTermination()
        state.append(sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"]))
    late = spark.read.parquet(base + "/late")
    assert [(str(r["flight_date"]), r["flight"], r["reason"]) for r in late.collect()] == [(days[2], 1, "late")]
    in_time = text_lines(spark, src).where(f"line != '{days[2]},1,A,B,X,0,-9.00'")
    # final: what the watermark, a day behind the newest date, has passed
    want = [r for r in rows(Q.best_itineraries(in_time)) if str(r[0]) <= days[-5]]
    got = rows(spark.read.parquet(base + "/table"))
    assert [r for r in got if str(r[0]) <= days[-5]] == want and len(want) == 3 * 7
    assert set(got) <= set(rows(Q.best_itineraries(in_time)))
    assert spark.read.parquet(base + "/accepted").count() + late.count() + 1 == text_lines(spark, src).count()
    # no more rows in state as the days go on
    assert max(state[4:]) <= max(state[2:4])
