"""Mixing and sharding against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from skytally.llm import common as C
from skytally.llm.op2_mixing import mix, mixed_text, op2_mixing, taken_words
from skytally.llm.op9_sharding import op9_sharding, place, shard_rows

SF = "/root/testdata/sf0.01"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Share the excess again and again, as the rule is written."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    cap = {s: 2 * sizes[s] for s in names}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_} if open_ else {}
        above = [s for s in open_ if share[s] > cap[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = float(cap[s])
            left -= cap[s]
            open_.remove(s)


def check(rows, got, tolerance):
    """rows: (id, text, source); got: result rows with source."""
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    want = targets(sizes)
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _, _ in rows)
    by_doc = defaultdict(list)
    for d, t, s in rows:
        by_doc[d].append((words(t), s))
    taken = defaultdict(int)
    for r in got:
        assert (r["size"], r["source"]) in by_doc[r["doc_id"]]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= tolerance, s


def test_mix_query(spark):
    rows = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    got = op2_mixing(spark, SF).collect()
    check(rows, got, 64)
    again = op2_mixing(spark, SF).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_edge_cases(spark):
    rows = [(1, "a b c " * 300, "x"), (2, None, "x"), (3, "", None), (4, " \t", "y"), (5, "w " * 1000, None), (5, "w " * 1000, None),
            (None, "one two", "y"), (7, "z" * 50_000, "z"), (8, "p q " * 50_000, "hot"), (9, "zero", "hot"), (10, "   x", "hot")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size long, block long")
    m = mix(df)
    got = taken_words(m).join(m["sources"].select("number", "source", "source_size", "target"), "number").withColumnRenamed("id", "doc_id").collect()
    check(rows, got, 64)
    empty = mix(df.limit(0))
    assert taken_words(empty).count() == 0 and empty["places"].count() == 0


def test_many_small_sources_come_near_their_targets(spark):
    """Sixty sources of 50 words, one of three words and one of 9000: totals within one block, none left out."""
    rows = [(i, " ".join(["w"] * 25), f"s{i % 60:02d}") for i in range(120)] + [(200, "a b c", "t"), (201, "x " * 9000, "u"), (202, "", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    m = mix(df)
    got = taken_words(m).join(m["sources"].select("number", "source", "source_size", "target"), "number").withColumnRenamed("id", "doc_id").collect()
    check(rows, got, 64)
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert abs(sum(taken.values()) - sum(target.values())) <= 64
    assert all(abs(taken[s] - target[s]) <= (64 if s == "u" else 1) for s in target)
    assert all(taken[s] > 0 for s in target if s != "v")
    assert sum(r["taken"] for r in got) == sum(len(r["text"].split()) for r in mixed_text(df, m).collect())


def test_mixed_text_is_whole_blocks_of_the_sources(spark):
    rows = [(i, " ".join(f"{i}_{k}" for k in range(37 * i % 200)), f"s{i % 3}") for i in range(1, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    m = mix(df, shard_blocks=16)
    out = mixed_text(df, m).collect()
    taken = Counter(w for r in out for w in r["text"].split(" "))
    per_doc = {r["id"]: r["taken"] for r in taken_words(m).collect()}
    count = Counter()
    for w, n in taken.items():
        count[int(w.split("_")[0])] += n
    assert {d: n for d, n in per_doc.items() if n} == dict(count)
    assert max(taken.values()) <= 2
    assert len(out) == m["places"].count() and len({(r["shard"], r["place"]) for r in out}) == len(out)


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 5, 10, 997, 4096):
        df = spark.range(n).withColumn("n", F.lit(n).cast("long"))
        got = [r[0] for r in C.feistel_permute(df, "id", "n", [F.lit(3).cast("long")], "p").select("p").collect()]
        assert sorted(got) == list(range(n))
        if n > 100:
            assert sum(a == b for a, b in enumerate(got)) < 10


def test_sharding_query(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = op9_sharding(spark, SF).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    # shard and slot can be computed: they are the images of 0 .. n-1
    assert sorted((r["shard"], r["slot"]) for r in got) == sorted(place(i, len(got)) for i in range(len(got)))
    # and do not depend on how the rows lie in partitions
    docs = C.read_documents(spark, SF).select("doc_id", F.octet_length("text").alias("n"))
    a, b = shard_rows(docs), shard_rows(docs.repartition(7, "n"))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_numbers_match_the_computed_places(spark):
    from skytally.llm.op9_sharding import SEED
    n = 1000
    df = spark.range(n).withColumn("n", F.lit(n).cast("long"))
    got = C.feistel_permute(df, "id", "n", [F.lit(SEED).cast("long")], "p").collect()
    assert all(place(r["id"], n) == (r["p"] % 16, r["p"] // 16) for r in got)


def test_sharding_edge_cases(spark):
    rows = [(1, "a")] * 500 + [(None, None), (None, None), (2, ""), (3, "x" * 200_000)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, shard int")
    got = shard_rows(df, shards=7).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    assert Counter((r["shard"], r["slot"]) for r in got) == Counter(place(i, len(rows), 7) for i in range(len(rows)))
    odd = df.selectExpr("doc_id AS _n", "doc_id AS `a.b`", "doc_id AS _number", "doc_id AS _b", "doc_id AS _copy", "doc_id AS _fa", "doc_id AS _place")
    out = shard_rows(odd, shards=7)
    assert out.columns == [*odd.columns, "shard", "slot"] and out.count() == odd.count()
    assert shard_rows(df.limit(0)).count() == 0


def test_copies_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(C, "COPIES_PER_STEP", 7)
    df = spark.createDataFrame([("a", 1), ("b", 20), ("c", 7)], "k string, n long")
    got = Counter((r["k"], r["i"]) for r in C.expand_copies(df, "n", "i").collect())
    assert got == Counter((k, i) for k, n in (("a", 1), ("b", 20), ("c", 7)) for i in range(n))


def test_prefix_sums(spark):
    rows = [("x", 3)] * 40 + [("x", 5), ("y", 2), (None, 4), (None, 4)]
    df = spark.createDataFrame(rows, "g string, w long")
    got = defaultdict(list)
    for r in C.prefix_sums(df, ["g"], "w", "s", 8).collect():
        got[r["g"]].append((r["s"], r["w"]))
    for parts in got.values():
        at = 0
        for s, w in sorted(parts):
            assert s == at
            at += w
    assert sum(map(len, got.values())) == len(rows)
