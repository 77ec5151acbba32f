"""DartMinHash against brute force."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from pyspark.sql import functions as F

from skytally.llm.op1_dartminhash import dart_signatures, near_duplicates, op1_dartminhash
from skytally.llm.shingles import similarities

SF = "/root/testdata/sf0.01"


def bag(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    if len(words) < 5:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a or b else 0.0


def brute_classes(rows):
    bags = [bag(t) for _, t in rows]
    at = defaultdict(set)
    for i, b in enumerate(bags):
        for s in b:
            at[s].add(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    empty = [i for i, b in enumerate(bags) if not b]
    for i in empty[1:]:
        parent[find(i)] = find(empty[0])
    for i, b in enumerate(bags):
        for j in {j for s in b for j in at[s] if j < i}:
            if find(i) != find(j) and jaccard(b, bags[j]) >= 0.8:
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return {d: min(v) for v in least.values() for d in v}


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = {r["doc_id"]: r["class_id"] for r in op1_dartminhash(spark, SF).collect()}
    assert got == brute_classes(rows)


def test_signature_agreement_is_weighted_similarity():
    rng = np.random.default_rng(3)
    e = rng.integers(1, 1 << 60, 300).astype(np.uint64)
    wa, wb = rng.uniform(0.1, 4, 300), rng.uniform(0.1, 4, 300)
    k = 1024
    s = dart_signatures(np.repeat([0, 1], 300), np.concatenate([e, e]), np.concatenate([wa, wb]), 2, k)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((s[0] == s[1]).mean() - want) < 4 * (want * (1 - want) / k) ** 0.5


def test_exact_similarity():
    texts = ["a b c d e f g", "a b c d e f g a b c d e", "x y", "", "a b c d e f x"]
    for a in texts:
        got = similarities([a] * len(texts), texts)
        assert np.allclose(got, [jaccard(bag(a), bag(b)) for b in texts])


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "one two", "x"), (5, "ONE  two\n", "x"), (None, "one two", "x"),
            (7, long, "x"), (8, long + " tail", "x"), (8, long + " tail", "x"), (9, "other words altogether here now", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumn("file", F.lit(1)).withColumn("node", F.lit(2))
    got = near_duplicates(df).collect()
    assert sorted((str(r["id"]), r["class_id"], r["class_size"], r["kept"]) for r in got) == sorted([
        ("1", 1, 3, True), ("2", 1, 3, False), ("3", 1, 3, False), ("4", 4, 3, True), ("5", 4, 3, False), ("None", 4, 3, False),
        ("7", 7, 3, True), ("8", 7, 3, False), ("8", 7, 3, False), ("9", 9, 1, True)])
    assert near_duplicates(df.limit(0)).count() == 0


def test_crowded_bucket_of_chained_copies(spark):
    """A chain of copies, each close to the next only: one class, although the ends are far apart."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words = words[4:] + [f"v{i}x{k}" for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["class_id"] for r in near_duplicates(df).collect()} == {0}
