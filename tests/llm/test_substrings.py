"""Byte-exact substring removal against brute force."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from skytally.llm.op4_substrings import op4_substrings, remove_repeats
from skytally.llm.suffixes import suffix_array

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    """Per text (n_bytes, n_removed, n_spans, sha256 of what is left)."""
    data = [(t or "").encode() for t in texts]
    count = Counter(hashlib.blake2b(d[i:i + length], digest_size=16).digest() for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[hashlib.blake2b(d[i:i + length], digest_size=16).digest()] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    want = {d: x for (d, _), x in zip(rows, brute([t for _, t in rows], 400))}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op4_substrings(spark, SF).collect()}
    assert got == want
    assert sum(x[1] for x in want.values()) > 0


def found(df, **kw):
    return sorted((str(r["id"]), len(r["bytes"]), len(r["bytes"]) - len(r["kept"]), len(r["spans"] or []), hashlib.sha256(r["kept"]).hexdigest())
                  for r in remove_repeats(df, **kw).collect())


@pytest.mark.parametrize("group", [1000, 2])
@pytest.mark.parametrize("core", [5, 20, 30])
def test_random_texts_with_shared_passages(spark, core, group):
    """Short strings, so that matches end everywhere and cores are ambiguous; both ways for crowded cores."""
    rng = random.Random(core + group)
    passages = ["".join(rng.choice("abé") for _ in range(rng.randint(20, 120))) for _ in range(6)]
    texts = [None, "", "ab", "ab" * 60, "ab" * 45, "a" * 100, passages[0], passages[0]]
    for _ in range(60):
        t = "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            t += p[rng.randint(0, 10):len(p) - rng.randint(0, 10)] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 30)))
        texts.append(t)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, bytes string")
    want = sorted((str(i), *x) for i, x in enumerate(brute(texts, 30)))
    assert found(df, length=30, core=core, group=group) == want


def test_edge_cases(spark):
    long = "".join(chr(33 + (i * i // 7) % 90) for i in range(50_000))
    rows = [(1, "x" + long), (2, long + "y"), (2, long + "y"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(df)
    assert [g[:3] for g in got] == [("1", 50_001, 50_000), ("2", 50_001, 50_001), ("2", 50_001, 50_001), ("None", 0, 0)]
    assert remove_repeats(df.limit(0)).count() == 0


def test_suffix_array_is_sorted():
    rng = random.Random(5)
    for _ in range(600):
        k = rng.choice([1, 2, 3, 300])
        s = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.3:
            s = (s[:4] * 20)[:len(s)]
        assert suffix_array(np.array(s, int)) == sorted(range(len(s)), key=lambda i: s[i:])
