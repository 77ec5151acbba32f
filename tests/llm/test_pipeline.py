"""The pipeline's stages against brute force, on the small table and on awkward rows."""

import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline
from skytally.llm import common as C
from test_mixing_sharding import targets, words
from test_near_dedup import brute_classes

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, sf_dir=SF):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = C.materialize(stage(spark, docs, sf_dir), f"t-{name}")
        out.append((docs.columns, [tuple(r) for r in docs.collect()]))
    return out


def test_stages_equal_brute_force(spark):
    docs = C.read_documents(spark, SF)
    rows = [tuple(r) for r in docs.collect()]
    language, exact, near, mix, pack = stages(spark, docs)
    assert all(c == COLUMNS for c, _ in (language, exact, near, mix))
    assert sorted(language[1]) == sorted(r for r in rows if re.search(r"[^\W\d_]", r[1] or ""))

    groups = defaultdict(list)
    for r in language[1]:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", r[1])].append(r)
    assert sorted(exact[1]) == sorted(min(g, key=lambda r: (-len(r[1]), r[0])) for g in groups.values())

    classes = brute_classes([(r[0], r[1]) for r in exact[1]])
    assert sorted(near[1]) == sorted(r for r in exact[1] if classes[r[0]] == r[0])

    size = defaultdict(int)
    taken = defaultdict(int)
    for r in near[1]:
        size[r[3]] += words(r[1])
    copies = Counter(mix[1])
    assert set(copies) <= set(near[1]) and max(copies.values()) <= 2
    for r, n in copies.items():
        taken[r[3]] += n * words(r[1])
    want = targets(size)
    largest = max(words(r[1]) for r in near[1])
    assert all(abs(taken[s] - t) <= 2 * largest for s, t in want.items())

    pieces = [dict(zip(pack[0], r, strict=True)) for r in pack[1]]
    assert Counter(p["doc_id"] for p in pieces if p["piece"] == 0) == Counter(r[0] for r in mix[1])
    filled = defaultdict(list)
    for p in pieces:
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_rows(spark, empty):
    text = "Die Katze und der Hund gehen in den Wald, und dann nach Haus."
    rows = [(1, text, "de", "a", 1), (1, text, "de", "a", 1), (2, text + " ", "de", None, 1), (3, None, "de", "a", 1), (4, "", None, "b", 1),
            (5, "12 34", None, "b", 1), (None, "The cat and the dog go into the house and then to the wood.", "en", "b", 1),
            (7, "wort " * 30_000, "de", "c", 1)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, file string, size int")
    docs = C.materialize(df.limit(0) if empty else df, "t-awkward")
    language, exact, near, mix, pack = stages(spark, docs)
    assert all(c == docs.columns for c, _ in (language, exact, near, mix))
    if empty:
        assert not any(r for _, r in (language, exact, near, mix, pack))
        return
    assert sorted(str(r[0]) for r in language[1]) == ["1", "1", "2", "7", "None"]
    assert sorted(str(r[0]) for r in exact[1]) == ["2", "7", "None"]
    assert near[1] and set(r[0] for r in pack[1]) <= {2, 7, None}


def test_python_workers_get_bounded_batches(spark, monkeypatch):
    """Whole texts reach Python workers, and become Python objects, a few megabytes at a time in near and pack, a slice at a time in language."""
    key, most, seen = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20, {}
    before, write = spark.conf.get(key), C.materialize

    def noted(df, name, **options):
        seen[name] = spark.conf.get(key)
        return write(df, name, **options)

    monkeypatch.setattr(C, "materialize", noted)
    rows = [(i, " ".join(f"w{i // 3}x{k}" for k in range(20)) + " end" * (i % 3), "en", "a", 1) for i in range(30)]
    docs = write(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "t-batches")
    corpus_pipeline.near(spark, docs, SF).collect()
    corpus_pipeline.pack(spark, docs, SF).collect()
    asked = ("near-signed", "near-links", "near-shingles", "near-links-2", "pack-pieces")
    assert [n for n in asked if not str(seen[n]).isdigit() or int(seen[n]) > most] == []
    assert spark.conf.get(key) == before

    texts = spark.createDataFrame([("x" * 50_000,)] * 400, "t string").coalesce(1)
    with C.small_python_batches(spark):
        sizes = C.materialize(texts.mapInArrow(lambda parts: (p.select([]).from_pydict({"n": [p.num_rows], "b": [p.nbytes]}) for p in parts),
                                               "n long, b long"), "t-sizes").collect()
    assert sum(r["n"] for r in sizes) == 400 and max(r["b"] for r in sizes) < 2 * most


def test_language_reads_texts_by_slices(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from skytally.llm import op7_language as o7

    asked = []

    def judge(self, texts):
        asked.append(len(texts))
        return [t or "und" for t in texts], np.arange(len(texts)) / 10_000, np.array([t is not None for t in texts], bool)

    monkeypatch.setattr(o7.Model, "judge", judge)
    predict = o7.predictor(spark, o7.Model(["en"], np.zeros((2, 1), np.float32)))
    texts = [None if i % 7 == 0 else f"t{i}" for i in range(2500)]
    got = predict.func(pa.array(texts, pa.string())).to_pylist()
    assert [r["lang_pred"] for r in got] == [t or "und" for t in texts] and [r["likely"] for r in got] == [t is not None for t in texts]
    assert max(asked) <= 1000 and len(predict.func(pa.array([], pa.string()))) == 0
