"""Phrase counts and collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from skytally.llm import op13_phrases as P

ODD = [None, "", " \t ", ".", "a", "A.b;c:d!e?f\ng\x0bh\x0ci\rj", "a  b\t c", "é É ñ", "x\x1cy z\x85 w\xa0q", "a,b a b,a b", "a a a a a a a"]


def texts(n=300):
    pick = random.Random(5)
    words = ["the", "of", "New", "York", "city", "état", "x-y", "a", "b", "c"]
    out = []
    for _ in range(n):
        size = pick.choice((1, 3, 40, 200))
        out.append("".join(pick.choices(words, [30, 20, 5, 5, 3, 3, 2, 1, 1, 1])[0] + pick.choice([" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n"])
                           for _ in range(size)))
    return out


def rows():
    langs = ["en", "en", "en", "de", None, "und"]
    return [(i, t, langs[i % 6]) for i, t in enumerate(ODD + texts() + ["New York city of the New York " * 60] * 7)]


def plain_counts(docs):
    found, total = Counter(), Counter()
    for _, text, lang in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, 5):
                    if i + k <= len(w):
                        found[lang, tuple(w[i:i + k])] += 1
    return found, total


def plain_ranking(docs, top):
    f, total = plain_counts(docs)
    cand = {(lang, w): n for (lang, w), n in f.items() if len(w) > 1 and n >= 30}
    longest = Counter()
    for (lang, w), n in cand.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                key = lang, w[i:i + size]
                longest[key] = max(longest[key], n)
    out = {}
    for (lang, w), a in cand.items():
        if 100 * longest[lang, w] >= 80 * a:
            continue
        score, _, left, right = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, rank + 1, p.decode(), -a, left, right, total[lang], -score)
            for lang, own in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top])}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows()], "doc_id long, text string, lang string, phrase string, n int").repartition(5)


@pytest.mark.parametrize("group,bits", [(250_000, 1 << 20), (500, 1 << 20), (40, 64), (8, 1 << 12)])
def test_counts_whatever_the_groups_and_bitmaps(spark, docs, monkeypatch, group, bits):
    want = {(lang, " ".join(w)): n for (lang, w), n in plain_counts(rows())[0].items() if n >= 30}
    got = P.phrase_counts(docs, group_suffixes=group, filter_bits=bits).collect()
    assert {(r["lang"], r["phrase"]): r["n"] for r in got} == want and len(got) == len(want) > 100


def test_ranking(spark, docs):
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    base = docs.selectExpr("coalesce(lang, 'und') AS lang", "cast(text AS binary) AS text")
    counts = P.phrase_counts(docs)
    for top in (7, 2000):
        got = P.collocations(counts, P.word_totals(base), top=top).collect()
        assert {tuple(r[c] for c in cols) for r in got} == plain_ranking(rows(), top) and len(got) > 10


def test_products_beyond_64_bits(spark):
    n = 6_000_000_000_000_000_001
    counts = spark.createDataFrame([("en", "a", n + 5), ("en", "b", n + 7), ("en", "a b", n), ("en", "a b c", 30), ("en", "b c", n - 1), ("en", "c", n)],
                                   "lang string, phrase string, n long")
    totals = spark.createDataFrame([("en", 9)], "lang string, n long")
    got = {r["phrase"]: r for r in P.collocations(counts, totals).collect()}
    assert got["a b"]["score"] == 2_000_000 * n // (2 * n + 12)
    assert got["a b c"]["score"] == min(2_000_000 * 30 // (n + 5 + n - 1), 2_000_000 * 30 // (2 * n))


def test_nothing_frequent_and_empty(spark, docs):
    assert docs.where("doc_id < 8").count() == 8      # with and without words
    for few in (docs.limit(0), docs.where("doc_id < 4"), docs.where("doc_id < 8"), docs.where("text = 'a  b\t c'")):
        assert P.phrase_counts(few).count() == 0
        assert P.collocations(P.phrase_counts(few), P.word_totals(few.select("lang", "text").limit(0))).count() == 0


def test_long_texts_are_cut_between_pieces_and_tallies_merge():
    text = ("New York. of the, " * 50).encode()
    parts = list(P.stretches(text, 100))
    assert len(parts) > 5 and max(map(len, parts)) < 130
    words = lambda x: [p.split() for p in x.translate(P._READ).split(b"\n") if p.split()]
    assert sum(map(words, parts), []) == words(text) and list(P.stretches(b"no end " * 50, 100)) == [b"no end " * 50]
    pick, tally, got, want = np.random.default_rng(1), P.Tally(limit=50), Counter(), Counter()
    for _ in range(30):
        h = pick.integers(0, 90, 40).astype(np.uint64)
        want.update(h.tolist())
        for a, b in tally.add(h):
            got.update(dict(zip(a.tolist(), b.tolist())))
    for a, b in tally.rest():
        got.update(dict(zip(a.tolist(), b.tolist())))
    assert got == want
