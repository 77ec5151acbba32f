"""The rule ledger against a plain reading of the rules."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skytally.llm import op12_rules as R

ODD = [None, "", " \t\n", "a", "a b", "a b c", "a a a a", "a b c a b c", "x y z\nx y z\n x y z\nx y z", "  a b", "é" * 5,
       "# * $ % & | < >", "..a...", "one...\ntwo…\nthree", "- a\n* b\n• c", "IBM NASA a", "THE! END!! é É", "1 2 3 | , 和",
       "a\x0bb\x0cc\rd\x1ce\x85f", "w " * 30_000, "𝒳 😀 " * 40, "a b c d\n" * 200 + "e", "\n\n\n", "line\r\nline\r\nline"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    bare = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(repeated), "n_lines": len(lines),
        "n_letterless_words": sum(bool(re.fullmatch(r"[\x00-@\[-`{-\x7f]+", w)) for w in words),
        "n_capital_words": sum(len(re.findall("[A-Z]", w)) > 1 and not re.search("[a-z]", w) for w in words),
        "n_exclamations": text.count("!"), "n_ellipsis_lines": sum(x.endswith(("...", "…")) for x in bare),
        "n_bullet_lines": sum(x.startswith(("-", "*", "•")) for x in bare)}


@pytest.fixture(scope="module")
def book(spark):
    docs = spark.createDataFrame([(i, t, i % 3, "x") for i, t in enumerate(ODD + ODD)] + [(None, "a b", 0, "x")],
                                 "doc_id long, text string, failed int, n_words string")
    return R.ledger(docs.repartition(3))


def test_measures_equal_a_plain_reading(book):
    got = {r["doc_id"]: r for r in book.collect()}
    assert len(got) == 2 * len(ODD) + 1 and got[None]["n_words"] == 2
    for i, text in enumerate(ODD + ODD):
        assert {m: got[i][m] for m in R.MEASURES} == plain(text), text and text[:40]


def test_bits_policies_and_ablations(spark, book):
    rows = book.collect()
    for r in rows:
        failed = {n for n in R.RULES if r["failed"] >> R.BITS[n] & 1}
        assert failed == {n for n, rule in R.RULES.items() if eval(rule, {}, r.asDict())}
    got = {(r["policy"], r["version"], r["rule"]): r for r in R.ablations(book).collect()}
    for p in R.POLICIES:
        for rule in p.rules:
            without = p.mask & ~(1 << R.BITS[rule])
            r = got[p.name, p.version, rule]
            assert r["documents"] == len(rows)
            assert r["kept"] == sum(not x["failed"] & p.mask for x in rows)
            assert r["kept_without"] == sum(not x["failed"] & without for x in rows)
            assert r["failed"] == sum(x["failed"] >> R.BITS[rule] & 1 for x in rows)
            assert r["never_decides"] == (r["kept"] == r["kept_without"])
    assert len(got) == sum(len(p.rules) for p in R.POLICIES)
    verdict = R.verdicts(book).where("kept_base_v1").count()
    assert verdict == sum(not x["failed"] & 3 for x in rows)
    groups = R.rule_groups(book.withColumn("g", F.col("n_words") > 2), ("g",)).collect()
    for g in groups:
        some = [x["failed"] for x in rows if (x["n_words"] > 2) == g["g"]]
        assert g["documents"] == len(some)
        assert all(f & ~g["failed_by_any"] == 0 and f & g["failed_by_all"] == g["failed_by_all"] for f in some)
    assert R.ablations(book, by=("doc_id",)).where("documents > 1").count() == 0


def test_policies_and_carried_columns(spark):
    assert R.policy("prose").version == 2 and R.policy("prose", 1).version == 1
    with pytest.raises(ValueError):
        R.policy("prose", 9)
    docs = spark.createDataFrame([(1, "a", 5)], "doc_id long, text string, `odd.name` int")
    assert R.ledger(docs, keep=("odd.name",)).select("`odd.name`").first()[0] == 5
    empty = R.ledger(docs.limit(0))
    assert empty.count() == 0 and R.ablations(empty).count() == 0


def test_kept_documents_of_the_table(spark):
    sf = "/root/testdata/sf0.1"
    got = R.op12_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    good, bad = (got.where(f"quality = {q}").agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.99 and bad < 0.05
