"""Exact deduplication and sentence spans against brute force."""

import random
import re
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from skytally.llm.op8_spans import dedup_spans, op8_spans, sentences, spans
from skytally.llm.op10_exact_dedup import OP10_SQL, exact_dedup, op10_exact_dedup

SF = "/root/testdata/sf0.001"


def test_exact_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = {r[0]: tuple(r[1:]) for r in con.sql(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({OP10_SQL})").fetchall()}
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in op10_exact_dedup(spark, SF).collect()}
    assert got == want


ROWS = [(3, "a b"), (1, "ab "), (2, "a\tb\n"), (5, None), (4, ""), (6, " \r\n"), (7, "x" * 100_000), (8, "x" * 100_000), (8, "x" * 100_000),
        (None, "solo"), (9, "a b"), (10, "so lo")]


def expect(rows):
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", "", t or "")].append((-len(t or ""), d is None, d or 0, i))
    out = []
    for text, members in groups.items():
        best = min(members)
        keep = rows[best[3]][0]
        out += [(str(rows[m[3]][0]), str(keep), len(members)) for m in members]
    return sorted(out)


def summary(df):
    got = df.collect()
    kept = defaultdict(int)
    for r in got:
        kept[(str(r["keep_id"]), r["group_size"])] += r["kept"]
    assert all(v >= 1 for v in kept.values())
    return sorted((str(r["id"]), str(r["keep_id"]), r["group_size"]) for r in got), sum(r["kept"] for r in got)


def test_exact_edge_cases(spark):
    df = spark.createDataFrame([(*r, "f", 1) for r in ROWS], "doc_id long, text string, file string, digest int")
    rows, kept = summary(exact_dedup(df))
    assert rows == expect(ROWS) and kept == len({re.sub(r"[\x20\x09-\x0D]+", "", t or "") for _, t in ROWS})
    assert exact_dedup(df.limit(0)).count() == 0


def test_exact_with_colliding_digests_and_several_triggers(spark):
    """A digest of one letter: full texts decide; state is carried over the feed's batches."""
    df = spark.createDataFrame(ROWS * 2, "doc_id long, text string").repartition(6)
    rows, kept = summary(exact_dedup(df, digest=lambda t: F.substring(F.sha2(t, 256), 1, 1), triggers=6))
    assert rows == expect(ROWS * 2) and kept == len({re.sub(r"[\x20\x09-\x0D]+", "", t or "") for _, t in ROWS})


def brute_spans(rows, least=2, words=20):
    first, all_spans = {}, []
    key = [((d is None, d or 0), i) for i, (d, _) in enumerate(rows)]
    for i, (d, t) in enumerate(rows):
        for lo, hi, h in spans(sentences(t), least, words):
            all_spans.append((i, lo, hi, h))
            first[h] = min(first.get(h, (key[i], lo)), (key[i], lo))
    gone = defaultdict(set)
    for i, lo, hi, h in all_spans:
        if first[h] != (key[i], lo):
            gone[i] |= set(range(lo, hi))
    return sorted((str(d), len(sentences(t)), len(gone[i]), "".join(s for k, s in enumerate(sentences(t)) if k not in gone[i])) for i, (d, t) in enumerate(rows))


def brute_runs(texts, least=2, words=20, long=40):
    """Per text, the sentences that stay if every run that counts, of any length, goes where it isn't the first of its kind."""
    first, runs = {}, []
    for d, t in enumerate(texts):
        split = [tuple(s.lower().split()) for s in sentences(t)]
        for lo in range(len(split)):
            for hi in range(lo + 1, len(split) + 1):
                size = sum(map(len, split[lo:hi]))
                if hi - lo >= least and size >= words or hi - lo == 1 and size >= long:
                    run = tuple(split[lo:hi])
                    runs.append((d, lo, hi, run))
                    first.setdefault(run, (d, lo))
    gone = defaultdict(set)
    for d, lo, hi, run in runs:
        if first[run] != (d, lo):
            gone[d] |= set(range(lo, hi))
    return ["".join(s for k, s in enumerate(sentences(t)) if k not in gone[d]) for d, t in enumerate(texts)]


def of_lengths(lengths, mark):
    return " ".join(" ".join(f"{mark}{k}x{i}" for i in range(n)) + "." for k, n in enumerate(lengths)) + " "


def test_repeated_runs_go_whole(spark):
    tail, after_long, middle = of_lengths([25, 20, 5, 4], "a"), of_lengths([45, 10], "b"), of_lengths([12, 5, 12], "c")
    texts = [f"Host {k} begins. {p}Host {k} ends." for p in (tail, after_long, middle) for k in (1, 2)]
    rng = random.Random(3)
    pool = [of_lengths([n], f"p{n}") for n in (1, 2, 4, 5, 9, 12, 19, 20, 39, 40, 45)]
    texts += ["".join(rng.choices(pool, k=rng.randrange(9))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["text"] for r in dedup_spans(df).collect()}
    assert got[1] == got[3] == got[5] == "Host 2 begins. Host 2 ends."
    assert [got[k] for k in range(len(texts))] == brute_runs(texts)


def test_spans_of_other_scripts(spark):
    zh = "春天来了，公园里的花都开了，孩子们在草地上奔跑。老人们坐在长椅上晒太阳，谈论着过去的事情和明天的打算！"
    ja = "昨日は友達と一緒に海へ行きました。とても天気が良くて、たくさんの写真を撮ることができました。"
    th = "วันนี้อากาศดีมากเราจึงไปเที่ยวทะเลกับเพื่อนหลายคน ทุกคนสนุกสนานและได้กินอาหารทะเลอร่อยมากมาย "
    hi = "आज मौसम बहुत अच्छा है और हम सब लोग बाग में घूमने गए। बच्चों ने वहाँ बहुत देर तक खेल खेला और सब खुश हुए। "
    quoted = "One two three four five six seven eight nine ten. Eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty. "
    hosts = [("甲说了一句话。", "“乙回答了。"), ("その一。", "その二。"), ("แรกสุดของเรื่อง ", "ต่อจากนั้น"), ("एक बात। ", "दूसरी बात।"), ('He said "no." ', "(Or so.) It ends.")]
    texts = []
    for (before, after), passage in zip(hosts, (zh, ja, th, hi, quoted), strict=True):
        texts += [passage + "x", before + passage + after]
    texts += [zh[:-1].replace("。", "，") * 2] * 2
    got = {r["id"]: r["text"] for r in dedup_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[2 * k + 1] for k in range(5)] == [a + b for a, b in hosts]
    assert all(got[2 * k] == texts[2 * k] for k in range(6)) and got[11] == ""
    assert all("".join(sentences(t)) == t for t in texts)
    assert sentences("在２０．５米处。2020年。「好。」完") == ["在２０．５米处。", "2020年。", "「好。」", "完"]
    assert sentences("« Non.\u00a0» Oui (si.) fin") == ["« Non.\u00a0» ", "Oui (si.) ", "fin"]


def as_rows(df):
    return sorted((str(r["id"]), r["n_sentences"], r["n_removed"], r["text"]) for r in df.collect())


def test_span_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    assert as_rows(op8_spans(spark, SF).withColumnRenamed("doc_id", "id")) == brute_spans(rows)


def test_span_edge_cases(spark):
    passage = "One two three four five six seven. Eight nine ten eleven twelve thirteen? Fourteen fifteen sixteen seventeen eighteen nineteen twenty! "
    rows = [(2, "Start here. " + passage + "End."), (1, passage), (3, None), (4, ""), (5, "\n\n" + passage.upper() + "\nTail"), (6, "Short. " * 3),
            (7, " ".join(f"w{i}" for i in range(20_000)) + ". " + passage), (None, passage + passage), (8, "No mark at all"),
            (11, "a\n" + " ".join(f"v{i}" for i in range(55)) + "\nb"), (12, "c\n" + " ".join(f"v{i}" for i in range(55)) + "\nd")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int").coalesce(1)
    got = {r["id"]: r for r in dedup_spans(df).collect()}
    assert got[1]["n_removed"] == 0 and got[1]["text"] == passage
    assert got[2]["text"] == "Start here. End." and got[5]["n_removed"] == 3 and got[None]["text"] == ""
    assert got[3]["text"] == "" and got[3]["n_sentences"] == 0 and got[6]["n_removed"] == 0 and got[8]["n_removed"] == 0
    assert got[11]["n_removed"] == 0 and got[12]["text"] == "c\nd"
    assert as_rows(dedup_spans(df)) == brute_spans(rows)
    twice = spark.createDataFrame([(1, passage)] * 3, "doc_id long, text string")
    assert sorted(r["n_removed"] for r in dedup_spans(twice).collect()) == [0, 3, 3]
    assert dedup_spans(df.limit(0)).count() == 0


def test_sentences_lose_nothing():
    for t in ["", "a", ".", "a.b c. d!? e\n\nf", "\n\n x", "x. y", "3.14 is pi. Yes"]:
        assert "".join(sentences(t)) == t
    assert sentences("3.14 is pi. Yes") == ["3.14 is pi. ", "Yes"]
