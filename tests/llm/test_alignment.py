"""Two tokenizers' alignment against a byte-by-byte reading, and the remembered encoders against the tokenizers."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from skytally.llm import op11_alignment as A
from skytally.llm import tokens as T

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n", "a", " a", "a b", "the the  the\n\nthe", "<|endoftext|> and <s>x</s> <0x41>", "é́ ﬁ 和平 😀🏳️‍🌈", "a▁b", " x\x85y\x1cz",
       "x" * 5000, "ab " * 3000, "'s 'S it's 12345 ½²", "\t\r\n\x0b", "\x00", "naïve café — “quoted” …", "аб вг", "لا إله", "﻿x"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(T.tokenizer_path(A.TOKENIZER_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=T.tokenizer_path(A.TOKENIZER_B))


def plain(text, libraries):
    """ids, byte sets and pairs by walking over the tokens, with the libraries alone."""
    tok, sp = libraries
    if not text:
        return None
    raw = (" " + text).encode()
    # the byte alphabet: printable bytes stand for themselves, the others follow from 256 on
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}
    ids_a = tok.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(byte_of[c] for c in tok.id_to_token(i)) for i in ids_a]
    ids_b = sp.encode(text)
    bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [sp.id_to_piece(i)]]
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None

    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    sa, sb = spans(bytes_a), spans(bytes_b)
    overlaps = [(i, j) for i, (s, e) in enumerate(sa) for j, (x, y) in enumerate(sb) if s < y and x < e] if len(sa) < 400 else None
    ends = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, lo = [], 0
    for hi in ends:
        groups.append(",".join(str(i) for i, (s, e) in zip(ids_a, sa) if lo < e <= hi) + "|"
                      + ",".join(str(i) for i, (s, e) in zip(ids_b, sb) if lo < e <= hi) if len(sa) < 400 else "")
        lo = hi
    end_a, end_b = {e: i for i, (_, e) in zip(ids_a, sa)}, {e: i for i, (_, e) in zip(ids_b, sb)}
    return ids_a, ids_b, overlaps, ";".join(groups), [(end_a[e], end_b[e]) for e in ends]


def test_remembered_units_equal_the_tokenizers(libraries):
    byte, piece = T.ByteLevelEncoder(T.tokenizer_path(A.TOKENIZER_A)), T.PieceEncoder(T.tokenizer_path(A.TOKENIZER_B))
    assert piece.by_units
    chars = [*map(chr, range(0x250)), *map(chr, range(0x2000, 0x2070)), "▁", "和", "😀", "ا", "　", "'s", "<|endoftext|>", "  ", "\n\n"]
    pick = random.Random(3)
    texts = [" " + a + b for c in chars for a, b in ((c, ""), ("a", c), (c, "a"), ("1", c), (" ", c), (c, " "), (c, c))]
    texts += [" " + "".join(pick.choice(chars) for _ in range(pick.randint(1, 14))) for _ in range(5000)]
    texts += [" " + "".join(pick.choice(" \t\n\xa0ab1'sé!.<") for _ in range(pick.randint(1, 14))) for _ in range(5000)]
    for text, want in zip(texts, libraries[0].encode_batch(texts, add_special_tokens=False)):
        ids, covers = byte.encode(text)
        assert np.frombuffer(ids, np.uint32).tolist() == want.ids and covers, repr(text)
        ids, covers = piece.encode(text)
        assert np.frombuffer(ids, np.uint32).tolist() == libraries[1].encode(text[1:]), repr(text)
        assert covers == ("▁" not in text)


def test_possible_pairs_by_suffixes():
    a, b = [b"", b"ab", b"b", b" x"], [b"b", b"ab", b"x", b"", b"zab"]
    want = {i * 5 + j for i, x in enumerate(a) for j, y in enumerate(b) if x and y and (x.endswith(y) or y.endswith(x))}
    assert A.suffix_pairs(a, b).tolist() == sorted(want)


def test_counts_and_groups_equal_a_plain_reading(spark, libraries):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect()] + ODD[5:9]
    docs = spark.createDataFrame([(i, t, 1.5, "clash") for i, t in enumerate(texts)] + [(None, "a b", 0.0, "")],
                                 "doc_id long, text string, n_a double, links string").repartition(3)
    found = A.C.materialize(A.digests(docs), "test-alignments")
    got = {r["id"]: r for r in A.counted(found).collect()}
    whole = {r["id"]: r for r in A.alignments(docs).collect()}
    read = {i: plain(t, libraries) for i, t in enumerate(texts + ["a b"])}
    counts = Counter(pair for r in read.values() if r for pair in r[4])
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    assert len(got) == len(texts) + 1
    for i, r in read.items():
        i = None if i == len(texts) else i
        g = got[i]
        if r is None:
            assert [g[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_overlaps")] == [0] * 7
            assert g["groups_sha256"] == "" and whole[i]["groups"] == ""
            continue
        ids_a, ids_b, overlaps, groups, links = r
        assert (g["n_a"], g["n_b"], g["n_groups"], g["n_links"]) == (len(ids_a), len(ids_b), len(links), len(links))
        assert g["count_sum"] == sum(counts[p] for p in links) and g["n_best"] == sum(counts[p] == top[p[1]] for p in links)
        assert (whole[i]["a_ids"], whole[i]["b_ids"]) == (ids_a, ids_b)
        if overlaps is not None:
            assert list(zip(whole[i]["overlap_a"], whole[i]["overlap_b"])) == overlaps and g["n_overlaps"] == len(overlaps)
            assert whole[i]["groups"] == groups
        assert g["groups_sha256"] == hashlib.sha256(whole[i]["groups"].encode()).hexdigest()
    empty = A.C.materialize(A.digests(docs.limit(0)), "test-none")
    assert A.counted(empty).count() == 0


def test_what_a_worker_remembers_is_bounded(monkeypatch):
    """However many different words come, an encoder holds two halves of them, and its ids stay the tokenizer's own."""
    from array import array

    from skytally.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    a, b = tokens.ByteLevelEncoder(tokens.tokenizer_path("byte_bpe_50k.json")), tokens.PieceEncoder(tokens.tokenizer_path("piece_bpe_32k.model"))
    for k in range(0, 2000, 10):
        text = " the " + " ".join(f"w{k + i}x the" for i in range(10))
        assert a.encode(text)[0] == array("I", a.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        assert b.encode(text)[0] == array("I", b.processor.encode(text[1:])).tobytes()
        for side in (a, b):
            assert len(side.known) <= 50 and len(side.known.old) <= 50
            assert " the" in side.known or " the" in side.known.old
    words = tokens.WordEncoder(tokens.tokenizer_path("word_bpe_49k.json"))
    texts = [f"some word{k} and other{k}" for k in range(300)]
    assert words.encode(texts) == [array("I", words.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert len(words.known) + len(words.known.old) <= 100


def test_record_batches_come_in_slices():
    """A worker that gets thousands of rows at once makes Python objects of a slice of them at a time."""
    import pyarrow as pa

    from skytally.llm.shingles import SLICE_ROWS, row_slices

    n = 2 * SLICE_ROWS + 7
    x = pa.array([[i] * (i % 3) for i in range(n)], pa.list_(pa.int64()))
    parts = [pa.RecordBatch.from_arrays([pa.array(range(n)), x], names=["k", "x"])]
    got = list(row_slices([*parts, parts[0].slice(0, 0)]))
    assert [p.num_rows for p in got] == [SLICE_ROWS, SLICE_ROWS, 7]
    assert [k for p in got for k in p.column(0).to_pylist()] == list(range(n))
    assert got[1].column(1).flatten().to_pylist() == [i for i in range(SLICE_ROWS, 2 * SLICE_ROWS) for _ in range(i % 3)]
