"""Substring deduplication by sliding spans of consecutive sentences.

A text is cut after sentence marks, with their closing quotes and brackets, followed by white space; after marks
of scripts that need none; after line ends; and where a script without blanks between words has one (Thai, Lao,
Khmer, Burmese). In such scripts letters are counted instead of words. A run of consecutive
sentences counts if it has at least ``SENTENCES`` sentences and ``WORDS`` words, or ``LONG`` words. The spans are
the shortest such run that begins at each sentence and the shortest that ends there: every sentence of a longer
run is in one of these that lies within the run, so removing spans removes repeated runs of any length whole.
Spans are compared by a 128-bit digest of their lower-cased words over all documents; sentences covered by any span that is not the
first of its kind go. First is the span of the smallest id (null last), then the earliest row and place, so
one copy of every repeated passage stays. Spans are judged on the input, not on what is left.

Counting combines before the shuffle, so a passage in a third of all documents is one row per task; only
spans that a bitmap of fixed size calls repeated are shuffled for the second look, and only texts that lose
a sentence are moved.

Defined results: a null text counts as empty and has no sentences; a text with fewer sentences or words
than a span needs loses nothing; of repeated rows the first keeps its text; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import common as C

SENTENCES = 2
WORDS = 20
LONG = 40
# Closing quotes and brackets (the second after marks that need no blank, where an opening one may follow); marks that
# need no blank; letters of scripts without blanks between words, of which about two or about four write a word; after the latter a
# blank ends a phrase.
_CLOSING = "[\"'”’“‘»«›‹)\\]}]"
_CLOSING_WIDE = "[”’)\\]}）］｝〕〉》」』】〗〙〛｠｣]"
_MARKS = "\u3002\uff61\uff01\uff1f\u0964\u0965\u061f\u06d4\u0589\u1362\u1367\u1368\u0e5a\u0e5b\u17d4\u17d5\u104a\u104b\u0f0d-\u0f11"
_PAIRS = "\u3005-\u3007\u3041-\u3096\u30a1-\u30fa\u30fc\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_FOURS = "\u0e01-\u0e4e\u0e81-\u0ece\u0edc-\u0edf\u0f40-\u0fbc\u1000-\u103f\u1050-\u109f\u1780-\u17d3"
_SENTENCE = re.compile(
    rf"[\s\S]+?(?:[.!?]++(?:[\u00a0\u202f]?{_CLOSING})*(?=\s|\Z|[{_PAIRS}])|(?:[{_MARKS}]|\uff0e(?!\d))[{_MARKS}.!?]*{_CLOSING_WIDE}*"
    rf"|\n|(?=\s)(?<=[{_FOURS}])|\Z)\s*")
_IN_PAIRS, _IN_FOURS = re.compile(f"[{_PAIRS}]"), re.compile(f"[{_FOURS}]")


def sentences(text: str | None) -> list[str]:
    """The text's sentences with what follows them up to the next; joined they are the text."""
    return _SENTENCE.findall(text or "")


def length(words: list[str]) -> int:
    """Words; where a script has no blanks between them, two (Han, kana) or four letters (Thai and others) are one."""
    return sum(1 if w.isascii() else max(1, len(_IN_PAIRS.findall(w)) // 2 + len(_IN_FOURS.findall(w)) // 4) for w in words)


def spans(parts: list[str], least: int = SENTENCES, words: int = WORDS) -> Iterator[tuple[int, int, bytes]]:
    """(first sentence, one past the last, digest) of every span, each once."""
    split = [p.lower().split() for p in parts]
    sums = [0]
    for w in split:
        sums.append(sums[-1] + length(w))
    digests = [blake2b(" ".join(w).encode("utf-8", "surrogatepass"), digest_size=16).digest() for w in split]
    n = len(parts)

    def enough(lo: int, hi: int) -> bool:
        size = sums[hi] - sums[lo]
        return size >= LONG or hi - lo >= least and size >= words

    runs, end, start = [], 1, 0
    for i in range(n):
        end = max(end, i + 1)
        while end <= n and not enough(i, end):
            end += 1
        if end > n:
            break
        runs.append((i, end))
    for j in range(1, n + 1):
        while start + 1 < j and enough(start + 1, j):
            start += 1
        if enough(start, j) and not (start < len(runs) and runs[start] == (start, j)):
            runs.append((start, j))
    for lo, hi in runs:
        yield lo, hi, digests[lo] if hi == lo + 1 else blake2b(b"".join(digests[lo:hi]), digest_size=16).digest()


def span_rows(rows: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """(id, file, row, first, until, a, b): all spans of all rows; a and b are the digest."""
    schema = rows.select("id", "file", "row").schema.add("first", "integer").add("until", "integer").add("a", "long").add("b", "long")

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            at, first, until, found = [], [], [], []

            def flush():
                both = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                take = pa.array(at, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(2).take(take), batch.column(3).take(take),
                     pa.array(first, pa.int32()), pa.array(until, pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1])],
                    names=["id", "file", "row", "first", "until", "a", "b"])

            for i, text in enumerate(texts):
                for lo, hi, digest in spans(sentences(text), least, words):
                    at.append(i)
                    first.append(lo)
                    until.append(hi)
                    found.append(digest)
                if len(at) >= 100_000:
                    yield flush()
                    at, first, until, found = [], [], [], []
            yield flush()

    return rows.mapInArrow(cut, schema)


def removed_spans(rows: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """(file, row, gone): per row that loses something, the list of (first, until) of its repeated spans."""
    found = C.materialize(span_rows(rows, least, words), "spans", compression="zstd")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row", "first")
    kinds = found.groupBy("a", "b").agg(F.min(order).alias("one"), F.count(F.lit(1)).alias("n"))
    kinds = C.materialize(kinds.where(F.col("n") > 1).select("a", "b", F.col("one.file").alias("file0"),
                          F.col("one.row").alias("row0"), F.col("one.first").alias("first0")), "span-kinds")
    again = C.maybe_in(found.drop("id"), ["a", "b"], kinds).join(kinds, ["a", "b"])
    again = again.where((F.col("file") != F.col("file0")) | (F.col("row") != F.col("row0")) | (F.col("first") != F.col("first0")))
    return again.groupBy("file", "row").agg(F.collect_list(F.struct("first", "until")).alias("gone"))


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", in_files: bool = False,
                least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """One row per document: id, n_sentences, n_removed, text (what stays)."""
    rows = C.located(docs, id_col, text_col, in_files)
    gone = C.materialize(removed_spans(rows, least, words), "span-gone")
    touched = C.maybe_in(rows, ["file", "row"], gone).join(gone, ["file", "row"], "left").select("id", "text", "gone")
    others = C.maybe_in(rows, ["file", "row"], gone, negate=True).select(
        "id", "text", F.lit(None).cast(gone.schema["gone"].dataType).alias("gone"))
    schema = rows.select("id").schema.add("n_sentences", "long").add("n_removed", "long").add("text", "string")

    def remove(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n, removed, kept = [], [], []
            for text, lost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                parts = sentences(text)
                out = {i for x in lost or () for i in range(x["first"], x["until"])}
                n.append(len(parts))
                removed.append(len(out))
                kept.append("".join(p for i, p in enumerate(parts) if i not in out) if out else text or "")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], names=["id", "n_sentences", "n_removed", "text"])

    return touched.union(others).mapInArrow(remove, schema)


def op8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_spans(C.read_documents(spark, sf_dir), in_files=True).withColumnRenamed("id", "doc_id")
