"""Alignment of two tokenizers over the bytes of every text.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (pieces with byte fallback) the text, to
which it adds the space. Both cover the same bytes, so their tokens are intervals of one line. Per batch of
whole documents two ``merge_asof`` joins, keyed by document, find for each token start the token of the other
side that covers it; both directions together are all overlapping pairs of tokens. Pairs that end at the same
byte are the links, and they cut both sequences into groups, the smallest runs that cover the same bytes.

Of two linked tokens the shorter one is a suffix of the longer one, so the possible pairs of ids follow from
the vocabularies alone: ``Pairing.keys`` lists them (about 10^5 pairs). Corpus-wide counts are one array of that
size at any number of documents; each task adds up its own and sends the pairs that it saw once, and the totals
are broadcast for the second pass, which reads the links that the first pass wrote, not the texts.

Defined results: a null or empty text, and one whose A or B bytes differ from space + text (it holds U+2581,
say), has no tokens, zeros and an empty digest; special tokens' strings are plain text; repeated rows are
aligned each; a null id is returned as null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from skytally.llm import common as C
from skytally.llm.shingles import batches, row_slices

if TYPE_CHECKING:
    import pyarrow as pa

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"


def suffix_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted keys (index in a) * len(b) + (index in b) of all pairs of which one ends in the other."""
    found = []
    for flip, (long, short) in enumerate(((a, b), (b, a))):
        places: dict[bytes, list[int]] = {}
        for k, s in enumerate(short):
            if s:
                places.setdefault(s, []).append(k)
        for i, s in enumerate(long):
            for cut in range(len(s)):
                for k in places.get(s[cut:], ()):
                    found.append(k * len(b) + i if flip else i * len(b) + k)
    return np.unique(np.array(found, np.int64))


@dataclass
class Alignment:
    """Of a batch of texts; tokens of all texts in one sequence per side."""
    ok: np.ndarray                     # per text: does it have tokens
    ids: tuple[np.ndarray, np.ndarray]
    counts: tuple[np.ndarray, np.ndarray]    # tokens per text
    ends: tuple[np.ndarray, np.ndarray]      # last byte + 1, counted over the whole batch
    overlaps: tuple[np.ndarray, np.ndarray]  # token numbers
    links: tuple[np.ndarray, np.ndarray]     # token numbers, ascending on both sides
    link_doc: np.ndarray

    def groups(self, names: pa.Array) -> pa.Array:
        """Every text's groups as ``a1,a2|b1;a3|b2,b3``. ``names``: see ``marked_names``."""
        import pyarrow as pa

        (a, b), (la, lb) = self.ids, self.links
        last = [np.zeros(len(x), np.int64) for x in (a, b)]
        last[0][la] = last[1][lb] = 1
        group = [np.cumsum(x) - x for x in last]
        before_a = np.concatenate([np.zeros(1, np.int64), lb + 1])[group[0]]   # B tokens of earlier groups
        before_b = (la + 1)[group[1]]                                          # A tokens up to this group
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + before_a] = a
        code[np.arange(len(b)) + before_b] = b
        mark = np.zeros(len(code), np.int64)
        mark[la + before_a[la]] = 1
        mark[lb + before_b[lb]] = 2
        tail = np.cumsum(self.counts[0] + self.counts[1])
        mark[tail[self.counts[0] > 0] - 1] = 3
        # the parts lie one after the other in the taken array's text, so a text's groups are a run of it
        _, ends, text = names.take(pa.array(code + mark * (len(names) // len(MARKS)))).buffers()
        at = np.frombuffer(ends, np.int64)[np.concatenate([[0], tail])]
        return pa.LargeStringArray.from_buffers(len(tail), pa.py_buffer(at), text)


MARKS = (",", "|", ";", "")   # after an id: within a side, after A's, after a group, after the last one


def marked_names(n: int) -> pa.Array:
    """The decimal ids up to ``n``, followed by each of ``MARKS`` in turn."""
    import pyarrow as pa

    return pa.array([f"{k}{mark}" for mark in MARKS for k in range(n)], pa.large_string())


class Pairing:
    """Two tokenizers and the pairs of ids that can be linked."""

    def __init__(self, path_a: str, path_b: str):
        from skytally.llm.tokens import ByteLevelEncoder, PieceEncoder

        self.sides = ByteLevelEncoder(path_a), PieceEncoder(path_b)
        self.bytes = [s.token_bytes for s in self.sides]
        self.lengths = [np.array([len(x) for x in s], np.int64) for s in self.bytes]
        self.keys = suffix_pairs(*self.bytes)
        self.names = marked_names(max(map(len, self.bytes)))

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[bytes]]]:
        """(has tokens, per side the ids of each text as 32-bit bytes, empty where it has none)."""
        ok, ids = np.zeros(len(texts), bool), [[b""] * len(texts) for _ in self.sides]
        for i, text in enumerate(texts):
            if text:
                found = [side.encode(" " + text) for side in self.sides]
                ok[i] = all(covered for _, covered in found)
                if ok[i]:
                    for s, (own, _) in enumerate(found):
                        ids[s][i] = own
        return ok, ids

    def align(self, texts: list[str | None]) -> Alignment:
        import pandas as pd

        ok, each = self.tokens(texts)
        ids, counts, ends, frames = [], [], [], []
        for s in (0, 1):
            n = np.fromiter(map(len, each[s]), np.int64, len(texts)) // 4
            i = np.frombuffer(b"".join(each[s]), np.uint32).astype(np.int64)
            end = np.cumsum(self.lengths[s][i])
            ids.append(i)
            counts.append(n)
            ends.append(end)
            frames.append(pd.DataFrame({"at": end - self.lengths[s][i], "doc": np.repeat(np.arange(len(texts)), n)}))
        a, b = frames
        cover_b = pd.merge_asof(a, b.assign(other=np.arange(len(b))), on="at", by="doc")["other"].to_numpy(np.int64)
        cover_a = pd.merge_asof(b, a.assign(other=np.arange(len(a))), on="at", by="doc")["other"].to_numpy(np.int64)
        # a pair that starts at the same byte is found from both sides
        alone = np.flatnonzero(a["at"].to_numpy()[cover_a] != b["at"].to_numpy())
        pa = np.concatenate([np.arange(len(a)), cover_a[alone]])
        pb = np.concatenate([cover_b, alone])
        linked = np.flatnonzero(ends[0][pa] == ends[1][pb])
        linked = linked[np.argsort(pa[linked], kind="stable")]
        return Alignment(ok, (ids[0], ids[1]), (counts[0], counts[1]), (ends[0], ends[1]), (pa, pb), (pa[linked], pb[linked]),
                         a["doc"].to_numpy()[pa[linked]])

    def places(self, found: Alignment) -> np.ndarray:
        """The links' places in ``keys``."""
        key = found.ids[0][found.links[0]] * len(self.bytes[1]) + found.ids[1][found.links[1]]
        return np.searchsorted(self.keys, key).astype(np.int32)


_pairings: dict[tuple[str, str], Pairing] = {}


def pairing(name_a: str, name_b: str) -> Pairing:
    """The worker's pairing of two tokenizer files; kept between tasks."""
    from skytally.llm.tokens import tokenizer_path

    if (name_a, name_b) not in _pairings:
        _pairings[name_a, name_b] = Pairing(tokenizer_path(name_a), tokenizer_path(name_b))
    return _pairings[name_a, name_b]


def _lists(values: np.ndarray, counts: np.ndarray):
    import pyarrow as pa

    offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(counts, dtype=np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _per_batch(docs: DataFrame, id_col: str, text_col: str, fields: list[StructField], name_a: str, name_b: str, make) -> DataFrame:
    """id and ``fields``; ``make(pairing, alignment)`` gives the fields' Arrow arrays."""
    from pyspark.sql import functions as F

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = StructType([rows.schema["id"], *fields])

    def each(parts: Iterator) -> Iterator:
        import pyarrow as pa

        pair = pairing(name_a, name_b)
        for part in row_slices(parts):
            texts = [t or "" for t in part.column(1).to_pylist()]
            for lo, hi in batches(texts):
                yield pa.RecordBatch.from_arrays([part.column(0).slice(lo, hi - lo), *make(pair, pair.align(texts[lo:hi]))],
                                                 names=schema.names)

    return rows.mapInArrow(each, schema)


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name_a: str = TOKENIZER_A,
               name_b: str = TOKENIZER_B) -> DataFrame:
    """id, a_ids, b_ids, overlap_a and overlap_b (token numbers within the text, one entry per overlapping
    pair), groups (as text): the whole alignment of every document."""
    ints = ArrayType(IntegerType())

    def make(pair: Pairing, found: Alignment) -> list:
        import pyarrow as pa

        (a, b), (na, nb) = found.overlaps, found.counts
        start_a, start_b = np.cumsum(na) - na, np.cumsum(nb) - nb
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        doc = np.repeat(np.arange(len(na)), na)[a]
        n = np.bincount(doc, minlength=len(na))
        return [_lists(found.ids[0], na), _lists(found.ids[1], nb), _lists(a - start_a[doc], n), _lists(b - start_b[doc], n),
                found.groups(pair.names).cast(pa.string())]

    return _per_batch(docs, id_col, text_col, [*[StructField(c, ints) for c in ("a_ids", "b_ids", "overlap_a", "overlap_b")],
                                               StructField("groups", StringType())], name_a, name_b, make)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name_a: str = TOKENIZER_A,
            name_b: str = TOKENIZER_B) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, links (places in ``Pairing.keys``)."""
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]

    def make(pair: Pairing, found: Alignment) -> list:
        import pyarrow as pa

        n = len(found.ok)
        links = np.bincount(found.link_doc, minlength=n)
        doc = np.repeat(np.arange(n), found.counts[0])
        overlaps = np.bincount(doc[found.overlaps[0]], minlength=n)
        _, ends, text = found.groups(pair.names).buffers()
        at, text = np.frombuffer(ends, np.int64).tolist(), memoryview(text or b"")
        hashes = [sha256(text[lo:hi]).hexdigest() if hi > lo else "" for lo, hi in zip(at, at[1:], strict=False)]
        # every group ends in one link
        return [*[pa.array(x, pa.int64()) for x in (*found.counts, links, links, overlaps)], pa.array(hashes, pa.string()),
                _lists(pair.places(found), links)]

    return _per_batch(docs, id_col, text_col, [*[StructField(c, LongType()) for c in counts], StructField("groups_sha256", StringType()),
                                               StructField("links", ArrayType(IntegerType()))], name_a, name_b, make)


def pair_counts(found: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> DataFrame:
    """(pair, n): how many links hold each pair of ids, pair being its place in ``Pairing.keys``."""
    from pyspark.sql import functions as F

    def each(parts: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(len(pairing(name_a, name_b).keys), np.int64)
        for part in row_slices(parts):
            total += np.bincount(part.column(0).flatten().to_numpy(), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["pair", "n"])

    return found.select("links").mapInArrow(each, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def counted(found: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> DataFrame:
    """``digests``' rows (a written table) with n_best and count_sum in place of links."""
    rows = pair_counts(found, name_a, name_b).toArrow()   # a row per possible pair at most: bounded by the vocabularies
    sent = found.sparkSession.sparkContext.broadcast((rows.column("pair").to_numpy(), rows.column("n").to_numpy()))
    kept = [c for c in found.columns if c != "links"]
    schema = StructType([*[found.schema[c] for c in kept], StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def each(parts: Iterator) -> Iterator:
        import pyarrow as pa

        pair = pairing(name_a, name_b)
        place, n = sent.value
        totals = np.zeros(len(pair.keys) + 1, np.int64)
        totals[place] = n
        b = pair.keys % len(pair.bytes[1])
        top = np.zeros(len(pair.bytes[1]), np.int64)
        np.maximum.at(top, b, totals[:-1])
        best = np.append(totals[:-1] == top[b], False).astype(np.int64)
        for part in row_slices(parts):
            links = part.column("links")
            flat, size = links.flatten().to_numpy(), np.diff(links.offsets.to_numpy())
            doc = np.repeat(np.arange(len(size)), size)
            sums = [np.zeros(len(size), np.int64) for _ in range(2)]
            for out, value in zip(sums, (best, totals), strict=True):
                np.add.at(out, doc, value[flat])
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *map(pa.array, sums)], names=schema.names)

    return found.mapInArrow(each, schema)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = C.materialize(digests(C.read_documents(spark, sf_dir)), "alignments", compression="zstd")
    return counted(found).select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
                                 "n_overlaps").withColumnRenamed("id", "doc_id")
