"""Near-duplicate documents by DartMinHash signatures over weighted word shingles.

A document is the multiset of its five-word shingles, each weighing its number of occurrences. Hashed darts
are thrown at the unit regions of every element's weight: a region's darts arrive by a Poisson process in
rank, drawn from hashes of the element, and only those below a threshold of about (k ln k + 2k) / weight are
drawn at all, so a signature costs the shingles plus k log k darts. Every dart belongs to one of k
coordinates; the earliest dart of each coordinate is the signature there, and two documents agree in a
coordinate with probability their weighted Jaccard similarity. A document with an empty coordinate is thrown
again with twice the threshold.

Signatures are cut into bands; documents that agree in a whole band meet in a bucket. Equal word sequences
are one class from the start. In a bucket every member is compared with three centres: the one that meets
most others over all its buckets (what copies were made from meets more of them than any copy does), the one
that meets fewest, and one by hash. After the components of these links are known, buckets where several
components still meet are gone through block by block: members of different components whose sizes and
signatures allow it are compared too, where they lie; only links that unite something leave the task. So no
bucket is expanded into all pairs and none is capped. The comparison is exact (weighted Jaccard similarity
of the whole texts' shingles, ``THRESHOLD`` or more).
Classes are connected components.

Defined results: words are separated by ASCII blanks and compared in lower case; a null text counts as
empty; all texts without words are one class; a text of fewer than five words has one shingle; of a class
the smallest id (null last), then the earliest row, stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

from skytally.llm import common as C
from skytally.llm.shingles import batches, mix, row_slices, shingles, similarities

THRESHOLD = 0.8
SIGN_CHARS = 1 << 18  # of text signed together
BLOCK = 1024  # members of a bucket compared with as many others at a time
BANDS, ROWS = 35, 6  # a pair at 0.8 is missed with probability (1 - 0.8^6)^35, about 2 in 100 000


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """(n_docs, k) earliest darts; rows of documents without elements are 0. ``weight`` > 0, any real."""
    total = np.bincount(doc, weight, minlength=n_docs)
    out = np.zeros((n_docs, k), np.uint64)
    pending = total > 0
    darts_wanted = k * math.log(k) + 2 * k
    while pending.any():
        theta = np.divide(darts_wanted, total, out=np.zeros(n_docs), where=pending)
        use = pending[doc]
        d, e, w = doc[use], element[use], weight[use]
        # one region for every started unit of weight
        units = np.ceil(w).astype(np.int64)
        own = np.repeat(np.arange(len(d)), units)
        unit = np.arange(len(own)) - np.repeat(np.cumsum(units) - units, units)
        region = mix(e[own] + mix(unit.astype(np.uint64) + np.uint64(1)))
        room, at, rank = w[own] - unit, d[own], np.zeros(len(own))
        got = []
        arrival = 0
        while len(region):
            arrival += 1
            r = mix(region + np.uint64(arrival * 0x9E3779B97F4A7C15 % (1 << 64)))
            rank = rank - np.log(((r >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53)
            near = rank <= theta[at]
            region, room, at, rank, r = region[near], room[near], at[near], rank[near], r[near]
            dart = mix(r + np.uint64(0x632BE59BD9B4E019))
            # a dart's weight lies in the region; above the element's own weight it misses
            high = mix(dart ^ np.uint64(0xD6E8FEB86659FD93))
            hits = (high >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 < room
            got.append((at[hits], dart[hits], rank[hits]))
        at, dart, rank = (np.concatenate(x) for x in zip(*got, strict=True))
        cell = at * k + (mix(dart + np.uint64(1)) % np.uint64(k)).astype(np.int64)
        order = np.lexsort((dart, rank, cell))
        cell, dart = cell[order], dart[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        cell, dart = cell[first], dart[first]
        full = np.bincount(cell // k, minlength=n_docs) == k
        use = full[cell // k]
        out.reshape(-1)[cell[use]] = dart[use]
        pending &= ~full
        darts_wanted *= 2
    return out


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for r in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15 | 1) + parts[:, :, r])
    return h.view(np.int64)


def plain_words(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), C.BLANK + "+", " ")))


def signed(rows: DataFrame, bands: int, per_band: int) -> DataFrame:
    """(id, file, row, key, size, sig, bands) of (id, file, row, key, words); bands is null without words. ``sig`` has one byte of
    every coordinate."""
    schema = rows.select("id", "file", "row", "key").schema.add("size", LongType()).add("sig", BinaryType()).add("bands", ArrayType(LongType()))

    def sign(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in row_slices(parts):
            texts = batch.column(4).to_pylist()
            for lo, hi in batches(texts, SIGN_CHARS):
                some = texts[lo:hi]
                d, s, c = shingles(some)
                darts = dart_signatures(d, s, c.astype(np.float64), len(some), bands * per_band)
                found = band_hashes(darts, bands, per_band)
                sigs = [row.tobytes() for row in (darts >> np.uint64(32)).astype(np.uint8)]
                size = np.bincount(d, c, minlength=len(some)).astype(np.int64)
                none = size == 0
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, bands), pa.int32()),
                                                 pa.array(found.reshape(-1)), mask=pa.array(none))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(lo, hi - lo) for k in range(4)), pa.array(size), pa.array(sigs, pa.binary()), lists],
                                                 names=["id", "file", "row", "key", "size", "sig", "bands"])

    return rows.mapInArrow(sign, schema)


class Classes:
    """Union-find over component numbers: what a task has already united."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while x != root:
            self.parent[x], x = root, self.parent.get(x, x)
        return root

    def unite(self, x: int, y: int) -> None:
        self.parent[self.find(x)] = self.find(y)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts' sorted shingles and their counts."""
    (sa, ca), (sb, cb) = a, b
    at = np.searchsorted(sb, sa)
    same = np.flatnonzero(at < len(sb))
    same = same[sb[at[same]] == sa[same]]
    shared = int(np.minimum(ca[same], cb[at[same]]).sum())
    return shared / (int(ca.sum()) + int(cb.sum()) - shared)


def counted_shingles(texts: DataFrame) -> DataFrame:
    """(node, shingles, counts) of (node, words): sorted hashes and counts as little-endian binaries."""
    def each(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in row_slices(parts):
            words = batch.column(1).to_pylist()
            for lo, hi in batches(words):
                d, s, c = shingles(words[lo:hi])
                cut = np.searchsorted(d, np.arange(hi - lo + 1))
                spans = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([s[x:y].tobytes() for x, y in spans], pa.binary()),
                     pa.array([c[x:y].astype(np.uint32).tobytes() for x, y in spans], pa.binary())], names=["node", "shingles", "counts"])

    return texts.select("node", "words").mapInArrow(each, "node long, shingles binary, counts binary")


def uniting(members: DataFrame, threshold: float, k: int) -> DataFrame:
    """Links (a, b) between different components that share a bucket, enough of them to unite what is alike.

    ``members``: bucket, n (members of it), node, size, component, sig, bands, shingles, counts. Members are
    dealt into blocks of about ``BLOCK``; every two blocks of a bucket are compared in one task. A pair is looked
    at in the first bucket that both share, if sizes and signatures allow it (five standard deviations below
    ``threshold`` are let through), and then by its exact similarity, unless links that the task has found
    unite it already. So a task emits fewer links than it has seen components, whatever the pairs are.
    """
    least = k * (threshold - 5 * math.sqrt(threshold * (1 - threshold) / k))
    d = members.withColumn("blocks", F.expr(f"cast((n + {BLOCK - 1}) div {BLOCK} as int)"))
    d = d.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    d = d.select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "size",
                 "component", "sig", "bands", "shingles", "counts")

    def compare(parts: Iterator) -> Iterator:
        import pyarrow as pa

        known = Classes()

        def found(bucket, group):
            block, node, size, comp, sig, bands, shingle, count = zip(*group, strict=True)
            block, node, size = (np.array(x) for x in (block, node, size))
            sig = np.frombuffer(b"".join(sig), np.uint8).reshape(len(node), -1)
            bands = np.array(bands, np.int64)
            band = int((bands == bucket).any(0).argmax())   # a bucket is of one band
            text = [(np.frombuffer(s, np.uint64), np.frombuffer(c, np.uint32)) for s, c in zip(shingle, count, strict=True)]
            left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
            alone = block.min() == block.max()
            root = np.array([known.find(c) for c in comp])
            for i in left:
                js = right[right > i] if alone else right
                js = js[(root[js] != root[i]) & (np.minimum(size[js], size[i]) >= threshold * np.maximum(size[js], size[i]))]
                js = js[(bands[js, :band] != bands[i, :band]).all(1)]
                agree = (sig[js] == sig[i]).sum(1)
                # likely links first: what they unite need not be compared
                for j in js[np.argsort(-agree, kind="stable")][:int((agree >= least).sum())]:
                    if root[j] != root[i] and similarity(text[i], text[j]) >= threshold:
                        known.unite(comp[i], comp[j])
                        root[root == root[j]] = root[i]
                        yield (min(node[i], node[j]), max(node[i], node[j]))
                        new = known.find(comp[i])
                        root[root == root[i]] = new

        key, group, out = None, [], []

        def batch_of(pairs):
            a, b = zip(*pairs, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in row_slices(parts):
            for b, lo, hi, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (b, lo, hi) != key and group:
                    out += found(key[0], group)
                    group = []
                key = (b, lo, hi)
                group.append(rest)
            if out:
                yield batch_of(out)
                out = []
        if group and (out := list(found(key[0], group))):
            yield batch_of(out)

    place = ["bucket", "lo", "hi"]
    return d.repartition(*place).sortWithinPartitions(*place).mapInArrow(compare, "a long, b long").distinct()


def linked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose ``texts`` (node, words) are similar enough."""
    j = (pairs.join(texts.select(F.col("node").alias("a"), F.col("words").alias("left")), "a")
         .join(texts.select(F.col("node").alias("b"), F.col("words").alias("right")), "b").select("a", "b", "left", "right"))

    def verify(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in row_slices(parts):
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            near = np.concatenate([similarities(left[lo:hi], right[lo:hi]) for lo, hi in batches(left)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(near >= threshold))

    return j.mapInArrow(verify, "a long, b long")


def may_be_near(a: str, b: str, threshold: float) -> Column:
    """The shingles that two texts share are at most the smaller one's: many strangers differ too much in size."""
    return F.least(a, b) >= F.greatest(a, b) * threshold


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", in_files: bool = False,
                    threshold: float = THRESHOLD, bands: int = BANDS, per_band: int = ROWS) -> DataFrame:
    """One row per document: id, file, row, class_id (smallest id of its class), class_size, kept."""
    spark, mark = docs.sparkSession, C.scratch_mark()
    rows = C.located(docs, id_col, text_col, in_files)
    worded = rows.select("id", "file", "row", plain_words(F.col("text")).alias("words"))
    worded = worded.withColumn("key", F.unhex(F.md5("words")))
    with C.small_python_batches(spark):
        members = C.materialize(signed(worded.select("id", "file", "row", "key", "words"), bands, per_band), "near-signed", compression="zstd")

    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row")
    best = members.groupBy("key").agg(F.min(place).alias("best"), F.count(F.lit(1)).alias("copies"),
                                      F.first("size").alias("size"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    kinds = C.materialize(best.withColumn("node", F.monotonically_increasing_id()), "near-kinds", compression="zstd")

    buckets = kinds.where("bands is not null").select("node", "size", F.explode("bands").alias("bucket"))
    crowded = C.materialize(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-crowded")
    meets = C.materialize(C.maybe_in(buckets, ["bucket"], crowded).join(crowded, "bucket"), "near-meets")
    # how many meetings a node has in all: what copies were made from meets most of them
    company = C.materialize(meets.groupBy("node").agg(F.sum("n").alias("company")), "near-company")
    meets = C.materialize(meets.select("node", "size", "bucket").join(company, "node"), "near-members")
    who, alone, any_ = (F.max(F.struct(order.alias("order"), "size", "node")) for order in (
        F.col("company"), -F.col("company"), F.xxhash64("node")))
    chosen = meets.groupBy("bucket").agg(F.array(who, alone, any_).alias("c"))
    centres = C.materialize(chosen.select("bucket", F.explode(F.array_distinct(F.transform(
        "c", lambda x: F.struct(x["size"].alias("c_size"), x["node"].alias("c_node"))))).alias("c")).select("bucket", "c.*"), "near-centres")
    pairs = meets.join(centres, (meets["bucket"] == centres["bucket"]) & (F.col("node") != F.col("c_node")) & may_be_near("size", "c_size", threshold))
    pairs = C.materialize(pairs.select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct(), "near-pairs")

    wanted = kinds.select("node", F.col("best.file").alias("file"), F.col("best.row").alias("row")).join(
        company.select("node"), "node")
    wanted = C.materialize(wanted, "near-wanted")
    texts = C.materialize(C.maybe_in(worded.select("file", "row", "words"), ["file", "row"], wanted)
                          .join(wanted, ["file", "row"]).select("node", "words"), "near-texts", compression="zstd")
    with C.small_python_batches(spark):
        links = C.materialize(linked(pairs, texts, threshold), "near-links")

    # buckets where different components still meet: all their members, block against block
    comp = C.materialize(C.connected_components(links, "near-comp"), "near-comp")
    placed = C.materialize(meets.select("bucket", "node", "size").join(comp, "node", "left").withColumn(
        "component", F.coalesce("component", "node")), "near-in-comp")
    mixed = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = C.materialize(mixed.where("lo != hi").select("bucket", "n"), "near-mixed")
    inside = C.materialize(C.maybe_in(placed, ["bucket"], mixed).join(mixed, "bucket"), "near-inside")
    with C.small_python_batches(spark):
        own = counted_shingles(inside.select("node").distinct().join(texts, "node")).join(kinds.select("node", "sig", "bands"), "node")
        own = C.materialize(own, "near-shingles", compression="zstd")
        late = C.materialize(uniting(inside.join(own, "node"), threshold, bands * per_band), "near-links-2")
    if not late.isEmpty():
        # the stars found so far and the late links: the same components as all links
        stars = comp.where("node != component").select(F.col("component").alias("a"), F.col("node").alias("b"))
        comp = C.connected_components(stars.union(late), "near-final")

    kinds = kinds.select("key", "best", "copies", "node").join(comp, "node", "left").select(
        "key", "best", "copies", F.coalesce("component", "node").alias("component"))
    kinds = C.materialize(kinds, "near-kind-class")
    classes = kinds.groupBy("component").agg(F.min("best").alias("keep"), F.sum("copies").alias("class_size"))
    of_key = C.materialize(kinds.select("key", "component").join(classes, "component").select("key", "keep", "class_size"), "near-class")
    C.drop_scratch(spark, mark, ("near-signed", "near-class"))
    return members.select("id", "file", "row", "key").join(of_key, "key").select(
        "id", "file", "row", F.col("keep.id").alias("class_id"), "class_size",
        ((F.col("keep.file") == F.col("file")) & (F.col("keep.row") == F.col("row"))).alias("kept"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (an unchanged read of Parquet files) that stay, all columns."""
    mark = C.scratch_mark()
    rest = C.without_rows(docs, near_duplicates(docs, in_files=True).where(~F.col("kept")))
    C.drop_scratch(docs.sparkSession, mark, ("gone",))
    return rest


def op1_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.read_documents(spark, sf_dir), in_files=True).select(
        F.col("id").alias("doc_id"), "class_id", "class_size", "kept")


#: Every pair of documents that shares a shingle; LSH misses a link at the threshold about 2 times in 100 000.
OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
c AS (SELECT doc_id, hash(s) AS s, count(*) AS c FROM s GROUP BY ALL),
t AS (SELECT doc_id, sum(c) AS t FROM c GROUP BY ALL),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.c, b.c)) AS n FROM c a JOIN c b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN t ta ON ta.doc_id = a JOIN t tb ON tb.doc_id = b WHERE n >= 0.8 * (ta.t + tb.t - n)
  UNION ALL
  SELECT x.doc_id, y.doc_id FROM w x JOIN w y ON len(x.w) = 0 AND len(y.w) = 0 AND x.doc_id <> y.doc_id),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.r = link.a),
k AS (SELECT doc_id, min(r) AS class_id, count(*) AS class_size FROM reach GROUP BY doc_id)
SELECT doc_id, class_id, class_size, doc_id = class_id AS kept FROM k
"""
