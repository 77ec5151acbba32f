"""Phrases of two to four words that stand together more often than their parts, per language.

The counting follows ERA's vertical partitioning of a suffix tree, over words and cut off at four levels:

1. Prefix frequencies: words are counted, then pairs of frequent words, by 64-bit hashes, combined in every
   task. What is frequent becomes a bitmap of fixed size (``FILTER_BITS``); a hash met by chance only lets more
   through. A phrase with an infrequent word or pair is itself infrequent, so suffixes end before one.
2. Grouping: every position's suffix of at most four words is shipped as its words and a count, combined in
   the task, sorted and as one row per group and task, to the group of its prefix. There are as many groups as the frequent words' occurrences fill
   ``GROUP_SUFFIXES``. A prefix is the first word; of a word that alone fills an eighth of a group the first
   two; of a pair that does, the whole suffix. So a group's rows stay within its budget whatever is hot.
3. Subtrees: each group sorts its suffixes and adds up leaf totals for every node, independently of the others.
   Nodes above a split prefix lie in several groups; their sums are combined afterwards.

Hashes decide only what is shipped where; counts are of the words themselves and exact. Scores use decimals.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count each; an
empty table, or one without frequent phrases, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.llm import common as C
from skytally.llm.shingles import _powers, batches, mix

DEPTH = 4
LEAST = 30                  # occurrences of a candidate
TOP = 2000                  # phrases reported per language
COVERED = 80                # per cent of a phrase's occurrences inside one longer candidate that drop it
SCALE = 2_000_000
GROUP_SUFFIXES = 250_000    # occurrences of frequent words per group of prefixes
FILTER_BITS = 1 << 27       # of each bitmap, 16 MB, at any size
TALLY_ENTRIES = 1 << 21     # counted hashes held by a task before they are sent on
LEAVES = 400_000            # distinct suffixes held by a task before they are sent on
LONG = 1 << 22              # bytes from which a text is cut at the next end of a piece

# what ends a piece becomes a line break, a tab a blank, A-Z a-z
_READ = bytes.maketrans(b".,;:!?\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n\n\n\n\n\n\n\n\n abcdefghijklmnopqrstuvwxyz")
_NEXT = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of texts in order: where they start and end in ``raw``, their hashes, and which follow each other."""

    def __init__(self, texts: list[bytes], seed: int):
        self.buffer = b"\n".join([*texts, b""]).translate(_READ)
        raw = np.frombuffer(self.buffer, np.uint8)
        line = raw == 10
        gap = line | (raw == 32)
        edge = np.diff(np.concatenate([[True], gap]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.piece = np.cumsum(line, dtype=np.int64)[self.start]
        up, down = _powers(len(raw) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1])])
        self.hash = mix(((sums[self.end] - sums[self.start]) * down[self.start]) ^ np.uint64(seed))
        self.joined = np.append(self.piece[1:] == self.piece[:-1], False)  # is the next word in the same piece
        self.pair = mix(self.hash * _NEXT + np.append(self.hash[1:], np.uint64(0))) if len(self.hash) else self.hash

    def __len__(self) -> int:
        return len(self.hash)


def lang_seed(lang: str) -> int:
    from hashlib import blake2b

    return int.from_bytes(blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class Bitmap:
    """A fixed number of bits; ``has`` may say yes to a hash that was never set, never no to one that was."""

    def __init__(self, places: np.ndarray, words: np.ndarray, bits: int):
        self.words, self.bits = np.zeros(bits // 64, np.uint64), bits
        self.words[places] = words.astype(np.uint64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.bits - 1)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bitmap_of(hashes: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, word) of the bitmap's words that aren't zero: at most ``bits`` / 64, whatever the input."""
    at = F.col("h").bitwiseAND(F.lit(bits - 1).cast("long"))
    found = hashes.select(F.shiftright(at, 6).cast("int").alias("place"), at.alias("at")).groupBy("place").agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("word")).toArrow()
    return found.column("place").to_numpy(), found.column("word").to_numpy()


class Tally:
    """Counts per hash, merged now and then; given out when there are too many."""

    def __init__(self, limit: int = TALLY_ENTRIES):
        self.limit, self.parts, self.size = limit, [], 0

    def add(self, hashes: np.ndarray) -> Iterator:
        h, n = np.unique(hashes, return_counts=True)
        self.parts.append((h, n))
        self.size += len(h)
        if self.size > self.limit:
            self.merge()
            if self.size > self.limit // 2:
                yield from self.rest()

    def merge(self) -> None:
        h, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[:len(h)])
        self.parts = [(h[first], np.add.reduceat(n, first) if len(first) else n)]
        self.size = len(first)

    def rest(self) -> Iterator:
        if self.parts:
            self.merge()
            yield self.parts[0]
        self.parts, self.size = [], 0


def stretches(text: bytes, long: int = LONG) -> Iterator[bytes]:
    """The text, or what lies between some of its pieces' ends: no word or phrase crosses them."""
    if len(text) > long:
        text = text.translate(_READ)
    at = 0
    while len(text) - at > long and (to := text.find(b"\n", at + long)) >= 0:
        yield text[at:to]
        at = to + 1
    yield text[at:] if at else text


def _by_language(part) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of a record batch (lang, text) by language, about a million bytes at a time."""
    langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
    held: dict[str, list[bytes]] = {}
    for lang, text in zip(langs, texts, strict=True):
        if text:
            held.setdefault(lang, []).extend(stretches(text))
    for lang, own in held.items():
        for lo, hi in batches(own):
            yield lang, own[lo:hi]


def _count(rows: DataFrame, hashes) -> DataFrame:
    """(h, n): counts of the hashes that ``hashes(words)`` gives."""
    def each(parts: Iterator) -> Iterator:
        import pyarrow as pa

        def sent(h, n):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])

        tally = Tally()
        for part in parts:
            for lang, texts in _by_language(part):
                for found in tally.add(hashes(Words(texts, lang_seed(lang)))):
                    yield sent(*found)
        for found in tally.rest():
            yield sent(*found)

    return rows.mapInArrow(each, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def word_totals(rows: DataFrame) -> DataFrame:
    """(lang, n): all word occurrences per language."""
    def each(parts: Iterator) -> Iterator:
        import pyarrow as pa

        total: Counter = Counter()
        for part in parts:
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                total[lang] += len((text or b"").translate(_READ).split())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                         names=["lang", "n"])

    return rows.mapInArrow(each, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def nodes_of(phrases, langs, counts: np.ndarray, need: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(row, total, depth) of the subtrees' nodes: leaf totals added up for every prefix of the sorted suffixes.

    ``need``: the depth from which a row's nodes are whole in this group. Whole nodes below ``least`` are left out.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    split = pc.split_pattern(phrases, " ")
    if isinstance(split, pa.ChunkedArray):
        split = split.combine_chunks()
    size = np.diff(split.offsets.to_numpy())
    codes = split.flatten().dictionary_encode().indices.to_numpy()
    row = np.repeat(np.arange(len(size)), size)
    table = np.full((len(size), DEPTH + 1), -1, np.int64)
    table[:, 0] = langs
    table[row, 1 + np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)] = codes
    order = np.lexsort(table.T[::-1])
    out = []
    for depth in range(1, DEPTH + 1):
        deep = order[size[order] >= depth]
        if not len(deep):
            break
        own = table[deep, :depth + 1]
        first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(1)))
        total = np.add.reduceat(counts[deep], first)
        head = deep[first]
        keep = (total >= least) | (need[head] > depth)
        out.append((head[keep], total[keep], depth))
    return out


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST,
                  group_suffixes: int = GROUP_SUFFIXES, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, n): all phrases of one to ``DEPTH`` words that occur ``least`` times or more, written once."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    heavy = max(1, group_suffixes // 8)

    words = C.materialize(_count(rows, lambda w: w.hash).where(F.col("n") >= least), "phrase-words")
    total = words.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // group_suffixes))
    frequent = spark.sparkContext.broadcast((bitmap_of(words, filter_bits), bitmap_of(words.where(F.col("n") > heavy), filter_bits)))

    def pairs(w: Words) -> np.ndarray:
        ok = Bitmap(*frequent.value[0], filter_bits).has(w.hash) if len(w) else np.zeros(0, bool)
        return w.pair[ok & w.joined & np.append(ok[1:], False)] if len(w) else w.pair

    doubles = C.materialize(_count(rows, pairs).where(F.col("n") >= least), "phrase-pairs")
    both = spark.sparkContext.broadcast((bitmap_of(doubles, filter_bits), bitmap_of(doubles.where(F.col("n") > heavy), filter_bits)))

    def ship(parts: Iterator) -> Iterator:
        import pyarrow as pa

        word_ok, word_hot = (Bitmap(*x, filter_bits) for x in frequent.value)
        pair_ok, pair_hot = (Bitmap(*x, filter_bits) for x in both.value)

        def group_of(phrases: list[bytes], lang: str) -> tuple[np.ndarray, np.ndarray]:
            """(group, depth from which nodes are whole in it) of every suffix."""
            w = Words(phrases, lang_seed(lang))     # no phrase holds a mark that ends a piece
            first = np.flatnonzero(np.append(True, w.piece[1:] != w.piece[:-1]))
            size = np.diff(np.append(first, len(w)))
            hot = word_hot.has(w.hash[first])
            deep = hot & (size > 1) & pair_hot.has(w.pair[first])
            whole = w.hash[first].copy()
            for k in range(1, DEPTH):
                more = np.flatnonzero(size > k)
                whole[more] = mix(whole[more] * _NEXT + w.hash[first[more] + k])
            # a pair may be hot by chance beside a word that isn't, so the word decides first
            key = np.where(deep, whole, np.where(hot & (size > 1), w.pair[first], w.hash[first]))
            return (mix(key) % np.uint64(groups)).astype(np.int64), np.where(deep, DEPTH, np.where(hot, 2, 1)).astype(np.uint8)

        def leaves(held: dict[str, Counter]) -> Iterator:
            for lang, found in held.items():
                if not found:
                    continue
                phrases = sorted(found)
                group, need = (np.concatenate(x) for x in zip(*(
                    group_of(phrases[lo:hi], lang) for lo, hi in batches(phrases)), strict=True))
                order = np.argsort(group, kind="stable")
                cut = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
                n = np.fromiter(map(found.__getitem__, phrases), np.int64, len(phrases))
                spans = list(zip(cut.tolist(), [*cut[1:].tolist(), len(order)], strict=True))
                at = order.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[order[cut]]), pa.array([lang] * len(cut), pa.string()),
                     pa.array([b"\n".join([phrases[i] for i in at[x:y]]) for x, y in spans], pa.binary()),
                     pa.array([n[order[x:y]].tobytes() for x, y in spans], pa.binary()),
                     pa.array([need[order[x:y]].tobytes() for x, y in spans], pa.binary())], names=["group", "lang", "phrases", "n", "need"])

        held: dict[str, Counter] = {}
        for part in parts:
            for lang, texts in _by_language(part):
                w = Words(texts, lang_seed(lang))
                if not len(w):
                    continue
                ok = word_ok.has(w.hash)
                link = np.zeros(len(w), bool)
                at = np.flatnonzero(ok & w.joined & np.append(ok[1:], False))
                link[at[pair_ok.has(w.pair[at])]] = True
                last = np.arange(len(w))                # the suffix's last word
                going = link.copy()
                for _ in range(DEPTH - 1):
                    last = np.where(going, last + 1, last)
                    going &= link[np.minimum(last, len(w) - 1)]
                # blanks between words become single, so a suffix is one stretch of the text
                keep = np.zeros(len(w.buffer) + 1, np.int32)
                np.add.at(keep, w.start, 1)
                np.add.at(keep, w.end + 1, -1)
                kept = np.cumsum(keep[:-1]) > 0
                raw = np.frombuffer(w.buffer, np.uint8)[kept].tobytes()
                end = np.cumsum(w.end - w.start + 1) - 1
                start = end - (w.end - w.start)
                at = np.flatnonzero(ok)
                held.setdefault(lang, Counter()).update(
                    [raw[a:b] for a, b in zip(start[at].tolist(), end[last[at]].tolist(), strict=True)])
                if sum(map(len, held.values())) > LEAVES:
                    yield from leaves(held)
                    held = {}
        yield from leaves(held)

    def subtrees(table):
        import pyarrow as pa

        n = np.frombuffer(b"".join(table.column("n").to_pylist()), np.int64)
        need = np.frombuffer(b"".join(table.column("need").to_pylist()), np.uint8)
        phrases = pa.array(b"\n".join(table.column("phrases").to_pylist()).decode("utf-8", "surrogatepass").split("\n") if len(n) else [], pa.string())
        each = np.array([len(x) for x in table.column("need").to_pylist()], np.int64)
        langs = table.column("lang").combine_chunks().take(pa.array(np.repeat(np.arange(len(each)), each)))
        found = nodes_of(phrases, langs.dictionary_encode().indices.to_numpy(), n, need, least)
        out = []
        for head, total, depth in found:
            part = [" ".join(p.split(" ", depth)[:depth]) for p in phrases.take(pa.array(head)).to_pylist()]
            out.append(pa.table([langs.take(pa.array(head)), pa.array(part, pa.string()), pa.array(total, pa.int64())],
                                names=["lang", "phrase", "n"]))
        return pa.concat_tables(out) if out else pa.table([[], [], []], schema=pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())]))

    suffixes = rows.mapInArrow(ship, "group long, lang string, phrases binary, n binary, need binary")
    nodes = suffixes.groupBy("group").applyInArrow(subtrees, "lang string, phrase string, n long")
    summed = nodes.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return C.materialize(summed, "phrase-counts")


def part(words: Column, lo: int | Column, n: int | Column) -> Column:
    return F.array_join(F.slice(words, lo, n), " ")


def big(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def collocations(counts: DataFrame, totals: DataFrame, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of ``counts``."""
    w = counts.withColumn("w", F.split("phrase", " ")).withColumn("size", F.size("w"))
    found = w.where(F.col("size") > 1).withColumnRenamed("n", "a")
    ks = F.expr("sequence(1, size - 1)")
    cuts = found.select("lang", "phrase", "a", "w", "size", F.explode(ks).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.col("w"), F.lit(1), F.col("k")).alias("first"),
        part(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    left, right = (counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(f)) for side, f in (("first", "l"), ("rest", "r")))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("both", big(F.col("l")) + big(F.col("r")))
    score = F.expr(f"(cast({SCALE} as decimal(8,0)) * cast(a as decimal(19,0))) div both")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("b")).select("lang", "phrase", "a", "b.*")

    runs = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    inside = found.where(F.col("size") > 2).select("lang", F.col("a").alias("longer"), F.explode(runs).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (big(F.lit(100)) * big(F.col("longer")) < big(F.lit(covered)) * big(F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read_documents(spark, sf_dir)
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    return collocations(phrase_counts(docs), C.materialize(word_totals(rows), "phrase-totals"))


OP13_SQL = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, w, i, unnest(range(1, least({DEPTH}, len(w) - i + 1) + 1)) AS size FROM i),
c AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, any_value(w[i:i + size - 1]) AS w, size, count(*) AS a
      FROM g GROUP BY 1, 2, 4),
t AS (SELECT lang, sum(a) AS n FROM c WHERE size = 1 GROUP BY 1),
cand AS (SELECT * FROM c WHERE size > 1 AND a >= {LEAST}),
cut AS (SELECT lang, phrase, w, size, a, unnest(range(1, size)) AS k FROM cand),
s AS (SELECT cut.lang, cut.phrase, cut.a, k, x.a AS l, y.a AS r, ({SCALE}::HUGEINT * cut.a) // (x.a + y.a) AS score FROM cut
      JOIN c x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[1:k], ' ')
      JOIN c y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[k + 1:cut.size], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
m AS (SELECT lang, w, size, a, unnest(range(2, size)) AS m FROM cand WHERE size > 2),
o AS (SELECT lang, w, a, m, unnest(range(1, size - m + 2)) AS j FROM m),
inside AS (SELECT lang, array_to_string(w[j:j + m - 1], ' ') AS phrase, max(a) AS longer FROM o GROUP BY 1, 2),
kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < {COVERED}::HUGEINT * best.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN t USING (lang) WHERE rank <= {TOP}
"""
