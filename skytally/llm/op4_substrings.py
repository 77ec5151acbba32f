"""Removal of every byte covered by a long string that also starts anywhere else, by suffix sorting.

Texts are UTF-8 bytes; strings of ``LENGTH`` bytes count. The string at each start is known by the smallest
hash of the ``CORE``-byte pieces in it (the leftmost of equal ones), its core; both depend on the string
alone. Consecutive starts with one core are a unit. Strings that are equal have equal cores, so:

* units whose core stands nowhere else repeat nothing (counted by a map-side combined sum);
* units that are equal as a whole, with the bytes around them, repeat at every start;
* the other units of a core meet in one group, with one representative of each kind of equal units. The
  group's units, with the common core as one symbol, are suffix-sorted by Lyndon groups in descending
  order (see ``suffixes``), and starts whose strings are neighbours and equal repeat.

A core with more than ``GROUP`` kinds of units isn't sorted in one task: the strings at its starts are
counted by 128-bit hashes instead, which spreads and combines them. Either way the result is exact.

Defined results: a null text counts as empty; texts shorter than the length lose nothing; repeated rows
lose what they share; strings are judged on the input; null ids are kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import common as C
from skytally.llm.shingles import mix
from skytally.llm.suffixes import repeated_starts

LENGTH = 400
CORE = 300
GROUP = 1000
SCAN = 1 << 20          # bytes looked at together
_PLACE = np.uint64((1 << 24) - 1)
_ONE, _TWO = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1


class Hashes:
    """Hashes of any stretch of a byte string from two running sums."""

    def __init__(self, raw: np.ndarray):
        n = len(raw) + 1
        self.sums, self.down = [], []
        for base in (_ONE, _TWO):
            up = np.full(n, np.uint64(base), np.uint64)
            down = np.full(n, np.uint64(pow(base, -1, 1 << 64)), np.uint64)
            up[0] = down[0] = 1
            np.cumprod(up, out=up)
            np.cumprod(down, out=down)
            sums = np.zeros(n, np.uint64)
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
            self.sums.append(sums)
            self.down.append(down)

    def of(self, which: int, lo, hi) -> np.ndarray:
        s = self.sums[which]
        return mix((s[hi] - s[lo]) * self.down[which][lo])


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every stretch of ``width``, from minima within blocks forwards and backwards."""
    n = len(v) - width + 1
    x = np.concatenate([v, np.full(-len(v) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(x, axis=1).reshape(-1)
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def units_of(texts: list[bytes], length: int, core: int):
    """Arrays (text, lo, hi, at, fp, ctx): starts lo..hi of a text have the core at ``at`` with hash fp;
    ctx is the hash of bytes lo .. hi + length and of where the core lies in them."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size) - size
    if len(raw) < length:
        return [np.zeros(0, np.int64)] * 6
    h = Hashes(raw)
    place = np.arange(len(raw) - core + 1)
    fp = h.of(0, place, place + core)
    least = sliding_min((fp & ~_PLACE) | place.astype(np.uint64), length - core + 1)
    at = (least & _PLACE).astype(np.int64)
    # starts whose string stays in its text
    n_starts = np.maximum(size - length + 1, 0)
    text = np.repeat(np.arange(len(texts)), n_starts)
    start = np.arange(len(text)) + (begin - (np.cumsum(n_starts) - n_starts))[text]
    at = at[start]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1 if len(first) else first
    lo, hi, at, text = start[first], start[last], at[first], text[first]
    ctx = mix(h.of(1, lo, hi + length) + mix((at - lo).astype(np.uint64)))
    return [text, lo - begin[text], hi - begin[text], at - begin[text], fp[at].view(np.int64), ctx.view(np.int64)]


def pieces_of(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A very long text in stretches whose starts are all of its starts."""
    step = 8 * SCAN
    if len(text) <= step:
        yield 0, text
        return
    for at in range(0, max(1, len(text) - length + 1), step):
        yield at, text[at:at + step + length - 1]


def unit_rows(rows: DataFrame, length: int, core: int) -> DataFrame:
    """(file, row, lo, hi, at, fp, ctx) of (file, row, bytes)."""
    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def emit(batch, owner, offset, part):
            text, lo, hi, at, fp, ctx = units_of(part, length, core)
            off = np.array(offset, np.int64)[text]
            take = pa.array(np.array(owner, np.int64)[text])
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(lo + off), pa.array(hi + off), pa.array(at + off),
                 pa.array(fp), pa.array(ctx)], names=["file", "row", "lo", "hi", "at", "fp", "ctx"])

        for batch in batches:
            owner, offset, part, held = [], [], [], 0
            for i, text in enumerate(batch.column(2).to_pylist()):
                for off, piece in pieces_of(text, length) if text and len(text) >= length else ():
                    if part and held + len(piece) > SCAN:
                        yield emit(batch, owner, offset, part)
                        owner, offset, part, held = [], [], [], 0
                    owner.append(i)
                    offset.append(off)
                    part.append(piece)
                    held += len(piece)
            if part:
                yield emit(batch, owner, offset, part)

    return rows.mapInArrow(scan, "file long, row long, lo long, hi long, at long, fp long, ctx long")


def cut_units(rows: DataFrame, wanted: DataFrame, length: int, core: int) -> DataFrame:
    """``wanted`` units (file, row, units) with their bytes: fp, file, row, lo, starts, single, crowded, left, right."""
    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("fp", pa.int64()), ("file", pa.int64()), ("row", pa.int64()), ("lo", pa.int64()), ("starts", pa.int64()),
                            ("single", pa.bool_()), ("crowded", pa.bool_()), ("left", pa.binary()), ("right", pa.binary())])
        for batch in batches:
            out = []
            for file, row, text, units in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for u in units:
                    lo, hi, at = u["lo"], u["hi"], u["at"]
                    out.append((u["fp"], file, row, lo, hi - lo + 1, u["single"], u["crowded"], text[lo:at], text[at + core:hi + length]))
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    lists = wanted.groupBy("file", "row").agg(F.collect_list(F.struct("fp", "lo", "hi", "at", "single", "crowded")).alias("units"))
    met = C.maybe_in(rows, ["file", "row"], wanted).join(lists, ["file", "row"]).select("file", "row", "bytes", "units")
    return met.mapInArrow(cut, "fp long, file long, row long, lo long, starts long, single boolean, crowded boolean, left binary, right binary")


def stretches(starts: list[int], length: int) -> Iterator[tuple[int, int]]:
    """(first byte, one past the last) of what strings at ascending ``starts`` cover, per run of starts."""
    first = last = None
    for s in starts:
        if last is not None and s == last + 1:
            last = s
            continue
        if last is not None:
            yield first, last + length
        first = last = s
    if last is not None:
        yield first, last + length


def sorted_groups(cut: DataFrame, length: int, core: int) -> DataFrame:
    """(file, row, lo, hi): byte stretches that the suffix sort of each core's group finds repeated."""
    symbols = length - core + 1

    def sort(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def told(group):
            found = repeated_starts([(u[5], u[6], u[3]) for u in group], symbols)
            return [(u[0], u[1], u[2] + lo, u[2] + hi) for u, starts in zip(group, found, strict=True) if u[4]
                    for lo, hi in stretches(starts, length)]

        fp, group, out = None, [], []
        for batch in batches:
            for f, *unit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if f != fp and group:
                    out += told(group)
                    group = []
                fp = f
                group.append(unit)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["file", "row", "lo", "hi"])
                out = []
        if group:
            out = told(group)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["file", "row", "lo", "hi"])

    d = cut.select("fp", "file", "row", "lo", "starts", "single", "left", "right")
    return d.repartition("fp").sortWithinPartitions("fp").mapInArrow(sort, "file long, row long, lo long, hi long")


def counted_strings(cut: DataFrame, length: int, core: int) -> DataFrame:
    """The same for crowded cores: every start's string is counted by its hash."""
    symbols = length - core + 1

    def hashed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for fp, file, row, lo, starts, single, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                both = left + b"\0" + right
                key = fp.to_bytes(8, "little", signed=True)
                found = [blake2b(both[s:s + symbols], digest_size=16, key=key, salt=(len(left) - s).to_bytes(8, "little")).digest() for s in range(starts)]
                two = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array([file] * starts, pa.int64()), pa.array([row] * starts, pa.int64()),
                     pa.array(np.arange(lo, lo + starts)), pa.array([single] * starts, pa.bool_())], names=["a", "b", "file", "row", "start", "single"])

    d = cut.select("fp", "file", "row", "lo", "starts", "single", "left", "right")
    strings = C.materialize(d.mapInArrow(hashed, "a long, b long, file long, row long, start long, single boolean"), "sub-strings")
    often = C.materialize(strings.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b"), "sub-often")
    hit = C.maybe_in(strings.where("single"), ["a", "b"], often).join(often, ["a", "b"])
    return hit.select("file", "row", F.col("start").alias("lo"), (F.col("start") + length).alias("hi"))


def repeated_bytes(rows: DataFrame, length: int = LENGTH, core: int = CORE, group: int = GROUP) -> DataFrame:
    """(file, row, spans) of (file, row, bytes): overlapping byte stretches to remove, per row that loses any."""
    units = C.materialize(unit_rows(rows.select("file", "row", "bytes"), length, core), "sub-units", compression="zstd")
    common = C.materialize(units.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp"), "sub-common")
    near = C.materialize(C.maybe_in(units, ["fp"], common).join(common, "fp").select(*units.columns), "sub-near", compression="zstd")
    kinds = near.groupBy("fp", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("file", "row", "lo", "hi", "at")).alias("one"))
    kinds = C.materialize(kinds.select("fp", "ctx", "n", "one.*"), "sub-kinds", compression="zstd")
    whole = kinds.where("n > 1").select("fp", "ctx")
    whole = C.maybe_in(near, ["fp", "ctx"], whole).join(whole, ["fp", "ctx"]).select("file", "row", "lo", (F.col("hi") + length).alias("hi"))

    open_ = kinds.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1")
    open_ = C.materialize(open_.select("fp", (F.col("kinds") > group).alias("crowded")), "sub-open")
    wanted = C.materialize(kinds.join(open_, "fp").select("fp", "file", "row", "lo", "hi", "at", (F.col("n") == 1).alias("single"), "crowded"), "sub-wanted")
    cut = C.materialize(cut_units(rows.select("file", "row", "bytes"), wanted, length, core), "sub-cut", compression="zstd")
    found = whole.union(sorted_groups(cut.where("NOT crowded"), length, core))
    crowded = cut.where("crowded")
    if not crowded.isEmpty():
        found = found.union(counted_strings(crowded, length, core))
    return C.materialize(found.groupBy("file", "row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "sub-spans", compression="zstd")


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal stretches: those that overlap or touch become one."""
    out: list[list[int]] = []
    for s in sorted((x["lo"], x["hi"]) for x in spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", in_files: bool = False,
                   length: int = LENGTH, core: int = CORE, group: int = GROUP) -> DataFrame:
    """One row per document: id, bytes, spans (maximal removed stretches, null if none), kept (the bytes left)."""
    rows = C.located(docs, id_col, text_col, in_files)
    rows = rows.select("id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes"), "file", "row")
    spans = repeated_bytes(rows, length, core, group)
    touched = C.maybe_in(rows, ["file", "row"], spans).join(spans, ["file", "row"], "left").select("id", "bytes", "spans")
    others = C.maybe_in(rows, ["file", "row"], spans, negate=True).select(
        "id", "bytes", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), F.col("bytes").alias("kept"))

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
        for batch in batches:
            spans, kept = [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                runs = merged(found or [])
                edges = [0, *(e for r in runs for e in r), len(text)]
                spans.append([{"lo": a, "hi": b} for a, b in runs] or None)
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind), pa.array(kept, pa.binary())],
                                             names=["id", "bytes", "spans", "kept"])

    return touched.mapInArrow(cut, others.schema).union(others)


def digests(kept: Column) -> Column:
    return F.lower(F.sha2(kept, 256))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(C.read_documents(spark, sf_dir), in_files=True)
    n = F.octet_length("bytes").cast("long")
    return out.select(F.col("id").alias("doc_id"), n.alias("n_bytes"), (n - F.octet_length("kept")).alias("n_removed"),
                      F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), digests(F.col("kept")).alias("kept_sha256"))


#: Every window of 400 bytes by its digest, over hexadecimal text.
OP4_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT r, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 399)) AS i FROM t),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS k FROM p),
twice AS (SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY k) > 1),
edges AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS first FROM twice),
runs AS (SELECT r, i, sum(first) OVER (PARTITION BY r ORDER BY i) AS g FROM edges),
spans AS (SELECT r, min(i) AS lo, max(i) + 400 AS hi FROM runs GROUP BY r, g),
gaps AS (SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS before FROM spans),
kept AS (SELECT r, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS last,
                string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS parts FROM gaps JOIN t USING (r) GROUP BY r)
SELECT doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(parts, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN kept USING (r)
"""
