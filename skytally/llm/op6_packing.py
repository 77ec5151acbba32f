"""Packing documents into fixed-length training sequences: large-item matching, then best fit.

Documents are encoded and cut where they are read; the pieces are written once to the shared folder. A
piece of full length is a sequence by itself. The others are dealt into groups of about
``GROUP_SEQUENCES`` sequences' worth of tokens (and ``GROUP_PIECES`` pieces at most on average), by the
row numbers of the written table. In a group, pieces above a third of the capacity are matched greedily,
the largest with the largest that still fits, so at most two of them share a sequence; then the smaller
pieces, from the largest down, go where the gap left is smallest, or into a new sequence. What grouping
can cost is one part-filled sequence per group.

Defined results: a null or empty text has the end token alone; repeated rows are packed each; a null id
is returned as null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from skytally.llm import common as C
from skytally.llm.shingles import row_slices

TOKENIZER = "word_bpe_49k.json"   # found by each worker on its own machine
CAPACITY = 4096
END_ID = 1
GROUP_SEQUENCES = 2048
GROUP_PIECES = 250_000
ENCODE_BYTES = 4 << 20  # of text encoded together


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids (little-endian unsigned 32-bit), one row per piece."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = StructType([rows.schema["id"], StructField("piece", IntegerType()), StructField("start", LongType()),
                         StructField("length", LongType()), StructField("ids", BinaryType())])
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from skytally.llm.tokens import encoder

        enc, step = encoder(tokenizer), 4 * capacity
        for batch in row_slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= ENCODE_BYTES):
                    size += len(texts[to])
                    to += 1
                doc, piece, ids = [], [], []
                for i, one in enumerate(enc.encode(texts[at:to])):
                    one += end
                    for k in range(0, len(one), step):
                        doc.append(at + i)
                        piece.append(k // step)
                        ids.append(one[k:k + step])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array([p * capacity for p in piece], pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], names=["id", "piece", "start", "length", "ids"])
                at = to

    return rows.mapInArrow(cut, schema)


def fill(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of every length: greedy matching above a third of ``capacity``, then best fit."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    gap: list[int] = []
    n_large = next((k for k, i in enumerate(order) if 3 * lengths[i] <= capacity), len(order))
    large, lo = order[:n_large], 0
    # pairs: the partner is the largest unmatched piece that fits; it moves up as the first one shrinks
    by_size: dict[int, list[int]] = {}
    mask = 0
    for i in large:
        by_size.setdefault(lengths[i], []).append(i)
        mask |= 1 << lengths[i]

    def take(size: int) -> int:
        nonlocal mask
        i = by_size[size].pop()
        if not by_size[size]:
            mask ^= 1 << size
        return i

    while mask:
        lo = mask.bit_length() - 1
        first = take(lo)
        bins[first] = len(gap)
        left = capacity - lo
        fits = mask & ((1 << (left + 1)) - 1)
        if fits:
            size = fits.bit_length() - 1
            second = take(size)
            bins[second], offsets[second] = len(gap), lo
            left -= size
        gap.append(left)
    # best fit: bit g of the mask stands for bins with a gap of g
    by_gap: dict[int, list[int]] = {}
    mask = 0
    for b, g in enumerate(gap):
        if g:
            by_gap.setdefault(g, []).append(b)
            mask |= 1 << g
    for i in order[n_large:]:
        size = lengths[i]
        fits = mask >> size
        if fits:
            g = size + (fits & -fits).bit_length() - 1
            b = by_gap[g].pop()
            if not by_gap[g]:
                mask ^= 1 << g
        else:
            b, g = len(gap), capacity
            gap.append(capacity)
        bins[i], offsets[i] = b, capacity - g
        if g > size:
            by_gap.setdefault(g - size, []).append(b)
            mask |= 1 << (g - size)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_sequences: int = GROUP_SEQUENCES) -> DataFrame:
    """``pieces`` (a written table with ``length``) with sequence_id and offset."""
    kept = pieces.columns
    rows = pieces.withColumn("_row", F.monotonically_increasing_id())
    whole = rows.where(F.col("length") >= capacity).select(
        *kept, (-F.col("_row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = rows.where(F.col("length") < capacity)
    tokens, n = pieces.where(F.col("length") < capacity).agg(F.sum("length"), F.count(F.lit(1))).first()
    groups = max(1, -(-(tokens or 0) // (capacity * group_sequences)), -(-n // GROUP_PIECES))
    part = part.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("long")).drop("_row")
    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def one_group(table):
        import pyarrow as pa

        bins, offsets = fill(table.column("length").to_pylist(), capacity)
        group = table.column("_group")[0].as_py() if len(bins) else 0
        return (table.drop(["_group"]).append_column("sequence_id", pa.array([(group << 32) + b for b in bins], pa.int64()))
                .append_column("offset", pa.array(offsets, pa.int64())))

    return part.groupBy("_group").applyInArrow(one_group, schema).union(whole)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed token ids of every sequence; a group holds one capacity at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(C.read_documents(spark, sf_dir))


def packed_documents(docs: DataFrame) -> DataFrame:
    pieces = encode_pieces(docs, TOKENIZER)
    with C.small_python_batches(docs.sparkSession):
        pieces = C.materialize(pieces, "pack-pieces", compression="zstd")
    return pack(pieces.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
