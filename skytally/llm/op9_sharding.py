"""Sharding by a Feistel permutation of global row numbers (DataFrame functions only).

Rows get global numbers 0 .. n-1 in an order that depends on their values alone (see
``common.prefix_sums``). A keyed Feistel network with cycle walking permutes the numbers; place p goes to
shard p mod k, slot p div k. So shard sizes differ by one at most, slots have no gaps, and
``place(number, n, shards, seed)`` computes both for any number without any data.

Defined results: null values are values like any other; equal rows get different numbers, and since
they are equal it does not matter which gets which; texts may be null, empty or of any length; an empty
table gives an empty result. Columns named shard or slot are replaced by the result.
"""

from __future__ import annotations

import math

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import common as C

SHARDS, SEED = 16, 20_240


def number_rows(rows: DataFrame, out: str, total: int) -> DataFrame:
    return C.prefix_sums(rows, [], None, out, C.bucket_count(total))


def shard_rows(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with shard (int) and slot (long), which replace columns of these names; others may have any name.
    Select the columns to carry before the call; all of them decide the numbering, so map columns can't take part."""
    rows = rows.drop("shard", "slot")
    names = rows.columns
    rows = rows.toDF(*[f"v{i}" for i in range(len(names))])
    total = rows.count()
    numbered = number_rows(rows, "_number", total).withColumn("_total", F.lit(total).cast("long"))
    placed = C.feistel_permute(numbered, "_number", "_total", [F.lit(seed).cast("long")], "_place")
    return placed.select(*[F.col(c).alias(n) for c, n in zip(rows.columns, names, strict=True)], F.expr(f"cast(_place % {shards} as int)").alias("shard"),
                         F.expr(f"_place div {shards}").alias("slot"))


def _hash(values: list[int]) -> int:
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def place(number: int, total: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of a global row number, without Spark."""
    a = max(1, math.ceil(math.sqrt(total)))
    b = max(1, math.ceil(total / a))
    v = number
    while True:
        lo, hi = divmod(v, b)
        for r in range(C.FEISTEL_ROUNDS):
            if r % 2 == 0:
                lo = (lo + _hash([seed, r, hi]) % a) % a
            else:
                hi = (hi + _hash([seed, r, lo]) % b) % b
        v = lo * b + hi
        if v < total:
            return v % shards, v // shards


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.read_documents(spark, sf_dir).select(
        "doc_id", (text_bytes(F.col("text")) + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return shard_rows(rows).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                   F.lit(None).cast("int").alias("grown_shard"))
