"""Mixing sources to target weights (DataFrame functions only).

The words of each source's documents, in a fixed order of documents, are cut into blocks of ``BLOCK``
words (of a source with fewer than ``BLOCK`` such blocks, into shorter ones: a ``BLOCK``th of its words, one at
least, so that rounding to blocks costs a small source no more than a large one). Every output shard of ``SHARD_BLOCKS`` places draws its sources multinomially (each place by a
hash of its number, with the sources' quotas as probabilities); counts per shard and source give each
draw its number within the source. Draws beyond a source's quota are handed, in order, to the sources
that came out short, so the totals are the quotas exactly. Number j of a source is block
``permutation(j mod blocks)`` of that source, with another permutation for each pass, so a block is
repeated only after all of its source were used. Blocks and places are joined by (source, block).

Targets: sources in code point order (null last) weigh 5, 2, 1, 5, 2, 1, ...; together they take 150 % of
all words; a source stops at twice its size and the excess is shared again by weight.

Defined results: a null or blank text has size 0 and is taken 0 times; a null source is a source; equal
rows are separate documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.llm import common as C

WEIGHTS = (5, 2, 1)
SHARE = 1.5          # of all words
MOST = 2             # times a source's size
BLOCK = 64           # words
SHARD_BLOCKS = 4096  # places of an output shard
SEED = 7


def word_count(text: Column) -> Column:
    """Number of runs of characters other than the ASCII blanks."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """(source, source_size, number, target): one row per source.

    Sharing the excess again and again ends where every source takes min(cap, level x weight). Sorted by
    cap / weight, the stopped sources come first, so the level follows from running sums.
    """
    s = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("number", F.row_number().over(by_name) - 1)
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", pick.cast("long")).withColumn("cap", F.col("source_size") * most)
    full = (F.col("cap") / F.col("weight")).alias("full")
    s = s.withColumn("full", full)
    order = Window.orderBy("full", "number")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = (s.withColumn("wanted", F.sum("source_size").over(everything) * F.lit(share))
         .withColumn("stopped", F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
         .withColumn("sharing", F.sum("weight").over(rest))
         .withColumn("level", (F.col("wanted") - F.col("stopped")) / F.col("sharing")))
    # the level that holds: of the first source (in this order) that isn't stopped by its own level
    s = s.withColumn("final", F.min(F.when(F.col("level") < F.col("full"), F.struct("full", "number", "level")))
                     .over(everything)["level"])
    target = F.when(F.col("final").isNull() | (F.col("full") <= F.col("final")), F.col("cap").cast("double")).otherwise(
        F.col("final") * F.col("weight"))
    return s.select("source", "source_size", "number", target.alias("target"))


def quotas(targets: DataFrame, block: int) -> DataFrame:
    """Adds length (words of the source's blocks), blocks, quota (places it gets) and until (running sum of quotas)."""
    length = F.least(F.lit(block).cast("long"), F.greatest(F.lit(1).cast("long"), F.expr(f"source_size div {block}L")))
    d = targets.withColumn("length", length).withColumn("blocks", F.expr("(source_size + length - 1L) div length"))
    quota = F.when(F.col("source_size") > 0,
                   F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"),
                           F.col("blocks") * MOST)).otherwise(F.lit(0)).cast("long")
    d = d.withColumn("quota", quota)
    return d.withColumn("until", F.sum("quota").over(Window.orderBy("number")))


def draw_places(q: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """(shard, place, number, ordinal): which source each output place takes, and its number therein.

    ``q`` has one row per source; it is a broadcast side below only while its counted size allows.
    """
    spark = q.sparkSession
    total = q.agg(F.max("until")).first()[0] or 0
    places = spark.range(total).withColumn("shard", F.expr(f"id div {shard_blocks}L"))
    u = F.pmod(F.xxhash64(F.lit(seed).cast("long"), F.col("id")), F.lit(max(total, 1)).cast("long"))
    picked = locate(places.withColumn("u", u), "u", q.select("number", F.col("until"), F.col("quota").alias("_len")), "number")
    picked = C.materialize(picked.select("id", "shard", "number"), "mix-picked")
    counts = picked.groupBy("shard", "number").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("shard").alias("_s"), F.col("number").alias("_k"), "n",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "number").orderBy("id")
    drawn = (picked.withColumn("i", F.row_number().over(inside) - 1)
             .join(counts, (F.col("shard") == F.col("_s")) & (F.col("number") == F.col("_k")))
             .select("id", "shard", "number", (F.col("first") + F.col("i")).alias("ordinal")))
    # reconcile: draws beyond the quota go, in order, to the sources that came out short
    got = counts.groupBy("_k").agg(F.sum("n").alias("got"))
    bal = (q.select("number", "quota").join(got, F.col("number") == F.col("_k"), "left")
           .select("number", "quota", F.coalesce("got", F.lit(0)).alias("got")))
    byn = Window.orderBy("number")
    over = F.greatest(F.col("got") - F.col("quota"), F.lit(0))
    under = F.greatest(F.col("quota") - F.col("got"), F.lit(0))
    bal = C.materialize(bal.select(F.col("number").alias("_k"), "quota", "got", under.alias("_len"),
                                   (F.sum(over).over(byn) - over).alias("spare_from"), F.sum(under).over(byn).alias("until")), "mix-balance")
    drawn = C.materialize(drawn, "mix-drawn")
    d = drawn.join(F.broadcast(bal.select("_k", "quota", "spare_from")) if small(bal) else bal.select("_k", "quota", "spare_from"),
                   F.col("number") == F.col("_k")).drop("_k")
    spare = F.col("spare_from") + F.col("ordinal") - F.col("quota")
    kept = d.where(F.col("ordinal") < F.col("quota")).select("id", "shard", "number", "ordinal")
    moved = locate(d.where(F.col("ordinal") >= F.col("quota")).select("id", "shard", spare.alias("u")), "u",
                   bal.select(F.col("_k").alias("number"), "until", "_len"), "number")
    moved = moved.join(bal.select(F.col("_k").alias("number"), "got"), "number").select(
        "id", "shard", "number", (F.col("got") + F.col("_at")).alias("ordinal"))
    return kept.union(moved).select("shard", F.expr(f"id % {shard_blocks}L").alias("place"), "number", "ordinal")


BROADCAST_ROWS = 100_000


def small(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def locate(df: DataFrame, value: str, ends: DataFrame, key: str) -> DataFrame:
    """Adds ``key`` and ``_at`` (place inside): the interval [until - _len, until) that holds ``value``.

    ``ends`` has one row per source. Both sides meet in ranges of a fixed width (about one per source).
    """
    ends = ends.where(F.col("_len") > 0)
    n = ends.count()
    if not n:
        return df.select("*", F.lit(0).alias(key), F.lit(0).cast("long").alias("_at")).limit(0)
    top = ends.agg(F.max("until")).first()[0]
    width = max(1, top // n)
    cut = ends.withColumn("_c", F.explode(F.expr(f"sequence((until - _len) div {width}L, (until - 1L) div {width}L)")))
    cut = cut.select("_c", "until", "_len", F.col(key))
    if n <= BROADCAST_ROWS:
        cut = F.broadcast(cut)
    return (df.withColumn("_c", F.expr(f"`{value}` div {width}L")).join(cut, "_c")
            .where((F.col(value) < F.col("until")) & (F.col(value) >= F.col("until") - F.col("_len")))
            .withColumn("_at", F.col(value) - F.col("until") + F.col("_len")).drop("_c", "until", "_len"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> dict[str, DataFrame]:
    """The mix as three tables:

    * ``sources``: source, source_size, number, target, length (of its blocks), blocks, quota;
    * ``documents``: id, source, size, start (its first word's place in its source), digest, and
      source_size, number, target, length, blocks;
    * ``places``: shard, place, number, block, taken as often as they stand there.

    All three are written tables.
    """
    digest = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    sized = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                        word_count(F.col(f"`{text_col}`")).alias("size"), digest.alias("digest"))
    sized = C.materialize(sized, "mix-sizes")
    q = C.materialize(quotas(source_targets(sized), block), "mix-quotas")
    placed = C.prefix_sums(sized, ["source"], "size", "start", C.bucket_count(sized.count()))
    per_source = q.select(F.col("source").alias("_src"), "source_size", "number", "target", "length", "blocks", "quota")
    if small(per_source):
        per_source = F.broadcast(per_source)
    documents = C.materialize(placed.join(per_source, C.same(F.col("source"), F.col("_src"))).drop("_src"), "mix-documents")
    drawn = draw_places(q, shard_blocks, seed).join(
        F.broadcast(q.select(F.col("number").alias("_k"), "blocks")) if small(q) else q.select(F.col("number").alias("_k"), "blocks"),
        F.col("number") == F.col("_k")).drop("_k")
    drawn = drawn.withColumn("pass", F.expr("ordinal div blocks")).withColumn("turn", F.expr("ordinal % blocks"))
    places = C.feistel_permute(drawn, "turn", "blocks", [F.lit(seed).cast("long"), F.col("number").cast("long"), F.col("pass")],
                               "block").select("shard", "place", "number", "block")
    places = C.materialize(places, "mix-places")
    return {"sources": q, "documents": documents, "places": places}


def pieces(documents: DataFrame) -> DataFrame:
    """One row per document and block it reaches into: .., block, words (of the document therein)."""
    some = documents.where(F.col("size") > 0)
    some = some.withColumn("block", F.explode(F.expr("sequence(start div length, (start + size - 1L) div length)")))
    lo = F.greatest(F.col("start"), F.col("block") * F.col("length"))
    hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("length"))
    return some.withColumn("from_word", lo - F.col("start")).withColumn("words", hi - lo)


def mixed_text(docs: DataFrame, mixed: dict[str, DataFrame], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself: shard, place, number, block, text (the block's words, joined by one space)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("digest"),
                        F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0)).alias("all_words")).distinct()
    p = pieces(mixed["documents"])
    p = p.join(words.withColumnRenamed("id", "_id").withColumnRenamed("digest", "_digest"),
               C.same(F.col("id"), F.col("_id")) & (F.col("digest") == F.col("_digest")))
    part = F.slice("all_words", F.col("from_word").cast("int") + 1, F.col("words").cast("int"))
    blocks = p.groupBy("number", "block").agg(F.sort_array(F.collect_list(F.struct("start", part.alias("w")))).alias("parts"))
    text = F.array_join(F.flatten(F.transform("parts", lambda x: x["w"])), " ")
    return mixed["places"].join(blocks.select("number", "block", text.alias("text")), ["number", "block"])


def taken_words(mixed: dict[str, DataFrame]) -> DataFrame:
    """Per document of the mix: its columns and taken (words of it that the mix takes)."""
    times = mixed["places"].groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
    docs = mixed["documents"]
    p = pieces(docs.select("id", "number", "digest", "start", "size", "length"))
    per_piece = p.join(times, ["number", "block"], "left").select(
        "id", "digest", "number", "start", "size", (F.col("words") * F.coalesce("times", F.lit(0))).alias("w"))
    none = docs.where(F.col("size") == 0).select("id", "digest", "number", "start", "size", F.lit(0).cast("long").alias("w"))
    # documents without words may repeat: they are counted and given back one by one
    taken = per_piece.groupBy("id", "digest", "number", "start", "size").agg(F.sum("w").cast("long").alias("taken"))
    return taken.union(none)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    seed: int = SEED) -> DataFrame:
    """``docs`` (an unchanged read of Parquet files), each row as often as the mix takes its words.

    taken / size copies: the whole part, and one more with the rest as probability, by a hash of the row's
    values. Of rows equal in id, source and text the first one stands for all.
    """
    key = ["id", "source", "digest"]
    mark = C.scratch_mark()
    mixed = mix(docs, id_col, text_col, source_col, seed=seed)
    taken = taken_words(mixed).join(mixed["sources"].select("number", "source"), "number").where("size > 0")
    chance = F.pmod(F.xxhash64(F.lit(seed).cast("long"), "id", "digest", "start"), F.lit(1 << 30)) / (1 << 30)
    copies = taken.groupBy(*key).agg(F.sum(F.floor(F.col("taken") / F.col("size") + chance)).cast("long").alias("copies"))
    meta = docs.metadataColumn("_metadata")
    place = [F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("row")]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                       F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("digest"), *place)
    first = rows.groupBy(*key).agg(F.min(F.struct("file", "row")).alias("at"))
    copies = copies.where("copies > 0").select(*[F.col(k).alias(f"_{k}") for k in key], "copies")
    on = C.same(F.col("id"), F.col("_id")) & C.same(F.col("source"), F.col("_source")) & (F.col("digest") == F.col("_digest"))
    often = C.materialize(first.join(copies, on).select("at.file", "at.row", "copies"), "mix-copies")
    C.drop_scratch(docs.sparkSession, mark, ("mix-copies",))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *place)
    # nearly every row has copies, so the list grows with the input: the same shuffled join at every size
    return C.expand_copies(whole.join(often.hint("shuffle_hash"), ["file", "row"]), "copies", "_copy").select("_doc.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(C.read_documents(spark, sf_dir))
    q = mixed["sources"].select("number", "source", "source_size", "target")
    t = taken_words(mixed)
    return t.join(F.broadcast(q) if small(q) else q, "number").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")
