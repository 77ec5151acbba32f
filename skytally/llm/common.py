"""Helpers shared by the corpus operators: scratch tables, numbering, permutations, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.session import scratch_path

BLANK = "[\\x20\\x09-\\x0D]"      # the six ASCII blanks
COPIES_PER_STEP = 100_000          # copies of one row emitted from one array
FEISTEL_ROUNDS = 6


def read_documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


_written: list[tuple[str, str]] = []   # names and paths of the scratch tables that are still there


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    _written.append((name, path))
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
PYTHON_BYTES = 4 << 20  # of rows handed to a Python worker at a time; the executor holds as much, doubled as its buffers grow


@contextmanager
def small_python_batches(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile passes batches of about ``PYTHON_BYTES`` to Python workers, however long the texts are."""
    old = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, PYTHON_BYTES)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, old)


def scratch_mark() -> int:
    """What ``drop_scratch`` takes as ``since``: the tables written up to now stay."""
    return len(_written)


def drop_scratch(spark: SparkSession, since: int, keep: tuple[str, ...] = ()) -> None:
    """Delete the scratch tables written after a mark, but those named ``keep`` (which a lazy result still reads)."""
    jvm = spark.sparkContext._jvm
    stay = []
    for name, path in _written[since:]:
        if name in keep:
            stay.append((name, path))
        else:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    _written[since:] = stay


def located(docs: DataFrame, id_col: str, text_col: str, in_files: bool) -> DataFrame:
    """(id, text, file, row): rows with a place that later scans find again.

    ``in_files``: ``docs`` is an unchanged read of Parquet files. Otherwise the two columns are written to
    the shared folder first. ``file`` is a hash of the file's path, ``row`` the row's number therein.
    """
    if not in_files:
        docs = materialize(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "rows")
        id_col, text_col = "id", "text"
    meta = docs.metadataColumn("_metadata")
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("row"))


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` (an unchanged read of Parquet files) without the rows at ``gone``'s (file, row)."""
    meta = docs.metadataColumn("_metadata")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("row"))
    gone = materialize(gone.select("file", "row"), "gone")
    sure = maybe_in(rows, ["file", "row"], gone, negate=True)
    rest = maybe_in(rows, ["file", "row"], gone).join(gone, ["file", "row"], "left_anti")
    return sure.select("_doc.*").union(rest.select("_doc.*"))


FILTER_BITS = 1 << 23  # of the bitmap below: 2^17 words, 2 MB, at any size


def maybe_in(df: DataFrame, keys: list[str], wanted: DataFrame, negate: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``keys`` may be among those of ``wanted`` (``negate``: the other rows).

    A bitmap of hashed keys, of a fixed size, is broadcast. No wanted row is missed; when the bitmap is
    crowded more others pass, so a join has to follow. It spares that join's shuffle most rows.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    words = wanted.select(place.alias("_p")).groupBy(F.shiftright("_p", 6).alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_p & 63 as int)))").alias("_bits"))
    d = (df.withColumn("_p", place).withColumn("_word", F.shiftright("_p", 6))
         .join(F.broadcast(words), "_word", "left" if negate else "inner"))
    hit = F.expr("(shiftright(_bits, cast(_p & 63 as int)) & 1L) = 1L")
    return d.where(~F.coalesce(hit, F.lit(False)) if negate else hit).select(*df.columns)


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


# ------------------------------------------------------------------ numbering

def expand_copies(df: DataFrame, count: str, ordinal: str) -> DataFrame:
    """One row per copy: ``ordinal`` runs from 0 to ``count`` - 1. Two levels of arrays, so a row
    with billions of copies never becomes one array."""
    step = COPIES_PER_STEP
    lots = df.withColumn("_lot", F.explode(F.expr(f"sequence(0L, (`{count}` - 1L) div {step}L)")))
    each = F.expr(f"sequence(_lot * {step}L, least(`{count}` - 1L, _lot * {step}L + {step - 1}L))")
    return lots.withColumn(ordinal, F.explode(each)).drop("_lot")


def bucket_count(rows: int, per_bucket: int = 20_000, least: int = 256) -> int:
    return max(least, -(-rows // per_bucket))


def prefix_sums(df: DataFrame, groups: list[str], weight: str | None, out: str, buckets: int) -> DataFrame:
    """Add ``out``: the sum of ``weight`` (1 if None) over the rows before this one in its group.

    The order is fixed by the rows' values alone: by a hash bucket, then by every column. Equal rows
    are merged to a count before anything is shuffled by value and given consecutive places when they
    are expanded again, so neither a hot group nor a row repeated many times meets in one task:
    windows see one hash bucket of distinct rows, and the offsets one row per bucket.
    """
    # the input's columns get names of their own, so no name of theirs can clash with one used here
    names = df.columns
    cols = [f"v{i}" for i in range(len(names))]
    own = [cols[names.index(g)] for g in groups]
    unit = F.lit(1).cast("long") if weight is None else F.col(cols[names.index(weight)]).cast("long")
    u = (df.toDF(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
         .withColumn("b", F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int"))
         .withColumn("w", unit))
    per_bucket = u.groupBy(*own, "b").agg(F.sum(F.col("w") * F.col("n")).alias("sum"))
    before = Window.partitionBy(*own).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *[F.col(g).alias(f"g{i}") for i, g in enumerate(own)], F.col("b").alias("gb"),
        F.coalesce(F.sum("sum").over(before), F.lit(0)).cast("long").alias("offset"))
    inside = (Window.partitionBy(*own, "b").orderBy(*cols)
              .rowsBetween(Window.unboundedPreceding, -1))
    u = u.withColumn("before", F.coalesce(F.sum(F.col("w") * F.col("n")).over(inside), F.lit(0)).cast("long"))
    on = F.col("b") == F.col("gb")
    for i, g in enumerate(own):
        on = on & same(F.col(g), F.col(f"g{i}"))
    placed = expand_copies(u.join(offsets, on), "n", "copy")
    return placed.select(*[F.col(c).alias(n) for c, n in zip(cols, names, strict=True)],
                         (F.col("offset") + F.col("before") + F.col("copy") * F.col("w")).alias(out))


# --------------------------------------------------------------- permutations

def feistel_sides(n: Column) -> tuple[Column, Column]:
    """The two digits' bases: left * right >= n, with fewer than ``left`` numbers to spare."""
    left = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("long")
    return left, F.greatest(F.ceil(n / left), F.lit(1)).cast("long")


def _half(seed: list[Column], r: int, other: Column, size: Column) -> Column:
    return F.pmod(F.xxhash64(*seed, F.lit(r).cast("long"), other), size)


def feistel_permute(df: DataFrame, value: str, n: str, seed: list[Column], out: str) -> DataFrame:
    """Add ``out``: the place of ``value`` under a keyed permutation of 0 .. ``n`` - 1.

    An alternating Feistel network on (left digit, right digit), and cycle walking: a result of
    ``n`` or more goes through the network again. The network never visits a number twice on the way
    back below ``n``, so the walk ends within the numbers to spare, which is the length of the loop.
    """
    nn = F.col(n).cast("long")
    left, right = feistel_sides(nn)
    d = df.withColumn("_fa", left).withColumn("_fb", right)
    a, b = F.col("_fa"), F.col("_fb")
    d = d.withColumn("_fl", F.expr(f"`{value}` div _fb")).withColumn("_fr", F.col(value) % b)
    for r in range(FEISTEL_ROUNDS):
        if r % 2 == 0:
            d = d.withColumn("_fl", (F.col("_fl") + _half(seed, r, F.col("_fr"), a)) % a)
        else:
            d = d.withColumn("_fr", (F.col("_fr") + _half(seed, r, F.col("_fl"), b)) % b)
    d = d.withColumn("_fv", F.col("_fl") * b + F.col("_fr"))

    def again(x: Column) -> Column:
        lo, hi = F.floor(x / b).cast("long"), x % b
        for r in range(FEISTEL_ROUNDS):
            if r % 2 == 0:
                lo = (lo + _half(seed, r, hi, a)) % a
            else:
                hi = (hi + _half(seed, r, lo, b)) % b
        return lo * b + hi

    walk = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(a * b - nn, F.lit(1).cast("long"))), F.col("_fv"),
                       lambda x, _: F.when(x >= nn, again(x)).otherwise(x))
    return (d.withColumn(out, F.when(F.col("_fv") >= nn, walk).otherwise(F.col("_fv")))
            .drop("_fa", "_fb", "_fl", "_fr", "_fv"))


# ----------------------------------------------------------------- components

def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for nodes with an edge.

    Alternating large-star and small-star steps: every node with larger neighbours sends them to its
    smallest neighbour, then the smaller ones. Each step is one map-side combined minimum per node
    and one join that adaptive execution can split, written to the shared folder; nothing but the
    count of changed edges reaches the driver. Ends when a round changes nothing.
    """
    def step(e: DataFrame, small: bool, tag: str) -> DataFrame:
        # (u, v): u is the centre. small: only neighbours below u, and u itself goes along.
        if small:
            pairs = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        else:
            pairs = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
                e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        lowest = materialize(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{tag}-min")
        j = pairs.join(lowest, "u")
        if small:
            moved = j.select(F.col("v").alias("x"), F.col("m")).union(lowest.select(F.col("u").alias("x"), "m"))
        else:
            moved = j.where(F.col("v") > F.col("u")).select(F.col("v").alias("x"), "m")
            # centres stay attached to their own minimum through the pair seen from the other side
        moved = moved.where(F.col("x") != F.col("m")).select(F.col("m").alias("a"), F.col("x").alias("b"))
        return materialize(moved.distinct(), tag)

    e = materialize(edges.where(F.col("a") != F.col("b"))
                    .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-0")
    def state(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first())

    seen = state(e)
    k = 0
    while seen[0]:
        k += 1
        e = step(step(e, False, f"{name}-l{k}"), True, f"{name}-s{k}")
        now = state(e)
        if now == seen:
            break
        seen = now
    nodes = e.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.union(e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


Query = Callable[[SparkSession, str], DataFrame]
