"""Embedding near-duplicates: HNSW graphs per shard, every shard queried, recall audited.

Equal vectors of a label are one node with a count. The nodes of a label are dealt by hash into shards of
about ``SHARD`` vectors; each shard becomes one navigable graph. Each shard's vectors are sent as queries to
its own graph and, of every two shards, one's to the other's graph (a link has two ends, so one direction
suffices; which one alternates, so no shard gets more blocks than another). Beams start at ``BEAM`` and from
every hit go on along its links. Two samples tell the beams' recall: queries of the block (``AUDIT``), compared with all
vectors of the shard for their links, and queries made at just the least cosine from vectors of the shard
(``PLANTED``), whose link is known, so that there is evidence where the block has no links. Beams are doubled and the
block searched again until both recalls are ``RECALL`` or more. Only a block that beams of a quarter of its shard
don't bring there, or whose shard is smaller than that from the start (128 vectors), is compared by matrix product. Every block says which way it went
(``block_counts``). Cosines are double precision products of unit vectors.

Links stay in their task: it adds up every node's number of links, weighted by copies, and gives one edge
per node towards the first node of its component within the block. Those are united by the distributed star steps.

Defined results: vectors that are null, empty, zero or have null or non-finite components, and vectors
without a label, link with nothing and are their own component; vectors of different lengths aren't
compared; equal rows link with each other; null ids are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import common as C

LEAST = 0.93
SHARD = 4096
BEAM = 32
RECALL = 0.995
AUDIT = 128  # queries of a block that are compared with all vectors of the shard
PLANTED = 256  # queries made at just the least cosine from known vectors of the shard
WIDE = 4     # beams of a shard's size divided by this cost more than the product


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda e: e != 0), F.lit(False))


def shard_graphs(nodes: DataFrame) -> DataFrame:
    """(grp, shard, shards, ids, copies, x, graph) of (grp, shard, shards, node, copies, vector): one row per shard."""
    def one(key, table):
        import numpy as np
        import pyarrow as pa

        from skytally.llm import hnsw

        ids = table.column("node").to_numpy()
        order = np.argsort(ids)
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        x = hnsw.unit(flat[order])
        g = hnsw.build(x)
        return pa.table({"grp": pa.array([key[0].as_py()], pa.int64()), "shard": pa.array([key[1].as_py()], pa.int64()),
                         "shards": pa.array([table.column("shards")[0].as_py()], pa.int64()),
                         "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                         "copies": pa.array([table.column("copies").to_numpy()[order].astype("<i8").tobytes()], pa.binary()),
                         "x": pa.array([x.astype("<f8").tobytes()], pa.binary()), "graph": pa.array([g.dumps()], pa.binary())})

    return nodes.groupBy("grp", "shard").applyInArrow(
        one, "grp long, shard long, shards long, ids binary, copies binary, x binary, graph binary")


def product(graph, queries, least: float):
    """(query, node, cosine) of all pairs of ``least`` or more."""
    import numpy as np

    out = []
    for lo in range(0, len(queries), AUDIT):
        cos = queries[lo:lo + AUDIT] @ graph.x.T
        r, c = np.nonzero(cos >= least)
        out.append((r + lo, c, cos[r, c]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def search_block(graph, queries, least: float, beam: int, recall: float, own=None):
    """((query, node, cosine) hits of ``queries`` in ``graph``, whether the graph found them), the beam widened
    until the audit passes. ``own`` has the node that each query itself is, if they are the graph's."""
    import numpy as np

    n, m = len(graph.x), len(queries)
    if WIDE * beam >= n:
        return product(graph, queries, least), False
    chosen = np.unique(np.linspace(0, m - 1, min(AUDIT, m)).astype(int))
    cos = queries[chosen] @ graph.x.T
    if own is not None:
        cos[np.arange(len(chosen)), own[chosen]] = -np.inf   # a vector's link with itself is no evidence
    want = (cos >= least).sum(1)
    # queries whose link is known: a vector of the shard, turned by the least cosine in some direction
    known = np.unique(np.linspace(0, n - 1, min(PLANTED, n)).astype(int))
    aside = np.random.default_rng(n).normal(size=(len(known), graph.x.shape[1]))
    aside -= (aside * graph.x[known]).sum(1, keepdims=True) * graph.x[known]
    length = np.sqrt((aside * aside).sum(1, keepdims=True))
    aside = np.divide(aside, length, out=np.zeros_like(aside), where=length > 0)
    planted = least * graph.x[known] + np.sqrt(1 - least * least) * aside
    while WIDE * beam < n:
        nodes, near = graph.nearest(planted, beam)
        # a beam full of links has found where to go on, though more vectors than it holds are as near
        if ((nodes == known[:, None]).any(1) | (near >= least - 1e-9).all(1)).mean() >= recall:
            r, c, s = graph.within(queries, least, beam)
            found = np.bincount(r if own is None else r[own[r] != c], minlength=m)[chosen]
            some = want > 0
            if found.sum() >= recall * want.sum() and (not some.any() or (found[some] / want[some]).mean() >= recall):
                return (r, c, s), True
        beam *= 2
    return product(graph, queries, least), False


def first_of_component(n: int, u, v):
    """Per node of 0 .. n - 1 the smallest node that the edges (u, v) connect it with."""
    import numpy as np

    first = np.arange(n)
    while True:
        low = np.minimum(first[u], first[v])
        now = first.copy()
        np.minimum.at(now, first[u], low)
        np.minimum.at(now, first[v], low)
        now = now[now]
        if np.array_equal(now, first):
            return first
        first = now


DEGREE_ROW, EDGE_ROW, BLOCK_ROW = 0, 1, 2


def links_of(graphs: DataFrame, least: float, beam: int = BEAM, recall: float = RECALL) -> DataFrame:
    """(kind, a, b) rows of every block of two shards: a node and its number of links there; an edge; whether
    the graph answered (1) or the product (0), and for how many queries."""
    blocks = graphs.select("grp", F.col("shard").alias("q_shard"), F.col("ids").alias("q_ids"), F.col("copies").alias("q_copies"),
                           F.col("x").alias("q_x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    # of two shards the lower one's graph is asked if their numbers' sum is even, else the higher one's
    even = (F.col("shard") + F.col("q_shard")) % 2 == 0
    blocks = blocks.where((F.col("shard") <= F.col("q_shard")) & even | (F.col("shard") > F.col("q_shard")) & ~even)
    met = graphs.select("grp", "shard", "ids", "copies", "graph").join(blocks, ["grp", "shard"]).select(
        "ids", "copies", "graph", "q_ids", "q_copies", "q_x")

    def search(parts: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from skytally.llm import hnsw

        def rows(kind: int, a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], names=["kind", "a", "b"])

        last, graph = None, None
        for batch in parts:
            for i in range(len(batch)):
                ids, copies, q_ids, q_copies = (np.frombuffer(batch.column(k)[i].as_py(), "<i8") for k in (0, 1, 3, 4))
                if last is None or not np.array_equal(last, ids):
                    last, graph = ids, hnsw.Graph.loads(batch.column(2)[i].as_py())
                q = np.frombuffer(batch.column(5)[i].as_py(), "<f8").reshape(len(q_ids), -1)
                same = np.array_equal(ids, q_ids)
                n, found, ways = len(ids), [], np.zeros(2, np.int64)
                for lo in range(0, len(q), 2048):
                    part = q[lo:lo + 2048]
                    (r, c, _), by_graph = search_block(graph, part, least, beam, recall, np.arange(lo, lo + len(part)) if same else None)
                    r = r + lo
                    ways[int(by_graph)] += len(part)
                    if same:    # either end may have found the other
                        key = np.minimum(r, c) * n + np.maximum(r, c)
                        found.append(np.unique(key[r != c]))
                    else:
                        found.append(r * n + c)
                r, c = np.divmod(np.unique(np.concatenate(found)) if same else np.concatenate(found), n)
                # one numbering of both sides: queries after the graph's nodes
                r = r if same else r + n
                node = ids if same else np.concatenate([ids, q_ids])
                weight = copies if same else np.concatenate([copies, q_copies])
                links = np.zeros(len(node), np.int64)
                np.add.at(links, r, weight[c])
                np.add.at(links, c, weight[r])
                linked = np.flatnonzero(links)
                yield rows(DEGREE_ROW, node[linked], links[linked])
                first = first_of_component(len(node), r, c)
                moved = np.flatnonzero(first != np.arange(len(node)))
                yield rows(EDGE_ROW, node[moved], node[first[moved]])
                ways_seen = np.flatnonzero(ways)
                yield rows(BLOCK_ROW, ways_seen, ways[ways_seen])

    return met.mapInArrow(search, "kind int, a long, b long")


def block_counts(found: DataFrame) -> DataFrame:
    """(by_graph, parts, queries): how many parts of blocks, and queries of them, the graphs answered or the product."""
    return found.where(F.col("kind") == BLOCK_ROW).groupBy((F.col("a") == 1).alias("by_graph")).agg(
        F.count(F.lit(1)).alias("parts"), F.sum("b").alias("queries"))


def graphs_of(nodes: DataFrame, shard: int = SHARD) -> DataFrame:
    """``shard_graphs`` of (label, vector, node, copies) rows, the nodes of a label and vector length dealt into shards."""
    sizes = nodes.groupBy("label", F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    sizes = C.materialize(sizes.select(F.col("label").alias("_l"), F.col("dim").alias("_d"), F.monotonically_increasing_id().alias("grp"),
                                       F.expr(f"(n + {shard - 1}L) div {shard}L").alias("shards")), "vec-sizes")
    dealt = nodes.join(sizes, (F.col("label") == F.col("_l")) & (F.size("vector") == F.col("_d")))
    return shard_graphs(dealt.select("grp", F.pmod(F.xxhash64("node"), F.col("shards")).alias("shard"), "shards", "node", "copies", "vector"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label",
                 least: float = LEAST, shard: int = SHARD) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"), F.col(f"`{group_col}`").alias("label"))
    ok = F.col("label").isNotNull() & usable(F.col("vector"))
    good, bad = rows.where(ok), rows.where(~ok)
    nodes = good.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least_id"))
    nodes = C.materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "vec-nodes")
    graphs = C.materialize(graphs_of(nodes, shard), "vec-graphs", compression="none")
    found = C.materialize(links_of(graphs, least), "vec-links")
    degree = found.where(F.col("kind") == DEGREE_ROW).groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("linked"))
    comp = C.connected_components(found.where(F.col("kind") == EDGE_ROW).select("a", "b"), "vec-comp")
    kinds = nodes.join(comp, "node", "left").join(degree, "node", "left").select(
        "label", "vector", "least_id", F.coalesce("component", "node").alias("component"),
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
    kinds = C.materialize(kinds, "vec-kinds")
    least_of = kinds.groupBy("component").agg(F.min("least_id").alias("component_id"))
    kinds = C.materialize(kinds.join(least_of, "component").select(
        F.col("label").alias("_l"), F.col("vector").alias("_v"), "n_links", "component_id"), "vec-class")
    found = good.join(kinds, (F.col("label") == F.col("_l")) & (F.col("vector") == F.col("_v"))).select("id", "n_links", "component_id")
    alone = bad.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return found.union(alone).withColumn("kept", C.same(F.col("id"), F.col("component_id")))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(C.read_documents(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON reach.r = link.a),
k AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM k LEFT JOIN n USING (vec_id)
"""
