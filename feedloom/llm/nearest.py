"""Approximate nearest neighbours by robust-pruned directed graphs.

Equal vectors are one node (a vector that a third of all rows hold is indexed
once). Nodes are dealt by hash over shards of about ``SHARD`` nodes, and every
shard gets one directed graph: nodes are inserted in batches, a greedy beam
search from the medoid proposes neighbours, and robust pruning with a relaxed
distance keeps a diverse few of them; reverse edges are pruned the same way.
For the inner product, vectors of a shard are lifted to equal length by one more
coordinate, so that the largest product is the nearest point.

Each distinct query vector searches every shard by beam search; shards answer
with their best nodes, scored in double precision on the original vectors, and
the answers are merged for each query. Queries go in blocks of about
``QUERY_BLOCK``, so neither a shard nor a block outgrows a task.

Defined cases: vectors that are null, empty, all zero, or hold null or
non-finite components take no part, as query or candidate; vectors are compared
with vectors of their own length only; rows with a null id take no part; rows
that repeat a query's id are not its candidates; equal scores go to the smaller
id; with fewer than ``k`` candidates all are returned; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import stage_table

from .tables import prepare

SHARD = 16_384
QUERY_BLOCK = 8_192
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
RELAX = 1.2
BATCH = 256
#: Nodes expanded in one step of the search.
WIDE = 4


# -- graph ----------------------------------------------------------------------

def lift(x: np.ndarray) -> np.ndarray:
    """Vectors of equal length one, in the order of their products with any
    query: the missing length goes to one more coordinate."""
    norm = (x.astype(np.float64) ** 2).sum(axis=1)
    longest = norm.max()
    return (np.concatenate([x, np.sqrt(np.maximum(longest - norm, 0))[:, None]], axis=1) / np.sqrt(longest)).astype(np.float32)


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest found of each query (-1: none), nearest first, and
    their negated products. All queries walk side by side."""
    b, n = len(queries), len(points)
    seen = np.zeros((b, n + 1), dtype=bool)
    seen[:, n] = True                                   # stands for "no node"
    ids = np.full((b, beam), n)
    far = np.full((b, beam), np.inf, dtype=np.float32)
    done = np.ones((b, beam), dtype=bool)
    ids[:, 0], far[:, 0], done[:, 0] = entry, -(queries @ points[entry]), False
    seen[:, entry] = True
    links = np.vstack([edges, np.full((1, edges.shape[1]), n)])
    padded = np.vstack([points, np.zeros((1, points.shape[1]), dtype=points.dtype)])
    live = np.arange(b)
    while len(live):
        open_ = np.where(done[live], np.inf, far[live])
        pick = np.argsort(open_, axis=1, kind="stable")[:, :WIDE] if beam > WIDE else np.tile(np.arange(beam), (len(live), 1))
        row = live[:, None]
        ready = ~done[row, pick]
        node = np.where(ready, ids[row, pick], n)
        done[row, pick] = True
        found = []
        for k in range(node.shape[1]):
            near = links[node[:, k]]
            near = np.where(seen[row, near], n, near)
            seen[row, near] = True
            found.append(near)
        near = np.concatenate(found, axis=1)
        dist = -np.einsum("brd,bd->br", padded[near], queries[live])
        dist[near == n] = np.inf
        all_ids, all_far = np.concatenate([ids[live], near], axis=1), np.concatenate([far[live], dist], axis=1)
        all_done = np.concatenate([done[live], near == n], axis=1)
        best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        at = np.arange(len(live))[:, None]
        ids[live], far[live], done[live] = all_ids[at, best], all_far[at, best], all_done[at, best]
        live = live[~done[live].all(axis=1)]
    order = np.argsort(far, axis=1, kind="stable")
    ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
    return np.where(np.isfinite(far), ids, -1), far


def robust_prune(points: np.ndarray, owners: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """At most ``degree`` neighbours of each owner out of its candidates (-1:
    none): the nearest one is kept, and candidates that are ``relax`` times nearer
    to it than to the owner are dropped, again and again."""
    safe = np.maximum(candidates, 0)
    x = points[safe]
    own = np.maximum(0, 2 - 2 * np.einsum("bcd,bd->bc", x, points[owners]))      # squared distances
    bad = (candidates < 0) | (candidates == owners[:, None])
    own[bad] = np.inf
    order = np.argsort(own, axis=1, kind="stable")
    own, safe = np.take_along_axis(own, order, 1), np.take_along_axis(safe, order, 1)
    x = np.take_along_axis(x, order[:, :, None], 1)
    between = np.maximum(0, 2 - 2 * np.matmul(x, x.transpose(0, 2, 1)))
    alive = np.isfinite(own)
    alive[:, 1:] &= safe[:, 1:] != safe[:, :-1]                                   # repeated candidates lie side by side
    out = np.full((len(owners), degree), -1)
    rows = np.arange(len(owners))
    for r in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        out[some, r] = safe[rows[some], first[some]]
        alive &= ~((relax * relax) * between[rows, first] <= own)
        alive[rows, first] = False
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX, seed: int = 1) -> tuple[np.ndarray, int]:
    """Out-edges of every node (-1: none) and the entry node."""
    n = len(points)
    rng = np.random.default_rng(seed)
    entry = int((points @ points.mean(axis=0)).argmax())
    edges = np.full((n, degree), -1)
    if n == 1:
        return edges, entry
    start = min(degree // 2, n - 1)
    edges[:, :start] = (np.arange(n)[:, None] + rng.integers(1, n, size=(n, start))) % n
    order = rng.permutation(n)
    for a in range(0, n, BATCH):
        batch = order[a:a + BATCH]
        found, _ = beam_search(points, np.where(edges < 0, n, edges), entry, points[batch], beam)
        edges[batch] = robust_prune(points, batch, np.concatenate([found, edges[batch]], axis=1), degree, relax)
        _add_reverse(points, edges, batch, degree, relax)
    return edges, entry


def _add_reverse(points: np.ndarray, edges: np.ndarray, batch: np.ndarray, degree: int, relax: float) -> None:
    """The edges of the batch, backwards; full lists are pruned."""
    to, source = edges[batch].ravel(), np.repeat(batch, degree)
    source, to = source[to >= 0], to[to >= 0]
    order = np.argsort(to, kind="stable")
    source, to = source[order], to[order]
    node, first, many = np.unique(to, return_index=True, return_counts=True)
    by_size = np.argsort(many, kind="stable")
    for part in np.array_split(by_size, max(1, len(node) // BATCH)):
        width = int(many[part].max()) if len(part) else 0
        new = np.full((len(part), width), -1)
        column = np.arange(width)[None, :]
        ok = column < many[part][:, None]
        new[ok] = source[(first[part][:, None] + column)[ok]]
        owner = node[part]
        new[(new[:, :, None] == edges[owner][:, None, :]).any(axis=2)] = -1
        merged = np.concatenate([edges[owner], new], axis=1)
        used = (merged >= 0).sum(axis=1)
        fits = used <= degree
        kept = np.take_along_axis(merged, np.argsort(merged < 0, axis=1, kind="stable"), 1)[:, :degree]
        edges[owner[fits]] = kept[fits]
        if not fits.all():
            edges[owner[~fits]] = robust_prune(points, owner[~fits], merged[~fits], degree, relax)


# -- operator -------------------------------------------------------------------

_NODE = "dim int, shard int, pos int, entry int, vector array<float>, edges array<int>, ids array<long>"
_ANSWER = "q1 long, q2 long, score double, ids array<long>"


def _build(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["k1", "k2"]).reset_index(drop=True)
    edges, entry = build_graph(lift(np.stack(group["vector"])))
    return pd.DataFrame({"dim": group["dim"], "shard": group["shard"], "pos": np.arange(len(group), dtype=np.int32), "entry": np.int32(entry),
                         "vector": group["vector"], "edges": list(edges.astype(np.int32)), "ids": group["ids"]})


def _search(k: int, beam: int):
    def run(nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"q1": pd.Series(dtype="int64"), "q2": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64"), "ids": pd.Series(dtype="object")})
        if not len(nodes) or not len(queries):
            return empty
        nodes = nodes.sort_values("pos").reset_index(drop=True)
        x, q = np.stack(nodes["vector"]), np.stack(queries["vector"])
        points, edges = lift(x), np.stack(nodes["edges"])
        edges = np.where(edges < 0, len(points), edges)
        ids, out = nodes["ids"].to_numpy(), []
        exact = x.astype(np.float64)
        for a in range(0, len(q), BATCH):
            part = q[a:a + BATCH].astype(np.float64)
            unit = part / np.sqrt((part ** 2).sum(axis=1, keepdims=True))
            found, _ = beam_search(points, edges, int(nodes["entry"][0]), np.concatenate([unit, np.zeros((len(part), 1))], axis=1).astype(np.float32), beam)
            score = np.einsum("bld,bd->bl", exact[np.maximum(found, 0)], part)
            score[found < 0] = -np.inf
            least = np.array([ids[i][0] for i in np.maximum(found, 0).ravel()]).reshape(found.shape)
            order = np.lexsort((least, -score), axis=1)[:, :k]
            found, score = np.take_along_axis(found, order, 1), np.take_along_axis(score, order, 1)
            row, column = np.nonzero(found >= 0)
            out.append(pd.DataFrame({"q1": queries["k1"].to_numpy()[a + row], "q2": queries["k2"].to_numpy()[a + row],
                                     "score": score[row, column], "ids": ids[found[row, column]]}))
        return pd.concat(out, ignore_index=True)
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, beam: int = SEARCH_BEAM, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row of ``queries`` the ``k``
    rows of ``vectors`` with the largest inner product found."""
    spark = vectors.sparkSession
    prepare(spark)

    def usable(df: DataFrame) -> DataFrame:
        x = F.col("vector")
        fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
        return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("vector"))
                .filter(F.col("id").isNotNull() & x.isNotNull()).filter(F.coalesce(fine, F.lit(False)))
                .withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.reverse("vector"), F.size("vector"))}))

    # A node keeps its k + 1 smallest ids: more rows of one vector are never among a query's nearest.
    rank = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("id"))
    nodes = (usable(vectors).dropDuplicates(["k1", "k2", "id"]).withColumn("r", rank).filter(F.col("r") <= k + 1)
             .groupBy("k1", "k2").agg(F.first("vector").alias("vector"), F.array_sort(F.collect_list("id")).alias("ids")))
    nodes = stage_table(nodes.withColumn("dim", F.size("vector")), "nodes")
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row a vector length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = F.element_at(F.create_map(*[x for d, n in sizes.items() for x in (F.lit(d), F.lit(-(-n // SHARD)))]), F.col("dim"))
    dealt = nodes.withColumn("shard", F.pmod(F.col("k2"), shards).cast("int"))
    graph = stage_table(dealt.groupBy("dim", "shard").applyInPandas(_build, _NODE), "graph")

    asked = usable(queries)
    distinct = stage_table(asked.groupBy("k1", "k2").agg(F.first("vector").alias("vector")).withColumn("dim", F.size("vector")), "queries")
    blocks = -(-max(1, distinct.count()) // QUERY_BLOCK)
    probes = (distinct.join(F.broadcast(spark.createDataFrame([(d, -(-n // SHARD)) for d, n in sizes.items()], "dim int, shards int")), "dim")
              .select("dim", "k1", "k2", "vector", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.pmod("k1", F.lit(blocks)).cast("int").alias("block")))
    served = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    answers = (served.groupBy("dim", "shard", "block").cogroup(probes.groupBy("dim", "shard", "block")).applyInPandas(_search(k + 1, beam), _ANSWER))

    best = F.row_number().over(Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id"))
    merged = (answers.select("q1", "q2", "score", F.explode("ids").alias("vec_id")).withColumn("r", best).filter(F.col("r") <= k + 1)
              .groupBy("q1", "q2").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("best")))
    own = (asked.select(F.col("id").alias("query_id"), F.col("k1").alias("q1"), F.col("k2").alias("q2")).join(merged, ["q1", "q2"])
           .select("query_id", F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k).alias("best")))
    return own.select("query_id", F.posexplode("best").alias("p", "b")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")
