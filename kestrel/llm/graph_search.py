"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Vectors are dealt over shards by a hash of their components.  In each shard,
points are inserted in batches: a greedy beam search from the shard's medoid
over the graph so far proposes neighbours, relaxed distance pruning keeps the
nearest one and drops those that are ``alpha`` times nearer to it than to the
point, and so on, which keeps edges in different directions; reverse edges are
added and pruned alike.  A second pass with the final ``alpha`` refines the
graph.  Every shard is asked every query by beam search, and the best of all
shards are ranked by exact distances.

Equal vectors are one point of the graph that lists the smallest ids of its
copies, as many as a query can ask for, so ties go to the smaller ids exactly and
a vector repeated very often costs one point.  Shards hold about ``shard_rows``
distinct vectors however many there are; queries go to a shard in blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import cut_lineage


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part: an id, and components that are all finite and not all zero."""
    v = F.col("vector")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return (rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
            .where(fine & F.col("vec_id").isNotNull()))


def points(rows: DataFrame, keep: int, salts: int = 64) -> DataFrame:
    """(vector, ids): distinct vectors with the ``keep`` smallest distinct ids of their copies, fewest in any task first."""
    part = rows.distinct().withColumn("_s", F.pmod(F.xxhash64("vec_id"), F.lit(salts)))
    first = lambda df, by: (df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))).where(F.col("_n") <= keep).drop("_n"))
    least = first(first(part, ["vector", "_s"]).drop("_s"), ["vector"])
    return least.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # at most ``keep``


class Graph:
    """Directed graph over the rows of ``data``; ``edges`` has -1 for none."""

    def __init__(self, data: np.ndarray, degree: int = 32, beam: int = 64, alpha: float = 1.2):
        self.data, self.degree, self.beam = np.ascontiguousarray(data, np.float64), degree, beam
        n = len(data)
        self.norms = (self.data ** 2).sum(1)
        self.edges = np.full((n, degree), -1, np.int32)
        self.medoid = int(((self.data - self.data.mean(0)) ** 2).sum(1).argmin())
        order = np.random.default_rng(n).permutation(n)  # rows come sorted: the same graph for every run
        # the first batch starts from random edges; later ones search the graph so far
        head = order[: min(n, 4 * degree)]
        for i, p in enumerate(head):
            self._prune(int(p), head[np.arange(len(head)) != i], 1.0)
        for a in (1.0, alpha):
            at = len(head) if a == 1.0 else 0
            while at < n:
                batch = order[at:at + (min(max(at, 64), 512))]
                self._insert(batch, a)
                at += len(batch)

    def distances(self, ids: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Squared distances of rows ``ids`` (m, k) to vectors ``to`` (m, d)."""
        return np.maximum(self.norms[ids] - 2 * np.einsum("mkd,md->mk", self.data[ids], to) + (to ** 2).sum(1)[:, None], 0)

    def _prune(self, p: int, candidates: np.ndarray, alpha: float) -> None:
        """Robust prune: set p's edges from candidates, nearest first, none that an earlier edge is alpha times nearer to."""
        candidates = np.unique(candidates[(candidates >= 0) & (candidates != p)])
        if not len(candidates):
            return
        v = self.data[candidates]
        near = ((v - self.data[p]) ** 2).sum(1)
        order = np.argsort(near, kind="stable")[: 3 * self.beam]
        candidates, v, near = candidates[order], v[order], near[order]
        between = np.maximum(self.norms[candidates][:, None] + self.norms[candidates][None, :] - 2 * v @ v.T, 0)
        covered, kept = np.zeros(len(candidates), bool), []
        cut = alpha * alpha * between <= near[None, :]  # row: the edge kept, column: what it makes needless
        for i in range(len(candidates)):
            if not covered[i]:
                kept.append(i)
                if len(kept) == self.degree:
                    break
                covered |= cut[i]
        self.edges[p] = -1
        self.edges[p, : len(kept)] = candidates[kept]

    def _insert(self, batch: np.ndarray, alpha: float) -> None:
        found, seen = self.search(self.data[batch], self.beam)
        backward: dict[int, list[int]] = {}
        for p, f, s in zip(batch.tolist(), found, seen, strict=True):
            self._prune(p, np.concatenate([f, s, self.edges[p]]), alpha)
            for q in self.edges[p]:
                if q >= 0:
                    backward.setdefault(int(q), []).append(p)
        for q, new in backward.items():
            have = self.edges[q][self.edges[q] >= 0]
            more = np.setdiff1d(new, have)
            if len(have) + len(more) <= self.degree:
                self.edges[q, len(have):len(have) + len(more)] = more
            else:
                self._prune(q, np.concatenate([have, more]), alpha)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all queries in step: (m, beam) row ids nearest first, -1 for none, and the rows expanded."""
        m, n = len(queries), len(self.data)
        beam = min(beam, n)
        ids = np.full((m, beam), -1, np.int64)
        far = np.full((m, beam), np.inf)
        done = np.ones((m, beam), bool)
        ids[:, 0] = self.medoid
        far[:, 0] = self.distances(ids[:, :1], queries)[:, 0]
        done[:, 0] = False
        met = np.zeros((m, n), bool)
        met[:, self.medoid] = True
        expanded = []
        rows = np.arange(m)
        while True:
            open_ = np.where(done, np.inf, far)
            pick = open_.argmin(1)
            live = np.isfinite(open_[rows, pick])
            if not live.any():
                break
            r = rows[live]
            p = ids[r, pick[live]]
            done[r, pick[live]] = True
            step = np.full(m, -1)
            step[r] = p
            expanded.append(step)
            new = self.edges[p]
            fresh = (new >= 0) & ~met[r[:, None], np.maximum(new, 0)]
            met[np.broadcast_to(r[:, None], new.shape)[fresh], new[fresh]] = True
            d = np.where(fresh, self.distances(np.maximum(new, 0), queries[r]), np.inf)
            all_ids = np.concatenate([ids[r], np.where(fresh, new, -1)], 1)
            all_far = np.concatenate([far[r], d], 1)
            all_done = np.concatenate([done[r], ~fresh], 1)
            best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids[r], far[r], done[r] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_far, all_done))
        seen = np.stack(expanded, 1) if expanded else np.empty((m, 0), np.int64)
        return ids, seen


def build(rows: DataFrame, keep: int, shard_rows: int = 2048, degree: int = 32, beam: int = 64, alpha: float = 1.2) -> DataFrame:
    """(dim, shard, node, vector, ids, edges, medoid): the graphs, one row per distinct vector."""
    distinct = cut_lineage(points(rows, keep).withColumn("dim", F.size("vector")))
    sizes = distinct.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"))  # a row per dimension
    # a graph is much work on few bytes: as many partitions as shards, which adaptive execution doesn't merge
    parts = 2 * (sizes.agg(F.sum("shards")).first()[0] or 1)
    dealt = distinct.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")))

    def graph(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(least=[i[0] for i in pdf["ids"]]).sort_values("least").drop(columns="least").reset_index(drop=True)
        g = Graph(np.stack(pdf["vector"].to_numpy()), degree, beam, alpha)
        return pdf[["dim", "shard", "vector", "ids"]].assign(node=np.arange(len(pdf), dtype=np.int64), edges=[e[e >= 0].tolist() for e in g.edges], medoid=g.medoid)

    out = "dim int, shard long, vector array<double>, ids array<long>, node long, edges array<int>, medoid long"
    return cut_lineage(dealt.select("dim", "shard", "vector", "ids").repartition(parts, "dim", "shard").groupBy("dim", "shard").applyInPandas(graph, out))


def _ask(k: int, beam: int):
    def run(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if shard.empty or queries.empty:
            return pd.DataFrame({n: [] for n in names})
        shard = shard.sort_values("node")
        g = object.__new__(Graph)
        g.data = np.stack(shard["vector"].to_numpy())
        g.norms, g.medoid = (g.data ** 2).sum(1), int(shard["medoid"].iloc[0])
        g.edges = np.full((len(shard), max(1, max(map(len, shard["edges"])))), -1, np.int64)
        for i, e in enumerate(shard["edges"]):
            g.edges[i, : len(e)] = e
        ids, rows = shard["ids"].tolist(), []
        asked = queries["query_id"].to_numpy()
        vectors = np.stack(queries["vector"].to_numpy())
        for lo in range(0, len(asked), 512):
            found, _ = g.search(vectors[lo:lo + 512], max(beam, 2 * k))
            for q, v, f in zip(asked[lo:lo + 512].tolist(), vectors[lo:lo + 512], found, strict=True):
                f = f[f >= 0]
                exact = np.sqrt(((g.data[f] - v) ** 2).sum(1))
                best = sorted((s, i) for s, node in zip(exact.tolist(), f.tolist(), strict=True) for i in ids[node] if i != q)[:k]
                rows += [(q, i, s) for s, i in best]
        return pd.DataFrame(rows, columns=names)
    return run


def search(index: DataFrame, queries: DataFrame, k: int = 10, beam: int = 128, block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each query (query_id, vector), itself excluded.

    Score is the Euclidean distance in double precision; ties go to the smaller
    vec_id.  Fewer rows if there are fewer candidates of the query's dimension.
    """
    shards = index.select(F.col("dim").alias("_dim"), F.col("shard").alias("_shard")).distinct()
    blocks = F.pmod(F.xxhash64("query_id"), F.lit(-(-queries.count() // block) or 1))
    asked = queries.select("query_id", "vector", F.size("vector").alias("dim"), blocks.alias("block"))
    sent = asked.join(shards, F.col("dim") == F.col("_dim")).select("dim", F.col("_shard").alias("shard"), "block", "query_id", "vector")  # each shard is asked each query
    held = (index.join(asked.select(F.col("dim").alias("_dim"), F.col("block").alias("_block")).distinct(), F.col("dim") == F.col("_dim"))
            .select("dim", "shard", F.col("_block").alias("block"), "node", "vector", "ids", "edges", "medoid"))
    by, parts = ["dim", "shard", "block"], 2 * (held.select("dim", "shard", "block").distinct().count() or 1)
    got = (held.repartition(parts, *by).groupBy(*by).cogroup(sent.repartition(parts, *by).groupBy(*by))
           .applyInPandas(_ask(k, beam), "query_id long, vec_id long, score double"))
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return got.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", **how) -> DataFrame:
    """Index all usable rows and search those that ``is_query`` (a condition on vec_id) picks.

    Rows with a null id or vector, a null, infinite or NaN component, or only
    zeros take no part.  Repeated rows count once; of several vectors under one
    id each is a candidate, and the query is the smallest vector of its id.
    """
    used = cut_lineage(usable(rows, id_col, vector_col))
    index = build(used, k + 1, **how)
    queries = used.where(is_query(F.col("vec_id"))).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    return search(index, cut_lineage(queries), k)
