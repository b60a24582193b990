"""Nearest neighbours by inner product: a hierarchical navigable small-world graph per shard, results merged.

Equal vectors are one node (a vector shared by a third of the rows is indexed once; its smallest ids are expanded at
the end). Nodes are dealt by hash into shards of about ``SHARD_ROWS``; each shard's graph is built in one task and
stored as flat arrays: nodes in descending order of their level, so a layer's nodes are a prefix, and per layer
one array of neighbours. Queries are dealt in blocks to every shard, and each query's results are merged.

Largest inner product becomes nearest neighbour by one more coordinate, which gives all vectors of a shard the same
norm (0 for queries). Searches and insertions run for many nodes at once, in numpy.

Scores are the inner products of the original vectors in double precision. Ids decide ties.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and null ids, take no part;
vectors are compared only with those of their length; of several rows with one id the one with the smallest
vector hash counts; fewer candidates than ``TOP`` give all that the graph reaches, in shards up to ``EF`` nodes all;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbus.llm.common import cut, work_folder

TOP = 20
SHARD_ROWS, BLOCK = 8192, 2048
M, M0 = 12, 24              # neighbours of a node in the upper layers and in layer 0
EF_BUILD, EF = 64, 160      # width of the beam
AT_ONCE = 256
EXPAND = 4                  # nodes of the beam that one step expands


class Graph:
    def __init__(self, vectors: np.ndarray, levels: np.ndarray):
        """``vectors``: double, in descending order of ``levels``."""
        self.x = vectors
        norms = np.einsum("ij,ij->i", vectors, vectors)
        more = np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))
        self.y = np.hstack([vectors, more[:, None]]).astype(np.float32)
        self.levels = levels
        top = int(levels.max(initial=0))
        self.sizes = [int((levels >= k).sum()) for k in range(top + 1)]
        self.links = [np.full((n, M0 if k == 0 else M), -1, dtype=np.int32) for k, n in enumerate(self.sizes)]

    # --- stored form ---
    def arrays(self) -> dict:
        return {"vectors": self.x.tobytes(), "dim": self.x.shape[1], "levels": self.levels.astype(np.int32).tobytes(),
                "links": b"".join(a.tobytes() for a in self.links)}

    @classmethod
    def stored(cls, row) -> "Graph":
        levels = np.frombuffer(row["levels"], np.int32)
        g = cls(np.frombuffer(row["vectors"], np.float64).reshape(len(levels), -1), levels)
        flat, at = np.frombuffer(row["links"], np.int32), 0
        for k, a in enumerate(g.links):
            g.links[k] = flat[at:at + a.size].reshape(a.shape)
            at += a.size
        return g

    # --- search ---
    def beam(self, q: np.ndarray, entry: np.ndarray, layer: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarity), descending, of a best-first search of each query from its entry nodes (-1: none)."""
        links, n = self.links[layer], self.sizes[layer]
        rows = len(q)
        # one more column takes the marks of "no node"
        seen = np.zeros((rows, n + 1), dtype=bool)
        every = np.arange(rows)[:, None]
        ids = np.full((rows, ef), -1, dtype=np.int64)
        sim = np.full((rows, ef), -np.inf, dtype=np.float32)
        k = min(ef, entry.shape[1])
        first = np.einsum("rkd,rd->rk", self.y[entry], q)
        first[entry < 0] = -np.inf
        order = np.argsort(-first, axis=1)[:, :k]
        ids[:, :k] = np.take_along_axis(entry, order, 1)
        sim[:, :k] = np.take_along_axis(first, order, 1)
        seen[every, entry] = True
        done = ids < 0
        active = np.arange(rows)
        while len(active):
            open_ = np.where(done[active], -np.inf, sim[active])
            some = min(EXPAND, ef)
            pick = np.argpartition(-open_, some - 1, axis=1)[:, :some] if some < ef else np.tile(np.arange(ef), (len(active), 1))
            good = np.take_along_axis(open_, pick, 1) > -np.inf
            go = good.any(axis=1)
            active, pick, good = active[go], pick[go], good[go]
            if not len(active):
                break
            a = active[:, None]
            node = np.where(good, ids[a, pick], -1)
            done[a, pick] = True
            near = np.where(node[:, :, None] >= 0, links[node], -1).reshape(len(active), -1).astype(np.int64)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[a, near]] = -1
            seen[a, near] = True
            keep = int((near >= 0).sum(axis=1).max(initial=0))
            if not keep:
                continue
            near = -np.sort(-near, axis=1)[:, :keep]
            s = np.einsum("rkd,rd->rk", self.y[near], q[active])
            s[near < 0] = -np.inf
            all_s = np.hstack([sim[active], s])
            order = np.argpartition(-all_s, ef - 1, axis=1)[:, :ef]
            ids[active] = np.take_along_axis(np.hstack([ids[active], near]), order, 1)
            sim[active] = np.take_along_axis(all_s, order, 1)
            done[active] = np.take_along_axis(np.hstack([done[active], near < 0]), order, 1)
        order = np.argsort(-sim, axis=1)
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)

    def search(self, queries: np.ndarray, top: int, ef: int = EF) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, inner products in double precision) of each query, nearest first; -1 where there is none."""
        top, n = min(top, len(self.x)), len(self.x)
        out_i, out_s = np.full((len(queries), top), -1, np.int64), np.full((len(queries), top), -np.inf)
        for at in range(0, len(queries), AT_ONCE):
            exact = queries[at:at + AT_ONCE]
            q = np.hstack([exact, np.zeros((len(exact), 1))]).astype(np.float32)
            if n <= ef:
                ids = np.tile(np.arange(n), (len(q), 1))
            else:
                ids = np.zeros((len(q), 1), dtype=np.int64)
                for layer in range(len(self.links) - 1, 0, -1):
                    ids = self.beam(q, ids, layer, 4)[0]
                ids = self.beam(q, ids, 0, ef)[0][:, :top + 8]
            s = np.einsum("rkd,rd->rk", self.x[ids], exact)
            s[ids < 0] = -np.inf
            order = np.argsort(-s, axis=1, kind="stable")[:, :top]
            got = np.take_along_axis(s, order, 1)
            out_s[at:at + len(q)] = got
            out_i[at:at + len(q)] = np.where(got > -np.inf, np.take_along_axis(ids, order, 1), -1)
        return out_i, out_s

    # --- construction ---
    def choose(self, of: np.ndarray, cand: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
        """Neighbours of the nodes ``of``: candidates (descending) nearer to the node than to a chosen one, then the nearest others."""
        rows, width = cand.shape
        v = self.y[cand]
        between = np.einsum("rid,rjd->rij", v, v)
        chosen = np.zeros((rows, width), dtype=bool)
        count = np.zeros(rows, dtype=np.int64)
        for k in range(width):
            close = np.where(chosen, between[:, k, :], -np.inf).max(axis=1)
            ok = (cand[:, k] >= 0) & (close < sim[:, k]) & (count < most)
            chosen[:, k] = ok
            count += ok
        # the chosen first, then the rest by similarity
        rank = np.where(cand < 0, 4 * width, np.where(chosen, 0, width) + np.arange(width))
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        out = np.take_along_axis(cand, order, 1)
        if out.shape[1] < most:
            out = np.hstack([out, np.full((rows, most - out.shape[1]), -1)])
        return out

    def connect(self, layer: int, new: np.ndarray, chosen: np.ndarray) -> None:
        links = self.links[layer]
        most = links.shape[1]
        links[new, :chosen.shape[1]] = chosen
        to, frm = chosen.ravel(), np.repeat(new, chosen.shape[1])
        there = to >= 0
        to, frm = to[there].astype(np.int64), frm[there].astype(np.int64)
        order = np.argsort(to, kind="stable")
        to, frm = to[order], frm[order]
        nodes, first, counts = np.unique(to, return_index=True, return_counts=True)
        for at in range(0, len(nodes), 512):
            v, f, c = nodes[at:at + 512], first[at:at + 512], counts[at:at + 512]
            wide = int(c.max())
            add = np.full((len(v), wide), -1, dtype=np.int64)
            r = np.repeat(np.arange(len(v)), c)
            add[r, np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)] = frm[np.repeat(f, c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)]
            cand = np.hstack([links[v].astype(np.int64), add])
            cand.sort(axis=1)
            cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
            sim = np.einsum("rkd,rd->rk", self.y[cand], self.y[v])
            sim[cand < 0] = -np.inf
            order = np.argsort(-sim, axis=1, kind="stable")[:, :2 * most]
            links[v] = self.choose(v, np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1), most)

    def build(self) -> "Graph":
        n, at, some = len(self.x), 0, 32
        while at < n:
            to = min(n, at + some)
            some = min(AT_ONCE, 2 * some)
            new = np.arange(at, to)
            q = self.y[new]
            own = q @ q.T
            np.fill_diagonal(own, -np.inf)
            entry = np.zeros((len(new), 1), dtype=np.int64)
            for layer in range(len(self.links) - 1, -1, -1):
                here = new[self.levels[new] >= layer]
                before = min(at, self.sizes[layer])
                if before:
                    ids, sim = self.beam(q, entry, layer, EF_BUILD if len(here) else 4)
                    entry = ids
                else:
                    ids, sim = np.full((len(new), 1), -1, np.int64), np.full((len(new), 1), -np.inf, np.float32)
                if len(here):
                    k = len(here)                       # nodes are in descending order of level: a prefix of the new ones
                    near = np.argsort(-own[:k, :k], axis=1, kind="stable")[:, :16]
                    cand = np.hstack([ids[:k], new[near]])
                    s = np.hstack([sim[:k], np.take_along_axis(own[:k, :k], near, 1)])
                    cand = np.where(np.isfinite(s), cand, -1)
                    order = np.argsort(-s, axis=1, kind="stable")[:, :EF_BUILD]
                    chosen = self.choose(here, np.take_along_axis(cand, order, 1), np.take_along_axis(s, order, 1), M)
                    self.connect(layer, here, chosen)
                if not before:
                    entry = np.zeros((len(new), 1), dtype=np.int64) if at else entry
            at = to
        return self


def levels_of(ids: np.ndarray) -> np.ndarray:
    """Level of each node from a hash of its id: geometric, with 1 / M of a layer's nodes in the next."""
    h = (ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    u = ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(M)).astype(np.int32)


INDEX = "dim int, shard int, ids binary, vectors binary, levels binary, links binary"


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    ids = pdf["node"].to_numpy(np.int64)
    levels = levels_of(ids)
    order = np.lexsort((ids, -levels))
    x = np.array(pdf["v"].tolist(), dtype=np.float64)[order]
    g = Graph(x, levels[order]).build()
    return pd.DataFrame([{"dim": int(pdf["dim"].iat[0]), "shard": int(pdf["shard"].iat[0]), "ids": ids[order].tobytes(), **g.arrays()}])[
        ["dim", "shard", "ids", "vectors", "levels", "links"]]


def _search(top, ef):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"q": pd.Series(dtype="int64"), "node": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(index) or not len(queries):
            return empty
        g, ids = Graph.stored(index.iloc[0]), np.frombuffer(index["ids"].iat[0], np.int64)
        nodes, scores = g.search(np.array(queries["v"].tolist(), dtype=np.float64), top, ef)
        there = nodes >= 0
        q = np.repeat(queries["q"].to_numpy(np.int64), nodes.shape[1]).reshape(nodes.shape)
        return pd.DataFrame({"q": q[there], "node": ids[nodes[there]], "score": scores[there]})
    return run


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, v, dim, h1, h2``: rows that take part, one for each id."""
    ok = (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
          .filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
          .filter("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(v, x -> x != 0)"))
    ok = ok.select("vec_id", "v", F.size("v").alias("dim"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2"))
    return ok.groupBy("vec_id").agg(F.min(F.struct("h1", "h2", "dim", "v")).alias("r")).select("vec_id", "r.*")


def build_index(nodes: DataFrame) -> DataFrame:
    """One row of flat arrays per shard of ``nodes`` (``node, v, dim``)."""
    counts = nodes.groupBy("dim").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"))
    dealt = nodes.join(counts, "dim").withColumn("shard", F.expr("cast(pmod(xxhash64(node), shards) as int)"))
    return dealt.select("dim", "shard", "node", "v").groupBy("dim", "shard").applyInPandas(_build, INDEX)


def search(index: DataFrame, queries: DataFrame, top: int, ef: int = EF) -> DataFrame:
    """``q, node, score``: the ``top`` nearest nodes of each query (``q, v, dim``) over all shards of its length."""
    shards = index.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    blocks = queries.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    asked = (queries.join(shards, "dim").join(blocks, "dim")
             .select("q", "v", "dim", F.expr("cast(pmod(xxhash64(q), blocks) as int)").alias("block"),
                     F.explode(F.expr("sequence(0, shards - 1)")).alias("shard")))
    copies = index.join(blocks, "dim").select("*", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block")).drop("blocks")
    keys = ["dim", "shard", "block"]
    found = copies.groupBy(keys).cogroup(asked.groupBy(keys)).applyInPandas(_search(top, ef), "q long, node long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "node")
    return found.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= top).drop("k")


def nearest(rows: DataFrame, every: int = 20, top: int = TOP, ef: int = EF) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` its nearest other rows."""
    spark = rows.sparkSession
    root = work_folder(spark, "hnsw")
    rows = cut(usable(rows), root, "rows")
    key = ["h1", "h2", "dim"]
    classes = rows.groupBy(key).agg(F.min("vec_id").alias("node"))
    member = cut(rows.select("vec_id", *key).join(classes, key).select("vec_id", "node"), root, "members")
    nodes = rows.join(classes.select(F.col("node").alias("vec_id")), "vec_id", "left_semi").select(F.col("vec_id").alias("node"), "v", "dim")
    nodes = cut(nodes, root, "nodes")
    index = cut(build_index(nodes), root, "index")
    asking = member.filter(F.col("vec_id") % every == 0)
    queries = nodes.join(asking.select("node").distinct(), "node", "left_semi").withColumnRenamed("node", "q")
    found = search(index, queries, top + 1, ef)
    # of a vector that many rows share, only the smallest ids can be among the nearest
    first = Window.partitionBy("node").orderBy("vec_id")
    few = member.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= top + 1).drop("k")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    of_class = cut(found.join(few, "node").withColumn("k", F.row_number().over(best)).filter(F.col("k") <= top + 1)
                   .select(F.col("q").alias("node"), "vec_id", "score", "k"), root, "found")
    own = (of_class.withColumnRenamed("vec_id", "found")
           .join(asking.withColumnRenamed("vec_id", "query_id"), "node"))
    # each query misses at most its own row, so ranks only move up by one behind it
    mine = of_class.select(F.col("vec_id").alias("query_id"), "node", F.col("k").alias("mine"))
    return (own.join(mine, ["query_id", "node"], "left").filter("found != query_id")
            .withColumn("rank", (F.col("k") - F.when(F.col("mine") < F.col("k"), 1).otherwise(0)).cast("int"))
            .filter(F.col("rank") <= top)
            .select("query_id", "rank", F.col("found").alias("vec_id"), "score"))
