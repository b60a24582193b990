"""Near-duplicate embeddings by int8 quantised tile products.

Within a label (and vector length) distinct vectors are dealt into chunks, and every two chunks make a tile. Each unit
vector u is stored as int8 values q times a scale s; the rest r = u - s q is never stored, only its length e. For two
vectors, u.w = (s_u q_u).(s_w q_w) + (s_u q_u).r_w + r_u.w, so the product of the quantised tiles is off by at most
|s_u q_u| e_w + e_u: a bound for every pair, from two numbers a vector. Pairs that may reach the threshold
under their bound are computed again in double precision; all others are proved to be below it.

The products of integers are exact: blocks of 1,024 dimensions sum to less than 2^24 in single precision.

Equal vectors are one class with a multiplicity from the start. A tile emits, for each of its vectors that has links,
how many they are and one vector of its component within the tile: never the pairs, so a cloud of near copies costs
its rows and not their square. Components over tiles come from the star steps of ``near_dup.components``.
Work is rows squared / 2 int8 products a label, as the method has it; a chunk is shipped once for each other
chunk of its label, so larger chunks ship less, and ``CHUNK_BYTES`` bounds what a task holds.

Defined results: rows whose label, vector or ``vec_id`` is null, whose vector is empty, zero or holds null or
non-finite entries link with nothing; vectors of different lengths never link; repeated rows are vectors each
(links count them); extra columns are ignored. A null ``vec_id`` has a null component and is kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import cut, work_folder
from nimbus.llm.near_dup import components

LEAST = 0.93
CHUNK_ROWS, CHUNK_BYTES = 4096, 32 << 20
STRIP = 512                 # rows of a tile that are multiplied at once
EXACT_DIMS = 1024           # 1024 * 127 * 127 < 2^24
PAIRS_AT_ONCE = 1 << 15
SLACK = 1e-9                # above every rounding of the bound itself

KEY = ["label", "dim", "h1", "h2"]
CHUNK = ("label string, dim int, chunk int, size int, q binary, scale binary, rest binary, length binary, v binary, "
         "wide boolean, rep binary, h1 binary, h2 binary, times binary")
_MANY = ("q", "scale", "rest", "length", "v", "rep", "h1", "h2", "times")
NODE = "struct<rep: bigint, h1: bigint, h2: bigint>"
FOUND = "rep long, h1 long, h2 long, links long, to_rep long, to_h1 long, to_h2 long"


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, so that no square over- or underflows; cosines stay the same."""
    _, e = np.frexp(np.abs(v).max(axis=1))
    half = e // 2
    return np.ldexp(np.ldexp(v, -half[:, None]), -(e - half)[:, None])


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale, a bound of the rest's length and a bound of the quantised vector's length, for each row."""
    v = scaled(v)
    u = v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None])
    near = q * scale[:, None]
    rest = np.sqrt(np.einsum("ij,ij->i", u - near, u - near)) + SLACK
    return q.astype(np.int8), scale, rest, np.sqrt(np.einsum("ij,ij->i", near, near)) + SLACK


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of two int8 tiles."""
    total = np.zeros((len(q), len(p)))
    for at in range(0, q.shape[1], EXACT_DIMS):
        total += q[:, at:at + EXACT_DIMS].astype(np.float32) @ p[:, at:at + EXACT_DIMS].astype(np.float32).T
    return total


def cosines(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """In double precision, row by row."""
    v, w = scaled(v), scaled(w)
    dot = np.einsum("ij,ij->i", v, w)
    return dot / (np.sqrt(np.einsum("ij,ij->i", v, v)) * np.sqrt(np.einsum("ij,ij->i", w, w)))


class Forest:
    """Components of the nodes 0..n-1; ``root`` is the smallest node of each."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = self.root[self.root]
                if np.array_equal(above, self.root):
                    break
                self.root = above


class Chunk:
    def __init__(self, row):
        d = int(row["dim"])
        self.q = np.frombuffer(row["q"], np.int8).reshape(-1, d)
        self.v = np.frombuffer(row["v"], np.float64 if row["wide"] else np.float32).reshape(-1, d)
        self.scale, self.rest, self.length = (np.frombuffer(row[c]) for c in ("scale", "rest", "length"))
        self.nodes = np.stack([np.frombuffer(row[c], np.int64) for c in ("rep", "h1", "h2")], axis=1)
        self.times = np.frombuffer(row["times"], np.int64)

    def possible(self, other: "Chunk", at: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a strip of this chunk with ``other`` whose cosine may reach the threshold."""
        s = slice(at, at + STRIP)
        near = products(self.q[s], other.q) * self.scale[s, None] * other.scale
        off = self.length[s, None] * other.rest + self.rest[s, None]
        return np.nonzero(near + off + SLACK >= LEAST)


def _tile(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links and a spanning forest of one tile: one or two chunks."""
    chunks = [Chunk(r) for r in pdf.sort_values("chunk").to_dict("records")]
    a, b = chunks[0], chunks[-1]
    same = pdf["low"].iat[0] == pdf["high"].iat[0]
    if not same and len(chunks) == 1:       # no vector was dealt to the other chunk
        return pd.DataFrame({c.split()[0]: pd.Series(dtype="int64") for c in FOUND.split(", ")})
    n = len(a.q) if same else len(a.q) + len(b.q)
    start = 0 if same else len(a.q)
    links, forest = np.zeros(n, np.int64), Forest(n)
    for at in range(0, len(a.q), STRIP):
        i, j = a.possible(b, at)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), PAIRS_AT_ONCE):
            x, y = i[k:k + PAIRS_AT_ONCE], j[k:k + PAIRS_AT_ONCE]
            linked = cosines(a.v[x].astype(np.float64), b.v[y].astype(np.float64)) >= LEAST
            x, y = x[linked], y[linked]
            links += np.bincount(x, b.times[y], n).astype(np.int64) + np.bincount(start + y, a.times[x], n).astype(np.int64)
            forest.join(x, start + y)
    there = np.flatnonzero(links)
    nodes = a.nodes if same else np.concatenate([a.nodes, b.nodes])
    own, top = nodes[there], nodes[forest.root[there]]
    return pd.DataFrame({"rep": own[:, 0], "h1": own[:, 1], "h2": own[:, 2], "links": links[there],
                         "to_rep": top[:, 0], "to_h1": top[:, 1], "to_h2": top[:, 2]})


def _chunk(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["rep", "h1", "h2"])
    v = np.array(pdf["v"].tolist(), dtype=np.float64)
    q, scale, rest, length = quantised(v)
    with np.errstate(over="ignore"):
        single = v.astype(np.float32)
    wide = not np.array_equal(single.astype(np.float64), v)
    cols = dict(q=q, scale=scale, rest=rest, length=length, v=v if wide else single,
                **{c: pdf[c].to_numpy(np.int64) for c in ("rep", "h1", "h2", "times")})
    return pd.DataFrame([{"label": pdf["label"].iat[0], "dim": int(pdf["dim"].iat[0]), "chunk": int(pdf["chunk"].iat[0]),
                          "size": len(pdf), "wide": wide, **{c: np.ascontiguousarray(x).tobytes() for c, x in cols.items()}}])[
        [c.split()[0] for c in CHUNK.split(", ")]]


def takes_part():
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) & finite
                      & F.exists(v, lambda x: x != 0), F.lit(False))


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, dim, h1, h2, v`` of the rows that take part."""
    ok = rows.filter(takes_part()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                                          F.col("embedding").cast("array<double>").alias("v"))
    return ok.select("vec_id", "label", F.size("v").alias("dim"), F.xxhash64("v").alias("h1"),
                     F.xxhash64(F.lit(7), "v").alias("h2"), "v")


def chunks_of(classes: DataFrame, chunk_rows: int) -> DataFrame:
    """One row of flat arrays for each chunk of the classes (``label, dim, rep, h1, h2, times, v``)."""
    most = F.greatest(F.lit(1), F.least(F.lit(chunk_rows), F.floor(F.lit(CHUNK_BYTES) / (9 * F.col("dim")))))
    counts = classes.groupBy("label", "dim").agg(F.count("*").alias("rows")).withColumn("chunks", F.ceil(F.col("rows") / most).cast("int"))
    dealt = (classes.join(counts, ["label", "dim"])
             .withColumn("chunk", F.expr("cast(pmod(xxhash64(h2, h1), chunks) as int)")))
    return (dealt.select("label", "dim", "chunk", "rep", "h1", "h2", "times", "v")
            .groupBy("label", "dim", "chunk").applyInPandas(_chunk, CHUNK))


def near_duplicates(rows: DataFrame, root: str | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``rows`` (``vec_id``, ``embedding``, ``label``)."""
    spark = rows.sparkSession
    root = root or work_folder(spark, "quantised-dup")
    good = usable(rows)
    classes = cut(good.groupBy(*KEY).agg(F.min("vec_id").alias("rep"), F.count("*").alias("times"), F.first("v").alias("v")),
                  root, "classes")
    chunks = cut(chunks_of(classes, chunk_rows), root, "chunks")
    counts = chunks.groupBy("label", "dim").agg((F.max("chunk") + 1).alias("chunks"))
    tiles = counts.agg(F.sum(F.expr("cast(chunks as long) * (chunks + 1) / 2"))).first()[0] or 1
    # the two chunks of a tile meet by the tile's key, so a large label is spread over many tasks
    tasks = int(min(tiles, 4 * spark.sparkContext.defaultParallelism))
    key = ["label", "dim", "low", "high"]
    sides = (chunks.join(counts, ["label", "dim"]).withColumn("with", F.explode(F.expr("sequence(0, chunks - 1)")))
             .withColumn("low", F.least("chunk", "with")).withColumn("high", F.greatest("chunk", "with")).drop("with", "chunks")
             .repartition(tasks, *key))
    found = cut(sides.groupBy(*key).applyInPandas(_tile, FOUND), root, "found")
    node = F.struct("rep", "h1", "h2").cast(NODE)
    edges = (found.select(node.alias("a"), F.struct("to_rep", "to_h1", "to_h2").cast(NODE).alias("b")).filter("a != b"))
    comps = components(edges, root, "components").select(F.col("id").alias("node"), F.col("comp.rep").alias("component"))
    links = found.groupBy(node.alias("node")).agg(F.sum("links").alias("links"))
    of_class = cut(classes.select(*KEY, "times", "rep", node.alias("node")).join(links, "node", "left").join(comps, "node", "left")
                   .select(*KEY, (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                           F.coalesce("component", "rep").alias("component")), root, "of-class")
    mine = good.select("vec_id", *KEY).join(of_class, KEY).select("vec_id", "n_links", F.col("component").alias("component_id"))
    vec_id = F.col("vec_id").cast("long")
    alone = (rows.filter(~takes_part())
             .select(vec_id.alias("vec_id"), F.lit(0).cast("long").alias("n_links"), vec_id.alias("component_id")))
    return mine.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
