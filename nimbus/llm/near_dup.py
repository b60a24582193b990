"""Near-duplicate documents by b-bit MinHash.

Each document keeps K minima of its shingle set. Bands of ``ROWS`` minima make candidates; of every minimum
only the low ``BITS`` bits are kept, packed into longs, and the similarity of a candidate pair is
estimated from the number of equal b-bit values, corrected for chance collisions. Estimates only discard:
pairs that pass are confirmed on their full shingle sets.

Only connectivity is asked for, so work on large groups is linear: documents with equal sets are one class
from the start; then, in a few rounds, every class meets one random class (the pivot) of each of its
buckets, is confirmed with the most similar one, and what links is contracted. The last round compares, within the
buckets that still hold several components, every pair of classes of different components, so no candidate is
left out. Hot buckets are dealt over many tasks in every round. Components come from alternating
large-star and small-star steps, all in DataFrames.

Texts travel as little as can be: those of the classes that share a bucket are set aside once, and to confirm
pairs each member's text meets its pivot, whose text is sent once for every ``GROUP_ROWS`` members.

Chance that a pair of similarity 0.75 shares no band: (1 - 0.75^4)^32 = 5e-6.

Defined results: a null or empty text, or one of white space, has no shingle and is alone; a null ``doc_id``
takes no part (component null, kept); repeated rows are classes of equal sets as any other; rows that share a
``doc_id`` but not a text are documents each, so two components may have one smallest id; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbus.llm.common import cut, work_folder
from nimbus.llm.shingles import mix, shingle_sets

ROWS, BANDS = 4, 32
K, BITS = 512, 2          # the first ROWS * BANDS minima make the bands, all of them the estimate
LONGS = K * BITS // 64
LEAST = 0.75              # similarity of a link
MARGIN = 0.09             # estimates below LEAST - MARGIN are discarded: 3.9 standard errors, a chance of 5e-5 at 0.75
PIVOT_ROUNDS, BEST = 4, 2
BUCKET_ROWS = 2048        # rows of a hot bucket that one task compares with the bucket
GROUP_ROWS = 512          # members of a pivot that one task confirms with it
BROADCAST_ROWS = 200_000  # of ids or classes (40 bytes each), after counting them; more are joined by a shuffle

_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 1 << 32, K, dtype=np.uint64).astype(np.uint32)
_MUL = _rng.integers(0, 1 << 32, K, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_BAND = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_PART = 1 << 16
SIG = [f"s{i}" for i in range(LONGS)]
CLASS = ["h1", "h2", "n"]
SIGNATURES = f"doc_id long, t1 long, t2 long, n int, h1 long, h2 long, {', '.join(f'{c} long' for c in SIG)}, bands array<long>"


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """K minima (32 bits) of each non-empty set."""
    sizes = np.array([len(s) for s in sets])
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    into = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), K), dtype=np.uint32)
    for k in range(K):
        out[:, k] = np.minimum.reduceat((x ^ _XOR[k]) * _MUL[k], into)
    out ^= out >> np.uint32(16)
    out *= np.uint32(0x7FEB352D)
    out ^= out >> np.uint32(15)
    return out


def packed(low: np.ndarray) -> np.ndarray:
    """The low BITS bits of each row's minima, packed into longs."""
    per = 64 // BITS
    bits = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(low), -1, per)
    return (bits << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64).view(np.int64)


def band_keys(m: np.ndarray) -> np.ndarray:
    parts = m[:, :ROWS * BANDS].astype(np.uint64).reshape(len(m), BANDS, ROWS)
    keys = (parts * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    return mix(keys).view(np.int64)


def _hashes(sets: list[np.ndarray]) -> np.ndarray:
    """Two hashes of each set: equal sets, and in effect only those, have equal pairs."""
    h = np.zeros((2, len(sets)), dtype=np.uint64)
    for i, s in enumerate(sets):
        if len(s):
            h[0, i], h[1, i] = np.sum(s, dtype=np.uint64), np.sum(mix(s + np.uint64(0x51ED270B)), dtype=np.uint64)
    return h.view(np.int64)


def _parts(sets):
    """(first row, sets) of consecutive rows with about ``_PART`` shingles."""
    at, held, size = 0, [], 0
    for s in sets:
        held.append(s)
        size += len(s)
        if size >= _PART:
            yield at, held
            at, held, size = at + len(held), [], 0
    if held:
        yield at, held


def _signatures(batches):
    for batch in batches:
        for at, held in _parts(shingle_sets(batch.column(3))):
            full = [s for s in held if len(s)]
            m = minima(full) if full else np.empty((0, K), np.uint32)
            n = np.array([len(s) for s in held], dtype=np.int32)
            sigs = np.zeros((len(held), LONGS), dtype=np.int64)
            sigs[np.flatnonzero(n)] = packed(m) if full else np.empty((0, LONGS), np.int64)
            offs = np.zeros(len(held) + 1, dtype=np.int32)
            offs[1:] = np.cumsum(np.where(n > 0, BANDS, 0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).slice(at, len(held)) for i in range(3)), pa.array(n), *map(pa.array, _hashes(held)),
                 *(pa.array(np.ascontiguousarray(sigs[:, i])) for i in range(LONGS)),
                 pa.ListArray.from_arrays(pa.array(offs), pa.array(band_keys(m).reshape(-1)))],
                names=["doc_id", "t1", "t2", "n", "h1", "h2", *SIG, "bands"])


def _classed(batches):
    """Texts with the class of their set."""
    for batch in batches:
        for at, held in _parts(shingle_sets(batch.column(1))):
            rows = batch.slice(at, len(held))
            yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, _hashes(held)),
                                              pa.array([len(s) for s in held], pa.int32()), rows.column(1)],
                                             names=["doc_id", *CLASS, "text"])


def _confirm(batches):
    """Of the rows (pivot, part, member, node, text), a pivot's own before its members': the members that are linked with it.

    A link has 100 * |intersection| >= 75 * |union| of the full sets. One set is held, whatever the group.
    """
    pivot = np.empty(0, np.uint64)
    for batch in batches:
        a, b = [], []
        for of, member, node, s in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), shingle_sets(batch.column(4))):
            if not member:
                pivot = s
                continue
            common = len(np.intersect1d(s, pivot, assume_unique=True))
            if 100 * common >= round(100 * LEAST) * (len(s) + len(pivot) - common):
                a.append(node)
                b.append(of)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


_ONES = sum(1 << k for k in range(0, 64, BITS))
_ONES -= _ONES >> 63 << 64


def _differing(x: str) -> str:
    """SQL: of the b-bit values whose exclusive or is the long ``x``, how many are not 0."""
    for k in (1 << e for e in range(BITS.bit_length() - 1)):
        x = f"({x} | shiftrightunsigned({x}, {k}))"
    return f"bit_count({x} & {_ONES}L)"


def _equal(a: str, b: str):
    """How many of the K b-bit values of two packed signatures are equal."""
    return F.expr(f"{K} - (" + " + ".join(_differing(f"({a}.{c} ^ {b}.{c})") for c in SIG) + ")")


def _at_least(equal, k: int, similarity: float):
    c = 2.0 ** -BITS              # b-bit values of different minima are equal by chance
    return equal >= k * (c + (1 - c) * similarity)


def _similar(a: str, b: str):
    """The collision-corrected estimate, and the bound from the set sizes."""
    return F.expr(f"least({a}.n, {b}.n) >= {LEAST}D * greatest({a}.n, {b}.n)") & _at_least(_equal(a, b), K, LEAST - MARGIN)


def components(edges: DataFrame, root: str, name: str) -> DataFrame:
    """(id, comp): for each node of ``edges`` (a, b) the smallest node it is connected with.

    Alternating large-star and small-star steps; each halves the depth of the forest, so the number of rounds
    grows with the logarithm of the longest path.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .filter("u != v").distinct(), root, f"{name}-0")
    mark, step = None, 0
    while True:
        step += 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = cut(large.filter("u != v").distinct(), root, f"{name}-{step}a")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = cut(small, root, f"{name}-{step}b")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            roots = e.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct()
            return e.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(roots)
        mark = now


def _few(df: DataFrame) -> DataFrame:
    """``df``, a written table, marked for broadcasting if its rows were counted to be few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _salted(df: DataFrame, node: str = "id") -> DataFrame:
    """Rows of a bucket (of ``m`` rows) dealt over parts of BUCKET_ROWS."""
    return df.withColumn("salt", F.expr(f"cast(pmod(xxhash64({node}), ceil(m / {BUCKET_ROWS}D)) as int)"))


def _in_every_part(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.expr(f"sequence(0, cast(ceil(m / {BUCKET_ROWS}D) as int) - 1)")))


def _classes(docs: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Signed rows (``doc_id, t1, t2, n, h1, h2``, ...), and per class ``h1, h2, n, comp, component, first``.

    ``comp`` names the component, ``component`` is its smallest doc_id and ``first`` its smallest (doc_id, t1, t2).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t1"),
                       F.xxhash64(F.lit(1), "text").alias("t2"), "text")
    signed = cut(docs.mapInArrow(_signatures, SIGNATURES), root, "signed")
    whole = signed.filter("n > 0 AND doc_id IS NOT NULL")
    # everything but the id is the same in a class; the number given to a class stands in the written table
    unique = cut(whole.groupBy(*CLASS).agg(F.min(F.struct("doc_id", "t1", "t2")).alias("first"),
                                           *(F.first(c).alias(c) for c in (*SIG, "bands")))
                 .withColumn("id", F.monotonically_increasing_id()), root, "unique")

    dealt = unique.select("id", F.posexplode("bands").alias("band", "key"))
    shared = cut(dealt.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), root, "shared")
    members = cut(dealt.join(shared, "key"), root, "members")
    bands = unique.select("id", "bands")
    sig = unique.select("id", "n", *SIG)

    # texts of the classes that share a bucket, read once for all rounds
    wanted = cut(unique.join(members.select("id").distinct(), "id", "left_semi")
                 .select("id", F.col("first.doc_id").alias("doc_id"), *CLASS), root, "wanted")
    ids = _few(cut(wanted.select("doc_id").distinct(), root, "wanted-ids"))
    texts = cut(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
                .mapInArrow(_classed, "doc_id long, h1 long, h2 long, n int, text string")
                .join(_few(wanted), ["doc_id", *CLASS]).select("id", "text").dropDuplicates(["id"]), root, "texts")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        pairs = cut(pairs.select("a", "b").distinct(), root, f"pairs-{name}")
        sizes = pairs.groupBy("b").agg(F.expr(f"cast(ceil(count(*) / {GROUP_ROWS}D) as int)").alias("parts"))
        of = pairs.join(sizes, "b").select("a", "b", F.expr("cast(pmod(xxhash64(a), parts) as int)").alias("part"))
        rows = (of.join(texts, of.a == texts.id).select("b", "part", F.lit(1).alias("member"), F.col("a").alias("node"), "text")
                .unionByName(sizes.select("b", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
                             .join(texts, F.col("b") == texts.id)
                             .select("b", "part", F.lit(0).alias("member"), F.col("b").alias("node"), "text")))
        met = rows.repartition("b", "part").sortWithinPartitions("b", "part", "member")
        return cut(met.mapInArrow(_confirm, "a long, b long"), root, f"links-{name}")

    def contracted(comps: DataFrame | None, links: DataFrame, name: str) -> DataFrame:
        """``comps`` (id, comp) after joining the components that ``links`` connects."""
        if comps is None:
            return cut(components(links, root, name), root, f"{name}-comps")
        for c in ("a", "b"):
            links = (links.join(comps.select(F.col("id").alias(c), F.col("comp").alias(f"{c}_")), c, "left")
                     .withColumn(c, F.coalesce(f"{c}_", c)).drop(f"{c}_"))
        merged = components(links, root, name).select(F.col("id").alias("comp"), F.col("comp").alias("to"))
        old = comps.join(merged, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"))
        new = merged.join(comps.select(F.col("id").alias("comp")), "comp", "left_anti")
        return cut(old.unionByName(new.select(F.col("comp").alias("id"), F.col("to").alias("comp"))), root, f"{name}-comps")

    tested, left, comps = None, members.withColumn("comp", F.col("id")), None
    for k in range(PIVOT_ROUNDS + 1):
        if comps is not None:
            left = members.join(comps, "id", "left").select("key", "band", "m", "id", F.coalesce("comp", "id").alias("comp"))
        mixed = (left.groupBy("key").agg(F.max("m").alias("m"), F.min("comp").alias("least"), F.max("comp").alias("most"))
                 .filter("least != most").select("key", "m"))
        rows = cut(_salted(left).join(_in_every_part(mixed).drop("m"), ["key", "salt"]), root, f"rows-{k}")
        if k < PIVOT_ROUNDS:
            # each bucket's pivot, another one in every bucket and round; of those a class meets, the most similar
            pivots = (rows.groupBy("key").agg(F.max("m").alias("m"), F.min(F.struct(F.xxhash64("id", "key", F.lit(k)).alias("o"), "id", "comp")).alias("p"))
                      .select("key", "m", F.col("p.id").alias("pivot"), F.col("p.comp").alias("other")))
            star = (rows.join(_in_every_part(pivots).drop("m"), ["key", "salt"]).filter("comp != other")
                    .select("id", "pivot").distinct())
            a, b = sig.alias("a"), sig.alias("b")
            pairs = (star.alias("p").join(a, F.expr("a.id = p.id")).join(b, F.expr("b.id = p.pivot"))
                     .filter(_similar("a", "b")).select(F.expr("a.id").alias("a"), F.expr("b.id").alias("b"), _equal("a", "b").alias("e")))
            # pairs that failed before make room for others; the last round may confirm those few again
            if tested is not None:
                pairs = pairs.join(tested, [F.least(pairs.a, pairs.b) == tested.x, F.greatest(pairs.a, pairs.b) == tested.y], "left_anti")
            best = Window.partitionBy("a").orderBy(F.desc("e"), "b")
            pairs = pairs.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= BEST)
        else:
            wide = (rows.join(sig, "id").join(bands, "id")
                    .select("key", "band", "id", "comp", "n", *SIG, "bands", "m", "salt"))
            # a pair comes from the first band it shares
            first = F.expr("NOT arrays_overlap(slice(a.bands, 1, a.band), slice(b.bands, 1, a.band))")
            a, b = wide.alias("a"), _in_every_part(wide.drop("salt")).alias("b")
            pairs = (a.join(b, F.expr("a.key = b.key AND a.salt = b.salt AND a.comp < b.comp") & _similar("a", "b") & first)
                     .select(F.expr("a.id").alias("a"), F.expr("b.id").alias("b")))
        found = confirmed(pairs, str(k))
        done = (spark.read.schema("a long, b long").parquet(f"{root}/pairs-{k}")
                .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")))
        tested = done if tested is None else tested.unionByName(done)
        if not found.isEmpty():
            comps = contracted(comps, found, f"cc{k}")
    if comps is None:
        comps = spark.createDataFrame([], "id long, comp long")
    named = cut(unique.select("id", *CLASS, "first").join(comps, "id", "left")
                .select(*CLASS, "first", F.coalesce("comp", "id").alias("comp")), root, "named")
    least = named.groupBy("comp").agg(F.min("first").alias("first"))
    return signed, cut(named.drop("first").join(least, "comp").withColumn("component", F.col("first.doc_id")), root, "of-class")


def near_duplicates(docs: DataFrame, root: str | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id``, ``text``)."""
    signed, of_class = _classes(docs, root or work_folder(docs.sparkSession, "near-dup"))
    part = F.expr("n > 0 AND doc_id IS NOT NULL")
    return (signed.select("doc_id", "n", *(F.when(part, F.col(c)).alias(c) for c in ("h1", "h2")))
            .join(of_class.select(*CLASS, "component"), CLASS, "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, root: str | None = None) -> DataFrame:
    """One row of each group of near duplicates; rows without words or without id all stay.

    A row is known by its id and two hashes of its text, so of rows that share an id only near duplicates go.
    """
    root = root or work_folder(docs.sparkSession, "near-dup")
    signed, of_class = _classes(docs, root)
    row = ["doc_id", "t1", "t2"]
    rows = (signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*row, *CLASS).agg(F.count("*").alias("times"))
            .join(of_class.select(*CLASS, "first"), CLASS)
            .select(*row, "times", (F.struct(*row) == F.struct(*(F.col(f"first.{c}") for c in row))).alias("stays")))
    rows = cut(rows.filter("times > 1 OR NOT stays"), root, "not-single")
    own = {"doc_id": F.col("doc_id").cast("long"), "t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")}
    marks = rows.select(*(F.col(c).alias(f"__{c}") for c in row), "stays")

    def same(some: DataFrame):
        """Rows of ``docs`` that are one of ``some``."""
        return [own[c] == some[f"__{c}"] for c in row]

    kept = docs.join(some := _few(marks), same(some), "left_anti")
    again = cut(marks.filter("stays").drop("stays"), root, "repeated")
    if again.isEmpty():
        return kept
    # the row that stays, where it stands several times
    once = docs.join(some := _few(again), same(some), "left_semi")
    keys = {f"__near_dup_{c}": own[c] for c in row}
    return kept.unionByName(once.withColumns(keys).dropDuplicates([*keys]).drop(*keys))
