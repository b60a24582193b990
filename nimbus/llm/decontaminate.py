"""Benchmark passages in documents, by the q-gram lemma.

Texts are compared in lower case, every run of other signs than letters and digits being one space. A passage of
``n`` characters may differ by ``e = RATE * n`` edits; a region within ``e`` edits shares at least
``(n - Q + 1) - Q * e`` of its q-grams, on diagonals (place in the document minus place in the passage) that
are at most ``e`` apart. Shared q-grams are counted in diagonal bands of twice that width that overlap by half, so
one band holds them all; bands that reach the bound are verified by an alignment limited to the band's diagonals.

The passages are dealt into blocks of about ``BLOCK_CHARS`` characters, a bounded broadcast each; documents are
scanned where they lie, whole, without a shuffle.

Defined results: null or empty texts hold nothing; a passage that is null or has no letter or digit is not
searched; passages shorter than a q-gram match only a document that is equal to them; equal passages are
reported under their smallest id; repeated documents are reported each; extra columns are kept by
``drop_contaminated`` and ignored else. Overlapping finds of one passage are one, with the fewest edits.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import cut, parts, work_folder

Q = 12
RATE = 0.05
BLOCK_CHARS = 4 << 20
PART_CHARS = 1 << 18
BITMAP = 22
MATCHES = 'doc_id long, item_id long, start long, "end" long, edits int'.replace('"', "`")

_OTHER = re.compile(r"[\W_]+")
_B = np.uint32(0x9E3779B1)
_B2, _B4 = (np.uint32(pow(int(_B), k, 1 << 32)) for k in (2, 4))
_APART = np.uint32(0x110000)         # no character: stands between texts


def normal(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


@lru_cache(maxsize=1)
def _signs() -> np.ndarray:
    """For each code point whether it is a letter or digit, as ``_OTHER`` says."""
    out = np.zeros(0x110001, dtype=bool)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for m in re.finditer(r"[^\W_]+", "".join(map(chr, points))):
        out[points[m.start()]:points[m.end() - 1] + 1] = True
    out[0xD800:0xE000] = False
    return out


def normals(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the normal forms one after the other, ``_APART`` after each, and their starts and lengths."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("\0".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    ends = np.cumsum([len(t) + 1 for t in low]) - 1
    codes[ends] = _APART
    sign = _signs()[codes]
    sign[ends] = True
    space = ~sign
    # of a run of other signs the first is a space, unless a text begins or ends there
    first = space.copy()
    first[1:] &= sign[:-1]
    codes[space] = 32
    at = np.flatnonzero(sign | first)
    codes = codes[at]
    blank = codes == 32
    drop = blank.copy()
    drop[1:] &= codes[:-1] == _APART
    if len(blank):
        drop[:-1] |= blank[:-1] & (codes[1:] == _APART)
    codes = codes[~drop]
    ends = np.flatnonzero(codes == _APART)
    starts = np.append(0, ends[:-1] + 1)[:len(ends)]
    return codes, starts, ends - starts


def places(text: str) -> list[int]:
    """For each character of ``normal(text)`` its place in ``text``, and the text's end."""
    out, low = [], []
    for i, c in enumerate(text):
        low += [(x, i) for x in c.lower()]
    joined, at = "".join(x for x, _ in low), 0
    for m in _OTHER.finditer(joined):
        out += [low[i][1] for i in range(at, m.start())]
        if out and m.end() < len(joined):
            out.append(low[m.start()][1])
        at = m.end()
    return [*out, *(low[i][1] for i in range(at, len(joined))), len(text)]


def qgrams(codes: np.ndarray) -> np.ndarray:
    """Hash of the Q = 8 + 4 characters from each place on."""
    if len(codes) < Q:
        return np.empty(0, np.uint32)
    c = (codes + np.uint32(1)) * np.uint32(0x85EBCA6B)
    two = c[:-1] * _B + c[1:]
    four = two[:-2] * _B2 + two[2:]
    eight = four[:-4] * _B4 + four[4:]
    h = eight[:-4] * _B4 + four[8:]
    return h ^ (h >> np.uint32(15))


class Index:
    """Q-grams of a block of passages: bitmap, sorted hashes and postings (passage, place)."""

    def __init__(self, items: list[tuple[int, str]]):
        first: dict[str, int] = {}
        for i, text in items:
            n = normal(text or "")
            if n:
                first[n] = min(first.get(n, i), i)
        self.short = {n: i for n, i in first.items() if len(n) < Q}
        kept = sorted((i, n) for n, i in first.items() if len(n) >= Q)
        self.ids = [i for i, _ in kept]
        self.codes = [np.frombuffer(n.encode("utf-32-le", "surrogatepass"), np.uint32) for _, n in kept]
        sizes = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.edits = np.minimum((RATE * sizes).astype(np.int64), np.maximum(0, (sizes - Q) // Q))
        self.least = sizes - Q + 1 - Q * self.edits
        grams = [qgrams(c) for c in self.codes]
        h = np.concatenate(grams) if grams else np.empty(0, np.uint32)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]) if grams else np.empty(0, np.int64)
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.item, self.place = item[order].astype(np.int32), place[order].astype(np.int32)
        self.hash, self.first = np.unique(h[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(h)))
        self.map = np.zeros(1 << BITMAP, dtype=bool)
        self.map[(self.hash >> np.uint32(32 - BITMAP))] = True

    def bands(self, codes: np.ndarray):
        """(passage, first diagonal) of the bands that hold enough shared q-grams."""
        h = qgrams(codes)
        at = np.flatnonzero(self.map[h >> np.uint32(32 - BITMAP)])
        if not len(at) or not len(self.hash):
            return []
        k = np.minimum(np.searchsorted(self.hash, h[at]), len(self.hash) - 1)
        there = self.hash[k] == h[at]
        at, k = at[there], k[there]
        n = self.count[k]
        post = np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item = self.item[post].astype(np.int64)
        diagonal = np.repeat(at, n) - self.place[post]
        step_of = self.edits + 1
        step = step_of[item]
        cell = diagonal // step
        span = len(codes) + 2 * int(max((len(c) for c in self.codes), default=0)) + 4
        shift = span // 2
        # band b is the cells b and b + 1, so each shared q-gram counts in two bands
        keys, counts = np.unique(np.concatenate([item * (2 * span) + (cell - back + shift) for back in (0, 1)]), return_counts=True)
        of, b = keys // (2 * span), keys % (2 * span) - shift
        good = counts >= self.least[of]
        return list(zip(of[good].tolist(), (b[good] * step_of[of[good]]).tolist()))


def align(passage: np.ndarray, codes: np.ndarray, low: int, width: int, edits: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of ``passage`` in ``codes`` on the diagonals low .. low + width - 1.

    One row of the banded matrix per character of the passage; column j of row i is the document's place i + low + j.
    The start may be any diagonal, each row adds a match or substitution, a deletion (from j + 1 of the row before) or an
    insertion (from j - 1 of the same row). ``None`` beyond ``edits``.
    """
    far = np.int64(1 << 20)
    j = np.arange(width)
    row = np.where((low + j >= 0) & (low + j <= len(codes)), 0, far)
    start = low + j
    for i, c in enumerate(passage):
        at = i + low + j
        inside = (at >= 0) & (at < len(codes))
        same = np.zeros(width, dtype=bool)
        same[inside] = codes[at[inside]] == c
        step = np.where(inside, row + ~same, far)
        up = np.append(row[1:], far) + 1
        take = up < step
        new = np.where(take, up, step)
        begin = np.where(take, np.append(start[1:], 0), start)
        # insertions: the least of new[k] + (j - k) over k <= j
        key = (new - j) * (4 * width) + j
        best = np.minimum.accumulate(key)
        k = best - (best // (4 * width)) * (4 * width)
        row, start = np.minimum(new[k] + j - k, far), begin[k]
        if row.min() > edits:
            return None
    j = int(np.argmin(row))
    return int(row[j]), int(start[j]), len(passage) + low + j


def matches(index: Index, texts: list[str]):
    """For each text the list of (passage id, start, end, edits) in its normal form."""
    out: list[list] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= PART_CHARS):
            size += len(texts[to])
            to += 1
        codes, first, lens = normals(texts[at:to])
        places: dict[tuple[int, int], list[int]] = {}
        for item, low in index.bands(codes):
            edits, passage = int(index.edits[item]), index.codes[item]
            low -= edits
            # a band may touch two or three texts; each is looked at by itself
            a = int(np.searchsorted(first, max(0, low), "right")) - 1
            b = int(np.searchsorted(first, low + 4 * edits + 4 + len(passage), "left"))
            for d in range(max(0, a), max(a + 1, b)):
                if lens[d] + edits >= len(passage):
                    places.setdefault((d, item), []).append(low - int(first[d]))
        for (d, item), lows in places.items():
            edits, passage = int(index.edits[item]), index.codes[item]
            own = codes[first[d]:first[d] + lens[d]]
            found: list[tuple] = []
            # equal places first: they need no alignment
            whole, part, k = own.tobytes(), passage.tobytes(), -1
            while (k := whole.find(part, k + 1)) >= 0:
                if k % 4 == 0:
                    found.append((index.ids[item], k // 4, k // 4 + len(passage), 0))
            done = -1 << 60
            for low in sorted(lows):
                width = 4 * edits + 4
                if low < done or any(low <= f[1] < low + width for f in found if not f[3]):
                    continue
                got = align(passage, own, low, width, edits)
                if got:
                    found.append((index.ids[item], got[1], got[2], got[0]))
                    done = low + width // 2
            out[at + d] += found
        if index.short:
            for d in range(at, to):
                if lens[d - at] < Q and (n := normal(texts[d])) in index.short:
                    out[d].append((index.short[n], 0, len(n), 0))
        at = to
    return [merged(x) for x in out]


def merged(found: list) -> list:
    """Overlapping finds of a passage as one, the one with the fewest edits."""
    kept: list = []
    for x in sorted(found, key=lambda x: (x[0], x[3], x[1], x[2])):
        if not any(k[0] == x[0] and k[1] < x[2] and x[1] < k[2] for k in kept):
            kept.append(x)
    return sorted(kept, key=lambda x: (x[1], x[0]))


def _find(index):
    def run(batches):
        for batch in parts(batches, 1):
            rows, texts = [], [t or "" for t in batch.column(1).to_pylist()]
            for doc, text, found in zip(batch.column(0).to_pylist(), texts, matches(index.value, texts)):
                if found:
                    at = places(text)
                    rows += [(doc, i, at[a], at[b - 1] + 1 if b else 0, e) for i, a, b, e in found]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 4, pa.int32()))],
                                             names=["doc_id", "item_id", "start", "end", "edits"])
    return run


def _drop(index, at):
    def run(batches):
        for batch in parts(batches, at):
            found = matches(index.value, [t or "" for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array([not f for f in found], pa.bool_()))
    return run


def _normal(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([normal(t) for t in batch.column(1).to_pylist()], pa.string())],
                                         names=["item_id", "text"])


def blocks(benchmark: DataFrame):
    """Broadcast indexes of the passages, about ``BLOCK_CHARS`` characters each."""
    # equal passages are one, with their smallest id, before anything is collected
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL AND item_id IS NOT NULL")
             .mapInArrow(_normal, "item_id long, text string").filter("text != ''")
             .groupBy("text").agg(F.min("item_id").alias("item_id")))
    items = cut(items, work_folder(benchmark.sparkSession, "benchmark"), "passages")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Index([(r.item_id, r.text) for r in rows]))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start, end, edits``: places (characters of the text) of benchmark passages in documents."""
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    out = None
    for index in blocks(benchmark):
        part = docs.mapInArrow(_find(index), MATCHES)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], MATCHES) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, with all their columns."""
    for index in blocks(benchmark):
        docs = docs.mapInArrow(_drop(index, docs.columns.index("text")), docs.schema)
    return docs
