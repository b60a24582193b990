"""Cross-tokenizer alignment: two tokenizers' ids of one text, cut into groups where both have a token end.

Tokenizer A is the byte-level BPE (on space + text), B the piece model (on text; it adds the space itself). A
document's tokens cover the same bytes twice. A dictionary from cumulative end to token index is made for each
side (hashed by the end itself, a direct-address table); the sorted intersection of their keys slices both id lists into groups, and the links of a group (pairs of
tokens whose byte ranges overlap) are expanded slice by slice: a slice with one token on a side by repetition,
others by the ends of both sides together.

The count of an id pair is the number of documents that hold it linked, over the whole corpus. Documents
are aligned once, in blocks of consecutive rows; a block's distinct pairs, with the number of its documents that
hold each, are what is shuffled by pair, and the corpus counts go back to the block, never to single
documents. So the most frequent pair has one row a block and not one a document, and no table of pairs is broadcast.

Defined results: a null or empty text, or one whose tokens do not spell its bytes again (U+2581 in the text), has
no tokens: zeros and an empty digest. Texts are never cut; repeated rows are documents each; a null ``doc_id``
stays null; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import cut, work_folder

A_MODEL, B_MODEL = "byte_bpe_50k", "piece_bpe_32k.model"
BLOCK_PAIRS, BLOCK_DOCS = 1 << 21, 1 << 16      # distinct pairs summed over its documents, and documents, of a block
TEXTS_AT_ONCE = 64
#: The pattern engine of the fast encoder gives up on runs of white space of about a million signs.
_LONG_SPACE = re.compile(r"\s{50000}")


@dataclass
class Sides:
    """Both encoders, with the bytes of every id."""

    encode_a: object
    encode_b: object
    bytes_a: list
    bytes_b: list
    len_a: np.ndarray
    len_b: np.ndarray
    texts: list             # text of each id with the separator that follows it


@lru_cache(maxsize=1)
def sides() -> Sides:
    import public_tokenizers
    import sentencepiece
    import tiktoken
    with open(public_tokenizers.path(f"{A_MODEL}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain = []

    def encode_a(text: str) -> np.ndarray:
        if not _LONG_SPACE.search(text):
            return bpe.encode_to_numpy(text, disallowed_special=())
        if not plain:
            from tokenizers import Tokenizer
            plain.append(Tokenizer.from_file(public_tokenizers.path(f"{A_MODEL}.json")))
            plain[0].encode_special_tokens = True
        return np.array(plain[0].encode(text, add_special_tokens=False).ids)

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B_MODEL))
    bytes_a = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        bytes_a[i] = token
    bytes_b = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
               else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]
    texts = [f"{i}{end}" for i in range(len(bytes_a)) for end in ",|"]
    texts += [f"{i}{end}" for i in range(len(bytes_b)) for end in ",;"]
    return Sides(encode_a, lambda some: model.encode(some, num_threads=1), bytes_a, bytes_b,
                 np.array([len(x) for x in bytes_a]), np.array([len(x) for x in bytes_b]), texts)


@dataclass
class Aligned:
    """Ids of both sides; group ``g`` ends before index ``cut_a[g]`` and ``cut_b[g]``."""

    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    link_a: np.ndarray      # indexes of the linked tokens, one entry a link
    link_b: np.ndarray

    def groups(self) -> bytes:
        """``a1,a2|b1;a3|b2,b3`` in order."""
        start_a, start_b = _starts(self.cut_a), _starts(self.cut_b)
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.cut_a - 1], last_b[self.cut_b - 1] = 1, 1
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        order[np.arange(len(self.a)) + np.repeat(start_b, self.cut_a - start_a)] = 2 * self.a + last_a
        s = sides()
        order[np.arange(len(self.b)) + np.repeat(self.cut_a, self.cut_b - start_b)] = 2 * len(s.bytes_a) + 2 * self.b + last_b
        return "".join(map(s.texts.__getitem__, order.tolist()))[:-1].encode()


def _starts(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], ends[:-1]]).astype(np.int64)


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(_starts(np.cumsum(sizes)), sizes)


def indexes(ends: np.ndarray, size: int) -> np.ndarray:
    """The dictionary from end to index: ends are whole numbers up to ``size``, so each is its own place in the table.

    0 stands for no token that ends there; keys come out in ascending order.
    """
    table = np.zeros(size + 1, dtype=np.int64)
    table[ends] = np.arange(1, len(ends) + 1)
    return table


def align_ids(a: np.ndarray, b: list[int], raw: bytes) -> Aligned | None:
    """The alignment, or None if the tokens of a side do not spell ``raw``.

    The byte-level encoder only splits the bytes, so its tokens spell them if they are as long.
    """
    s = sides()
    ends_a = np.cumsum(s.len_a[a])
    if not raw or not len(a) or ends_a[-1] != len(raw) or b"".join(map(s.bytes_b.__getitem__, b)) != raw:
        return None
    a, b = a.astype(np.int64), np.array(b, dtype=np.int64)
    ends_b = np.cumsum(s.len_b[b])
    at_a, at_b = indexes(ends_a, len(raw)), indexes(ends_b, len(raw))
    common = np.flatnonzero((at_a > 0) & (at_b > 0))
    cut_a, cut_b = at_a[common], at_b[common]
    start_a, start_b = _starts(cut_a), _starts(cut_b)
    many_a, many_b = cut_a - start_a > 1, cut_b - start_b > 1
    # a group of x and y tokens has no inner common end, hence x + y - 1 links
    links = cut_a - start_a + cut_b - start_b - 1
    into, inner = _starts(np.cumsum(links)), _within(links)
    link_a = np.repeat(start_a, links) + inner * np.repeat(many_a, links)
    link_b = np.repeat(start_b, links) + inner * np.repeat(many_b, links)
    mixed = many_a & many_b
    if mixed.any():
        # each piece between two neighbouring ends of either side lies in one token of both: one link
        ends = np.union1d(ends_a[np.repeat(mixed, cut_a - start_a)], ends_b[np.repeat(mixed, cut_b - start_b)])
        at = np.repeat(into[mixed], links[mixed]) + _within(links[mixed])
        link_a[at], link_b[at] = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    return Aligned(a, b, cut_a, cut_b, link_a, link_b)


def alignments(texts: list[str | None]):
    """One Aligned or None for each text."""
    s = sides()
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        some = [t or "" for t in texts[at:at + TEXTS_AT_ONCE]]
        for text, b in zip(some, s.encode_b(some)):
            yield align_ids(s.encode_a(" " + text), b, b" " + text.encode()) if text else None


GROUPS = ("doc_id long, ids_a array<long>, ids_b array<long>, cuts_a array<long>, cuts_b array<long>, "
          "links_a array<long>, links_b array<long>")


def _groups(batches):
    for batch in batches:
        found = list(alignments(batch.column(1).to_pylist()))
        cols = [pa.array([getattr(x, c) if x else [] for x in found], pa.list_(pa.int64()))
                for c in ("a", "b", "cut_a", "cut_b", "link_a", "link_b")]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols],
                                         names=["doc_id", "ids_a", "ids_b", "cuts_a", "cuts_b", "links_a", "links_b"])


def align(docs: DataFrame) -> DataFrame:
    """Ids, group ends and links (indexes into the ids) of every row of ``docs`` (``doc_id``, ``text``)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_groups, GROUPS)


_DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
BLOCKS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "refs binary, times binary, pairs array<long>, docs array<int>")
_BLOCK_TYPES = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in _DOC[1:5]),
                          ("groups_sha256", pa.string()), ("refs", pa.binary()), ("times", pa.binary()),
                          ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32()))])


def _summary(x: Aligned | None) -> tuple[tuple, np.ndarray, bytes]:
    """Counts and digest of a document, its distinct pairs, and how often it has each."""
    if x is None:
        return (0, 0, 0, 0, ""), np.empty(0, np.int64), b""
    key, n = np.unique((x.a[x.link_a] << 32) | x.b[x.link_b], return_counts=True)
    return (len(x.a), len(x.b), len(x.cut_a), len(x.link_a), hashlib.sha256(x.groups()).hexdigest()), key, n.astype("<i4").tobytes()


def _blocks(batches):
    """Rows of the documents, whose pairs are numbered within their block, and after them the block's table of pairs."""
    part, block = TaskContext.get().partitionId(), 0
    rows, keys, times, size = [], [], [], 0

    def flush():
        if keys:
            pairs, refs, docs = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        else:
            pairs, refs, docs = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        number, at, out = (part << 32) + block, 0, []
        for (head, k), t in zip(rows, times):
            # ascending within a document: the differences are small and compress well
            out.append((number, *head, np.diff(refs[at:at + k], prepend=0).astype("<i4").tobytes(), t, None, None))
            at += k
        for a in range(0, len(pairs), 1 << 16):
            out.append((number, *[None] * 8, pairs[a:a + (1 << 16)], docs[a:a + (1 << 16)].astype(np.int32)))
        for a in range(0, len(out), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out[a:a + 4096]), _BLOCK_TYPES)],
                                             schema=_BLOCK_TYPES)

    known: dict[bytes, tuple] = {}             # of the block, by digest: equal texts are aligned once
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for at in range(0, len(ids), TEXTS_AT_ONCE):
            some = texts.slice(at, TEXTS_AT_ONCE).to_pylist()
            marks = [hashlib.sha256((t or "").encode()).digest() for t in some]
            new = {m: t for m, t in zip(marks, some) if m not in known}
            known.update(zip(new, map(_summary, alignments(list(new.values())))))
            for doc_id, mark in zip(ids.slice(at, TEXTS_AT_ONCE).to_pylist(), marks):
                head, key, n = known[mark]
                rows.append(((doc_id, *head), len(key)))
                keys.append(key)
                times.append(n)
                size += len(key)
            if size >= BLOCK_PAIRS or len(rows) >= BLOCK_DOCS:
                yield from flush()
                rows, keys, times, size, block, known = [], [], [], 0, block + 1, {}
    if rows:
        yield from flush()


COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"


def _counted(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a block with the corpus counts of its pairs, which are numbered in ascending order."""
    order = np.argsort(answers["pair"].to_numpy())
    count, best = (answers[c].to_numpy()[order].astype(np.int64) for c in ("n_docs", "best"))
    n_best, total = [], []
    for refs, times in zip(docs["refs"].to_pylist(), docs["times"].to_pylist()):
        refs, times = np.cumsum(np.frombuffer(refs, "<i4"), dtype=np.int64), np.frombuffer(times, "<i4").astype(np.int64)
        n_best.append(int(times @ best[refs]))
        total.append(int(times @ count[refs]))
    out = docs.select(_DOC)
    return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))


def count_links(docs: DataFrame, root: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``."""
    root = root or work_folder(docs.sparkSession, "alignment")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = cut(docs.mapInArrow(_blocks, BLOCKS), root, "blocks")
    table = (blocks.filter("pairs IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
             .select("block", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs")))
    counts = cut(table.groupBy("pair").agg(F.sum("docs").alias("n_docs")), root, "counts")
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n_docs").alias("most"))
    scored = (counts.withColumn("a", F.shiftright("pair", 32)).join(most, "a")
              .select("pair", "n_docs", (F.col("n_docs") == F.col("most")).cast("int").alias("best")))
    answers = table.select(F.col("block").alias("of"), "pair").join(scored, "pair")
    rows = blocks.filter("refs IS NOT NULL").select("block", *_DOC, "refs", "times")
    return rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_counted, COUNTED)

