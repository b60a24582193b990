"""Packing of token sequences, balanced by attention cost.

The cost of a piece of ``n`` tokens is ``LINEAR * n + QUADRATIC * n * n``: the part of a layer that grows with
the tokens and the part that attends within the piece. A document longer than a sequence fills whole
sequences by itself; what is left of each document is assigned in descending order of length to the sequence
of lowest cost that still has room. A piece that fits nowhere is cut to fill the sequence with most room, so
every sequence of a block is full. The capacity of a block's last tokens is split by powers of two, lengths
that need no padding: a block has no padding at all.

Blocks hold at most ``BLOCK`` remainders of one input split and are packed where the split is tokenized: no
shuffle, no group that grows with the data, and a lost task packs its split again with the same result.

Ids are those of ``byte_bpe_50k.json`` in the library tokenizers. They are made from the same vocabulary's
ranks by tiktoken, which gives equal ids five times as fast (tests/llm compare the two); the special string
``<|endoftext|>`` inside a text becomes its special id, as in tokenizers.

Defined results: a null or empty text is the one id 0; repeated rows are packed each; a null ``doc_id`` keeps
its pieces with a null id; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SEQUENCE = 1024
LINEAR, QUADRATIC = 12.0 * 768, 1.0      # of a transformer layer of width 768: 12 d^2 n and d n^2, over d
BLOCK = 4096
END = 0
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
          " sequence_tokens long, sequence_cost double")


@lru_cache(maxsize=1)
def encoder(vocabulary: str = "byte_bpe_50k.tiktoken", special: str = "<|endoftext|>"):
    """text -> ids of the byte-level BPE vocabulary."""
    import public_tokenizers
    import tiktoken
    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                            special_tokens={special: len(ranks)})
    allowed = {special}

    def encode(text: str) -> np.ndarray:
        if special in text:
            return np.array(bpe.encode(text, allowed_special=allowed, disallowed_special=()), dtype="<u4")
        return np.array(bpe.encode_ordinary(text), dtype="<u4")
    return encode


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def assign(lengths: np.ndarray, capacity: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """(item, start within the item, length, sequence, offset): every token of ``lengths`` placed, no room left.

    Sequences have ``capacity`` tokens; what remains of the sum is split into powers of two.
    """
    total = int(lengths.sum())
    rest = total % capacity
    room = [capacity] * (total // capacity) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
    size = np.array(room, dtype=np.int64)
    room, spent = size.copy(), np.zeros(len(size))
    placed = []
    for item in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[item])
        while left:
            fits = np.flatnonzero(room >= left)
            if len(fits):
                to, take = int(fits[np.argmin(spent[fits])]), left
            else:
                to = int(np.argmax(room))
                take = int(room[to])
            placed.append((int(item), start, take, to, int(size[to] - room[to])))
            room[to] -= take
            spent[to] += cost(take)
            start, left = start + take, left - take
    return placed


def _pack(batches):
    encode = encoder()
    base = TaskContext.get().partitionId() << 40
    state = {"next": base}
    tails: list[tuple] = []

    def emit(rows):
        cols = list(zip(*rows))
        types = [pa.int64()] * 8 + [pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=[x.split()[0] for x in PIECES.split(",")])

    def block():
        lengths = np.array([len(t[2]) for t in tails], dtype=np.int64)
        placed = assign(lengths)
        held, spent = {}, {}
        for _, _, n, seq, _ in placed:
            held[seq] = held.get(seq, 0) + n
            spent[seq] = spent.get(seq, 0.0) + cost(n)
        rows = []
        for item, start, n, seq, offset in placed:
            doc, at, ids, tokens = tails[item]
            rows.append((doc, at + start, n, zlib.crc32(ids[start:start + n].tobytes()), tokens,
                         state["next"] + seq, offset, held[seq], spent[seq]))
        state["next"] += len(held)
        tails.clear()
        return rows

    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
            tokens = len(ids)
            whole = tokens - tokens % SEQUENCE
            for at in range(0, whole, SEQUENCE):
                rows.append((doc, at, SEQUENCE, zlib.crc32(ids[at:at + SEQUENCE].tobytes()), tokens, state["next"], 0,
                             SEQUENCE, cost(SEQUENCE)))
                state["next"] += 1
            if tokens > whole:
                tails.append((doc, whole, ids[whole:].copy(), tokens))
            if len(tails) >= BLOCK:
                rows += block()
        if rows:
            yield emit(rows)
    if tails:
        yield emit(block())


def pack(docs: DataFrame) -> DataFrame:
    """One row per piece of each document's ids; ``sequence_tokens`` and ``sequence_cost`` describe its sequence."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_pack, PIECES)
