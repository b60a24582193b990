"""Packing: exact round trip of the ids of tokenizers. Token counts: the library's own counts."""

import zlib

import numpy as np
import pytest

from nimbus.llm import packing, token_counts

TEXTS = [(1, "It's a test of 123 pieces."), (2, ""), (3, None), (4, "word " * 5000), (5, "a <|endoftext|> b"), (5, "a <|endoftext|> b"),
         (6, "Ünïcödé  \n\n  x  漢字 🙂" * 30), (None, "no id"), (7, "x" * 3000)]


def expected(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return tok.encode(text or "", add_special_tokens=False).ids + [0]


def test_every_id_lies_in_one_piece(spark):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in TEXTS], "doc_id long, text string, start int, offset int").coalesce(2)
    rows = packing.pack(df).collect()
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == seq[0].sequence_tokens <= 1024
        assert at & (at - 1) == 0                                # full, or a power of two: no padding at all
    for i, t in dict(TEXTS).items():
        ids = np.array(expected(t), dtype="<u4")
        pieces = by_doc[i]
        copies = sum(x == i for x, _ in TEXTS)
        assert sum(p.length for p in pieces) == copies * len(ids)
        for p in pieces:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())


def test_assignment_is_full_and_balanced():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 1024, 2000)
    placed = packing.assign(lengths)
    held, spent = {}, {}
    for item, _, n, seq, _ in placed:
        held[seq] = held.get(seq, 0) + n
        spent[seq] = spent.get(seq, 0) + packing.cost(n)
    assert sum(held.values()) == lengths.sum() and all(v & (v - 1) == 0 for v in held.values())
    full = np.array([spent[s] for s, v in held.items() if v == 1024])
    first = {}
    for k, n in enumerate(lengths):                              # in order of arrival instead, cut where full
        first.setdefault(int(lengths[:k].sum()) // 1024, []).append(n)
    assert full.std() <= np.array([sum(map(packing.cost, v)) for v in first.values()]).std()
    assert packing.assign(np.array([], dtype=np.int64)) == []


def test_counts_are_the_librarys_and_come_from_the_cache(spark, tmp):
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [*TEXTS, (8, " lead and  <s> </s> \ttab\n"), (9, "long " * 5000)]
    df = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, n_tokens int")
    got = sorted((tuple(r) for r in token_counts.count_tokens(df, cache=f"{tmp}/cache").collect()), key=repr)
    want = sorted(((i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for i, t in texts), key=repr)
    assert got == want
    stored = spark.read.parquet(f"{tmp}/cache")
    assert stored.count() == len({t or "" for _, t in texts})    # each distinct content once
    again = df.unionByName(spark.createDataFrame([(99, "something new", 0)], df.schema))
    assert token_counts.count_tokens(again, cache=f"{tmp}/cache").count() == len(texts) + 1
    assert spark.read.parquet(f"{tmp}/cache").count() == stored.count() + 1      # only the miss was added
    assert token_counts.count_tokens(df.limit(0), cache=f"{tmp}/empty").count() == 0


def test_a_json_vocabulary_is_counted_by_tokenizers():
    count = token_counts.counter("byte_bpe_50k.json")
    assert count([t or "" for _, t in TEXTS]) == [len(expected(t)) - 1 for _, t in TEXTS]
    assert token_counts.tokenizer_digest("byte_bpe_50k.json") != token_counts.tokenizer_digest("piece_bpe_32k.model")


@pytest.mark.parametrize("schema", ["doc_id long, text string"])
def test_empty_table(spark, schema):
    assert packing.pack(spark.createDataFrame([], schema)).count() == 0


def exchanged(df):
    """Columns that an exchange of the plan carries."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]


def test_warm_run_ships_no_text(spark, tmp):
    """The second run encodes nothing and exchanges no text; one hot text is folded where it is read."""
    rows = [(i, "hot text " * 200) for i in range(3000)] + [(10_000 + i, f"text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    first = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, cache=f"{tmp}/c").collect()}
    assert spark.read.parquet(f"{tmp}/c").count() == 51
    again = token_counts.count_tokens(df, cache=f"{tmp}/c")
    assert {r.doc_id: r.n_tokens for r in again.collect()} == first and spark.read.parquet(f"{tmp}/c").count() == 51
    assert "text" not in " ".join(exchanged(again))
    more = df.unionByName(spark.createDataFrame([(1, "new")], "doc_id long, text string"))
    assert token_counts.count_tokens(more, cache=f"{tmp}/c").count() == len(rows) + 1
    assert spark.read.parquet(f"{tmp}/c").count() == 52


def test_many_misses_take_the_other_way(spark, tmp, monkeypatch):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    want = sorted(map(tuple, token_counts.count_tokens(df).collect()), key=repr)
    monkeypatch.setattr(token_counts, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, token_counts.count_tokens(df, cache=f"{tmp}/c").collect()), key=repr) == want
