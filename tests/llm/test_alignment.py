"""Cross-tokenizer alignment against the libraries' own tokens and all pairs of byte ranges."""

import hashlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest

from nimbus.llm import alignment

TEXTS = [(1, "It's a test of 123 pieces."), (2, ""), (3, None), (4, "word " * 3000), (5, "a <|endoftext|> <s> b"),
         (5, "a <|endoftext|> <s> b"), (6, "Ünïcödé  \n\n  x  漢字 🙂 हिन्दी" * 30), (None, "no id"), (7, "x" * 3000),
         (8, "a▁b"), (9, " "), (10, "\x00 \t"), (1 << 60, "It's a test of 123 pieces."), (11, "straße" * 9 + "\n" * 70000)]


@lru_cache(maxsize=1)
def libraries():
    import public_tokenizers as p
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    signs = {}
    for token, i in a.get_vocab().items():
        signs[i] = token
    # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    b = sentencepiece.SentencePieceProcessor(model_file=p.path("piece_bpe_32k.model"))
    return a, b, signs, byte


def tokens(text):
    a, b, signs, byte = libraries()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(byte[c] for c in signs[i]) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in ids_b]
    return ids_a, ids_b, bytes_a, bytes_b


def ranges(parts):
    at = 0
    for p in parts:
        yield at, at + len(p)
        at += len(p)


def brute(rows):
    docs, holds, out = [], Counter(), []
    for _, text in rows:
        text = text or ""
        a, b, ba, bb = tokens(text) if text else ([], [], [], [])
        if not text or b"".join(ba) != b" " + text.encode() or b"".join(bb) != b" " + text.encode():
            docs.append(None)
            continue
        ra, rb = list(ranges(ba)), list(ranges(bb))
        links = []
        first = 0
        for i, (s, e) in enumerate(ra):
            while rb[first][1] <= s:
                first += 1
            j = first
            while j < len(rb) and rb[j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        common = sorted({e for _, e in ra} & {e for _, e in rb})
        text_of, ia, ib = [], 0, 0
        for end in common:
            x, y = [], []
            while ia < len(ra) and ra[ia][1] <= end:
                x.append(str(a[ia]))
                ia += 1
            while ib < len(rb) and rb[ib][1] <= end:
                y.append(str(b[ib]))
                ib += 1
            text_of.append(",".join(x) + "|" + ",".join(y))
        holds.update(set(links))
        docs.append((len(a), len(b), len(common), links, hashlib.sha256(";".join(text_of).encode()).hexdigest()))
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    for (doc_id, _), d in zip(rows, docs):
        if d is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links, sha = d
            out.append((doc_id, n_a, n_b, groups, len(links), sum(holds[x] == most[x[0]] for x in links),
                        sum(holds[x] for x in links), sha))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in row)


@pytest.mark.parametrize("pairs", [alignment.BLOCK_PAIRS, 5])
def test_whole_table_against_all_byte_ranges(spark, monkeypatch, pairs):
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", pairs)     # one block a partition, or one a document
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in TEXTS], "doc_id long, text string, block string, n_a int").repartition(3)
    got = [tuple(r[c] for c in COLUMNS) for r in alignment.count_links(df).collect()]
    assert sorted(got, key=key) == sorted(brute(TEXTS), key=key)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = [tuple(r[c] for c in COLUMNS) for r in alignment.count_links(df).collect()]
    assert sorted(got) == sorted(brute([(r.doc_id, r.text) for r in df.collect()]))


def test_groups_are_returned(spark):
    df = spark.createDataFrame([(1, "It's a test of Ünïcödé."), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in alignment.align(df).collect()}
    a, b, _, _ = tokens("It's a test of Ünïcödé.")
    assert (rows[1].ids_a, rows[1].ids_b) == (a, b) and rows[1].cuts_a[-1] == len(a) and rows[1].cuts_b[-1] == len(b)
    assert len(rows[1].links_a) == len(a) + len(b) - len(rows[1].cuts_a) and rows[2].ids_a == []


def test_long_white_space_takes_the_other_encoder():
    text = "a" + " " * 1_200_000 + "b"
    from tokenizers import Tokenizer
    import public_tokenizers
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(" " + text, add_special_tokens=False).ids
    assert alignment.sides().encode_a(" " + text).tolist() == want


def test_empty_table(spark):
    assert alignment.count_links(spark.createDataFrame([], "doc_id long, text string")).collect() == []
