"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary (``piece_bpe_32k.model``; a word starts with its word mark) and every
single character. A language is a probability for each piece. The probability of a word is the sum over
all its segmentations into pieces, by a forward recursion over its characters; the score of a text is the sum
of the logarithms over all its words, for every language, plus the language's prior.

The probabilities are fitted by expectation maximisation: the expected piece counts over all segmentations
(forward-backward) of the words of at most ``DOCS`` documents a language (those with the smallest hash of their id,
the documented bound of the fit), ``ROUNDS`` times, smoothed by the pieces' shares in all languages. Words are aggregated
in Spark; the model is languages x pieces floats.

Words are runs of letters, lower-cased, of the whole text. The work is vectorised over the distinct words of
a batch of the same length.

Defined results: ``und`` with score 0 if the text is null or has no letter, or if nothing could be learned; score
is the posterior of the predicted language; ties go to the first language by name; repeated rows appear each; a null
``doc_id`` is predicted but not learned from; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import cut, held_out, work_folder

VOCABULARY = "piece_bpe_32k.model"
DOCS = 3000
ROUNDS = 3
SMOOTH = 1.0          # pseudo-counts a piece, dealt by its share in all languages
FLOOR = 1e-7          # of a character that no language has
KNOWN_WORDS = 200_000
LONG_WORD = 64        # longer runs of letters are recursed one by one, whole

_WORD = re.compile(r"[^\W\d_]+")
#: ``\w`` takes numerals and signs that are no letters (², ½, Ⅷ, ①), and no marks that combine with a letter.
_ODD = re.compile(r"[^\x00-\x7F\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02C1\u0370-\u0373\u0386-\u0481\u048A-\u052F\s]")
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _hash(codes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Hash of strings one character longer."""
    return (before ^ (codes.astype(np.uint64) + np.uint64(0x632BE5AB))) * _MUL


@lru_cache(maxsize=1)
def pieces(vocabulary: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray, int]:
    """(sorted hashes, piece of each, longest piece) of the vocabulary's letter pieces, in lower case."""
    import public_tokenizers
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
    found = sorted({p.lower() for i in range(model.get_piece_size()) if _WORD.fullmatch((p := model.id_to_piece(i)).lstrip("▁"))
                    and not p.startswith("▁▁")} | {chr(c) for c in range(97, 123)})
    h = np.array([_hash_one(p) for p in found], dtype=np.uint64)
    order = np.argsort(h)
    return h[order], order, max(map(len, found))


def _hash_one(s: str) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for c in s:
        h = _hash(np.array([ord(c)]), h)
    return h[0]


def lookup(h: np.ndarray) -> np.ndarray:
    """Piece number of each hash, or -1."""
    keys, number, _ = pieces()
    k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[k] == h, number[k], -1)


def lattice(words: list[str]):
    """For words of one length: codes and, for each (end, length), the pieces that end there."""
    codes = np.frombuffer("".join("▁" + w for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.reshape(len(words), -1)
    n, longest = codes.shape[1], pieces()[2]
    at: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(n + 1)]
    for i in range(n):
        h = np.zeros(len(words), np.uint64)
        for j in range(i, min(n, i + longest)):
            h = _hash(codes[:, j], h)
            if j == 0:
                continue                     # the word mark alone is no piece: it belongs to what follows
            p = lookup(h)
            if j == i or (p >= 0).any():
                at[j + 1].append((i, p))
    return codes, at


def forward(words: list[str], prob: np.ndarray, single: np.ndarray):
    """Log probability of each word (rows) in each language (columns); ``prob``: pieces x languages.

    ``single``: languages, the probability of a character that is no piece. A first letter may stand without its
    word mark piece: then the mark and the letter are one character piece.
    """
    codes, at = lattice(words)
    n = codes.shape[1]
    alpha = [None] * (n + 1)
    alpha[0] = np.ones((len(words), prob.shape[1]))
    scale = np.zeros((len(words), prob.shape[1]))
    for j in range(2, n + 1):
        total = np.zeros_like(alpha[0])
        for i, p in at[j]:
            if i == 1 or alpha[i] is None:
                continue
            step = np.where((p >= 0)[:, None], prob[p], single if i == j - 1 else 0.0)
            total += alpha[i] * step
        if j == 2:                           # the mark and the first letter
            found = next((p for i, p in at[2] if i == 0), np.full(len(words), -1))
            letter = lookup(_hash(codes[:, 1], np.zeros(len(words), np.uint64)))
            total += np.where((found >= 0)[:, None], 0.0, np.where((letter >= 0)[:, None], prob[letter], single))
        alpha[j] = total
        if j % 8 == 0:                       # long words would underflow
            top = total                      # of each word and language
            for k in range(max(0, j - pieces()[2]), j + 1):
                if alpha[k] is not None:
                    alpha[k] = alpha[k] / top
            scale += np.log(top)
    return np.log(alpha[n]) + scale


def expected(words: list[str], counts: np.ndarray, prob: np.ndarray, single: float) -> np.ndarray:
    """Expected uses of each piece in ``counts`` occurrences of the words, over all segmentations (one language)."""
    codes, at = lattice(words)
    n, m = codes.shape[1], len(words)
    alpha, beta = np.zeros((n + 1, m)), np.zeros((n + 1, m))
    alpha[0], beta[n] = 1.0, 1.0
    steps = []
    for j in range(2, n + 1):
        for i, p in at[j]:
            if i == 1:
                continue
            steps.append((i, j, p, np.where(p >= 0, prob[p], single if i == j - 1 else 0.0)))
        if j == 2:
            found = next((p for i, p in at[2] if i == 0), np.full(m, -1))
            letter = lookup(_hash(codes[:, 1], np.zeros(m, np.uint64)))
            p = np.where(found >= 0, -1, letter)
            steps.append((0, 2, p, np.where(found >= 0, 0.0, np.where(letter >= 0, prob[letter], single))))
    # each place is scaled by its own power, as long words would underflow
    up, down = np.zeros((n + 1, m)), np.zeros((n + 1, m))
    by: dict[int, list] = {}
    for s in steps:
        by.setdefault(s[1], []).append(s)
    for j in sorted(by):
        up[j] = np.max([up[i] for i, *_ in by[j]], axis=0)
        for i, _, _, w in by[j]:
            alpha[j] += alpha[i] * w * np.exp(up[i] - up[j])
        top = np.where(alpha[j] > 0, alpha[j], 1.0)
        alpha[j] /= top
        up[j] += np.log(top)
    by = {}
    for s in steps:
        by.setdefault(s[0], []).append(s)
    for i in sorted(by, reverse=True):
        down[i] = np.max([down[j] for _, j, *_ in by[i]], axis=0)
        for _, j, _, w in by[i]:
            beta[i] += beta[j] * w * np.exp(down[j] - down[i])
        top = np.where(beta[i] > 0, beta[i], 1.0)
        beta[i] /= top
        down[i] += np.log(top)
    out = np.zeros(len(prob))
    for i, j, p, w in steps:
        use = counts * alpha[i] * w * beta[j] * np.exp(up[i] + down[j] - up[n])
        there = p >= 0
        np.add.at(out, p[there], use[there])
    return out


@dataclass
class Model:
    langs: list[str]
    prob: np.ndarray                 # pieces x languages
    single: np.ndarray
    prior: np.ndarray

    def words(self, words: list[str]) -> np.ndarray:
        """Log probabilities, words x languages."""
        out = np.empty((len(words), len(self.langs)))
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by.setdefault(len(w), []).append(i)
        for n, at in by.items():
            most = 4096 if n <= LONG_WORD else 1
            for k in range(0, len(at), most):
                some = at[k:k + most]
                out[some] = forward([words[i] for i in some], self.prob, self.single)
        return out


def words_of(text: str | None) -> Counter:
    """The runs of Unicode letters, with the marks on them."""
    if not text:
        return Counter()
    low = text.lower()
    return Counter((_LETTERS if _ODD.search(low) else _WORD).findall(low))


def _train_words(batches):
    for batch in batches:
        by: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by.setdefault(lang, Counter()).update(words_of(text))
        rows = [(la, w, n) for la, c in by.items() for w, n in c.items()]
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()))],
                                         names=["lang", "word", "n"])


def _expect(langs, prob, single):
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            by: dict[tuple[str, int], list[tuple[str, int]]] = {}
            for la, w, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                by.setdefault((la, len(w)), []).append((w, n))
            for (la, _), some in by.items():
                k = langs.index(la)
                most = 4096 if len(some[0][0]) <= LONG_WORD else 1
                for at in range(0, len(some), most):
                    part = some[at:at + most]
                    got = expected([w for w, _ in part], np.array([n for _, n in part], dtype=float), prob[:, k], single[k])
                    total[la] = total.get(la, 0) + got
        for la, v in total.items():
            there = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array([la] * len(there), pa.string()), pa.array(there, pa.int32()), pa.array(v[there])],
                                             names=["lang", "piece", "uses"])
    return run


def learn(docs: DataFrame, usable=None, root: str | None = None) -> Model | None:
    """Fit on ``text`` and non-null ``lang`` of the usable rows."""
    rows = docs.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    if usable is not None:
        rows = rows.filter(usable)
    share = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}     # a row a language
    if not share:
        return None
    langs = sorted(share)
    # the bound of the sample, chosen by id alone, so that no text is shuffled
    ids = reduce(DataFrame.unionByName, [rows.filter(F.col("lang") == la).select("doc_id", "lang").orderBy(F.xxhash64("doc_id"), "doc_id").limit(DOCS)
                                         for la in langs]).distinct()
    sample = (rows.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
              .select("lang", "text"))                                                   # one text an id
    words = cut(sample.mapInArrow(_train_words, "lang string, word string, n long").groupBy("lang", "word")
                .agg(F.sum("n").alias("n")), root or work_folder(docs.sparkSession, "language-id"), "words")
    count = len(pieces()[0])
    prob = np.full((count, len(langs)), 1.0 / count)
    single = np.full(len(langs), FLOOR)
    for _ in range(ROUNDS):
        uses = np.zeros_like(prob)
        got = (words.mapInArrow(_expect(langs, prob, single), "lang string, piece int, uses double")
               .groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toPandas())   # at most pieces x languages
        if len(got):
            uses[got["piece"].to_numpy(), got["lang"].map(langs.index).to_numpy()] = got["uses"].to_numpy()
        every = (uses.sum(axis=1, keepdims=True) + 0.01) / (uses.sum() + 0.01 * count)
        prob = (uses + SMOOTH * count * every) / (uses.sum(axis=0, keepdims=True) + SMOOTH * count)
    prior = np.log(np.array([share[la] for la in langs], dtype=float) / sum(share.values()))
    return Model(langs, prob, single, prior)


def _predict(model):
    def run(batches):
        known: dict[str, int] = {}
        table = np.empty((0, len(model.value.langs)))
        for batch in batches:
            m, ids, langs, scores = model.value, batch.column(0), [], []
            counts = [words_of(batch.column(1)[i].as_py()) for i in range(batch.num_rows)]
            if len(known) > KNOWN_WORDS:
                known, table = {}, table[:0]
            new = list(dict.fromkeys(w for c in counts for w in c if w not in known))
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new))))
                table = np.vstack([table, m.words(new)])
            for c in counts:
                if not c:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                total = np.fromiter(c.values(), float, len(c)) @ table[[known[w] for w in c]] + m.prior
                k = int(np.argmax(total))
                langs.append(m.langs[k])
                scores.append(float(1 / np.exp(total - total[k]).sum()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row."""
    if model is None:
        return docs.selectExpr("cast(doc_id as long) doc_id", "'und' lang_pred", "0D score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")


def fold(column: str = "doc_id"):
    return held_out(column, 4, 2)
