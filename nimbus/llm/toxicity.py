"""Toxic documents: a learned lexicon, misspellings by Levenshtein automata, and the context of each hit.

1. Learning, from at most ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` other labelled documents (those with the
   smallest hash of their id, the documented bound of the fit): words whose documents are toxic with a Wilson lower
   bound of ``PURITY`` or more, in at least ``SUPPORT`` of the toxic documents and in several different
   contexts (copies of one text don't make a term), are the terms. Their number is bounded by
   mean words of a document / SUPPORT. Beginnings of 4 to 7 letters that several such words share are stems by
   the same test, so a term's unseen forms count too.
2. Misspellings: words are run against a trie of the terms by the bit-parallel simulation of the Levenshtein
   automaton of the word, one edit from terms of 4 letters or more, two from 10 letters on; look-alike digits and
   signs count as the letters they stand for. Words that the clean training documents use are no misspellings.
3. Each hit is weighed by its window: in quotation marks or near a verb of reporting it counts as quoted, near
   the second person it counts more, misspelled it counts less. The sums of plain and of quoted weights, the
   heaviest window and the length are the inputs of a logistic model, fitted on the same rows.

Only the text enters a score. Whole texts are scored.

Defined results: a null or empty text scores as one without hits; documents repeat as often as their rows; a
null ``doc_id`` is scored but never learned from; of several labels of one document the larger counts; without
a toxic label to learn from every score is 0. Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import held_out

TOXIC_ROWS, CLEAN_ROWS = 8000, 12000
SUPPORT, PURITY, CONTEXTS = 0.002, 0.5, 4
STEMS, STEM_WORDS = (7, 6, 5, 4), 3
THRESHOLD = 0.7
WINDOW = 8                  # words on either side of a hit
QUOTED, REPORTED, ADDRESSED, MISSPELLED = 0.35, 0.6, 1.3, 0.6
KNOWN_WORDS = 300_000       # words a task remembers; then it starts to remember anew

_TOKEN = re.compile(r"[^\W_]+(?:[@$*!'’][^\W_]+)*")
_LOOKS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_QUOTES = re.compile("[\"“”„«»‹›\n]")
_CLOSES = {"\"": "\"", "“": "”", "„": "“”", "«": "»", "‹": "›", "»": "«", "›": "‹"}
# fixed cue words of the four languages of the corpus
_REPORT = frozenset("said says say wrote writes called calls quoted quote quoting term word according dit écrit appelé "
                    "mot sagte sagt schrieb nannte wort dijo escribió llamó palabra".split())
_PERSON = frozenset("you your you're youre yourself tu toi vous ton ta du dich dein deine ihr usted tú ti eres".split())


def quotations(text: str) -> list[tuple[int, int]]:
    """Places of the quotations: from each opening mark to the mark that closes it, on one line.

    A mark that is open is closed by the first mark that may close it, so what stands between two quotations is in none.
    """
    found, begin, closes = [], 0, ""
    for m in _QUOTES.finditer(text):
        sign = m.group()
        if sign == "\n":
            closes = ""
        elif closes:
            if sign in closes:
                found.append((begin, m.start()))
                closes = ""
        elif sign in _CLOSES:
            begin, closes = m.end(), _CLOSES[sign]
    return found


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


class Trie:
    """Terms as nested dictionaries; the key ``""`` holds the term that ends there."""

    def __init__(self, terms):
        self.root: dict = {}
        # within one or two edits, one of the two or three parts of a term stays as it is, at its place from either end
        self.heads: dict[str, list] = {}
        self.tails: dict[str, list] = {}
        self.middles: dict[str, list] = {}
        for t in terms:
            node = self.root
            for c in t:
                node = node.setdefault(c, {})
            node[""] = t
            if reach(t):
                part, sort = len(t) // (reach(t) + 1), (len(t), frozenset(t), reach(t))
                self.heads.setdefault(t[:part], []).append(sort)
                self.tails.setdefault(t[-part:], []).append(sort)
                if reach(t) > 1:
                    self.middles.setdefault(t[part:2 * part], []).append(sort)
        self.sizes = sorted({len(h) for h in self.heads})
        self.inner = sorted({len(h) for h in self.middles})

    def near(self, word: str, edits: int, own: bool = False) -> tuple[str, int] | None:
        """Closest term within ``edits`` insertions, deletions and substitutions (ties: smallest term).

        ``own``: of the terms that have the word within their own reach.

        ``masks[d]``: the states of the word's automaton that are reached with ``d`` edits; state i has read i
        letters of the word.
        """
        at: dict[str, int] = {}
        for i, c in enumerate(word):
            at[c] = at.get(c, 0) | 1 << i
        final, best = 1 << len(word), None
        stack = [(self.root, [(1 << (d + 1)) - 1 for d in range(edits + 1)])]
        while stack:
            node, masks = stack.pop()
            if "" in node:
                for d, m in enumerate(masks):
                    if m & final:
                        if own and d > reach(node[""]):
                            break
                        if best is None or (d, node[""]) < (best[1], best[0]):
                            best = (node[""], d)
                        break
            for c, child in node.items():
                if c:
                    fits, nxt = at.get(c, 0), []
                    for d, m in enumerate(masks):
                        to = (m & fits) << 1
                        if d:
                            to |= masks[d - 1] | masks[d - 1] << 1 | nxt[-1] << 1
                        nxt.append(to)
                    if nxt[-1]:
                        stack.append((child, nxt))
        return best

    def may_be_near(self, word: str) -> bool:
        """Cheap and never wrong about a word that is near: parts, length and letters."""
        def fits(sorts) -> bool:
            return any(abs(len(word) - n) <= k and len(letters.difference(word)) <= k for n, letters, k in sorts)

        for n in self.sizes:
            if (a := self.heads.get(word[:n])) and fits(a) or (b := self.tails.get(word[-n:])) and fits(b):
                return True
        if len(word) >= 8:
            for n in self.inner:
                for i in range(n - 2, n + 3):
                    if (a := self.middles.get(word[i:i + n])) and fits(a):
                        return True
        return False


def reach(term: str) -> int:
    """Edits within which a word counts as the misspelled term."""
    return 0 if len(term) < 4 else 1 if len(term) < 10 else 2


@dataclass
class Model:
    weights: dict[str, float]
    stems: dict[str, float] = field(default_factory=dict)
    clean: frozenset[str] = frozenset()
    beta: list[float] = field(default_factory=list)
    prior: float = 0.0

    def __post_init__(self):
        self.trie, self.known = Trie(self.weights), {}

    def __getstate__(self):
        return self.weights, self.stems, self.clean, self.beta, self.prior

    def __setstate__(self, state):
        self.weights, self.stems, self.clean, self.beta, self.prior = state
        self.__post_init__()

    def term(self, word: str) -> tuple[str, bool] | None:
        """(term, misspelled) that ``word`` stands for."""
        if word in self.known:
            return self.known[word]
        found = None
        if word in self.weights:
            found = (word, False)
        elif stem := next((word[:n] for n in STEMS if len(word) > n and word[:n] in self.stems), None):
            found = (stem, False)
        elif word not in self.clean and not word.isdigit():
            plain = word if word.isalpha() else word.translate(_LOOKS)
            if plain != word and plain in self.weights:
                found = (plain, True)
            elif len(plain) >= 3 and self.trie.may_be_near(plain):
                # the largest reach of a term that two deletions bring to this length
                near = self.trie.near(plain, reach("." * (len(plain) + 2)), own=True)
                if near:
                    found = (near[0], True)
        if len(self.known) >= KNOWN_WORDS:
            self.known.clear()
        self.known[word] = found
        return found

    def features(self, text: str) -> list[float]:
        words = tokens(text)
        known, look = self.known, self.term
        hit = {w: t for w in set(words) if (t := known[w] if w in known else look(w))}
        if not hit:
            return [0.0, 0.0, 0.0, float(np.log1p(len(words)))]
        low = text.lower()
        spans = [m.span() for m in _TOKEN.finditer(low)]
        quotes = quotations(low)
        sums = [0.0, 0.0]
        weight = np.zeros(len(words))
        for i, w in enumerate(words):
            if w not in hit:
                continue
            term, misspelled = hit[w]
            lo, hi = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
            around = words[lo:hi]
            value, quoted = self.weights.get(term) or self.stems[term], False
            if any(a <= spans[i][0] and spans[i][1] <= b for a, b in quotes):
                value, quoted = value * QUOTED, True
            elif not _REPORT.isdisjoint(around):
                value *= REPORTED
            if not _PERSON.isdisjoint(around):
                value *= ADDRESSED
            weight[i] = value * (MISSPELLED if misspelled else 1.0)
            sums[quoted] += weight[i]
        run = np.convolve(weight, np.ones(2 * WINDOW + 1), "same") if len(weight) else weight
        return [*np.log1p(sums).tolist(), float(np.log1p(run.max())), float(np.log1p(len(words)))]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.beta:
            return np.full(len(x), self.prior)
        z = self.beta[0] + x @ np.array(self.beta[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _word_counts(batches):
    for batch in batches:
        seen: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for w in set(tokens(text or "")):
                seen.setdefault(w, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
             pa.array([v[1] for v in seen.values()], pa.int64())], names=["word", "n0", "n1"])


def _contexts(terms):
    def run(batches):
        for batch in batches:
            found = set()
            for text in batch.column(0).to_pylist():
                words = ["", *tokens(text or ""), ""]
                for i, w in enumerate(words):
                    found |= {(x, f"{words[i - 1]} {words[i + 1]}") for x in (w, *(w[:n] + "*" for n in STEMS if len(w) > n)) if x in terms}
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in (0, 1)],
                                             names=["word", "context"])
    return run


def _near_words(model):
    def run(batches):
        for batch in batches:
            words = [w for w in batch.column(0).to_pylist() if (t := model.term(w)) and t[1]]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], names=["word"])
    return run


def _features(model, *others):
    def run(batches):
        for batch in batches:
            x = np.array([model.features(t or "") for t in batch.column(0).to_pylist()]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), batch.column(1)],
                                             names=["x", "toxic"])
    return run


def wilson(good: int, n: int, z: float = 2.58) -> float:
    """Lower bound of a proportion."""
    if not n:
        return 0.0
    p = good / n
    return (p + z * z / (2 * n) - z * ((p * (1 - p) + z * z / (4 * n)) / n) ** 0.5) / (1 + z * z / n)


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, l2: float = 1.0, steps: int = 30) -> list[float]:
    """Weighted ridge logistic regression by Newton steps; the first coefficient is the constant."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [l2] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (y - p)) - ridge @ beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hess, grad)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


def learn(docs: DataFrame, labels: DataFrame, usable=None) -> Model:
    """``labels``: ``doc_id, toxic``. ``usable``: which of its rows may be learned from (default: all)."""
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if usable is not None:
        rows = rows.filter(usable)
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    total = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}        # two rows
    if not total.get(1):
        return Model({})
    pick = [rows.filter(F.col("toxic") == t).orderBy(F.xxhash64("id"), "id").limit(n)
            for t, n in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]
    chosen = pick[0].unionByName(pick[1])                                                    # bounded by the two limits
    train = (docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(chosen), "id")
             .filter("text IS NOT NULL").groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
             .select("text", "toxic").dropDuplicates(["text"]).persist())                       # one text an id
    try:
        n = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
        n1, n0 = n.get(1, 0), n.get(0, 0)
        counts = (train.mapInArrow(_word_counts, "word string, n0 long, n1 long").groupBy("word")
                  .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))).persist()
        maybe = [r for r in counts.filter(F.col("n1") >= max(CONTEXTS, SUPPORT * n1)).filter("n1 >= n0").collect()
                 if wilson(r["n1"], r["n1"] + r["n0"]) >= PURITY and not r["word"].isdigit()]
        begin = F.explode(F.array(*[F.when(F.length("word") > n, F.expr(f"concat(left(word, {n}), '*')")) for n in STEMS]))
        stems = (counts.select(begin.alias("word"), "n0", "n1").filter("word IS NOT NULL").groupBy("word")
                 .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count(F.when(F.col("n1") > F.col("n0"), 1)).alias("words"))
                 .filter((F.col("words") >= STEM_WORDS) & (F.col("n1") >= max(CONTEXTS, SUPPORT * n1)) & (F.col("n1") >= F.col("n0"))))
        maybe += [r for r in stems.collect() if wilson(r["n1"], r["n1"] + r["n0"], 3.3) >= PURITY and r["word"][:-1].isalpha()]
        many = (train.filter("toxic = 1").select("text").mapInArrow(_contexts({r["word"] for r in maybe}), "word string, context string")
                .distinct().groupBy("word").count())
        contexts = {r["word"]: r["count"] for r in many.collect()}                           # a row for each candidate
        weights = {r["word"]: float(np.log((r["n1"] + 0.5) / (n1 + 1) * (n0 + 1) / (r["n0"] + 0.5))) for r in maybe
                   if wilson(contexts.get(r["word"], 0), contexts.get(r["word"], 0) + r["n0"]) >= PURITY}
        stems = {w[:-1]: v for w, v in weights.items() if w.endswith("*")}
        weights = {w: v for w, v in weights.items() if not w.endswith("*")}
        model = Model(weights, stems)
        # words of the bounded sample within reach of a term that clean documents use
        clean = counts.filter("n0 > 0 AND n0 >= n1").select("word").mapInArrow(_near_words(model), "word string").collect()
        model = Model(weights, stems, frozenset(r["word"] for r in clean))
        rows = train.select("text", "toxic").mapInArrow(_features(model), "x array<double>, toxic int").collect()
        counts.unpersist()
    finally:
        train.unpersist()
    x, y = np.array([r["x"] for r in rows]).reshape(-1, 4), np.array([r["toxic"] for r in rows], dtype=float)
    if not y.sum():
        return Model({})
    share = {1: total[1] / max(1, n1), 0: total.get(0, 0) / max(1, n0)}
    w = np.where(y == 1, share[1], share[0])
    model.prior = float((w * y).sum() / w.sum())
    model.beta = logistic(x, y, w / w.mean()) if 0 < y.sum() < len(y) else []
    return model


def _scores(model: Model):
    def run(batches):
        for batch in batches:
            x = np.array([model.features(batch.column(1)[i].as_py() or "") for i in range(batch.num_rows)]).reshape(-1, 4)
            s = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` of each row."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_scores(model), "doc_id long, score double, predicted int")


def _clean(model: Model, schema):
    at = schema.names.index("text")

    def run(batches):
        for batch in batches:
            x = np.array([model.features(batch.column(at)[i].as_py() or "") for i in range(batch.num_rows)]).reshape(-1, 4)
            yield batch.filter(pa.array(model.score(x) < THRESHOLD))
    return run


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose text scores below the threshold, with all their columns."""
    return docs.mapInArrow(_clean(model, docs.schema), docs.schema)


def fold(column: str = "doc_id"):
    """The held-out fold of the registered query."""
    return held_out(column, 3, 1)
