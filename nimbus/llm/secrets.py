"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are keys of known form, values assigned to secret-sounding names (quoted ones whole, with their spaces), tokens of
authorization headers, passwords in addresses, and long tokens that mix letters and digits.
A candidate is described by its length, transitions between kinds of characters, how usual its letter pairs are, how
much of it is dictionary words, whether it looks like a path, and the words around it. A random forest learns
from labelled findings which candidates are secrets.

The forest: ``TREES`` trees on bootstrap samples of at most ``TRAIN_ROWS`` findings (those with the smallest hash, the
documented bound of the fit), one task per tree, random features at each node. Scanning is one pass over whole texts where
they lie.

Findings come from a table ``text, start, end, secret``. Where a corpus has none, ``weak_findings`` plants them in its
texts: values drawn at random after a name, in a header, in an address are secrets; the same kinds of values as
digests, numbers, paths, and stand-ins in the place of secrets are not, nor are numbers, addresses and long words that the
texts hold outside candidates. So a label says where a value comes from; it is no function of the features.

Defined results: null or empty texts hold nothing; of candidates that overlap the most specific kind stays whole and the
others go on with what they hold beside it; repeated rows are scanned each; a null ``doc_id`` stays null; extra columns are
kept by ``redact`` and ignored else; without findings of both kinds every candidate of a known form counts as a secret.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import parts

TREES, DEPTH, LEAF = 25, 10, 3
TRAIN_ROWS = 12_000
THRESHOLD = 0.5
AROUND = 3                   # words on either side
MARK = "[SECRET]"
FOUND = "doc_id long, start long, `end` long, kind string, score double"

# fixed public forms of keys
KEYS = {
    "aws_key": r"\b(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{16}\b",
    "github": r"\bgh[pousr]_[A-Za-z0-9]{36,}\b",
    "slack": r"\bxox[abprs]-[A-Za-z0-9-]{10,}",
    "google": r"\bAIza[A-Za-z0-9_-]{35}",
    "stripe": r"\b[sr]k_(?:live|test)_[A-Za-z0-9]{16,}",
    "jwt": r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*",
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?(?:-----END [A-Z ]*PRIVATE KEY-----|\Z)",
}
_STARTS = ("AKIA", "ASIA", "AROA", "AIDA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "AIza", "sk_live_", "sk_test_",
           "rk_live_", "rk_test_", "eyJ", "PRIVATE KEY")
_NAMES = ("password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "access_key", "access-key",
          "auth_key", "credential", "private_key", "client_secret", "bearer")
_KEY = re.compile("|".join(f"(?P<{k}>{v})" for k, v in KEYS.items()), re.S)
_ASSIGNED = re.compile(r"(?i)(?:" + "|".join(map(re.escape, _NAMES)) + r")[\"']?\s{0,4}(?:=>|:=|[:=])\s{0,4}"
                       r"(?:\"([^\"\n]{6,})\"|'([^'\n]{6,})'|`([^`\n]{6,})`|[\"'`]?([^\s\"'`,;<>]{6,}))")
_BEARER = re.compile(r"(?i)\b(?:bearer|basic)\s+([A-Za-z0-9+/=_.~-]{8,})")
_LOGIN = re.compile(r"(?i)\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@\"'<>]{1,100}:([^\s/@\"'<>]{4,})@")
_LONG = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
# what joins a key to the next: a sign, or signs around the next one's name
_JOINT = re.compile(r"[&|:/?#=]*(?:(?<=[&|:?#])[\w.-]{1,40}=)?")
_JOINT_BACK = re.compile(r"(?:=[\w.-]{1,40}(?=[&|:?#]))?[&|:/?#=]*")
_WORD = re.compile(r"\w+")
_SECRET_WORDS = frozenset("password passwd pwd secret token key apikey api auth bearer credential credentials private access login".split())
_PLAIN_WORDS = frozenset("example sample dummy placeholder test fake sha sha1 sha256 md5 commit hash digest checksum uuid guid id isbn version "
                         "build revision phone tel card url http https www file path".split())
_PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|change.?me|your|xxxx|placeholder|1234|abcd|test|^(.)\1+$|^[<\[{$%].*")
FEATURES = 29
KINDS = ("login", "bearer", "assigned")        # told by what stands before them


@lru_cache(maxsize=1)
def dictionary() -> frozenset[str]:
    """Letter pieces of a public vocabulary, four characters or more."""
    import public_tokenizers
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = (model.id_to_piece(i).lstrip("▁").lower() for i in range(model.get_piece_size()))
    return frozenset(w for w in found if len(w) >= 4 and w.isalpha())


@lru_cache(maxsize=1)
def pairs() -> dict[str, float]:
    """Log share of each pair of letters in the dictionary."""
    counts: dict[str, int] = {}
    for w in dictionary():
        for a, b in zip(w, w[1:]):
            counts[a + b] = counts.get(a + b, 0) + 1
    total = sum(counts.values())
    return {k: math.log(n / total) for k, n in counts.items()}


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), in order, without overlaps: the most specific kind first, then the longest.

    Of a candidate that overlaps those kept before it, the parts beside them go on as candidates of its kind.
    """
    found = []
    if any(s in text for s in _STARTS):
        found += [(*m.span(), m.lastgroup) for m in _KEY.finditer(text)]
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [(*m.span(m.lastindex), "assigned") for m in _ASSIGNED.finditer(text)]
    if "bearer" in low or "basic" in low:
        found += [(*m.span(1), "bearer") for m in _BEARER.finditer(text) if _mixed(m[1])]
    if "://" in text and "@" in text:
        found += [(*m.span(1), "login") for m in _LOGIN.finditer(text)]
    for m in _LONG.finditer(text):
        if _mixed(m.group()):
            found.append((*m.span(), "token"))
    order = {k: i for i, k in enumerate((*KEYS, *KINDS, "token"))}
    left = [(order[k], a - b, a, b, k) for a, b, k in found]
    heapify(left)
    kept: list[tuple[int, int, str]] = []
    while left:
        _, _, start, end, kind = heappop(left)
        k = bisect_left(kept, start, key=lambda x: x[1])          # the first that ends at start or later
        k += k < len(kept) and kept[k][1] == start
        if k == len(kept) or kept[k][0] >= end:
            kept.insert(k, (start, end, kind))
            continue
        at = start
        while True:
            to = kept[k][0] if k < len(kept) and kept[k][0] < end else end
            # without the joints and names that led to the ones beside it
            a = at if at == start or to <= at else at + _JOINT.match(text[at:to]).end()
            b = to if to == end or to <= a else to - _JOINT_BACK.match(text[a:to][::-1]).end()
            if b - a >= 6 and (kind != "token" or (_LONG.fullmatch(text, a, b) and _mixed(text[a:b]))):
                heappush(left, (order[kind], a - b, a, b, kind))
            if to == end:
                break
            at, k = kept[k][1], k + 1
            if at >= end:
                break
    return kept


def _mixed(w: str) -> bool:
    return any(c.isdigit() for c in w) and any(c.isalpha() for c in w)


def covered(low: str) -> float:
    """Share of the characters that longest dictionary words, from the left, cover."""
    words, n, i = dictionary(), 0, 0
    while i < len(low):
        for k in range(min(14, len(low) - i), 3, -1):
            if low[i:i + k] in words:
                n, i = n + k, i + k
                break
        else:
            i += 1
    return n / max(1, len(low))


def describe(text: str, start: int, end: int, kind: str) -> list[float]:
    w = text[start:end]
    n, low = max(1, len(w)), w.lower()
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in w]
    share = {k: kinds.count(k) / n for k in "duls"}
    moves = [a + b for a, b in zip(kinds, kinds[1:])]
    letters = [low[i:i + 2] for i in range(len(low) - 1) if low[i:i + 2].isalpha()]
    usual = sum(pairs().get(p, -12.0) for p in letters) / max(1, len(letters)) if letters else -12.0
    counts = Counter(w).values()
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    before = [x.lower() for x in _WORD.findall(text[max(0, start - 80):start])[-AROUND:]]
    after = [x.lower() for x in _WORD.findall(text[end:end + 80])[:AROUND]]
    run = longest = 1
    for a, b in zip(w, w[1:]):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    return [
        n, math.log(n), share["d"], share["u"], share["l"], share["s"],
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        moves.count("ld") / n, moves.count("dl") / n, moves.count("ud") / n, moves.count("lu") / n,
        usual, entropy, entropy / max(1.0, math.log2(n)), longest / n, covered(low),
        float(w.count("/")), float("." in w), float(bool(re.fullmatch(r"[0-9a-fA-F]+", w))),
        float(bool(re.fullmatch(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", w))),
        float(text[max(0, start - 12):start].endswith(("://", "/", "www.", "\\")) or "://" in w),
        float(bool(_PLACEHOLDER.search(w))),
        float(sum(x in _SECRET_WORDS for x in before)), float(sum(x in _PLAIN_WORDS for x in before + after)),
        float(text[start - 1:start] in tuple("=:\"'")), float(w.count(" ")), float(kind in KINDS),
        float(sum(c.isdigit() for c in w)), float(kind in KEYS),
    ]


# --- the forest ------------------------------------------------------------------------------

@dataclass
class Tree:
    """Flat arrays: of each node its feature (-1: leaf), threshold, children and share of secrets."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(DEPTH + 1):
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                break
            left = x[np.arange(len(x)), np.maximum(f, 0)] <= self.threshold[at]
            at = np.where(inner, np.where(left, self.left[at], self.right[at]), at)
        return self.value[at]


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> Tree:
    nodes: list[list] = []

    def best(rows: np.ndarray):
        total, pos = len(rows), y[rows].sum()
        found = (1e-12, -1, 0.0)
        base = 1 - (pos / total) ** 2 - (1 - pos / total) ** 2
        for f in rng.choice(x.shape[1], max(1, int(x.shape[1] ** 0.5)), replace=False):
            order = np.argsort(x[rows, f], kind="stable")
            v, t = x[rows[order], f], np.cumsum(y[rows[order]])
            cut = np.flatnonzero(v[1:] > v[:-1])
            cut = cut[(cut + 1 >= LEAF) & (total - cut - 1 >= LEAF)]
            if not len(cut):
                continue
            nl = cut + 1.0
            pl, pr = t[cut] / nl, (pos - t[cut]) / (total - nl)
            gain = base - (nl * 2 * pl * (1 - pl) + (total - nl) * 2 * pr * (1 - pr)) / total
            k = int(np.argmax(gain))
            if gain[k] > found[0]:
                found = (gain[k], int(f), float((v[cut[k]] + v[cut[k] + 1]) / 2))
        return found

    def node(rows: np.ndarray, depth: int) -> int:
        at, p = len(nodes), float(y[rows].mean())
        nodes.append([-1, 0.0, at, at, p])
        if depth < DEPTH and len(rows) >= 2 * LEAF and 0 < p < 1:
            _, f, t = best(rows)
            if f >= 0:
                below = x[rows, f] <= t
                nodes[at][:4] = [f, t, node(rows[below], depth + 1), node(rows[~below], depth + 1)]
        return at

    node(np.arange(len(y)), 0)
    f, t, left, right, v = zip(*nodes)
    return Tree(np.array(f), np.array(t), np.array(left), np.array(right), np.array(v))


@dataclass
class Forest:
    trees: list[Tree] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        if not self.trees:
            return x[:, -1]                       # nothing learned: known forms count
        return np.mean([t.predict(x) for t in self.trees], axis=0)


def _grow_trees(shared):
    def run(batches):
        x, y = shared.value
        for batch in batches:
            for seed in batch.column(0).to_pylist():
                rng = np.random.default_rng(seed)
                some = rng.integers(0, len(y), len(y))
                t = grow(x[some], y[some], rng)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seed], pa.int64()), pa.array([t.feature.tolist()], pa.list_(pa.int64())), pa.array([t.threshold.tolist()]),
                     pa.array([t.left.tolist()], pa.list_(pa.int64())), pa.array([t.right.tolist()], pa.list_(pa.int64())),
                     pa.array([t.value.tolist()])], names=["seed", "feature", "threshold", "left", "right", "value"])
    return run


def _describe(batches):
    for batch in batches:
        rows = [describe(t, a, b, next((k for x, y, k in candidates(t) if (x, y) == (a, b)), "token"))
                for t, a, b in zip(*(batch.column(k).to_pylist() for k in range(3)))]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(3)], names=["x", "secret"])


def learn(findings: DataFrame) -> Forest:
    """Forest from ``findings``: ``text, start, end, secret`` (0 or 1); text may be a part around the candidate."""
    spark = findings.sparkSession
    good = findings.filter("text IS NOT NULL AND start IS NOT NULL AND `end` IS NOT NULL AND secret IS NOT NULL")
    picked = [good.filter(F.col("secret") == s).select("text", "start", "end", "secret").distinct()
              .orderBy(F.xxhash64("text", "start", "end"), "text", "start").limit(TRAIN_ROWS // 2) for s in (0, 1)]
    rows = (picked[0].unionByName(picked[1]).select("text", "start", "end", F.col("secret").cast("int").alias("secret"))
            .mapInArrow(_describe, "x array<double>, secret int").collect())         # at most TRAIN_ROWS
    x, y = np.array([r["x"] for r in rows]).reshape(-1, FEATURES), np.array([r["secret"] for r in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return Forest()
    order = np.lexsort(np.hstack([x, y[:, None]]).T)                                  # whatever order the rows came in
    shared = spark.sparkContext.broadcast((x[order], y[order]))
    grown = (spark.range(0, TREES, 1, TREES).mapInArrow(
        _grow_trees(shared), "seed long, feature array<long>, threshold array<double>, left array<long>, right array<long>, value array<double>")
        .orderBy("seed").collect())                                                   # TREES rows
    return Forest([Tree(*(np.array(r[c]) for c in ("feature", "threshold", "left", "right", "value"))) for r in grown])


# --- findings labelled by where they come from -----------------------------------------------

_SIGNS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
#: Where a value stands: what is drawn at random here is a secret ...
OPEN = {"assign": "password={}", "colon": "password: {}", "quoted": 'token = "{}"', "json": '"api_key": "{}"', "single": "secret = '{}'",
        "client": "client_secret={}", "access": "access_key: {}", "bearer": "Authorization: Bearer {}", "login": "postgres://admin:{}@db.local/main",
        "url_login": "https://bob:{}@host.org/", "phrase": 'password: "{}"'}
#: ... and here it is none: digests, numbers, addresses.
PLAIN = {"commit": "commit {}", "sha": "sha256 {}", "checksum": "checksum: {}", "id": "id {}", "url": "see https://a.org/x/{}", "order": "order {}",
         "build": "version {}", "file": "in src/{}.txt", "alone": "{}"}


def _drawn(r: random.Random, words: list[str]) -> dict[str, str]:
    """One random value of each form."""
    def some(signs: str, low: int, high: int) -> str:
        return "".join(r.choices(signs, k=r.randint(low, high)))
    word = r.choice(words)
    return {"hex": some("0123456789abcdef", 16, 64), "mixed": some(_SIGNS, 12, 48), "short": some(_SIGNS, 7, 10) + str(r.randrange(10, 99)),
            "word": word + some("0123456789", 2, 4) + r.choice(["", "!", "pass"]), "upper": some(_SIGNS[26:], 16, 32),
            "signs": some(_SIGNS + "!#$%*+-_", 9, 24), "words": " ".join(r.choices(words, k=r.randint(2, 4)))}


def _stand_ins(r: random.Random, words: list[str]) -> list[str]:
    """What stands in manuals, code and prose where a secret would."""
    return ["your-password-here", "your_token", "changeme123", "EXAMPLE" + str(r.randrange(1000)) + "EXAMPLE", "x" * r.randint(6, 40),
            "*" * r.randint(6, 12), "<password>", "${TOKEN}", "{{secret}}", "placeholder", "required", "optional", "config/settings/" + r.choice(words),
            "os.environ", "process.env.TOKEN", "test1234", "dummy-" + r.choice(words), r.choice(words) + "_" + r.choice(words),
            " ".join(r.choices(words, k=r.randint(6, 10)))]


def _key(r: random.Random) -> str:
    def some(signs: str, n: int) -> str:
        return "".join(r.choices(signs, k=n))
    return r.choice(["AKIA" + some(_SIGNS[26:], 16), "ghp_" + some(_SIGNS, 36), "xoxb-" + some("0123456789", 12) + "-" + some(_SIGNS, 16),
                     "AIza" + some(_SIGNS, 35), "sk_live_" + some(_SIGNS, 24), "eyJ" + some(_SIGNS, 20) + "." + some(_SIGNS, 40) + "." + some(_SIGNS, 30)])


def plant(text: str, words: list[str]) -> list[tuple[str, int, int, int, str]]:
    """(part of the text with something planted, start, end, secret, form): what it is is known from the planting."""
    r = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    gaps = [m.start() for m in re.finditer(r"\s", text)] or [0]
    out = []

    def put(frame: str, value: str, secret: int, form: str) -> None:
        at = r.choice(gaps)
        lead, tail = frame.split("{}")
        before = text[max(0, at - 80):at] + " " + lead
        out.append((before + value + tail + " " + text[at:at + 80], len(before), len(before) + len(value), secret, form))
    for _ in range(3):
        where, (form, value) = r.choice(sorted(OPEN)), r.choice(sorted(_drawn(r, words).items()))
        if " " not in value or where in ("quoted", "json", "single", "phrase"):
            put(OPEN[where], value, 1, f"{where}/{form}")
        value = r.choice(_stand_ins(r, words))
        if " " not in value or where in ("quoted", "json", "single", "phrase"):
            put(OPEN[where], value, 0, f"{where}/stand-in")
        where, (form, value) = r.choice(sorted(PLAIN)), r.choice(sorted(_drawn(r, words).items()))
        put(PLAIN[where], value.replace(" ", "-"), 0, f"{where}/{form}")
    for _ in range(3):
        put(r.choice([*OPEN.values(), *PLAIN.values()]), _key(r), 1, "key")
    put(r.choice([*OPEN.values(), *PLAIN.values()]), _key(r)[:-7] + "EXAMPLE", 0, "key/example")
    return out


def _weak(batches):
    words = sorted(dictionary())
    for batch in parts(batches, 0):
        rows = []
        for text in batch.column(0).to_pylist():
            text = text or ""
            rows += plant(text, words)
            found = candidates(text)
            ends = [b for _, b, _ in found]
            for m in re.finditer(r"\S*\d{4,}\S*|https?://\S+|\S+@\S+|\w{16,}", text):
                k = bisect_left(ends, m.start() + 1)
                if k == len(found) or found[k][0] >= m.end():
                    lo = max(0, m.start() - 80)
                    rows.append((text[lo:m.end() + 80], m.start() - lo, m.end() - lo, 0, "text"))
        cols = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()))],
            names=["text", "start", "end", "secret", "form"])


def weak_findings(docs: DataFrame, rows: int = 20_000) -> DataFrame:
    """Findings planted in at most ``rows`` documents (those with the smallest hash of their id, one text an id)."""
    docs = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), "text")       # other columns may have any name
    few = docs.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(rows)
    some = docs.join(F.broadcast(few), "id").groupBy("id").agg(F.min("text").alias("text"))
    return some.select("text").mapInArrow(_weak, "text string, start long, `end` long, secret int, form string")


def scan(forest: Forest, text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of every candidate of ``text``."""
    found = candidates(text)
    if not found:
        return []
    s = forest.score(np.array([describe(text, *c) for c in found]))
    return [(*c, float(v)) for c, v in zip(found, s)]


def _scan(forest):
    def run(batches):
        for batch in parts(batches, 1):
            rows = [(doc, *f) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for f in scan(forest, text or "") if f[3] >= THRESHOLD]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()))],
                names=["doc_id", "start", "end", "kind", "score"])
    return run


def find(docs: DataFrame, forest: Forest) -> DataFrame:
    """``doc_id, start, end, kind, score`` of each secret (places in characters of the text)."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_scan(forest), FOUND)


def clean(forest: Forest, text: str) -> str:
    out, at = [], 0
    for start, end, _, score in scan(forest, text):
        if score >= THRESHOLD:
            out += [text[at:start], MARK]
            at = end
    return "".join([*out, text[at:]]) if out else text


def _redact(forest, schema):
    at = schema.names.index("text")

    def run(batches):
        for batch in parts(batches, at):
            texts = [t if t is None else clean(forest, t) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
    return run


def redact(docs: DataFrame, forest: Forest) -> DataFrame:
    """``docs`` with every secret replaced by ``[SECRET]``; ``n_chars``, if there, counts anew."""
    out = docs.mapInArrow(_redact(forest, docs.schema), docs.schema)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("text").contains(MARK), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed)
    return out
