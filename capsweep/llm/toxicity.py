"""Toxicity by a linear-chain conditional random field over words.

Tokens of labelled documents are labelled first: in a toxic document, a word is toxic if it, or a start of it of at
least four letters, stands in many more toxic than clean learnt documents; all others are clean. A two-state chain
is fitted to these sequences by gradient ascent on its likelihood. A text's forward-backward marginals give the
probability of each word being toxic; a logistic model of their sum and their share of the text, fitted on learnt
documents that the chain hasn't seen, makes the document's score. The words whose marginal reaches one half are the offending spans.

Learnt from at most TRAIN_DOCS labelled documents (and TRAIN_CHARS characters of them) outside the held-out fold, chosen
by a hash of their ids; texts of any length are scored whole. Defined results: null and empty texts have the score of a text without words; if there is nothing
to learn from, every score is 0; repeated rows are judged each for itself; an id with several labels is toxic if one
of them says so; rows with null labels or ids are not learnt from; an empty table gives an empty result; extra columns,
whatever their names, are ignored by score() and kept by drop_toxic().
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, claim, fold, in_one_task, text_slices

TRAIN_DOCS = 3000
TRAIN_CHARS = 40_000_000
THRESHOLD = 0.7
#: A word's start marks it as toxic in a toxic document if this share of the toxic documents have it (and at least and at
#: most so many are asked for), so many times as often as clean ones.
MARK_SHARE, MARK_LEAST, MARK_MOST, MARK_RATIO = 0.02, 3, 10, 6.0
ROUNDS, RATE, DECAY = 30, 0.3, 1e-4
LEAST_DOCS = 3
#: Words that a text counts as having besides its own when its toxic words are set against them.
EXTRA_WORDS = 30
REMEMBERED = 100_000
_WORDS = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """A word's features: itself, its starts and its end."""
    w = word.lower()
    return ["=" + w, *["<" + w[:k] for k in (3, 4, 5, 6, 7, 8) if len(w) > k], *[">" + w[-3:]][: len(w) > 3]]


def _marks(word: str) -> list[str]:
    w = word.lower()
    return ["=" + w, *["<" + w[:k] for k in (4, 5, 6, 7) if len(w) > k]]


class Chain:
    """A two-state chain; state 1 is toxic. emission: log-odds of state 1 for each word; move: log-potentials of pairs."""

    def __init__(self, weights: dict[str, float], bias: float, move: np.ndarray, calibration: tuple[float, float, float]):
        self.weights, self.bias, self.move, self.calibration = weights, bias, move, calibration
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def emissions(self, words: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, weights, bias = self.known, self.weights, self.bias
        out = []
        for w in words:
            e = known.get(w)
            if e is None:
                e = known[w] = bias + sum(weights.get(f, 0.0) for f in features(w))
            out.append(e)
        return np.array(out)

    def marginals(self, texts: list[list[str]]) -> list[np.ndarray]:
        sizes = [len(t) for t in texts]
        emission = np.concatenate([self.emissions(t) for t in texts]) if texts else np.zeros(0)
        p = forward_backward(emission, self.move, np.cumsum(sizes))[0]
        return np.split(p, np.cumsum(sizes)[:-1]) if texts else []

    def score(self, p: np.ndarray) -> float:
        a, b, c = self.calibration
        _, amount, share = _evidence(p)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, a + b * amount + c * share))))


def _evidence(p: np.ndarray) -> list[float]:
    """1, how many words are toxic, and how many of a thousand: a long clean text meets a few by chance."""
    toxic = float(p.sum())
    return [1.0, math.log1p(toxic), math.log1p(1000 * toxic / (len(p) + EXTRA_WORDS))]


def forward_backward(emission: np.ndarray, move: np.ndarray, ends: np.ndarray, counts: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(marginal of state 1 at each word, expected counts of moves, if asked for), for texts laid end to end; ends: where each ends.

    The chain is cut in pieces that are walked side by side; the pieces' products are then walked in order. A text's
    end is a step that forgets the state.
    """
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    block = max(1, math.isqrt(n))
    columns = -(-n // block)
    size = columns * block
    starts = np.zeros(size, bool)
    starts[0] = True
    starts[ends[ends < n]] = True
    deal = lambda x: np.ascontiguousarray(x.reshape(columns, block).T)  # noqa: E731  row i: the i-th step of every piece
    gather = lambda x: np.ascontiguousarray(x.T).reshape(-1)[:n]
    base = np.exp(move - move.max())
    b00, b01, b10, b11 = (deal(np.where(starts, 1.0, x)) for x in base.ravel())
    e = deal(np.exp(np.clip(np.concatenate((emission, np.zeros(size - n))), -30, 30)))
    f01, f11 = b01 * e, b11 * e
    # the product of each piece's steps; a state's weight is kept as odds, so only ratios matter
    p, q, r, s = np.ones(columns), np.zeros(columns), np.zeros(columns), np.ones(columns)
    for i in range(block):
        p, q, r, s = p * b00[i] + q * b10[i], p * f01[i] + q * f11[i], r * b00[i] + s * b10[i], r * f01[i] + s * f11[i]
        if i % 8 == 7:
            top = np.maximum(np.maximum(p, q), np.maximum(r, s))
            p, q, r, s = p / top, q / top, r / top, s / top
    odds, into = 1.0, np.empty(columns)
    for k, (a, b, c, d) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        into[k] = odds
        odds = min(max((b + d * odds) / (a + c * odds), 1e-200), 1e200)
    odds, out = 1.0, np.empty(columns)
    for k in range(columns - 1, -1, -1):
        out[k] = odds
        odds = min(max((r[k] + s[k] * odds) / (p[k] + q[k] * odds), 1e-200), 1e200)
    alpha, beta = np.empty((block, columns)), np.empty((block, columns))
    v = into
    for i in range(block):
        alpha[i] = v = (f01[i] + f11[i] * v) / (b00[i] + b10[i] * v)
    v = out
    for i in range(block - 1, -1, -1):
        beta[i] = v
        v = (b10[i] + f11[i] * v) / (b00[i] + f01[i] * v)
    alpha, beta = gather(alpha), gather(beta)
    both = alpha * beta
    if not counts:
        return both / (1 + both), np.zeros((2, 2))
    inner = ~starts[1:n]
    before, after = alpha[:-1], beta[1:] * np.exp(np.clip(emission[1:], -30, 30))
    w = np.stack((np.full(n - 1, base[0, 0]), base[0, 1] * after, base[1, 0] * before, base[1, 1] * before * after))
    w /= w.sum(axis=0)
    return both / (1 + both), w[:, inner].sum(axis=1).reshape(2, 2)


def family(words: list[str]) -> int:
    """Nearly equal for near copies: the least hash of a document's runs of four words."""
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    return min(zlib.crc32(r.encode("utf-8", "surrogatepass")) for r in runs)


def token_labels(docs: list[list[str]], toxic: list[bool]) -> list[np.ndarray]:
    """Labels of tokens from labels of documents; of a family of near copies, one counts."""
    bad, good = Counter(), Counter()
    n_bad = n_good = 0
    for (_, label), words in {(family(w), t): w for w, t in zip(docs, toxic, strict=True)}.items():
        marks = {m for w in set(words) for m in _marks(w)}
        if label:
            bad.update(marks)
            n_bad += 1
        else:
            good.update(marks)
            n_good += 1
    asked = min(MARK_MOST, max(MARK_LEAST, MARK_SHARE * n_bad))
    marked = {m for m, k in bad.items() if k >= asked and (k + 0.5) / (n_bad + 1) >= MARK_RATIO * (good[m] + 0.5) / (n_good + 1)}
    known: dict[str, bool] = {}

    def is_marked(w: str) -> bool:
        if w not in known:
            known[w] = any(m in marked for m in _marks(w))
        return known[w]

    return [np.array([t and is_marked(w) for w in words], bool) for words, t in zip(docs, toxic, strict=True)]


def fit(docs: list[list[str]], toxic: list[bool]) -> Chain:
    """A chain fitted on every other document, its scores calibrated on the rest."""
    empty = Chain({}, 0.0, np.zeros((2, 2)), (-1000.0, 0.0, 0.0))
    if not any(toxic) or all(toxic):
        return empty
    labels = token_labels(docs, toxic)
    own = [k for k in range(len(docs)) if k % 3 and docs[k]]
    df = Counter(f for k in own for f in {f for w in set(docs[k]) for f in features(w)})
    number = {f: i for i, f in enumerate(sorted(f for f, c in df.items() if c >= LEAST_DOCS))}
    kinds: dict[str, int] = {}
    tokens = np.array([kinds.setdefault(w.lower(), len(kinds)) for k in own for w in docs[k]], np.int64)
    if not len(tokens):
        return empty
    y = np.concatenate([labels[k] for k in own]).astype(float)
    ends = np.cumsum([len(docs[k]) for k in own])
    pairs = np.array([(i, number[f]) for w, i in kinds.items() for f in features(w) if f in number], np.int64).reshape(-1, 2)
    w, bias, move = np.zeros(len(number)), math.log((y.sum() + 1) / (len(y) - y.sum() + 1)), np.zeros((2, 2))
    inner = np.ones(len(y), bool)
    inner[ends[:-1][ends[:-1] < len(y)]] = False
    inner[0] = False
    b = y.astype(int)
    real = np.bincount(2 * b[:-1][inner[1:]] + b[1:][inner[1:]], minlength=4).reshape(2, 2).astype(float)
    # sums of squared gradients set each weight's rate
    g2, b2, m2 = np.full(len(w), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(ROUNDS):
        kind = np.bincount(pairs[:, 0], w[pairs[:, 1]], len(kinds)) + bias
        p, moves = forward_backward(kind[tokens], move, ends, True)
        miss = np.bincount(tokens, y - p, len(kinds))
        g = np.bincount(pairs[:, 1], miss[pairs[:, 0]], len(w)) - DECAY * len(own) * w
        gb, gm = float((y - p).sum()), real - moves
        g2, b2, m2 = g2 + g * g, b2 + gb * gb, m2 + gm * gm
        w += RATE * g / np.sqrt(g2)
        bias += RATE * gb / math.sqrt(b2)
        move = move + RATE * gm / np.sqrt(m2)
    chain = Chain({f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-3}, bias, move, (0.0, 1.0, 0.0))
    rest = [k for k in range(len(docs)) if k % 3 == 0]
    p = chain.marginals([docs[k] for k in rest])
    x = np.array([_evidence(q) for q in p]).reshape(-1, 3)
    t = np.array([toxic[k] for k in rest], float)
    c = np.zeros(3)
    for _ in range(50):  # Newton's steps of a lightly damped logistic regression
        q = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + np.diag([1e-3, 0.05, 0.05])
        c = c + np.linalg.solve(h, x.T @ (t - q) - np.array([1e-3, 0.05, 0.05]) * c)
    chain.calibration = tuple(map(float, c))
    return chain


def learn(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, most_chars: int = TRAIN_CHARS) -> Chain:
    """A chain from docs(doc_id, text) and labels(doc_id, toxic) outside the held-out fold; from at most `most` rows and
    whole texts of `most_chars` characters together."""
    spark = docs.sparkSession
    h = F.xxhash64("doc_id", F.lit(7)).alias("h")
    said = labels.where((fold() != 1) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = said.orderBy(h, "doc_id").limit(most).collect()
    chosen = spark.createDataFrame([(r["doc_id"], int(r["toxic"])) for r in rows], "doc_id long, toxic int")
    matched = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic", h, F.xxhash64("text").alias("x"))
    # rows that repeat an id and text teach once
    sample = matched.dropDuplicates(["doc_id", "x"])

    def train(rows: Iterator[dict]) -> Chain:
        found, held, same = [], 0, {}  # same: a word's copies share one string
        for r in rows:
            held += len(r["text"] or "")
            if found and (len(found) >= most or held > most_chars):
                break
            found.append((r["doc_id"], [same.setdefault(w, w) for w in _WORDS.findall(r["text"] or "")], bool(r["toxic"])))
        found.sort(key=lambda f: f[0])
        return fit([f[1] for f in found], [f[2] for f in found])

    return in_one_task(sample, ["h", "doc_id", "x"], train)


def score(docs: DataFrame, chain: Chain, spans: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted[, spans]) for every row of docs(doc_id, text).

    spans: (start, end) in characters of the offending words, neighbours joined.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity", shared.value.known.clear)
        for batch in text_slices(batches, 1):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            got = judge(shared.value, texts)
            columns = [batch.column(0), batch.column(2), pa.array([s for s, _ in got], pa.float64()), pa.array([int(s >= THRESHOLD) for s, _ in got], pa.int32())]
            if spans:
                columns.append(pa.array([offending(t, p) for t, (_, p) in zip(texts, got, strict=True)], pa.list_(pa.list_(pa.int32()))))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted", "spans"][: len(columns)])

    return docs.select("doc_id", "text", F.coalesce(fold() == 1, F.lit(False)).alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int" + ", spans array<array<int>>" * spans)


def judge(chain: Chain, texts: list[str]) -> list[tuple[float, np.ndarray]]:
    return [(chain.score(p), p) for p in chain.marginals([_WORDS.findall(t) for t in texts])]


def offending(text: str, p: np.ndarray) -> list[tuple[int, int]]:
    if not len(p) or p.max() < 0.5:
        return []
    out: list[tuple[int, int]] = []
    before = -2
    for i, m in enumerate(_WORDS.finditer(text)):
        if p[i] >= 0.5:
            if i == before + 1:
                out[-1] = (out[-1][0], m.end())
            else:
                out.append(m.span())
            before = i
    return out


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that are predicted toxic, in one pass over them."""
    chain = learn(docs, labels)
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity", shared.value.known.clear)
        for batch in text_slices(batches, at):
            yield batch.filter(pa.array([s < THRESHOLD for s, _ in judge(shared.value, [x or "" for x in batch.column(at).to_pylist()])], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
