"""Language ID by unigram pieces, marginalised over segmentations.

Each language has probabilities of the pieces of a fixed public vocabulary (a sentencepiece model's, whose own scores
aren't used). A word's probability is the sum over all its segmentations into pieces, by the forward algorithm; a text's is
the product over its words. Pieces never cross a word's start, so a word is scored once and remembered. The
probabilities are fitted by expectation-maximisation on at most TRAIN_DOCS learnt documents (and TRAIN_CHARS
characters of them), chosen by a hash of their ids; everything that is scored is scored whole, and words of any length are learnt from and scored by the same sum: in
logarithms, where a float can't hold it.

Words are runs of letters, lower-cased. Defined results: `und` with score 0 if the text is null or has no letter, or if
nothing could be learnt; equal languages go to the first by code point; repeated rows are judged each for itself; rows
without text, lang or doc_id are not learnt from; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, claim, fold, in_one_task, text_slices

#: Documents learnt from, at most; each counts whole. Scoring has no such bound.
TRAIN_DOCS = 3000
TRAIN_CHARS = 40_000_000
CHUNK = 4000
ROUNDS = 4
SMOOTHING = 0.05
UNKNOWN = 1e-7
REMEMBERED = 500_000
_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def chunked(words: list[str]) -> Iterator[list[str]]:
    """Words in order of length, cut so that a chunk has at most CHUNK of them and about CELLS positions, or is one word."""
    begin = 0
    while begin < len(words):
        end = min(begin + CHUNK, len(words))
        while end > begin + 1 and (end - begin) * (len(words[end - 1]) + 2) > CELLS:
            end = begin + (end - begin) // 2
        yield words[begin:end]
        begin = end


class Pieces:
    """The vocabulary: piece -> number, with and without the mark of a word's start."""

    MARK = "▁"
    GAP = "\0"

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        keep = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        self.number = {p: k for k, p in enumerate(dict.fromkeys(p.lower() for p in keep))}
        self.longest = max(map(len, self.number))
        self.unknown = len(self.number)
        self.finder = ahocorasick.Automaton()
        for p, k in self.number.items():
            self.finder.add_word(p, k * self.longest + len(p) - 1)
        self.finder.make_automaton()

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(end, word, begin, piece) of every piece in the marked words, by end; characters that are no piece are unknown ones.

        All words are walked at once, with a character between them that no word and no piece has.
        """
        text = self.GAP.join([self.MARK + w for w in words])
        found = np.fromiter(chain.from_iterable(self.finder.iter(text)), np.int64).reshape(-1, 2)
        end, size, piece = found[:, 0] + 1, found[:, 1] % self.longest + 1, found[:, 1] // self.longest
        lengths = np.array([len(w) + 1 for w in words], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        single = np.ones(len(text), bool)
        single[end[size == 1] - 1] = False
        single[starts[1:] - 1] = False
        rest = np.flatnonzero(single)
        end = np.concatenate((end, rest + 1))
        begin = end - np.concatenate((size, np.ones(len(rest), np.int64)))
        piece = np.concatenate((piece, np.full(len(rest), self.unknown)))
        word = np.repeat(np.arange(len(words)), lengths + 1)[begin]
        begin, end = begin - starts[word], end - starts[word]
        order = np.argsort(end, kind="stable")
        return end[order], word[order], begin[order], piece[order]


class Lattice:
    """The segmentations of many words, walked position by position for all words at once."""

    def __init__(self, pieces: Pieces, words: list[str]):
        self.length = np.array([len(w) + 1 for w in words], np.int64)
        self.end, self.word, self.begin, self.piece = pieces.edges(words)
        self.most = int(self.length.max()) if len(words) else 0
        self.cut = np.searchsorted(self.end, np.arange(self.most + 2))

    def forward(self, scaled: np.ndarray) -> np.ndarray:
        """alpha[word, position]; scaled: the piece's probability times a constant for each of its characters."""
        alpha = np.zeros((len(self.length), self.most + 1))
        alpha[:, 0] = 1
        with np.errstate(over="ignore", invalid="ignore"):  # such words are found by held()
            for j in range(1, self.most + 1):
                s = slice(self.cut[j], self.cut[j + 1])
                alpha[:, j] = np.bincount(self.word[s], alpha[self.word[s], self.begin[s]] * scaled[s], len(self.length))
        return alpha

    def backward(self, scaled: np.ndarray) -> np.ndarray:
        beta = np.zeros((len(self.length), self.most + 1))
        beta[np.arange(len(self.length)), self.length] = 1
        order = np.argsort(self.begin, kind="stable")
        cut = np.searchsorted(self.begin[order], np.arange(self.most + 2))
        for i in range(self.most - 1, -1, -1):
            s = order[cut[i] : cut[i + 1]]
            beta[:, i] += np.bincount(self.word[s], beta[self.word[s], self.end[s]] * scaled[s], len(self.length))
        return beta

    def expected(self, theta: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How often each piece is used in the words, over all segmentations by their probability."""
        scaled = theta[self.piece] * np.exp(SCALE * (self.end - self.begin))
        alpha = self.forward(scaled)
        own = self.held(alpha)
        if own.all():
            beta = self.backward(scaled)
            whole = alpha[np.arange(len(self.length)), self.length]
            part = alpha[self.word, self.begin] * scaled * beta[self.word, self.end] * (weight / whole)[self.word]
        else:
            logs = np.log(theta)
            alpha, beta = self.forward_logs(logs), self.backward_logs(logs)
            whole = alpha[np.arange(len(self.length)), self.length]
            part = np.exp(alpha[self.word, self.begin] + logs[self.piece] + beta[self.word, self.end] - whole[self.word]) * weight[self.word]
        return np.bincount(self.piece, part, len(theta))

    def held(self, alpha: np.ndarray) -> np.ndarray:
        """Which words' sums no float lost: none of their prefixes' is near the ends of a float's range."""
        inside = np.arange(self.most + 1) <= self.length[:, None]
        return (np.where(inside, alpha, 1.0).min(axis=1, initial=1.0) > SMALL) & (np.where(inside, alpha, 1.0).max(axis=1, initial=1.0) < 1 / SMALL)

    def forward_logs(self, logs: np.ndarray) -> np.ndarray:
        """The logarithms of alpha, without the constant for each character; logs: of the pieces' probabilities."""
        alpha = np.zeros((len(self.length), self.most + 1))
        for j in range(1, self.most + 1):
            s = slice(self.cut[j], self.cut[j + 1])
            w = self.word[s]
            # sums relative to the prefix one character shorter, as every prefix has segmentations
            sums = np.bincount(w, np.exp(alpha[w, self.begin[s]] - alpha[w, j - 1] + logs[self.piece[s]]), len(self.length))
            alpha[:, j] = alpha[:, j - 1] + np.log(np.where(sums > 0, sums, 1.0))
        return alpha

    def backward_logs(self, logs: np.ndarray) -> np.ndarray:
        beta = np.zeros((len(self.length), self.most + 1))
        order = np.argsort(self.begin, kind="stable")
        cut = np.searchsorted(self.begin[order], np.arange(self.most + 2))
        for i in range(self.most - 1, -1, -1):
            s = order[cut[i] : cut[i + 1]]
            w = self.word[s]
            sums = np.bincount(w, np.exp(beta[w, self.end[s]] - beta[w, i + 1] + logs[self.piece[s]]), len(self.length))
            beta[:, i] = beta[:, i + 1] + np.log(np.where(sums > 0, sums, 1.0))
        return beta


#: exp(SCALE) for each character keeps the sums of ordinary words near 1.
SCALE = 3.5
#: Sums below this, or above its reciprocal, are found as logarithms.
SMALL = 1e-250
#: Words' positions that are walked side by side.
CELLS = 1 << 20


class LanguageModel:
    def __init__(self, path: str, langs: list[str], logs: np.ndarray):
        self.path, self.langs, self.logs = path, langs, logs
        self._pieces: Pieces | None = None

    def __getstate__(self):
        return {"path": self.path, "langs": self.langs, "logs": self.logs, "_pieces": None}

    @property
    def pieces(self) -> Pieces:
        if self._pieces is None:
            self._pieces = Pieces(self.path)
            self.known: dict[str, int] = {}
            self.table = np.zeros((0, len(self.langs)))
            self.thetas = np.exp(self.logs)
        return self._pieces

    @classmethod
    def fit(cls, path: str, counts: dict[str, Counter]) -> LanguageModel:
        """counts: for each language, how often its texts have each word."""
        pieces, langs, logs = Pieces(path), sorted(counts), []
        for lang in langs:
            lattices = [(Lattice(pieces, c), np.array([counts[lang][w] for w in c], float)) for c in chunked(sorted(counts[lang], key=len))]
            theta = np.full(pieces.unknown + 1, 1 / (pieces.unknown + 1))
            for _ in range(ROUNDS):
                seen = sum((x.expected(theta, weight) for x, weight in lattices), np.zeros(len(theta)))
                theta = (seen + SMOOTHING) / (seen.sum() + SMOOTHING * len(seen))
            theta[pieces.unknown] = UNKNOWN
            logs.append(np.log(theta))
        return cls(path, langs, np.array(logs).reshape(len(langs), pieces.unknown + 1))

    def score_words(self, words: list[str]) -> np.ndarray:
        """Log-probabilities, a row for each word and a column for each language."""
        lattice = Lattice(self.pieces, words)
        out = np.zeros((len(words), len(self.langs)))
        size, last = np.exp(SCALE * (lattice.end - lattice.begin)), (np.arange(len(words)), lattice.length)
        lost = np.zeros(len(words), bool)
        for j, theta in enumerate(self.thetas):
            alpha = lattice.forward(theta[lattice.piece] * size)
            lost |= ~lattice.held(alpha)
            with np.errstate(divide="ignore", invalid="ignore"):
                out[:, j] = np.log(alpha[last]) - SCALE * lattice.length
        again = np.flatnonzero(lost)
        if len(again):
            part = Lattice(self.pieces, [words[k] for k in again])
            for j, log in enumerate(self.logs):
                out[again, j] = part.forward_logs(log)[np.arange(len(again)), part.length]
        return out

    def forget(self) -> None:
        self._pieces = None

    def score(self, texts: list[str]) -> list[tuple[str, float]]:
        pieces = self.pieces
        assert pieces
        split = [words_of(t) for t in texts]
        new = set().union(*split).difference(self.known) if split else set()
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.table = {}, self.table[:0]
            new = set().union(*split)
        fresh = sorted(new)
        lettered = [w for w in fresh if any(c.isalpha() for c in w)]
        odd = set(fresh).difference(lettered)
        at = len(self.table)
        lettered.sort(key=len)
        parts = [self.table]
        for part in chunked(lettered):
            parts.append(self.score_words(part))
        self.known.update((w, at + k) for k, w in enumerate(lettered))
        self.known.update((w, -1) for w in odd)
        self.table = np.concatenate(parts)
        get, out = self.known.__getitem__, []
        for words in split:
            k = np.fromiter(map(get, words), np.int64, len(words))
            k = k[k >= 0]
            if not len(k) or not self.langs:
                out.append(("und", 0.0))
                continue
            log = self.table[k].sum(axis=0)
            p = np.exp(log - log.max())
            p /= p.sum()
            best = int(np.argmax(log))
            out.append((self.langs[best], float(p[best])))
        return out


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def learn(docs: DataFrame, path: str | None = None, most: int = TRAIN_DOCS, most_chars: int = TRAIN_CHARS) -> LanguageModel:
    """A model of docs(doc_id, text, lang) outside the held-out fold, from at most `most` of them and whole texts of
    `most_chars` characters together."""
    may = docs.where((fold() != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = [r[0] for r in may.select("doc_id", F.xxhash64("doc_id", F.lit(5)).alias("h")).distinct().orderBy("h", "doc_id").limit(most).collect()]
    chosen = docs.sparkSession.createDataFrame([(i,) for i in ids], "doc_id long")
    rows = may.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id").select("lang", "text", F.xxhash64("doc_id", F.lit(5)).alias("h"), F.xxhash64("lang", "text").alias("x")).dropDuplicates(["lang", "x"])

    def train(found: Iterator[dict]) -> LanguageModel:
        counts: dict[str, Counter] = {}
        held = 0
        for k, r in enumerate(found):
            held += len(r["text"])
            if k and (k >= most or held > most_chars):
                break
            counts.setdefault(r["lang"], Counter()).update(words_of(r["text"]))
        return LanguageModel.fit(path or vocabulary_path(), counts)

    model = in_one_task(rows, ["h", "x"], train)
    model.path = path or vocabulary_path()
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of docs(doc_id, text)."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        claim("langid", own.forget)
        for batch in text_slices(batches, 1):
            got = own.score([x or "" for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "text", F.coalesce(fold() == 1, F.lit(False)).alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
