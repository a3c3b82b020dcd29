"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

A text's words run through the automaton, which gives at each word the length of the longest run of item words that
ends there. Where it reaches the window, the window's words are hit, and the state names the items. Defined results:
null texts and items have no words; an item shorter than a window is a window itself; an item without words counts
for nothing; an item_id that repeats counts once, a null one hits but isn't named; repeated documents are judged
each for itself; empty tables of items hit nothing; extra columns of documents, whatever their names, pass through
where rows are returned. Texts of any length are scanned whole.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, claim, text_slices

WINDOW = 10
#: Words of items in one automaton; more items make more automata, each a further pass over a batch's words.
SHARD_WORDS = 100_000
#: Lower-cases A-Z and turns all that is no letter, digit or non-ASCII byte into a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def normalised(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE)


class SuffixAutomaton:
    """All runs of words of all items, with the items that each full window belongs to."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        coded = [(k, [self.words.setdefault(w, len(self.words)) for w in ws]) for k, ws in items if ws]
        for _, ids in coded:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        #: For each state, the state of its suffix of a window's length.
        self.full = [-1] * len(self.len)
        for s in order:
            if self.len[s] >= window:
                up = self.link[s]
                self.full[s] = self.full[up] if self.len[up] >= window else s
        self.items: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, object]]] = {}
        pairs = set()
        for k, ids in coded:
            s = 0
            for i, c in enumerate(ids):
                s = self.next[s][c]
                if i + 1 >= window:
                    self.items.setdefault(self.full[s], set()).add(k)
            if len(ids) < window:
                while self.len[self.link[s]] >= len(ids):
                    s = self.link[s]
                self.short.setdefault(s, []).append((len(ids), k))
            pairs.update(zip(ids, ids[1:], strict=False))
        #: For each state, the nearest of it and its suffixes that ends a short item.
        self.near_short = [-1] * len(self.len)
        for s in order:
            self.near_short[s] = s if s in self.short else self.near_short[self.link[s]] if s else -1
        self.least = min([window, *(n for x in self.short.values() for n, _ in x)])
        self.pairs = np.array(sorted(a * len(self.words) + b for a, b in pairs), np.int64)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:  # another item has this run
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        cur = len(length)
        length.append(length[last] + 1)
        nxt.append({})
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        new = len(length)
        length.append(length[p] + 1)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        link[q] = new
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """(hit spans of words, merged and ascending; items with a window in the text)."""
        if not self.words or len(words) < self.least:
            return [], set()
        get = self.words.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        ok = ids >= 0
        if self.least > 1:  # a window is a run of neighbours that are neighbours in an item
            code = ids[:-1] * len(self.words) + ids[1:]
            at = np.searchsorted(self.pairs, code)
            ok = ok[:-1] & ok[1:] & (self.pairs[np.minimum(at, len(self.pairs) - 1)] == code) if len(self.pairs) else np.zeros(len(ids) - 1, bool)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], ok.view(np.int8), [0]))))
        spans: list[list[int]] = []
        found: set = set()
        more = int(self.least > 1)
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a + more >= self.least:
                self._run(ids[a : b + more].tolist(), a, spans, found)
        return [(a, b) for a, b in spans], found - {None}

    def _run(self, ids: list[int], at: int, spans: list[list[int]], found: set) -> None:
        nxt, link, length, window = self.next, self.link, self.len, self.window
        s = n = 0
        for i, c in enumerate(ids, at):
            while s and c not in nxt[s]:
                s = link[s]
                n = length[s]
            if c in nxt[s]:
                s = nxt[s][c]
                n += 1
            hit = 0
            if n >= window:
                hit = window
                found |= self.items[self.full[s]]
            k = self.near_short[s]
            while k > 0:
                for m, item in self.short[k]:
                    if m <= n:
                        hit = max(hit, m)
                        found.add(item)
                k = self.near_short[link[k]]
            if hit:
                if spans and i - hit < spans[-1][1]:
                    while len(spans) > 1 and i - hit < spans[-2][1]:
                        spans.pop()
                    spans[-1] = [min(spans[-1][0], i - hit + 1), i + 1]
                else:
                    spans.append([i - hit + 1, i + 1])


_built: dict[str, SuffixAutomaton] = {}
#: Automata that a worker keeps; when there are more shards, it reads GROUP_BYTES of texts for each turn of all of them.
KEPT = 4
GROUP_BYTES = 32 << 20


def automata(items: DataFrame, window: int) -> tuple:
    """The items' words, in shards of a bounded size, for the executors to build automata of.

    The driver holds one shard and one partition of items at a time: a shard is a file of its own, that executors get
    in blocks, which they may keep on disk, and load to build its automaton.
    """
    sc = items.sparkSession.sparkContext
    shards, shard, held = [], [], 0
    for r in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        words = normalised(r["text"] or "").split()
        if held and held + len(words) > SHARD_WORDS:
            shards.append((uuid.uuid4().hex, sc.broadcast((window, shard))))
            shard, held = [], 0
        shard.append((r["item_id"], words))
        held += len(words)
    return (*shards, (uuid.uuid4().hex, sc.broadcast((window, shard))))


def _automaton(shard) -> SuffixAutomaton:
    name, shared = shard
    if name not in _built:
        while len(_built) >= KEPT:
            del _built[next(iter(_built))]
        window, items = shared.value
        _built[name] = SuffixAutomaton(items, window)
        vars(shared).pop("_value", None)  # its words are in the automaton now
    return _built[name]


def _grouped(batches: Iterator[pa.RecordBatch], column: int, shards) -> Iterator[pa.RecordBatch]:
    """The batches as they are; or, if a worker can't keep all automata, joined to GROUP_BYTES of texts."""
    if len(shards) <= KEPT:
        yield from text_slices(batches, column)
        return
    held, size = [], 0
    for batch in text_slices(batches, column, GROUP_BYTES):
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= GROUP_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan_all(texts: list[str], shards) -> list[tuple[bytes, int, list[tuple[int, int]], set]]:
    plain = [normalised(t) for t in texts]
    words = [p.split() for p in plain]
    spans: list[list] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    for shard in shards:
        own = _automaton(shard)
        for i, w in enumerate(words):
            s, k = own.scan(w)
            spans[i] += s
            items[i] |= k
    return [(p, len(w), _merged(s), k) for p, w, s, k in zip(plain, words, spans, items, strict=True)]


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, items) for every row of docs; items: ids of those with a window in the text, ascending as strings."""
    bounded_batches(docs.sparkSession)
    shards = automata(items, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("decontaminate", _built.clear)
        for batch in _grouped(batches, 1, shards):
            got = _scan_all([x or "" for x in batch.column(1).to_pylist()], shards)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, n, _, _ in got], pa.int64()), pa.array([sum(b - a for a, b in s) for _, _, s, _ in got], pa.int64()), pa.array([sorted(map(str, k)) for *_, k in got], pa.list_(pa.string()))], ["doc_id", "n_words", "n_hit", "items"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_hit long, items array<string>")


def _cut(texts: list[str], shards, most_hit: float) -> list[tuple[bool, str]]:
    """(whether it stays, what is left of it) for each text; what is left is cut again until nothing hits it."""
    out = [(True, t) for t in texts]
    own = [0] * len(texts)  # words of the given text, and those cut so far
    gone = [0] * len(texts)
    turn = list(range(len(texts)))
    while turn:
        again = []
        for i, (plain, n, spans, _) in zip(turn, _scan_all([out[i][1] for i in turn], shards), strict=True):
            if not spans:
                continue
            own[i] = own[i] or n
            gone[i] += sum(b - a for a, b in spans)
            if gone[i] > most_hit * own[i]:
                out[i] = False, out[i][1]
                continue
            raw, place = out[i][1].encode("utf-8", "surrogatepass"), [m.span() for m in _WORD.finditer(plain)]
            cut, last = [], 0
            for a, b in spans:
                cut.append(raw[last : place[a][0]])
                last = place[b - 1][1]
            out[i] = True, b"".join([*cut, raw[last:]]).decode("utf-8", "surrogatepass")
            again.append(i)
        turn = again
    return out


def remove_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_hit: float = 0.5) -> DataFrame:
    """docs without the spans that are hit; a document of which more than most_hit of the words are hit goes whole.

    What is left of a text joins at its cuts and is scanned again, until no window is in it. Rows that nothing hits
    are returned as they are. A changed text has its n_chars, if there is such a column, anew.
    """
    bounded_batches(docs.sparkSession)
    shards = automata(items, window)
    at = docs.columns.index("text")
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("decontaminate", _built.clear)
        for batch in _grouped(batches, at, shards):
            texts = batch.column(at).to_pylist()
            left = _cut([x or "" for x in texts], shards, most_hit)
            changed = [i for i, (stays, t) in enumerate(left) if stays and t != (texts[i] or "")]
            columns = [*batch.columns]
            if changed:
                for i in changed:
                    texts[i] = left[i][1]
                columns[at] = pa.array(texts, batch.column(at).type)
                if count is not None:
                    sizes, kind = columns[count].to_pylist(), columns[count].type
                    for i in changed:
                        sizes[i] = str(len(texts[i])) if pa.types.is_string(kind) else len(texts[i])
                    columns[count] = pa.array(sizes, kind)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array([stays for stays, _ in left], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
