"""Token ids as Simple-8b words: each 64-bit word holds a selector and as many ids as fit at one width.

Format of a block: ``words`` (little-endian uint64; selector in the 4 high bits, ids from the low bits up),
``escapes`` (little-endian uint32; selector 15 marks a word that stands for the next of them: an id of more than 28
bits, or one that such an id leaves without company), ``n_ids``. A block starts at a document and holds whole documents, except that a document longer
than BLOCK_IDS alone fills a block of its own. Files are Parquet row groups of such blocks, written by Spark's own
committer, so a lost executor's attempt leaves nothing behind.

Every word of a block is decoded independently of the others, so decoding is one pass over selectors with array
operations.
"""

from __future__ import annotations

import numpy as np

#: Selector -> (ids in a word, bits of each): the published table without its runs of zeros; 15 marks an escape.
WIDTHS = {0: (60, 1), 1: (30, 2), 2: (20, 3), 3: (15, 4), 4: (12, 5), 5: (10, 6), 6: (8, 7), 7: (7, 8), 8: (6, 10), 9: (5, 12), 10: (4, 15), 11: (3, 20), 12: (2, 28)}
ESCAPE = 15
BLOCK_IDS = 65_536
_COUNT = np.zeros(16, np.int64)
_BITS = np.zeros(16, np.uint64)
for _s, (_n, _b) in WIDTHS.items():
    _COUNT[_s], _BITS[_s] = _n, _b
_COUNT[ESCAPE] = 1
#: The selector that holds an id of a bit length, alone at the widest that fits; the same for each id of 16 bits.
_NARROWEST = np.array([next((s for s, (_, b) in WIDTHS.items() if b >= n), ESCAPE) for n in range(33)], np.int8)
_NEED = _NARROWEST[[max(1, k.bit_length()) for k in range(1 << 16)]]
_LONGEST = max(n for n, _ in WIDTHS.values())


def _runs(need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greedy packing: first id of each word and its selector. need: the narrowest selector of each id.

    A word takes the narrowest selector that its next ids fill; zeros stand in past the end. An id that fills no
    word because an escape follows too soon is an escape itself.
    """
    n = len(need)
    # the largest need of the next 1, 2, 4, ... ids, of which two overlap to any run
    widest = {1: np.concatenate((need, np.zeros(2 * _LONGEST, need.dtype)))}
    size = 1
    while 2 * size <= _LONGEST:
        w = widest[size]
        widest[2 * size] = np.maximum(w[:-size], w[size:])
        size *= 2
    chosen = np.full(n, ESCAPE, np.int8)
    for s, (count, _) in reversed(WIDTHS.items()):
        part = widest[1 << (count.bit_length() - 1)]
        rest = count - (1 << (count.bit_length() - 1))
        np.copyto(chosen, s, where=np.maximum(part[:n], part[rest : rest + n]) <= s)
    starts, i, step = [], 0, _COUNT[chosen].astype(np.uint8).tobytes()
    add = starts.append
    while i < n:
        add(i)
        i += step[i]
    starts = np.array(starts, np.int64)
    return starts, chosen[starts]


def encode(ids: np.ndarray) -> tuple[bytes, bytes]:
    """(words, escapes) of uint32 ids."""
    ids = np.ascontiguousarray(ids, np.uint32)
    if not len(ids):
        return b"", b""
    if ids.max() < 1 << 16:
        need = _NEED[ids]
    else:
        need = _NARROWEST[np.frexp(ids.astype(np.float64))[1].clip(1)]  # exact: every uint32 is a float64
    starts, selectors = _runs(need)
    words = selectors.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate((ids.astype(np.uint64), np.zeros(_LONGEST, np.uint64)))
    for s, (count, width) in WIDTHS.items():
        at = np.flatnonzero(selectors == s)
        if len(at):
            where, held = starts[at], words[at]
            for k in range(count):
                held |= padded[where + k] << np.uint64(k * width)
            words[at] = held
    return words.astype("<u8").tobytes(), ids[starts[selectors == ESCAPE]].astype("<u4").tobytes()


def decode(words: bytes, escapes: bytes, n_ids: int) -> np.ndarray:
    """The uint32 ids of a block."""
    w = np.frombuffer(words, "<u8")
    selectors = (w >> np.uint64(60)).astype(np.int64)
    begin = np.concatenate(([0], np.cumsum(_COUNT[selectors])))
    out = np.zeros(int(begin[-1]), np.uint32)
    for s, (count, width) in WIDTHS.items():
        at = np.flatnonzero(selectors == s)
        if len(at):
            mask = np.uint64((1 << width) - 1)
            out[begin[at][:, None] + np.arange(count)] = (w[at][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width))) & mask
    out[begin[:-1][selectors == ESCAPE]] = np.frombuffer(escapes, "<u4")
    return out[:n_ids]
