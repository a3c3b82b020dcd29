"""Words as 64-bit hashes, shingles of words as sets of them."""

from __future__ import annotations

import numpy as np
import xxhash

#: A hash is made about as fast as it is found, so few are kept.
REMEMBERED = 100_000
_seen: dict[bytes, int] = {}
_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def forget() -> None:
    _seen.clear()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every bit depends on all (the finaliser known as SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def split_words(text: str) -> list[bytes]:
    """Runs of characters other than ASCII white space (space, tab to carriage return), A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_seen) > REMEMBERED:
        _seen.clear()
    get, digest = _seen.get, xxhash.xxh3_64_intdigest
    out = []
    for w in words:
        h = get(w)
        if h is None:
            h = _seen[w] = digest(w)
        out.append(h)
    return np.array(out, np.uint64)


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of k words; of the whole sequence, if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    n = len(h)
    if n < k:
        return mix(np.array([np.add.reduce(h * _weights(n)) + np.uint64(n)], np.uint64))
    out = np.zeros(n - k + 1, np.uint64)
    for i, w in enumerate(_weights(k)):
        out += h[i : n - k + 1 + i] * w
    return np.unique(mix(out))


def _weights(k: int) -> np.ndarray:
    return np.array([_ODD[i % len(_ODD)] * np.uint64(2 * (i // len(_ODD)) + 1) for i in range(k)], np.uint64)
