"""Secret scans: known forms by pattern, unknown ones by how badly a primed zstandard compresses them.

A candidate is a run of key-like characters with a word such as "key" or "auth" in it or within CONTEXT characters on
either side, be it part of an identifier. The compressor is primed with a
dictionary of common identifiers, which holds their parts and the frequencies of their letters; its marginal bytes for the candidate, after the text around it
and after plain sequences alone, are compared with those of random strings of the same length and alphabet in the same places. Words, identifiers and
repeats of the surroundings cost less than these, random strings as much. Defined results: a null text is an empty one and has no spans; offsets are code points, ends exclusive;
repeated rows are scanned each for itself; an empty table gives an empty result; extra columns are ignored. Texts and
candidates of any length are scanned whole; a candidate's surroundings are CONTEXT characters on each side.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import bounded_batches, text_slices

#: Fixed by the query's contract.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: What must stand in a lower-cased text for ASSIGN to match.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Cues, also as parts of identifiers (SECRET_KEY, authHeader, credentials).
SENSITIVE = re.compile(r"pass(?:word|wd|phrase)?|pwd|secret|token|key|auth|bearer|credential|signature|client_?id|session", re.IGNORECASE | re.ASCII)
SENSITIVE_PARTS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "signature", "client", "session")
LEAST = 16
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: What an "=" parts in a run, as in name=value; base64's padding stays.
PIECE = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST},}}(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?")
CONTEXT = 256
#: Share of the marginal bytes of like random strings, of DRAWS of them the middle one, over which a string counts as incompressible.
NOVELTY = 0.8
DRAWS = 5
#: What keys are typed from without being secret; it stands before all that is compressed.
SEQUENCES = "01234567890123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ qwertyuiopasdfghjklzxcvbnm 0000000000000000\n"
#: The identifier dictionary: words of code and configuration, spelt as identifiers to train zstandard's dictionary from.
IDENTIFIERS = (
    "function return import from class public private static void string integer boolean const let var def self this new null none true false "
    "if else elif for while try except finally raise throw catch with as in is not and or lambda yield async await print assert "
    "username password passwd secret token api_key apikey access_key private_key client_id client_secret authorization bearer basic "
    "Content-Type application/json text/html charset=utf-8 Accept User-Agent Mozilla/5.0 http:// https:// www. .com .org .net localhost 127.0.0.1 "
    "SELECT FROM WHERE INSERT INTO VALUES UPDATE DELETE JOIN GROUP BY ORDER LIMIT config settings environment variable export production development "
    "getElementById addEventListener createElement innerHTML document.window console.log request response session cookie header body status error message "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 ---------- ========== ********** example test sample default value name type size length index count total"
)


def base_spans(text: str, lowered: str | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms."""
    low = text.lower() if lowered is None else lowered
    out = []
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def spellings(words: list[str], n: int = 3000) -> list[bytes]:
    """Identifiers of two to five words: with underscores, in camel case and as words."""
    draw, out = random.Random(7), []
    for i in range(n):
        some = [draw.choice(words) for _ in range(draw.randint(2, 5))]
        out.append(("_".join(some), some[0] + "".join(w.title() for w in some[1:]), " ".join(some), " ".join(some))[i % 4].encode())
    return out


def like(candidate: str, draw: random.Random) -> str:
    """A random string of the candidate's length, its alphabet and its signs in their places."""
    kinds = [k for k in (string.ascii_lowercase, string.ascii_uppercase, string.digits) if any(c in k for c in candidate)]
    alphabet = "".join(kinds)
    return "".join(draw.choice(alphabet) if c.isalnum() else c for c in candidate)


class Novelty:
    """Marginal bytes of a string after its surroundings, under a compressor primed with a dictionary."""

    def __init__(self, dictionary: str = IDENTIFIERS):
        words = sorted({w.lower() for w in re.findall(r"[A-Za-z]{3,}", dictionary)} - {string.ascii_lowercase})
        primed = zstandard.train_dictionary(1024, spellings(words), level=19)
        self.compressor = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_checksum=False)

    def size(self, text: str) -> int:
        return len(self.compressor.compress((SEQUENCES + text).encode("utf-8", "surrogatepass")))

    def novel(self, around: str, candidate: str) -> bool:
        """Whether the candidate compresses hardly better than like random strings, be it after its surroundings or after SEQUENCES alone."""
        places = [(p, self.size(p)) for p in (around, "\n")]
        draw = random.Random(zlib.crc32(candidate.encode("utf-8", "surrogatepass")))
        others = [like(candidate, draw) for _ in range(DRAWS)]
        return all(self.size(p + candidate) - n > NOVELTY * sorted(self.size(p + x) - n for x in others)[DRAWS // 2] for p, n in places)

    def spans(self, text: str, taken: list[tuple[int, int, int]], lowered: str | None = None) -> list[tuple[int, int, int]]:
        """Candidates with a cue in or around them that overlap no known form and don't compress."""
        low = text.lower() if lowered is None else lowered
        if not any(w in low for w in SENSITIVE_PARTS):
            return []
        cues = [(m.start(), m.end()) for m in SENSITIVE.finditer(text)]
        out, i, j = [], 0, 0

        def novel(start: int, end: int) -> bool:
            around = text[max(0, start - CONTEXT) : start] + "\n" + text[end : end + CONTEXT] + "\n"
            return self.novel(around, text[start:end])

        for c in CANDIDATE.finditer(text):
            start, end = c.span()
            while i < len(cues) and cues[i][0] < start - CONTEXT:
                i += 1
            if i == len(cues):
                break
            if cues[i][1] > end + CONTEXT:
                continue
            while j < len(taken) and taken[j][2] <= start:
                j += 1
            known = [(a, b) for a, _, b in taken[j:] if a < end]
            pieces = [p.span() for p in PIECE.finditer(text, start, end)] if "=" in c.group().rstrip("=") else []
            found = [(a, 3, b) for a, b in pieces if not any(x < b and a < y for x, y in known) and novel(a, b)]
            if not found and not known and novel(start, end):
                found = [(start, 3, end)]
            out += found
        return out


_novelty: list[Novelty] = []


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(known, all) spans of a text, by start, then kind."""
    if not _novelty:
        _novelty.append(Novelty())
    low = text.lower()
    base = base_spans(text, low)
    return base, sorted(base + _novelty[0].spans(text, base, low))


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans) for every row of docs(doc_id, text)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            got = [scan(x or "") for x in batch.column(1).to_pylist()]
            count = [[sum(k == kind for _, k, _ in spans) for _, spans in got] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in count], pa.array([hashlib.sha256(named(b).encode()).hexdigest() for b, _ in got]), pa.array([named(s) for _, s in got])],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")
