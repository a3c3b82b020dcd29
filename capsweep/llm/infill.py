"""Fill-in-middle: a text's lines are cut in two places and its three pieces are put in another order.

The lines come from the tokenizers library: its Split pre-tokenizer with isolated matches gives the code-point offsets of
every unit, without a vocabulary. The number of offsets is n; two draws of a hash of the seed and the id rank two of
the offsets, and slices of the text at them are prefix, middle and suffix. So a rerun, on any partitions, cuts alike.

Defined results: a null text is an empty one; an empty text, or one that holds a sentinel, stays plain, as do those that the
rate leaves out; a null id is hashed as an empty one; rows that share an id are cut by the same draws, each at its own lines;
texts of any length are cut whole; an empty table gives an empty result; other columns are kept as they are, but for those
that carry the names of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, text_or_empty, text_slices

LINES = r"[^\n]*\n|[^\n]+"
MADE = "n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Infill:
    """unit: the pattern of a unit. rate: texts of a hundred that are cut; spm_rate: of these, those that begin with the suffix."""

    seed: int = 7
    rate: int = 100
    spm_rate: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    unit: str = LINES

    def __post_init__(self):
        marks = self.marks
        # else a piece's end and the mark after it could read as another mark
        for a in marks:
            for b in marks:
                if not a or (a is not b and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"sentinels {a!r} and {b!r} can overlap")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def draws(doc_id: Column, seed: int) -> Column:
    """Four unsigned integers of 32 bits, from the hash of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def infill(docs: DataFrame, by: Infill = Infill()) -> DataFrame:
    """docs with n (units), form (plain, psm or spm), prefix_chars and middle_chars (code points; null if plain) and output."""
    names = [f.split()[0] for f in MADE.split(", ")]
    kept = [c for c in docs.columns if c.lower() not in names]
    text = F.coalesce("text", F.lit(""))
    h = draws(F.col("doc_id"), by.seed)
    plain = (text == "") | (h[2] % 100 >= by.rate)
    for mark in by.marks:
        plain = plain | F.contains(text, F.lit(mark))
    form = F.when(plain, "plain").when(h[3] % 100 < by.spm_rate, "spm").otherwise("psm")
    drawn, shape = (_free(docs, c) for c in ("fim_draws", "fim_form"))
    bounded_batches(docs.sparkSession)
    given, at = docs.select(*kept, h.alias(drawn), form.alias(shape)), kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        units = Split(Regex(by.unit), behavior="isolated")
        p, s, m = by.marks
        for batch in text_slices(batches, at):
            rows = []
            for t, d, f in zip(text_or_empty(batch.column(at)), *(batch.column(len(kept) + i).to_pylist() for i in range(2)), strict=True):
                ends = [0, *[e for _, (_, e) in units.pre_tokenize_str(t)]]
                n = len(ends) - 1
                if f == "plain":
                    rows.append((n, f, None, None, t))
                    continue
                a, b = sorted(ends[x % (n + 1)] for x in d[:2])
                pieces = (p, t[:a], s, t[b:], m, t[a:b]) if f == "psm" else (s, t[b:], p, t[:a], m, t[a:b])
                rows.append((n, f, a, b - a, "".join(pieces)))
            made = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *made], [*kept, *names])

    return given.mapInArrow(run, T.StructType([*[docs.schema[c] for c in kept], *T._parse_datatype_string(MADE).fields]))


def restored(output: Column, form: Column, by: Infill = Infill()) -> Column:
    """The text that an output was made of. Each sentinel stands in it once."""
    between = lambda a, b: F.substring_index(F.substring_index(output, a, -1), b, 1)
    last = F.substring_index(output, by.middle, -1)
    psm = F.concat(between(by.prefix, by.suffix), last, between(by.suffix, by.middle))
    spm = F.concat(between(by.prefix, by.middle), last, between(by.suffix, by.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
