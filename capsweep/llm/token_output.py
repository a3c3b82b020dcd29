"""Token ids of every document, written in id order as Simple-8b blocks and read back.

Defined results: a null text is an empty one and gives its end id alone; a null doc_id sorts first; documents with
the same id follow each other by text; repeated rows are documents of their own; an empty table gives no file rows;
extra columns are ignored. Texts of any length are encoded whole.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simple8b
from .common import SLICE_BYTES, bounded_batches, claim, shared_dir, text_slices

FILE_SCHEMA = "shard int, block int, n_ids long, doc_ids array<long>, ends array<long>, words binary, escapes binary"
ODD_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
#: Texts with any of these, or white space at an end, are encoded in one piece: a boundary may not hold there.
ODD = f"\\A[ \n]|[ \n]\\z|  |\n\n| \n|\n |[{ODD_SPACES}]"
#: Stems and ends that a worker remembers; when there are more, those that fewest batches had are forgotten.
REMEMBERED = 300_000
#: Words that go to the library in one call; longer texts cost it more for each word.
AT_ONCE = 50
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LETTERS = "".join(c for c in map(chr, range(0x180)) if c.isalpha())
#: Numbers of what every encoder knows: no ids at all, and a line break's.
NOTHING, LINE = 0, 1


class WordEncoder:
    """A byte-level BPE tokenizer whose words are encoded once.

    The tokenizer never merges over the boundary before a space or a line break that stands between two other
    characters, so the ids of a text are those of its pieces: each word with the space or line break before it. Arrow
    finds a batch's distinct pieces. Where the tokenizer splits as the published byte-level pattern does, a word of
    letters with punctuation at its end is two of its units, so Arrow parts it into a stem and an end, which many
    pieces share; any other piece is a stem of its own. Stems that the worker doesn't know are encoded by the library:
    those of letters by its model, without being searched for units again, many at once with a byte between them that
    no merge joins to another, the rest as texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        line = self.whole("\n")
        self.line = int(line[0]) if len(line) == 1 else None
        #: "\n" and an end, "\r" and a stem after a line break or at a text's start, else a stem after a space
        self.known: dict[str, int] = {"\n": NOTHING, "": LINE}
        self.flat, self.begin, self.used = line, np.array([0, 0, len(line)]), np.zeros(2, np.int64)
        form = json.loads(self.tokenizer.to_str())
        split, model = form.get("pre_tokenizer") or {}, form["model"]
        added = [x["content"] for x in form.get("added_tokens", ())]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        rest = iter(range(256, 512))
        self.byte = np.array([b if b in set(plain) else next(rest) for b in range(256)], "<u4")
        self.apart = chr(self.byte[255])  # no text's UTF-8 has it
        self.model = None
        by_words = form.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and all(re.search(r"[^\sA-Za-z][A-Za-z]", x) for x in added)
        by_merges = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        if by_words and by_merges and self.apart in model["vocab"] and self.apart not in "".join(map("".join, model["merges"])):
            self.model, self.apart_id = self.tokenizer.model, model["vocab"][self.apart]

    def whole(self, text: str) -> np.ndarray:
        """The ids of a text, without the offsets that encode() would keep."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, how many each word has)."""
        ids = self.whole("\n".join(words))
        cut = np.flatnonzero(ids == self.line)
        if len(cut) != len(words) - 1:  # a word's own ids hold a line break
            each = [self.whole(w) for w in words]
            return np.concatenate(each), np.array([len(x) for x in each], np.int64)
        return np.delete(ids, cut), np.diff(np.concatenate(([-1], cut, [len(ids)]))) - 1

    def _modelled(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, how many each has) of stems of letters, by the model alone."""
        units = pc.if_else(pc.starts_with(stems, "\r"), pc.ascii_ltrim(stems, "\r"), pc.binary_join_element_wise(" ", stems, ""))
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(units)], units), "\n")[0].as_buffer()
        units = self.byte[np.frombuffer(text, np.uint8)].tobytes().decode("utf-32-le").split(chr(self.byte[10]))
        ids: list[int] = []
        for k in range(0, len(units), AT_ONCE):
            ids += [t.id for t in self.model.tokenize(self.apart.join(units[k : k + AT_ONCE]))]
            ids.append(self.apart_id)
        got = np.array(ids, np.uint32)
        cut = np.flatnonzero(got == self.apart_id)
        return np.delete(got, cut), np.diff(cut, prepend=-1) - 1

    def _learn(self, keys: pa.Array) -> np.ndarray:
        """The numbers that keys of `known` get."""
        end, start = (pc.starts_with(keys, x).to_numpy(zero_copy_only=False) for x in ("\n", "\r"))
        by_model = np.zeros(len(keys), bool)
        if self.model is not None:
            by_model = ~end & pc.equal(pc.utf8_ltrim(keys, "\r" + LETTERS), "").to_numpy(zero_copy_only=False)
        order, flat, sizes = [np.flatnonzero(by_model)], [self.flat], []
        if by_model.any():
            got, n = self._modelled(keys.filter(pa.array(by_model)))
            flat.append(got)
            sizes.append(n)
        for kind, lead in ((end, ""), (start & ~by_model, ""), (~(end | start | by_model), " ")):
            words = [lead + (w if lead else w[1:]) for w in keys.filter(pa.array(kind)).to_pylist()]
            for k in range(0, len(words), AT_ONCE):
                got, n = self._joined(words[k : k + AT_ONCE])
                flat.append(got)
                sizes.append(n)
            order.append(np.flatnonzero(kind))
        numbers = np.empty(len(keys), np.int64)
        numbers[np.concatenate(order)] = np.arange(len(self.known), len(self.known) + len(keys))
        self.known.update(zip(keys.to_numpy(zero_copy_only=False).tolist(), numbers.tolist(), strict=True))
        self.flat = np.concatenate(flat)
        self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(np.concatenate(sizes))))
        self.used = np.concatenate((self.used, np.zeros(len(keys), np.int64)))
        return numbers

    def _forget(self) -> None:
        """Half of what is known, that of most batches, stays."""
        keep = np.union1d([NOTHING, LINE], np.argsort(-self.used, kind="stable")[: REMEMBERED // 2])
        self.flat, n = self._gathered(self.flat, self.begin, keep)
        new = np.full(len(self.used), -1)
        new[keep] = np.arange(len(keep))
        self.known = {w: k for w, k in zip(self.known, new[list(self.known.values())].tolist(), strict=True) if k >= 0}
        self.begin, self.used = np.concatenate(([0], np.cumsum(n))), self.used[keep] // 2

    @staticmethod
    def _gathered(flat: np.ndarray, begin: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the entries `at` end to end, how many each has); entry k is flat[begin[k] : begin[k + 1]]."""
        first = begin[at]
        n = begin[at + 1] - first
        end = np.cumsum(n)
        return flat[np.repeat(first - (end - n), n) + np.arange(end[-1])], n

    def _numbers(self, keys: pa.Array) -> np.ndarray:
        """Those of keys of `known`, learnt where they aren't known."""
        coded = keys.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        gaps = number < 0
        if gaps.any():
            number[gaps] = self._learn(coded.dictionary.filter(pa.array(gaps)))
        self.used[number] += 1
        return number[coded.indices.to_numpy()]

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, how many each has) of pieces: "\n" and a word after a line break, "\r" and a word at a
        text's start, else a word after a space."""
        line = np.where(pc.starts_with(pieces, "\n").to_numpy(zero_copy_only=False), LINE, NOTHING)
        if self.model is None:
            stems, ends = pieces, pa.repeat("", len(pieces))
        else:
            stems, ends = pc.ascii_rtrim(pieces, PUNCTUATION), pc.utf8_ltrim(pieces, "\r\n" + LETTERS)
            two = pc.and_(pc.equal(pc.ascii_rtrim(ends, PUNCTUATION), ""), pc.not_equal(pc.ascii_ltrim(stems, "\r\n"), ""))
            stems, ends = pc.if_else(two, stems, pieces), pc.if_else(two, ends, "")
        number = self._numbers(pa.concat_arrays([pc.replace_substring(stems, "\n", "\r"), pc.binary_join_element_wise("\n", ends, "")]))
        ids, n = self._gathered(self.flat, self.begin, np.stack((line, *np.split(number, 2)), 1).ravel())
        return ids, n.reshape(-1, 3).sum(1)

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, how many each has); null texts are empty."""
        texts = texts.fill_null("")
        plain = pc.and_(pc.greater(pc.binary_length(texts), 0), pc.invert(pc.match_substring_regex(texts, ODD))).to_numpy(zero_copy_only=False)
        if self.line is None:
            plain[:] = False
        n_ids = np.zeros(len(texts), np.int64)
        odd = {i: self.whole(texts[i].as_py()) for i in np.flatnonzero(~plain).tolist() if len(texts[i].as_py())}
        for i, ids in odd.items():
            n_ids[i] = len(ids)
        if not plain.any():
            return np.concatenate([np.zeros(0, np.uint32), *odd.values()]), n_ids
        if len(self.known) > REMEMBERED:
            self._forget()
        some = texts if plain.all() else texts.filter(pa.array(plain))
        split = pc.split_pattern(pc.binary_join_element_wise("\r", pc.replace_substring(some, "\n", " \n"), ""), " ")
        ends = split.offsets.to_numpy()[1:].astype(np.int64) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        flat, n = self._pieces(coded.dictionary)
        ids, n = self._gathered(flat, np.concatenate(([0], np.cumsum(n))), coded.indices.to_numpy())
        end = np.cumsum(n)
        n_ids[plain] = np.diff(np.concatenate(([0], end[ends - 1])))
        if odd:
            each = iter(np.split(ids, np.cumsum(n_ids[plain])[:-1]))
            ids = np.concatenate([next(each) if p else odd.get(i, np.zeros(0, np.uint32)) for i, p in enumerate(plain.tolist())])
        return ids, n_ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, n = self.encode_flat(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(n)[:-1]) if texts else []


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One for each worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def write_tokens(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Encode docs(doc_id, text), append end_id to each, and write the ids in ascending doc_id order.

    Returns the written files as a table of FILE_SCHEMA: `shard` numbers the files in id order, `block` the blocks of a
    file; `ends` holds, for each document of a block, where its ids end in it. folder: a new folder for the files that
    all executors reach; if none is given, one in the session's shared folder. The files stay after the session, and
    the table's `shared_path` names their folder. The rows are dealt by ranges of doc_id and of a text's start, so
    every task holds a slice of the order whatever its source. vocabulary: a tokenizers file, the 50k byte-level one
    if not given.
    """
    bounded_batches(docs.sparkSession)
    path = vocabulary

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("token_output", _encoders.clear)
        own, shard, block = encoder(path or vocabulary_path()), TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        docs_: list[int | None] = []
        ends: list[int] = []
        size = 0

        def row() -> pa.RecordBatch:
            words, escapes = simple8b.encode(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([size], pa.int64()), pa.array([docs_], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())), pa.array([words], pa.binary()), pa.array([escapes], pa.binary())], ["shard", "block", "n_ids", "doc_ids", "ends", "words", "escapes"])

        for batch in text_slices(batches, 1, 4 * SLICE_BYTES):
            ids, n = own.encode_flat(batch.column(1))
            close = np.cumsum(n + 1)
            ids = np.insert(ids, np.cumsum(n), np.uint32(end_id))
            first = last = 0  # of this batch's documents, those that aren't held yet begin at `first`
            for doc, a, b in zip(batch.column(0).to_pylist(), (close - n - 1).tolist(), close.tolist(), strict=True):
                if size and size + b - a > simple8b.BLOCK_IDS:
                    held.append(ids[first:last])
                    yield row()
                    held, docs_, ends, size, block, first = [], [], [], 0, block + 1, a
                docs_.append(doc)
                size += b - a
                ends.append(size)
                last = b
            held.append(ids[first:last])
        if docs_:
            yield row()

    # ranges of a text's start agree with the order of whole texts, and part an id that has very many rows
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", F.substring("text", 1, 16)).sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(encode, FILE_SCHEMA)
    folder = folder or f"{shared_dir(docs.sparkSession).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    files.write.option("compression", "zstd").parquet(folder)
    back = docs.sparkSession.read.schema(files.schema).parquet(folder)
    back.shared_path = folder
    return back


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the blocks of a written table alone."""
    bounded_batches(files.sparkSession)
    per_block = files.groupBy("shard", "block").agg(F.sum("n_ids").alias("n_ids"))
    shards = per_block.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # one row for each file; its documents' ids begin after those of the files before it
    base = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    inner = Window.partitionBy("shard").orderBy("block")
    starts = per_block.select("shard", "block", (F.sum("n_ids").over(inner) - F.col("n_ids")).alias("in_shard")).join(base, "shard").select("shard", "block", (F.col("in_shard") + F.col("shard_start")).alias("start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = simple8b.decode(r["words"], r["escapes"], r["n_ids"])
                ends = np.array(r["ends"], np.int64)
                begins = np.concatenate(([0], ends[:-1]))
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                n = len(ends)
                yield pa.RecordBatch.from_arrays([pa.array([r["shard"]] * n, pa.int32()), pa.array([r["block"]] * n, pa.int32()), pa.array(r["doc_ids"], pa.int64()), pa.array(begins, pa.int64()), pa.array(ends - begins, pa.int64()), pa.array(crc, pa.int64())], ["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"])

    read = files.mapInArrow(decode, "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read.join(starts, ["shard", "block"]).select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
