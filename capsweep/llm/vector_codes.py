"""Vector codes: vectors are cut into parts, and each part is coded by the nearest entry of its position's codebook.

Codebooks are fitted by the filtering form of Lloyd's rounds. Rows are dealt in blocks; a block's task builds one kd-tree
over the parts at each position, with the box, the sum and the count of every node's parts, and writes them. A round walks
the trees level by level, all nodes of a level at once: entries that are farther than another from everywhere in a node's
box leave the node's list, and where one entry is left the node's whole subtree is its own, by the sums that were kept.
Leaves that several entries reach compare their parts with these alone. What leaves a block is a count and a sum for each
entry; the driver sees those of all blocks together, which are as many as the codebooks' entries. Everything is done in
integers, so that codes, errors and codebooks don't hang on blocks or order.

Defined results: rows whose vector is null, empty, or holds a null or a component that isn't finite take no part; nor do
those whose length isn't that of the least id's vector. A length that the parts don't divide is an error, as are
components beyond largest() after scaling (2^28 at eight a part). Null ids come last; rows alike in id are rows of their own, ordered by their vectors. With
fewer rows than entries a codebook has as many entries as there are rows; an empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise
from .topk import quantised, usable

#: Rows of a block at most, and parts of a leaf at most.
BLOCK_ROWS, LEAF = 8_192, 32
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6


def largest(size: int) -> int:
    """The greatest component with which no distance or corner of a box leaves 64 bits."""
    return math.isqrt((1 << 62) // (8 * max(size, 1)))


@dataclass
class Tree:
    """Nodes in breadth-first order; order lists the rows of the block so that a node's are order[begin:end]. child is the
    left child's number (the right one follows), 0 for a leaf."""

    points: np.ndarray
    order: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    total: np.ndarray
    child: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> Tree:
        order = np.arange(len(points))
        spans, low, high, total, child = [(0, len(points))], [], [], [], []
        i = 0
        while i < len(spans):
            a, b = spans[i]
            own = points[order[a:b]]
            lo, hi = own.min(axis=0), own.max(axis=0)
            low.append(lo)
            high.append(hi)
            total.append(own.sum(axis=0))
            wide = int(np.argmax(hi - lo))
            if b - a > LEAF and hi[wide] > lo[wide]:
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, wide], middle)]
                child.append(len(spans))
                spans += [(a, a + middle), (a + middle, b)]
            else:
                child.append(0)
            i += 1
        begin, end = np.array(spans, np.int64).T
        return cls(points, order, begin, end, np.array(low), np.array(high), np.array(total), np.array(child, np.int64))

    def nearest(self, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(numbers, entries of each, whether the numbers are whole nodes; else they are rows), covering every row once."""
        k = len(entries)
        squares = (entries * entries).sum(axis=1)
        nodes, alive = np.zeros(1, np.int64), np.ones((1, k), bool)
        while len(nodes):
            low, high = self.low[nodes], self.high[nodes]
            # twice the distance to the middle of the box, so that it stays whole
            at = low + high
            far = 4 * squares[None, :] - 4 * at @ entries.T
            best = np.argmin(np.where(alive, far, np.iinfo(np.int64).max), axis=1)
            # an entry's distance less the best's is linear in the box; it is least at one corner
            step = entries[None, :, :] - entries[best][:, None, :]
            corner = np.where(step > 0, high[:, None, :], low[:, None, :])
            least = squares[None, :] - squares[best][:, None] - 2 * (step * corner).sum(axis=2)
            number = np.arange(k)[None, :]
            alive &= (least < 0) | ((least == 0) & (number <= best[:, None]))
            one = alive.sum(axis=1) == 1
            if one.any():
                yield nodes[one], alive[one].argmax(axis=1), True
            leaf = ~one & (self.child[nodes] == 0)
            if leaf.any():
                counts = (self.end - self.begin)[nodes[leaf]]
                before = np.repeat(np.cumsum(counts) - counts, counts)
                rows = self.order[np.repeat(self.begin[nodes[leaf]], counts) + np.arange(counts.sum()) - before]
                d = squares[None, :] - 2 * self.points[rows] @ entries.T
                d = np.where(np.repeat(alive[leaf], counts, axis=0), d, np.iinfo(np.int64).max)
                yield rows, d.argmin(axis=1), False
            deeper = ~one & ~leaf
            left = self.child[nodes[deeper]]
            nodes, alive = np.concatenate([left, left + 1]), np.concatenate([alive[deeper], alive[deeper]])

    def sums(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts of each entry, their sum)."""
        count, total = np.zeros(len(entries), np.int64), np.zeros_like(entries)
        for numbers, best, whole in self.nearest(entries):
            np.add.at(count, best, (self.end - self.begin)[numbers] if whole else 1)
            np.add.at(total, best, self.total[numbers] if whole else self.points[numbers])
        return count, total

    def codes(self, entries: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.points), np.int64)
        for numbers, best, whole in self.nearest(entries):
            if whole:
                for node, b in zip(numbers.tolist(), best.tolist(), strict=True):
                    out[self.order[self.begin[node] : self.end[node]]] = b
            else:
                out[numbers] = best
        return out

    def stored(self) -> dict:
        return {k: np.ascontiguousarray(v, "<i8").tobytes() for k, v in vars(self).items()}

    @classmethod
    def read(cls, kept: dict, rows: int) -> Tree:
        v = {k: np.frombuffer(b, "<i8") for k, b in kept.items()}
        return cls(**{k: x.reshape(rows, -1) if k == "points" else x.reshape(len(v["begin"]), -1) if k in ("low", "high", "total") else x for k, x in v.items()})


def within(x: np.ndarray, size: int) -> None:
    if x.size and max(-int(x.min()), int(x.max())) > largest(size):
        raise ValueError(f"a component is beyond {largest(size)} after scaling")


_TREE = "struct<points:binary,order:binary,begin:binary,end:binary,low:binary,high:binary,total:binary,child:binary>"
INDEX = f"ids array<long>, labels array<string>, trees array<{_TREE}>"
_ARROW_TREE = pa.struct([(k, pa.binary()) for k in ("points", "order", "begin", "end", "low", "high", "total", "child")])


def index(vectors: DataFrame, parts: int, size: int) -> DataFrame:
    """A row for each block of vectors(vec_id, label, vector): ids, labels and a tree for each position."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(held: pa.Table) -> pa.RecordBatch:
            held = held.combine_chunks()
            x = held["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(held.num_rows, parts, size)
            within(x, size)
            trees = [Tree.of(np.ascontiguousarray(x[:, p])).stored() for p in range(parts)]
            return pa.RecordBatch.from_arrays([pa.array([held["vec_id"].to_pylist()], pa.list_(pa.int64())), pa.array([held["label"].to_pylist()], pa.list_(pa.string())), pa.array([trees], pa.list_(_ARROW_TREE))], ["ids", "labels", "trees"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= BLOCK_ROWS:
                t = pa.Table.from_batches(held)
                yield made(t.slice(0, BLOCK_ROWS))
                held = t.slice(BLOCK_ROWS).to_batches()
        if sum(b.num_rows for b in held):
            yield made(pa.Table.from_batches(held))

    return vectors.select("vec_id", "label", "vector").mapInArrow(blocks, INDEX)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def round_sums(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """counts and sums of every entry's parts, over all blocks: [position, entry, 1 + size]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((*books.shape[:2], 1 + books.shape[2]), np.int64)
        for row in _rows(batches):
            for p, kept in enumerate(row["trees"]):
                count, total = Tree.read(kept, len(row["ids"])).sums(books[p])
                out[p, :, 0] += count
                out[p, :, 1:] += total
        p, e, j = np.indices(out.shape)
        yield pa.RecordBatch.from_arrays([pa.array(x.ravel(), pa.int64()) for x in (p, e, j, out)], ["p", "e", "j", "x"])

    sums = blocks.select("ids", "trees").mapInArrow(run, "p long, e long, j long, x long").groupBy("p", "e", "j").agg(F.sum("x").alias("x"))
    out = np.zeros((*books.shape[:2], 1 + books.shape[2]), np.int64)
    for r in sums.collect():  # as many rows as the codebooks have numbers
        out[r["p"], r["e"], r["j"]] = r["x"]
    return out


def fit(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        got = round_sums(blocks, books)
        count = got[:, :, :1]
        books = np.where(count > 0, got[:, :, 1:] // np.maximum(count, 1), books)
    return books


def encode(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every row of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n = len(row["ids"])
            codes, error = np.zeros((n, len(books)), np.int64), np.zeros(n, np.int64)
            for p, kept in enumerate(row["trees"]):
                tree = Tree.read(kept, n)
                codes[:, p] = tree.codes(books[p])
                d = tree.points - books[p][codes[:, p]]
                error += (d * d).sum(axis=1)
            digits = 2 if books.shape[1] <= 256 else 4
            text = ["".join(f"{c:0{digits}x}" for c in r) for r in codes.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()), pa.array(text, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, "vec_id long, label string, code string, error long")


@dataclass(frozen=True)
class Codes:
    """books[position, entry, component]; coded(vec_id, label, code, error), written."""

    books: np.ndarray
    coded: DataFrame

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codebooks fitted on all of vectors(vec_id, embedding, label), and every row's code."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    kept = vectors.where(usable(F.col("embedding"))).select("vec_id", F.col("label").cast("string").alias("label"), quantised(F.col("embedding"), scale).alias("vector"))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return Codes(np.zeros((parts, 0, 0), np.int64), kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")))
    length = len(first[0]["vector"])
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    kept = kept.where(F.size("vector") == length)
    start = [r["vector"] for r in first if len(r["vector"]) == length]
    if len(start) < len(first):
        start = [r["vector"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()]
    books = np.array(start, np.int64).reshape(len(start), parts, length // parts).transpose(1, 0, 2)
    within(books, length // parts)
    # blocks by a hash, so that tasks have equal shares whatever files the rows come from
    blocks = materialise(index(kept.repartition(spark.sparkContext.defaultParallelism, F.xxhash64("vec_id", "vector")), parts, length // parts), "kd-trees")
    books = fit(blocks, np.ascontiguousarray(books), rounds)
    return Codes(books, materialise(encode(blocks, books), "vector-codes"))


def with_label_errors(coded: DataFrame) -> DataFrame:
    """coded with label_error: the error summed over rows of an equal label, nulls together."""
    # one row for each label, written, so that its size is known when it is joined
    totals = materialise(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of")
