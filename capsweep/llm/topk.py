"""Exact top-k search by inner product over a bit-sliced index.

The rows are dealt in blocks. A block's index holds, for every component of its vectors and every bit of the components'
two's complement (shifted to be unsigned), one bitmap over the block's rows; that is what is written. A query adds the slices of the
components it weighs, shifted by the bits of its own components, with carry-save adders on whole bitmaps; the sum's slices
are read from the most significant downward to select the k highest rows, and the rows that tie at the boundary are
settled by id. Every block returns its k best for each query, so what meets at the end is k rows for each block and
query.

Queries meet rows in blocks: each block of rows is shuffled once, to the task where every block of queries comes to it.
Defined results: vectors that are null or empty, or hold a null or a component that isn't finite, take no part, nor do
rows without an id; vectors of another length than the query's are no candidates; equal scores go to the smaller id; a
query's own row is every row of its id; rows that repeat an id and vector are as many candidates (the index holds up
to k of them, as no more can be among the k best) and as many queries, each answered; different vectors under one id are
different queries; an empty table gives an empty result; extra columns are ignored. Components beyond 2^61 and scores
beyond a long are errors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, sorted_groups

#: Rows of a block, at least and at most (between them, so many that all tasks have blocks), and queries of one.
LEAST_ROWS, ROWS, QUERIES = 16_384, 65_536, 128
LARGEST = 1 << 61
SCALE = 256


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    inf = float("inf")
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(inf)))


class BitSlices:
    """Bitmaps of the components' bits over a block of rows."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, slices: np.ndarray):
        self.ids, self.rows, self.low, self.slices = ids, len(ids), low, slices  # slices[component, bit]: a bitmap
        self.bits = slices.shape[1]
        full = np.packbits(np.ones(self.rows, np.uint8), bitorder="little")
        self.all = np.zeros(slices.shape[2] * 8, np.uint8)
        self.all[: len(full)] = full
        self.all = self.all.view(np.uint64)

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray) -> BitSlices:
        if vectors.size and max(abs(int(vectors.min())), abs(int(vectors.max()))) > LARGEST:
            raise ValueError("a component is beyond 2^61")
        order = np.argsort(ids, kind="stable")
        v = vectors[order].T.astype(np.int64)
        low = v.min(axis=1) if len(ids) else np.zeros(len(v), np.int64)
        v = v - low[:, None]
        bits = int(v.max()).bit_length() if v.size else 0
        packed = np.zeros((len(v), bits, -(-len(ids) // 64) * 8), np.uint8)
        for b in range(bits):
            p = np.packbits(((v >> b) & 1).astype(np.uint8), axis=1, bitorder="little")
            packed[:, b, : p.shape[1]] = p
        return cls(ids[order], low, packed.view(np.uint64))

    def stored(self) -> tuple[bytes, bytes, int, bytes]:
        return self.ids.astype("<i8").tobytes(), self.low.astype("<i8").tobytes(), self.bits, self.slices.astype("<u8").tobytes()

    @classmethod
    def read(cls, ids: bytes, low: bytes, bits: int, slices: bytes) -> BitSlices:
        own, least = np.frombuffer(ids, "<i8"), np.frombuffer(low, "<i8")
        return cls(own, least, np.frombuffer(slices, "<u8").reshape(len(least), bits, -(-len(own) // 64)))

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], int]:
        """(slices of the sums of positive weights, of negative ones, constant): score = positive - negative + constant."""
        constant = sum(a * b for a, b in zip(query.tolist(), self.low.tolist(), strict=True))
        terms: dict[int, list[tuple[int, int]]] = {1: [], -1: []}
        for d, w in enumerate(query.tolist()):
            shift = 0
            while w:  # non-adjacent signed binary digits: the fewest additions
                if w & 1:
                    digit = 2 - (w & 3)
                    terms[digit].append((d, shift))
                    w -= digit
                w >>= 1
                shift += 1
        return self._sum(terms[1]), self._sum(terms[-1]), constant

    def _sum(self, terms: list[tuple[int, int]]) -> list[np.ndarray]:
        """Slices of a sum of shifted components: bitmaps of equal weight are added three to two until one of each is left."""
        columns: list[list[np.ndarray]] = []
        for d, shift in terms:
            while len(columns) < shift + self.bits:
                columns.append([])
            for b in range(self.bits):
                columns[shift + b].append(self.slices[d, b])
        out, k = [], 0
        while k < len(columns):
            maps = columns[k]
            if k + 1 == len(columns) and len(maps) > 1:
                columns.append([])
            while len(maps) > 2:
                # many at once: thirds of the list are added as arrays
                third = len(maps) // 3
                if third >= 4:
                    stack = np.array(maps[: 3 * third])
                    a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third :]
                    x = a ^ b
                    carry, total = (a & b) | (x & c), x ^ c
                    columns[k + 1].extend(carry)
                    maps[: 3 * third] = list(total)
                else:
                    a, b, c = maps.pop(), maps.pop(), maps.pop()
                    x = a ^ b
                    columns[k + 1].append((a & b) | (x & c))
                    maps.append(x ^ c)
            if len(maps) == 2:
                a, b = maps
                columns[k + 1].append(a & b)
                maps = [a ^ b]
            out.append(maps[0] if maps else np.zeros_like(self.all))
            k += 1
        return out

    def top(self, query: np.ndarray, k: int, own: int | None = None) -> list[tuple[int, int]]:
        """(id, score) of the k rows with the highest scores, ties to the smaller id, without rows of id `own`."""
        up, down, constant = self.scores(query)
        total = _subtract(up, down, self.all)  # two's complement; the last slice is the sign
        rest = self.all.copy()
        if own is not None:
            a, b = np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right")
            for i in range(a, b):
                rest[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        sure, need = np.zeros_like(rest), min(k, _count(rest))
        for s, bitmap in enumerate(reversed(total)):
            high = rest & (~bitmap if s == 0 else bitmap)
            n = _count(high)
            if n >= need:
                rest = high
                if n == need:
                    break
            else:
                sure |= high
                need -= n
                rest &= ~high
            if not need:
                break
        picked = np.concatenate((_rows(sure), _rows(rest)[:need])).astype(np.int64)  # boundary rows: in order of id
        # weights of the slices, the sign's negative
        score = [constant] * len(picked)
        for s, bitmap in enumerate(total):
            weight = -(1 << s) if s == len(total) - 1 else 1 << s
            for i in np.flatnonzero((bitmap[picked // 64] >> (picked % 64).astype(np.uint64)) & np.uint64(1)).tolist():
                score[i] += weight
        return sorted(zip(self.ids[picked].tolist(), score, strict=True), key=lambda x: (-x[1], x[0]))


def _subtract(up: list[np.ndarray], down: list[np.ndarray], full: np.ndarray) -> list[np.ndarray]:
    zero = np.zeros_like(full)
    n = max(len(up), len(down)) + 1
    carry, out = full, []
    for s in range(n):
        a, b = up[s] if s < len(up) else zero, ~(down[s] if s < len(down) else zero)
        x = a ^ b
        out.append(x ^ carry)
        carry = (a & b) | (x & carry)
    return out


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _rows(bitmap: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(bitmap)
    if not len(at):
        return at
    bits = np.unpackbits(bitmap[at].view(np.uint8).reshape(len(at), 8), axis=1, bitorder="little")
    i, j = np.nonzero(bits)
    return at[i] * 64 + j


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, rows_per_block: int | None = None, queries_per_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of rows and queries (vec_id, vector of long), as quantised() makes them."""
    spark = rows.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounded_batches(spark)

    def once(df: DataFrame) -> DataFrame:
        ok = df.where("vec_id is not null and vector is not null and size(vector) > 0")
        return ok.groupBy("vec_id", "vector").agg(F.count("*").alias("copies")).withColumn("dims", F.size("vector"))

    def dealt(df: DataFrame, per_block: Column) -> DataFrame:
        """df with its number of a block; a hash of id and vector parts rows of one id."""
        count = df.groupBy("dims").agg(F.count("*").alias("n"))  # a row for each length of vector
        blocks = materialise(count.select("dims", F.ceil(F.col("n") / per_block).cast("int").alias("blocks")), "blocks")
        return df.join(blocks, "dims").withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), "blocks").cast("int"))

    def matrix(group: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
        return group["vec_id"].to_numpy().astype("<i8"), group["vector"].combine_chunks().flatten().to_numpy().astype("<i8").reshape(-1, dims)

    def slice_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["dims", "block"]):
            dims = group["dims"][0].as_py()
            ids, low, bits, slices = BitSlices.of(*matrix(group, dims)).stored()
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((dims, group["block"][0].as_py(), ids, low, bits, slices), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()), strict=True)], ["dims", "block", "ids", "low", "bits", "slices"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["dims", "block"]):
            dims = group["dims"][0].as_py()
            ids, vectors = matrix(group, dims)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((dims, group["block"][0].as_py(), ids.tobytes(), vectors.tobytes(), group["copies"].to_numpy().astype("<i8").tobytes()), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["dims", "q", "q_ids", "q_vectors", "q_copies"])

    grouped = lambda df, columns: df.select("dims", "block", *columns).repartition(parts, "dims", "block").sortWithinPartitions("dims", "block")
    per_block = F.lit(rows_per_block) if rows_per_block else F.least(F.greatest(F.col("n") / parts, F.lit(LEAST_ROWS)), F.lit(ROWS))
    held = dealt(once(rows), per_block).withColumn("vec_id", F.explode(F.array_repeat("vec_id", F.least("copies", F.lit(k)).cast("int"))))
    index = materialise(grouped(held, ["vec_id", "vector"]).mapInArrow(slice_, "dims int, block int, ids binary, low binary, bits int, slices binary"), "index")
    asked = grouped(dealt(once(queries), F.lit(queries_per_block)), ["vec_id", "vector", "copies"]).mapInArrow(pack, "dims int, q int, q_ids binary, q_vectors binary, q_copies binary")
    asked = materialise(asked, "queries").join(index.select("dims", "block"), "dims")  # numbers of blocks only

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for r in batch.to_pylist():
                if r["q"] < 0:
                    own = BitSlices.read(r["ids"], r["low"], r["bits"], r["slices"])
                    continue
                q_ids, copies = np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["q_copies"], "<i8")
                found = [(r["q"], j, i, c, v, s) for j, (i, c, x) in enumerate(zip(q_ids.tolist(), copies.tolist(), np.frombuffer(r["q_vectors"], "<i8").reshape(-1, r["dims"]), strict=True)) for v, s in own.top(x, k, i)]
                yield pa.RecordBatch.from_arrays([pa.array([r["dims"]] * len(found), pa.int32()), *[pa.array([f[j] for f in found], t) for j, t in enumerate((pa.int32(), pa.int32(), *[pa.int64()] * 4))]], ["dims", "q", "at", "query_id", "copies", "vec_id", "score"])

    # a block of rows sorts before the blocks of queries that meet it
    both = index.withColumn("q", F.lit(-1)).unionByName(asked, allowMissingColumns=True)
    met = both.repartition(parts, "dims", "block").sortWithinPartitions("dims", "block", "q")
    best = met.mapInArrow(search, "dims int, q int, at int, query_id long, copies long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("dims", "q", "at").orderBy(F.desc("score"), "vec_id"))
    best = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("query_id", "rank", "vec_id", "score")
