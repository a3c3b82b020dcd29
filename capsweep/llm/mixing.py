"""Mixing sources to target weights: whole documents are taken so that each source's tokens fit its budget.

A source's documents are counted by exact length. The lengths' counts give the copies that all documents get, then a
share of every length, then single documents in a seeded order of lengths, while what is left of the budget is over
DP_BUDGET, then as many as fit of each length, the longest first, while it is over twice that, and long ones in
exchange for short ones where only long ones are left. A bounded-knapsack dynamic programme over the counts that
remain fits all that is left then; where documents are so few and long that more than a thousandth of the budget stays
unfilled, the programme runs over all of them, in coarser units if it must. Which documents of a length are taken follows a seeded hash of their ids. Texts stay where they are read, but for those of rows alike in id and size of which some are taken. Defined results: null
texts have size 0 and take no part in a budget, so that their taken is 0; a null source is a source, the last; repeated rows are documents of their own (of rows alike in id and size, any
may be the one that is taken); empty sources and tables have target 0 and no rows; extra columns are ignored by
mix() and kept by take(), whatever their names. Texts of any length are counted whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

WEIGHTS = (5.0, 2.0, 1.0)
#: Tokens to which single documents go; the dynamic programme fits at most twice as many at the end.
DP_BUDGET = 1 << 16
#: Slots of the seeded hash: a length's documents are ranked only in the slot where its count runs out.
SLOTS = 4096
#: Rows of a table of lengths or ids, without texts, that is broadcast; beyond it, the join shuffles.
PLAN_ROWS = 1_000_000
SEED = 1729


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def reshared(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Targets by weight, stopped at `most` times the size; the excess goes by weight to those below, until none is above."""
    target, capped = [0.0] * len(sizes), [s <= 0 for s in sizes]
    left, open_ = float(total), [i for i, c in enumerate(capped) if not c]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not above:
            for i in open_:
                target[i] = unit * weights[i]
            break
        for i in above:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ = [i for i in open_ if i not in set(above)]
    return target


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take, 0 to its count, for a sum of lengths as near to budget as found."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    everything = int((lengths * counts).sum())
    if budget >= everything:
        return counts.copy()
    if budget <= 0:
        return np.zeros_like(counts)
    take = np.floor(counts * (budget / everything)).astype(np.int64)
    left = budget - int((lengths * take).sum())
    order = np.random.default_rng(seed).permutation(len(lengths))
    for i in order.tolist():
        if left <= DP_BUDGET:
            break
        if lengths[i] <= left and take[i] < counts[i]:
            take[i] += 1
            left -= int(lengths[i])
    _settle(lengths, counts, take, budget, order)
    # near enough is a thousandth of the budget; each exchange leaves less
    while budget - int(lengths @ take) > budget // 1000 and _exchange(lengths, counts, take, budget):
        _settle(lengths, counts, take, budget, order)
    if budget - int(lengths @ take) > budget // 1000:  # few documents, and long ones: the programme over all of them, in coarser units if it must
        unit = -(-budget // (2 * DP_BUDGET))
        rough = np.zeros_like(counts)
        rough[order] = _knapsack(-(-lengths[order] // unit), counts[order], budget // unit)
        _settle(lengths, counts, rough, budget, order)
        if lengths @ rough > lengths @ take:
            take = rough
    return take


def _settle(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: int, order: np.ndarray) -> None:
    """Fill what is left of the budget with documents that remain, the last of it by the dynamic programme."""
    _fill(lengths, counts, take, budget, 2 * DP_BUDGET)
    left = budget - int(lengths @ take)
    if left <= 2 * DP_BUDGET:
        take[order] += _knapsack(lengths[order], (counts - take)[order], left)


def _fill(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: int, enough: int) -> None:
    """Take as many as fit of each length, the longest first, but no more than bring what is left down to `enough`."""
    left = budget - int(lengths @ take)
    for i in np.argsort(-lengths, kind="stable").tolist():
        if left <= enough:
            break
        if lengths[i] > 0:
            n = min(int(counts[i] - take[i]), left // int(lengths[i]), -(-(left - enough) // int(lengths[i])))
            take[i] += n
            left -= n * int(lengths[i])


def _exchange(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: int) -> bool:
    """Give back short documents for one that doesn't fit beside them; whether that left less of the budget."""
    left = budget - int(lengths @ take)
    short = [i for i in np.argsort(-lengths, kind="stable").tolist() if 0 < lengths[i] <= left and take[i] > 0]
    for j in np.argsort(lengths, kind="stable").tolist():
        need = int(lengths[j]) - left
        if need <= 0 or take[j] >= counts[j] or sum(int(lengths[i] * take[i]) for i in short) < need:
            continue
        back = np.zeros_like(take)
        for i in short:
            n = min(int(take[i]), need // int(lengths[i]))
            back[i] += n
            need -= n * int(lengths[i])
        for i in reversed(short):  # the shortest that is left covers the rest
            if need > 0 and take[i] > back[i]:
                back[i] += 1
                need -= int(lengths[i])
        if need <= 0 and -need < left:
            take -= back
            take[j] += 1
            return True
    return False


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum: the counts whose sum is the largest reachable one up to budget."""
    by = np.full(budget + 1, -1, np.int64)  # the chunk that first reached a sum
    by[0] = -2
    chunks: list[tuple[int, int]] = []
    for i, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        if length <= 0 or length > budget:
            continue
        count, size = min(count, budget // length), 1
        while count > 0 and by[budget] == -1:
            size = min(size, count)
            step = size * length
            if step <= budget:
                fresh = np.flatnonzero((by[: budget + 1 - step] != -1) & (by[step:] == -1)) + step
                by[fresh] = len(chunks)
                chunks.append((i, size))
            count -= size
            size *= 2
        if by[budget] != -1:
            break
    out = np.zeros(len(lengths), np.int64)
    at = int(np.flatnonzero(by != -1)[-1])
    while at:
        i, size = chunks[by[at]]
        out[i] += size
        at -= size * int(lengths[i])
    return out


def _slot(seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.lit(SLOTS)).cast("int")


same = lambda *names: reduce(and_, [F.col(x).eqNullSafe(F.col("_" + x)) for x in names])


def _bounded(df: DataFrame) -> DataFrame:
    """df, for a join that broadcasts it while its counted rows allow that; it holds numbers and names of sources only."""
    return F.broadcast(df) if df.count() <= PLAN_ROWS else df


class Plan:
    """What a mix takes: for each source and length, `whole` copies of all documents and one more of those in the slots
    before `cut`; in that slot, `more` of the n documents of an id have one more."""

    def __init__(self, sized: DataFrame, weights, share: float, most: float, seed: int):
        """sized(doc_id, source, size): a table, which is read several times."""
        self.seed = seed
        lengths = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
        sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))

        def targets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            # one row for each source, whatever the number of documents
            rows = sorted(((r.source, int(r.source_size)) for f in frames for r in f.itertuples()), key=lambda r: (r[0] is None, r[0] or ""))
            if rows:
                sizes = [n for _, n in rows]
                got = reshared(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), most)
                yield pd.DataFrame({"source": [s for s, _ in rows], "source_size": sizes, "target": got})

        self.budget = materialise(sources.coalesce(1).mapInPandas(targets, "source string, source_size long, target double"), "targets")

        def fitted(frame: pd.DataFrame) -> pd.DataFrame:
            # one row for each distinct length of a source, not for each document
            frame = frame.sort_values("size")
            target, total = float(frame["target"].iloc[0]), int(frame["source_size"].iloc[0])
            whole = 0 if total == 0 else min(math.floor(round(target) / total), math.floor(most))
            extra = fit(frame["size"].to_numpy(), frame["n"].to_numpy(), round(target) - whole * total if whole < most else 0, seed)
            real = frame["size"].to_numpy() > 0
            return pd.DataFrame({"source": frame["source"], "size": frame["size"], "whole": np.where(real, whole, 0), "extra": np.where(real, extra, 0)})

        given = lengths.join(F.broadcast(_named(self.budget)), same("source")).drop("_source").withColumnsRenamed({"_source_size": "source_size", "_target": "target"})
        per_length = given.groupBy("source").applyInPandas(fitted, "source string, size long, whole long, extra long")
        # the slot in which a length's extra copies run out: sums over at most SLOTS rows of a length
        slots = sized.withColumn("slot", _slot(seed)).groupBy("source", "size", "slot").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("slot")) - F.col("n")
        slots = slots.withColumn("before", before).join(_named(per_length), same("source", "size")).select("source", "size", "slot", F.col("_whole").alias("whole"), "n", (F.col("_extra") - F.col("before")).alias("left"))
        cut = F.min(F.when(F.col("left") < F.col("n"), F.struct("slot", F.greatest("left", F.lit(0)).alias("left"))))
        self.lengths = materialise(slots.groupBy("source", "size").agg(F.max("whole").alias("whole"), cut.alias("c")).select("source", "size", "whole", F.coalesce("c.slot", F.lit(SLOTS)).alias("cut"), F.coalesce("c.left", F.lit(0)).alias("left")), "plan")
        edge = self._placed(sized).where("slot = cut").groupBy("source", "size", "doc_id").agg(F.count("*").alias("n"), F.max("left").alias("left"))
        upto = F.sum("n").over(Window.partitionBy("source", "size").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id"))
        self.ids = materialise(edge.withColumn("more", F.least(F.greatest(F.col("left") - upto + F.col("n"), F.lit(0)), F.col("n"))).select("source", "size", "doc_id", "n", "more"), "edge")

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("slot", _slot(self.seed)).join(_bounded(_named(self.lengths)), same("source", "size")).drop("_source", "_size").withColumnsRenamed({"_whole": "whole", "_cut": "cut", "_left": "left"})

    def copies(self, rows: DataFrame) -> DataFrame:
        """rows(doc_id, source, size, r) with copies. Rows don't move, but for those of the slots that are cut."""
        columns = [*rows.columns]
        placed = self._placed(rows)
        out = placed.where("slot <> cut").select(*columns, (F.col("whole") + (F.col("slot") < F.col("cut")).cast("long")).alias("copies"))
        edge = placed.where("slot = cut").withColumn("p", F.spark_partition_id()).join(_bounded(_named(self.ids)), same("source", "size", "doc_id")).drop("_source", "_size", "_doc_id")
        clear = edge.where("_more = 0 or _more = _n").select(*columns, (F.col("whole") + (F.col("_more") > 0).cast("long")).alias("copies"))
        out = out.unionByName(clear)
        if self.ids.where("more > 0 and more < n").isEmpty():
            return out
        # of an id's rows, the first as the table is read: ranks within a partition, after those of partitions before; written
        # with their partitions, as a second reading could deal them otherwise
        part = materialise(edge.where("_more > 0 and _more < _n"), "alike")
        keys = ["source", "size", "doc_id"]
        counts = part.groupBy(*keys, "p").agg(F.count("*").alias("m"))
        counts = counts.select(*keys, "p", (F.sum("m").over(Window.partitionBy(*keys).orderBy("p")) - F.col("m")).alias("before"))
        rank = F.row_number().over(Window.partitionBy(*keys, "p").orderBy(F.lit(0))) + F.col("_before")
        part = part.join(_bounded(_named(counts)), same(*keys, "p")).withColumn("copies", F.col("whole") + (rank <= F.col("_more")).cast("long"))
        return out.unionByName(part.select(*columns, "copies"))


def _named(df: DataFrame) -> DataFrame:
    """df with "_" before its names, for the right side of a join."""
    return df.select(*[F.col(c).alias("_" + c) for c in df.columns])


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, source) for every row of docs(doc_id, source, text).

    Sources in the order of their code points, null last, weigh `weights` in turn and share `share` times all sizes.
    taken = copies * size; copies are 0, 1 or 2 (at most `most`).
    """
    sized = materialise(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sized")
    plan = Plan(sized, weights, share, most, seed)
    return plan.copies(sized).join(_bounded(_named(plan.budget)), same("source")).select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("copies") * F.col("size")).alias("taken"), "copies", "source"
    )


def take(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of docs, each as often as it is taken (documents without words, which cost nothing, are left out).

    Of rows alike in id, source and size, as many are taken as by mix(). Columns of docs may have any names.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), row)
    sized = materialise(rows.drop("r"), "sized")
    taken = Plan(sized, weights, share, most, seed).copies(rows).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*[F.col("r")[c].alias(c) for c in docs.columns])
