"""Points within spans by equal keys: a span is cut into few aligned blocks, and a point looks its blocks up.

A span of n places has at most two aligned blocks of each power of two, which cover it once; a point lies in one block
of each size. So spans and points meet in an equi-join, each pair once, however wide the spans are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes of blocks: spans of up to 2^40 places.
LEVELS = 40


def blocks(low: Column, high: Column) -> Column:
    """array of STRUCT<level, block> that covers low to high, ends included; empty if high lies before low or an end is null."""
    # of what remains at a level, a first block that is a right half and a last one that is a left half stand alone
    given = F.struct(low.cast("bigint").alias("a"), (high.cast("bigint") + 1).alias("b"))

    def at(k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), k)
        first, last = F.ceil(given["a"] / size).cast("bigint"), F.floor(given["b"] / size).cast("bigint")
        some = first < last
        one = lambda n, odd: F.when(some & (F.pmod(odd, F.lit(2)) == 1), F.struct(k.alias("level"), n.alias("block")))
        return F.array(one(first, first), one(last - 1, last))

    # no block is wider than the span
    top = F.least(F.lit(LEVELS), F.ceil(F.log2(F.greatest(given["b"] - given["a"], F.lit(1)).cast("double"))).cast("int"))
    every = F.flatten(F.transform(F.sequence(F.lit(0), top), at))
    place = F.array(F.struct(F.lit(0).alias("level"), given["a"].alias("block")))
    return F.when(low == high, place).when(given["b"] > given["a"], F.filter(every, lambda x: x.isNotNull())).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))


def spanned(spans: DataFrame, low: str, high: str) -> DataFrame:
    """spans with _level and _block, a row for each of their blocks."""
    return spans.withColumn("_b", F.explode(blocks(F.col(low), F.col(high)))).select(*spans.columns, F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block"))


def placed(points: DataFrame, at: str, levels: list[int]) -> DataFrame:
    """points with _level and _block, a row for each of the levels that spans use."""
    p = F.col(at).cast("bigint")
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.floor(p / (1 << k)).cast("bigint").alias("block")) for k in levels]))
    return points.withColumn("_b", each).select(*points.columns, F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block"))


def levels_of(cut_spans: DataFrame) -> list[int]:
    return sorted(r["_level"] for r in cut_spans.select("_level").distinct().collect())  # at most LEVELS


def within(spans: DataFrame, low: str, high: str, points: DataFrame, at: str, keys: list[str] | None = None) -> DataFrame:
    """Every span with every point in it (and of equal keys): the columns of both, which share no names but the keys'."""
    wide = spanned(spans, low, high)
    levels = levels_of(wide)
    if not levels:
        return wide.join(points.withColumns({"_level": F.lit(0), "_block": F.lit(0).cast("bigint")}), ["_level", "_block", *(keys or [])]).drop("_level", "_block")
    return wide.join(placed(points, at, levels), ["_level", "_block", *(keys or [])]).drop("_level", "_block")
