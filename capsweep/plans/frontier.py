"""The frontier: what earlier items name is searched for next, until nothing new comes or the budget ends."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.queues import ranked_seeds
from ..sources.capped import CappedSource
from ..shared import cut
from .sweep import bisected

#: Windows of seeds that are asked at once where no budget counts requests; those beyond the stop are asked in vain.
BATCH = 32
LEDGER = "item_id string, document_id string, reason string"


@dataclass
class Crawl:
    items: DataFrame  # item_id, seed_no: each item once, with the first seed that found it
    ledger: DataFrame  # cells that failed
    seeds_processed: int
    new_items: int
    requests: int


def harvest_seeds(hits: DataFrame, cells: DataFrame, kind: str, value: str) -> DataFrame:
    """(kind, value, cell_state) of what each hit names; split and full cells count as truncated."""
    state = F.when(F.col("saturated"), "truncated").otherwise("complete").alias("cell_state")
    named = hits.where(F.col(value).isNotNull()).select("unit_key", F.lit(kind).alias("kind"), F.col(value).alias("value"))
    return named.join(cells.select("unit_key", state), "unit_key").select("kind", "value", "cell_state")


def numbered(seeds: DataFrame, kinds: list[str]) -> DataFrame:
    """Seeds with seed_no from 1, in rank order; only the partitions' sizes meet in one task."""
    ordered = cut(ranked_seeds(seeds, kinds).withColumns({"_p": F.spark_partition_id(), "_o": F.monotonically_increasing_id()}))
    sizes = ordered.groupBy("_p").agg(F.count("*").alias("n"))
    before = sizes.select("_p", (F.sum("n").over(Window.orderBy("_p")) - F.col("n")).alias("_b"))
    # an id's low 33 bits are its place in its partition
    place = F.col("_o").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(F.broadcast(before), "_p").withColumn("seed_no", F.col("_b") + place + 1).drop("_p", "_o", "_b")


def crawl(source: CappedSource, seeds: DataFrame, kinds: list[str], unit_from_seed: Callable[[DataFrame], DataFrame], max_requests: int | None = 500, window: int = 5, max_depth: int = 20) -> Crawl:
    """Search for seeds(kind, value, cell_state, ordinal) in rank order: `window` of them at a time under a budget, else BATCH windows.

    unit_from_seed makes cells (the sweep's columns, and seed_no) of numbered seeds; full cells are halved by days.
    The crawl ends after `window` seeds in a row without a new item; seeds of the last batch beyond that point don't
    count. Without a budget, seeds of a batch that ask for the same cell are answered together, and the request counts for each. The request budget admits the cells of a batch level by level, in seed order. Failures, which the source
    marks with a `reason`, go to the ledger and the crawl goes on. No seeds: nothing is asked.
    """
    spark = seeds.sparkSession
    queue = cut(numbered(seeds, kinds))
    total, asked, processed, dry, new_items = queue.count(), 0, 0, 0, 0
    items = spark.createDataFrame([], "item_id string, seed_no long")
    ledger = spark.createDataFrame([], LEDGER)
    low, batch = 0, window if max_requests is not None else BATCH * window
    while low < total and (max_requests is None or asked < max_requests) and dry < window:
        level = unit_from_seed(queue.where(F.col("seed_no").between(low + 1, low + batch)))
        if max_requests is None:
            # seeds that ask the same are answered once: the first finds what there is
            level = level.groupBy(*[c for c in level.columns if c != "seed_no"]).agg(F.min("seed_no").alias("seed_no"), F.array_sort(F.collect_list("seed_no")).alias("seeds"))  # at most a batch's
        else:
            level = level.withColumn("seeds", F.array("seed_no"))
        level = level.withColumn("unit_key", F.concat_ws("#", "seed_no", "unit_key"))
        started, found, failed = 0, [], []
        while True:
            if max_requests is not None:
                level = level.orderBy("seed_no", "unit_key").limit(max_requests - asked)
            level = cut(level)
            n = level.agg(F.sum(F.size("seeds"))).first()[0]
            if not n:
                break
            asked += n
            started = started or n
            hits = source.discover(level)
            bad = F.col("reason").isNotNull() if "reason" in hits.columns else F.lit(False)
            keep = ["unit_key", F.col("item_id").cast("string").alias("item_id"), (F.col("reason") if "reason" in hits.columns else F.lit(None).cast("string")).alias("reason")]
            hits = cut(hits.withColumn("_bad", bad).select(*keep, "_bad"))
            lost = hits.where("_bad").join(level.select("unit_key", F.explode("seeds").alias("_seed")), "unit_key")
            failed.append(lost.select(F.concat_ws("#", "_seed", F.expr("substring(unit_key, instr(unit_key, '#') + 1)")).alias("item_id"), F.lit(None).cast("string").alias("document_id"), "reason"))
            hits = hits.where("not _bad")
            found.append(hits.select("item_id", F.substring_index("unit_key", "#", 1).cast("long").alias("seed_no")))
            if source.cap is None:
                break
            full = hits.groupBy("unit_key").agg(F.count("*").alias("n")).where(F.col("n") >= source.cap).select("unit_key")
            halves = bisected(level.where(F.col("depth") < max_depth).join(full, "unit_key", "left_semi"), ["seed_no", "seeds"])
            level = halves.withColumn("unit_key", F.concat_ws("#", "seed_no", "unit_key"))
        got = found[0]
        for f in found[1:]:
            got = got.unionByName(f)
        fresh = cut(got.groupBy("item_id").agg(F.min("seed_no").alias("seed_no")).join(items, "item_id", "left_anti"))
        counts = {r["seed_no"]: r["n"] for r in fresh.groupBy("seed_no").agg(F.count("*").alias("n")).collect()}  # at most a batch of rows
        last = low
        for last in range(low + 1, low + started + 1):
            processed += 1
            dry = 0 if counts.get(last) else dry + 1
            new_items += counts.get(last, 0)
            if dry >= window:
                break
        items = items.unionByName(fresh.where(F.col("seed_no") <= last).select("item_id", "seed_no"))
        for f in failed:
            ledger = ledger.unionByName(f.where(F.substring_index("item_id", "#", 1).cast("long") <= last))
        low += batch
        items, ledger = cut(items), cut(ledger)  # a long crawl's plan stays short
    return Crawl(items, ledger, processed, new_items, asked)
