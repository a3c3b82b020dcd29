"""Probes from what a sweep observes: counts grow with each level, and each cell is offered the best that it hasn't had."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import bigrams
from ..operators.queues import common_probes, probe_queue
from ..shared import cut, drop
from ..stores import Stores
from .sweep import DIMENSION_ROWS, Traversal

SEEN = "struct<batch:string,unit_key:string,item_id:string,place:int>"


@dataclass
class HarvestedTraversal(Traversal):
    """A traversal whose probes are pairs of neighbouring words of names that its levels have shown, most frequent first, ties to the
    one seen first; then those of `probes`, the common ones if not given.

    A level's pairs are counted once and merged into the table of counts; no level is read again. A cell is offered the first max_probes of
    the queue as it stands when the cell is split, and is given the same ones when it is split again, as a resumed run does;
    further() goes on to the next ones. All cells of a level share a queue. Names without two words and null ones give no probe.

    What split() gives is to be written before cells are split again, as sweeps and runs do.

    stores: where counts, cell by cell, and offers are kept, and from which a later run goes on; a cell that a crash made a run
    ask twice counts once.
    """

    probes: DataFrame | None = None
    max_probes: int | None = 50
    stores: Stores | None = None
    _counts: DataFrame | None = field(default=None, repr=False)
    _given: DataFrame | None = field(default=None, repr=False)
    _batch: str = "start"

    def __post_init__(self):
        if self.max_probes is None or self.max_probes > DIMENSION_ROWS:
            raise ValueError("a cell needs a ceiling of probes")
        spark = self.facets.sparkSession
        if self.probes is None:
            self.probes = common_probes(spark)
        self._facets = self._sized(self.facets if self.max_facets is None else self.facets.where(F.col("position") < self.max_facets))
        self._counts = spark.createDataFrame([], f"probe string, n bigint, first_seen {SEEN}")
        self._given = spark.createDataFrame([], "unit_key string, probe string, position int")
        if self.stores is not None:
            kept = self.stores.read("probes").groupBy("unit_key", "probe").agg(F.min_by(F.struct("n", "seen"), "seen").alias("r")).select("probe", "r.*")
            self._counts = cut(_merged(kept.withColumnRenamed("seen", "first_seen")))
            self._given = cut(self.stores.read("offers").select("unit_key", "probe", "position").distinct())

    def observed(self, hits: DataFrame, batch: str) -> None:
        if not self.max_probes:
            return
        words = hits.select("unit_key", F.col("item_id").cast("string").alias("item_id"), F.posexplode(bigrams(F.col("name"))).alias("place", "probe"))
        seen = F.min(F.struct(F.lit(batch).alias("batch"), "unit_key", "item_id", "place")).alias("seen")
        per_cell = cut(words.groupBy("unit_key", "probe").agg(F.count("*").alias("n"), seen))
        self._batch = batch
        if self.stores is not None:
            self.stores.append("probes", per_cell, batch)
        new = per_cell.select("probe", "n", F.col("seen").alias("first_seen"))
        old, self._counts = self._counts, cut(_merged(self._counts.unionByName(new)))
        drop(old)
        drop(per_cell)

    def queue(self, most: int) -> DataFrame:
        """(probe, position): the first `most` probes as things stand."""
        head = probe_queue(self._counts, self.probes).limit(most)
        # at most `most` rows meet here
        place = F.row_number().over(Window.orderBy("source_rank", F.desc("n"), "first_seen", F.col("position"))) - 1
        return head.withColumn("position", place).select("probe", "position")

    def offered_probes(self, cells: DataFrame) -> DataFrame:
        if not self.max_probes:
            return cells.withColumn("probe", F.lit(None).cast("string")).where("false")
        keys = cells.select("unit_key").distinct()
        self._offer(keys.join(self._given.select("unit_key").distinct(), "unit_key", "left_anti"))
        return cells.join(self._given.select("unit_key", "probe"), "unit_key")

    def further(self, cells: DataFrame) -> DataFrame:
        """(unit_key, probe): for each of cells(unit_key) the first max_probes of the queue that it hasn't been offered; from now on it has."""
        if not self.max_probes:
            return cells.select("unit_key", F.lit(None).cast("string").alias("probe")).where("false")
        return self._offer(cells.select("unit_key").distinct())

    def _offer(self, keys: DataFrame) -> DataFrame:
        had = self._given.join(keys, "unit_key", "left_semi")
        # a cell that has had k probes finds its next ones among the queue's first k + max_probes
        most = had.groupBy("unit_key").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        offered = keys.join(self._sized(self.queue(most + self.max_probes)), F.lit(True))
        if most:
            offered = offered.join(had.select("unit_key", "probe"), ["unit_key", "probe"], "left_anti")
            rank = F.row_number().over(Window.partitionBy("unit_key").orderBy("position"))
            offered = offered.withColumn("_r", rank).where(F.col("_r") <= self.max_probes)
        offered = cut(offered.select("unit_key", "probe", "position"))
        if self.stores is not None:
            self.stores.append("offers", offered, f"{self._batch}-{uuid.uuid4().hex}")
        old, self._given = self._given, cut(self._given.unionByName(offered))
        drop(old)
        return offered.select("unit_key", "probe")


def _merged(counts: DataFrame) -> DataFrame:
    return counts.groupBy("probe").agg(F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"))
