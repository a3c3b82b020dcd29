"""The sweep: cells are asked level by level, and only those that reach the cap are split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import cell_state, is_saturated, set_hash
from ..operators.coverage import pending
from ..shared import cut, drop
from ..sources.capped import CappedSource

CELL = "unit_key string, window_key string, facet_value string, probe string, date_from date, date_to date, depth int"


def day_cells(spark: SparkSession, date_from: str, date_to: str) -> DataFrame:
    """One cell for each day, ends included."""
    day = F.explode(F.sequence(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))).alias("d")
    key = F.concat_ws("..", "d", "d")
    none = F.lit(None).cast("string")
    return spark.range(1).select(day).select(key.alias("unit_key"), key.alias("window_key"), none.alias("facet_value"), none.alias("probe"), F.col("d").alias("date_from"), F.col("d").alias("date_to"), F.lit(0).alias("depth"))


def bisected(cells: DataFrame, others: list[str] | None = None) -> DataFrame:
    """Two halves of each span of days. others: further columns that they inherit."""
    others = others or []
    days = F.datediff("date_to", "date_from")
    middle = F.date_add("date_from", F.floor(days / 2).cast("int"))
    halves = F.explode(F.array(F.struct(F.col("date_from").alias("a"), middle.alias("b")), F.struct(F.date_add(middle, 1).alias("a"), F.col("date_to").alias("b")))).alias("h")
    key = F.concat_ws("..", "h.a", "h.b")
    return cells.where(days > 0).select(*others, "facet_value", "probe", (F.col("depth") + 1).alias("depth"), halves).select(
        F.concat_ws("|", key, "facet_value").alias("unit_key"), key.alias("window_key"), "facet_value", "probe", F.col("h.a").alias("date_from"), F.col("h.b").alias("date_to"), "depth", *others
    )


#: Rows of a dimension of facets or probes that is broadcast to the cells it splits.
DIMENSION_ROWS = 100_000


@dataclass
class Traversal:
    """How a saturated cell splits: days into days, a day into facets, a facet into probes.

    facets(facet, position) and probes(probe, position) are dimension tables; the ceilings take their first rows, none
    if a ceiling is 0. used(unit_key, probe): probes that a cell has been asked with and isn't again.
    """

    facets: DataFrame
    probes: DataFrame
    max_facets: int | None = None
    max_probes: int | None = None
    used: DataFrame | None = None

    def __post_init__(self):
        head = lambda d, most: d if most is None else d.where(F.col("position") < most)
        self._facets = self._sized(head(self.facets, self.max_facets))
        # without used probes, a cell's first ones are everyone's
        self._probes = self._sized(self.probes if self.used is not None else head(self.probes, self.max_probes))

    @staticmethod
    def _sized(dimension: DataFrame) -> DataFrame:
        n = dimension.count()
        if n > DIMENSION_ROWS:
            raise ValueError(f"a dimension of {n} values is no ceiling for a cell's children; set max_facets or max_probes")
        return F.broadcast(dimension)

    def split(self, cells: DataFrame) -> DataFrame:
        """The children of cells, each with its parent_key."""
        cells = cells.withColumn("parent_key", F.col("unit_key"))
        key = ["window_key", "facet_value", "probe", "date_from", "date_to", "depth", "parent_key"]
        by_day = bisected(cells, ["parent_key"]).select("unit_key", *key)
        day = F.col("date_from") == F.col("date_to")
        next_depth = (F.col("depth") + 1).alias("depth")
        by_facet = cells.where(day & F.col("facet_value").isNull()).drop("facet_value").join(self._facets, F.lit(True))
        by_facet = by_facet.select(F.concat_ws("|", "window_key", "facet").alias("unit_key"), "window_key", F.col("facet").alias("facet_value"), "probe", "date_from", "date_to", next_depth, "parent_key")
        by_probe = self.offered_probes(cells.where(day & F.col("facet_value").isNotNull() & F.col("probe").isNull()).drop("probe"))
        by_probe = by_probe.select(F.concat_ws("|", "unit_key", "probe").alias("unit_key"), "window_key", "facet_value", "probe", "date_from", "date_to", next_depth, "parent_key")
        return by_day.unionByName(by_facet).unionByName(by_probe)

    def offered_probes(self, cells: DataFrame) -> DataFrame:
        """cells with the probes each is asked with next, a row for each."""
        by_probe = cells.join(self._probes, F.lit(True))
        if self.used is not None:
            by_probe = by_probe.join(self.used.select("unit_key", "probe"), ["unit_key", "probe"], "left_anti")
            if self.max_probes is not None:
                rank = F.row_number().over(Window.partitionBy("parent_key").orderBy("position"))
                by_probe = by_probe.withColumn("_r", rank).where(F.col("_r") <= self.max_probes)
        return by_probe

    def observed(self, hits: DataFrame, batch: str) -> None:
        """Told of each level's rows before its cells are split; batches sort in the order of levels."""


def observe(cells: DataFrame, hits: DataFrame, cap: int | None, keep: list[str] | None = None) -> DataFrame:
    """cells with result_count, saturated, state and item_set_hash; a cell without rows has the hash of nothing.

    keep: columns of its rows that a cell's observation holds too, as `rows`. A cell's ids meet in one row: at most cap of them, or all
    that an uncapped source answers a cell with.
    """
    held = F.collect_list(F.struct(F.col("item_id").cast("string").alias("_id"), *(keep or [])))
    stats = hits.groupBy("unit_key").agg(held.alias("_rows"))
    limit = F.lit(cap).cast("long")
    n = F.when(F.col("_rows").isNull(), 0).otherwise(F.size("_rows")).cast("long")
    rows = [F.transform("_rows", lambda r: F.struct(*[r[k].alias(k) for k in keep])).alias("rows")] if keep else []
    ids = F.transform("_rows", lambda r: r["_id"])
    return cells.join(stats, "unit_key", "left").select(*cells.columns, n.alias("result_count"), is_saturated(n, limit).alias("saturated"), cell_state(n, limit).alias("state"), set_hash(ids).alias("item_set_hash"), *rows)


def with_children(seen: DataFrame, traversal: Traversal, columns: list[str], max_depth: int) -> tuple[DataFrame, DataFrame]:
    """(seen, children): the children of truncated cells, written; cells that have any are subdivided."""
    full = seen.where("state = 'truncated'").select(*columns).where(F.col("depth") < max_depth)
    children = cut(traversal.split(full))
    parents = children.select(F.col("parent_key").alias("unit_key")).distinct().withColumn("split", F.lit(True))
    seen = seen.join(parents, "unit_key", "left").withColumn("state", F.when(F.col("split"), "subdivided").otherwise(F.col("state"))).drop("split")
    return seen, children


def sweep(source: CappedSource, traversal: Traversal, seeds: DataFrame, max_depth: int = 20, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(coverage, items): a row for each cell asked, `subdivided` where it was split; and each item once.

    done: checkpoints of an earlier run; its cells aren't asked again. Where it has the cells' own columns, the
    children of those it split are asked too, as far as it hasn't done them.
    """
    columns, level, coverage, found = seeds.columns, seeds, [], []
    if done is not None and set(columns) <= set(done.columns):
        level = level.unionByName(traversal.split(done.where("state = 'subdivided'").select(*columns)).select(*columns)).dropDuplicates(["unit_key"])
    level = cut(level if done is None else pending(level, done))
    while True:
        hits = source.discover(level)
        keep = ["item_id", "facet", "name"] if "facet" in hits.columns else ["item_id"]
        # a level is written once, each cell with its rows, from which the items come
        observed = cut(observe(level, hits, source.cap, keep))
        drop(level)
        if "name" in keep:
            traversal.observed(observed.select("unit_key", F.inline("rows")), f"{len(found):06d}")
        seen, children = with_children(observed.drop("rows"), traversal, columns, max_depth)
        coverage.append(seen)
        found.append(observed.select(F.inline("rows")))
        if children.isEmpty():
            break
        level = children.select(*columns)
        if done is not None:
            level = cut(pending(level, done))
    return _union(coverage), _union(found).dropDuplicates(["item_id"])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def recall(items: DataFrame, everything: DataFrame) -> DataFrame:
    return everything.select("item_id").distinct().join(items.select("item_id", F.lit(1).alias("got")), "item_id", "left").agg((F.sum("got") / F.count("*")).alias("recall"))
