"""Accounting of cells: latest observations, tallies, and whether parts add up to the whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str | list[str], at: str = "observed_at", ordinal: str = "ordinal") -> DataFrame:
    """The row of each key with the greatest (at, ordinal); the maximum is combined before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, ordinal)).alias("r"))
    return best.select(*keys, *[F.col("r")[c].alias(c) for c in rest])


def summary(records: DataFrame, at: str = "observed_at", ordinal: str = "ordinal") -> DataFrame:
    """One row: cells complete, truncated, failed, and unresolved items of all latest cells, subdivided ones included."""
    now = latest(records, "unit_key", at, ordinal)
    count = lambda s: F.count_if(F.col("state") == s).alias(s)
    return now.agg(count("complete"), count("truncated"), count("failed"), F.coalesce(F.sum(F.coalesce("unresolved", F.lit(0))), F.lit(0)).alias("unresolved"))


def pending(cells: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """cells without a checkpoint, or with a failed one."""
    return cells.join(checkpoints.where(F.col("state") != "failed").select("unit_key"), "unit_key", "left_anti")


def unresolved_failures(ledger: DataFrame) -> DataFrame:
    """Failures of documents that no entry anywhere in the ledger resolves."""
    resolved = F.coalesce(F.col("resolved"), F.lit(False))
    done = ledger.where(resolved).select("item_id", "document_id")
    return ledger.where(~resolved & F.col("document_id").isNotNull()).join(done, ["item_id", "document_id"], "left_anti")


def deeper(parent: Column, child: Column) -> Column:
    """Whether the child's dimension names are a strict superset of the parent's."""
    return (F.size(F.array_except(parent, child)) == 0) & (F.size(child) > F.size(parent))


def partition_invariant(records: DataFrame, at: str = "observed_at", ordinal: str = "ordinal", dedupe: bool = False) -> DataFrame:
    """(window_key, facet_value, parent_count, child_sum, holds): whether parts reach their whole's count.

    For a window: its latest row without a facet against the sum of its facets' shallow rows, those that aren't deeper
    than another row of their facet. For a facet: its latest shallow row against the sum of those deeper than that one.
    dedupe: count only the latest observation of each child.
    """
    r = records.withColumn("keys", F.array_sort(F.map_keys("dimensions")))
    children = latest(r, "unit_key", at, ordinal) if dedupe else r
    depth = F.size("keys")
    # key sets of a (window, facet) that no other of its key sets is inside of
    sets = children.where("facet_value is not null").select("window_key", "facet_value", "keys").distinct()
    inner = sets.alias("a").join(sets.alias("b"), (F.col("a.window_key") == F.col("b.window_key")) & (F.col("a.facet_value") == F.col("b.facet_value")) & deeper(F.col("b.keys"), F.col("a.keys"))).select("a.window_key", "a.facet_value", "a.keys").distinct()
    faceted = children.where("facet_value is not null")
    shallow = faceted.join(inner, ["window_key", "facet_value", "keys"], "left_anti")
    windows = latest(r.where("facet_value is null").withColumn("d", depth), "window_key", at, ordinal).select("window_key", F.col("result_count").alias("parent_count"))
    by_window = windows.join(shallow.groupBy("window_key").agg(F.sum("result_count").alias("child_sum")), "window_key").select("window_key", F.lit(None).cast("string").alias("facet_value"), "parent_count", "child_sum")
    # a facet's top is the latest of its shallow rows; only rows deeper than that one count for it
    tops = shallow.groupBy("window_key", "facet_value").agg(F.max_by(F.struct("keys", F.col("result_count").alias("parent_count")), F.struct(at, ordinal)).alias("t")).select("window_key", "facet_value", F.col("t.keys").alias("top"), "t.parent_count")
    deep = faceted.join(tops, ["window_key", "facet_value"]).where(deeper(F.col("top"), F.col("keys")))
    by_facet = deep.groupBy("window_key", "facet_value", "parent_count").agg(F.sum("result_count").alias("child_sum"))
    both = by_window.unionByName(by_facet.select(*by_window.columns))
    return both.withColumn("holds", F.col("child_sum") >= F.col("parent_count"))


def broken(invariant: DataFrame) -> DataFrame:
    return invariant.where(~F.col("holds")).withColumn("shortfall", F.col("parent_count") - F.col("child_sum"))


def first_seen(items: DataFrame, key: str, ordinal: str) -> DataFrame:
    rest = [c for c in items.columns if c != key]
    best = items.groupBy(key).agg(F.min_by(F.struct(*rest), ordinal).alias("r"))
    return best.select(key, *[F.col("r")[c].alias(c) for c in rest])
