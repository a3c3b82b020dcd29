"""Sources that answer a cell with at most `cap` rows, in an order of their own that is total."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.intervals import within
from ..operators.substrings import contained


class CappedSource(Protocol):
    cap: int | None

    def discover(self, cells: DataFrame) -> DataFrame:
        """(unit_key, item_id, ...) for the cells' rows, capped in each cell."""


@dataclass
class TableSource:
    """A table behind a cap. Cells ask for a span of days, a facet's value and a part of a name; null asks for nothing."""

    rows: DataFrame  # item_id, day, facet, name
    cap: int | None

    def discover(self, cells: DataFrame) -> DataFrame:
        # equi-joins: spans of days by their blocks, facets and probes where cells ask for them
        asked = cells.select("unit_key", "facet_value", F.lower("probe").alias("_probe"), F.unix_date("date_from").alias("_low"), F.unix_date("date_to").alias("_high"))
        points = self.rows.withColumn("_day", F.unix_date("day"))
        hits = []
        for r in cells.select(F.col("facet_value").isNotNull().alias("facet"), F.col("probe").isNotNull().alias("probe")).distinct().collect():  # at most four
            some = asked.where((F.col("facet_value").isNotNull() == r["facet"]) & (F.col("_probe").isNotNull() == r["probe"]))
            some = some.select("unit_key", "_low", "_high", *[F.col("facet_value").alias("facet")] * r["facet"], *["_probe"] * r["probe"])
            rows = points
            if r["probe"]:
                # a name meets a probe once, not in every cell
                names = self.rows.select(F.lower("name").alias("name")).where("name is not null").distinct()
                probes = some.select(F.col("_probe").alias("probe")).distinct()
                found = contained(names, probes).select(F.col("name").alias("_name"), F.col("probe").alias("_probe"))
                rows = rows.join(found, F.lower("name") == F.col("_name")).drop("_name")
            hits.append(within(some, "_low", "_high", rows, "_day", ["facet"] * r["facet"] + ["_probe"] * r["probe"]).select("unit_key", "item_id", "facet", "name"))
        if not hits:
            return self.rows.where("false").select(F.lit("").alias("unit_key"), "item_id", "facet", "name")
        return capped(reduce(DataFrame.unionByName, hits), F.col("item_id"), self.cap)


@dataclass
class RangeSource:
    """The same over integer keys instead of days: cells are (low, high) spans."""

    rows: DataFrame  # item_id, region
    cap: int | None

    def discover(self, cells: DataFrame) -> DataFrame:
        return capped(within(cells.select("unit_key", "low", "high"), "low", "high", self.rows, "region").select("unit_key", "item_id"), F.col("item_id"), self.cap)


def capped(hits: DataFrame, order: Column, cap: int | None) -> DataFrame:
    """The first `cap` rows of each cell: a rank that Spark limits in each partition before it shuffles."""
    if cap is None:
        return hits
    rank = F.row_number().over(Window.partitionBy("unit_key").orderBy(order))
    return hits.withColumn("_r", rank).where(F.col("_r") <= cap).drop("_r")
