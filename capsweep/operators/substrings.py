"""Which names contain which probes, by an index of their three-letter parts instead of every name against every probe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of an indexed part; shorter probes are looked up among the names' shorter parts.
GRAM = 3


def parts(text: Column, size: int) -> Column:
    """Distinct runs of `size` letters."""
    n = F.length(text) - (size - 1)
    return F.when(n < 1, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(text, i, F.lit(size)))))


def postings(names: DataFrame) -> DataFrame:
    """(gram, name) of names(name): a name's list entries."""
    return names.select(F.explode(parts(F.col("name"), GRAM)).alias("gram"), "name")


def contained(names: DataFrame, probes: DataFrame) -> DataFrame:
    """(name, probe) for every probe that is part of a name; names(name) and probes(probe), distinct, in one case.

    A probe's hits are in the posting lists of all its parts. The shortest of them is read and its names are verified,
    so that a probe meets as many names as its rarest part has; a probe with a part that no name has meets none. Probes of fewer
    letters than a part are equal to a name's short part. The empty probe is part of every name.
    """
    index = postings(names)
    sizes = index.groupBy("gram").agg(F.count("*").alias("n"))
    long = probes.where(F.length("probe") >= GRAM).select("probe", F.explode(parts(F.col("probe"), GRAM)).alias("gram"))
    rarest = long.join(sizes, "gram", "left").groupBy("probe").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r")).where("r.n > 0").select("probe", "r.gram")
    found = rarest.join(index, "gram").where(F.contains("name", "probe")).select("name", "probe")
    short = F.concat(F.array(F.lit("")), *[parts(F.col("name"), k) for k in range(1, GRAM)])
    brief = names.select("name", F.explode(short).alias("probe")).join(probes.where(F.length("probe") < GRAM), "probe").select("name", "probe")
    return found.unionByName(brief)
