"""Ranked queues, budgets and pacing: what runs next, and when a run ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import bigrams
from .substrings import contained


def bigram_frequency(names: DataFrame, name: str, ordinal: str) -> DataFrame:
    """(probe, n, first_seen) over neighbouring tokens of all names; sums meet before the shuffle."""
    pairs = names.select(F.col(ordinal).alias("o"), F.posexplode(bigrams(F.col(name))).alias("p", "probe"))
    return pairs.groupBy("probe").agg(F.count("*").alias("n"), F.min(F.struct("o", "p")).alias("first_seen"))


def name_probe_hits(names: DataFrame, name: str) -> DataFrame:
    """(probe, hits): each distinct whole name as a probe, and the rows whose name contains it; names match once, with their counts."""
    counted = names.select(F.lower(name).alias("_name")).where("_name is not null").groupBy("_name").agg(F.count("*").alias("_n"))
    return probe_hits(counted, counted.select(F.col("_name").alias("probe")))


def probe_hits(counted: DataFrame, probes: DataFrame) -> DataFrame:
    """(probe, hits) of probes(probe) that any of counted(_name, _n) contains; both distinct, in lower case."""
    pairs = contained(counted.select(F.col("_name").alias("name")), probes)
    return pairs.join(counted, F.col("name") == F.col("_name")).groupBy("probe").agg(F.sum("_n").alias("hits"))


#: Name parts that are common, in the order they are asked when nothing better is known.
COMMON_PROBES = (
    "DA SILVA", "DOS SANTOS", "DE OLIVEIRA", "DA COSTA", "DE SOUZA", "DOS REIS", "DA CRUZ", "DE ALMEIDA", "DO NASCIMENTO", "DE ARAUJO", "DE LIMA", "DA ROCHA",
    "INSTITUTO NACIONAL", "CAIXA ECONOMICA", "UNIAO FEDERAL", "FAZENDA NACIONAL", "MINISTERIO PUBLICO", "MUNICIPIO DE",
)


def common_probes(spark) -> DataFrame:
    return spark.createDataFrame([(p, i) for i, p in enumerate(COMMON_PROBES)], "probe string, position int")


def probe_queue(frequencies: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(probe, source_rank, n, first_seen, position): harvested ones by frequency, then the dictionary's others in order."""
    mine = frequencies.select("probe", F.lit(0).alias("source_rank"), "n", F.col("first_seen"), F.lit(None).cast("int").alias("position"))
    rest = dictionary.join(frequencies.select("probe"), "probe", "left_anti")
    rest = rest.select("probe", F.lit(1).alias("source_rank"), F.lit(0).cast("long").alias("n"), F.lit(None).cast(frequencies.schema["first_seen"].dataType).alias("first_seen"), F.col("position").cast("int"))
    return mine.unionByName(rest).orderBy("source_rank", F.desc("n"), "first_seen", "position")


def ranked_seeds(seeds: DataFrame, kinds: list[str]) -> DataFrame:
    """Seeds of truncated cells first, then by kind, unknown kinds last, ties by order. Copies stay."""
    rank = F.nullif(F.array_position(F.array(*map(F.lit, kinds)), F.col("kind")), F.lit(0))
    return seeds.withColumns({"state_rank": F.when(F.col("cell_state") == "truncated", 0).otherwise(1), "kind_rank": F.coalesce(rank, F.lit(2**31 - 1)).cast("int")}).orderBy("state_rank", "kind_rank", "ordinal")


def yield_decay(seeds: DataFrame, hit: str, order: str, window: int = 5, by: list[str] | None = None) -> DataFrame:
    """seeds with seed_no and stopped: whether the last `window` up to it found nothing. by: independent queues."""
    w = Window.partitionBy(*(by or [])).orderBy(order)
    recent = F.sum(F.col(hit).cast("int")).over(w.rowsBetween(1 - window, 0))
    return seeds.withColumn("seed_no", F.row_number().over(w)).withColumn("stopped", (recent == 0) & (F.col("seed_no") >= window))


def within_budget(rows: DataFrame, order: list, item: str, most: int | None, per_item: int | None, by: str | None = None) -> DataFrame:
    """The first rows of a run that the global and the per-item budget admit, in order; None is no ceiling."""
    if per_item is not None:
        rows = rows.withColumn("_i", F.row_number().over(Window.partitionBy(*([by] if by else []), item).orderBy(*order))).where(F.col("_i") <= per_item).drop("_i")
    if most is not None:
        if by:
            rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_n") <= most).drop("_n")
        else:
            rows = rows.orderBy(*order).limit(most)  # a top-k in each partition, then one merge of k rows
    return rows


def rate_gate(requests: DataFrame, ready: str, order: str, spacing: int, by: str, cooldown: str | None = None) -> DataFrame:
    """requests with granted: max(ready, previous grant + spacing), in order, for each gate.

    cooldown: milliseconds for which a request's answer (a 429) closes the gate after its grant, null for none. A cooldown
    is not added to the spacing, the longer of them holds; nor do cooldowns add up.
    """
    w = Window.partitionBy(by).orderBy(order)
    step = F.greatest(F.lit(spacing), F.coalesce(F.col(cooldown), F.lit(0))) if cooldown else F.lit(spacing)
    # grants are max-plus sums: the latest of all ready times, each with the steps since
    rows = requests.withColumn("_s", F.coalesce(F.sum(step.cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    lead = F.max(F.col(ready) - F.col("_s")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("granted", lead + F.col("_s")).drop("_s")


def last_before(df: DataFrame, value: str, when, by: list[str], order: list, name: str) -> DataFrame:
    """df with the latest earlier value of rows for which `when` holds (an as-of attachment within a group)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(F.when(when, F.col(value)), ignorenulls=True).over(w))
