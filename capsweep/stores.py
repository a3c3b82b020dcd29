"""What a run keeps, as JSON lines in one folder for each store: items, coverage, checkpoints, the ledger and adapters' states.

Stores are only appended to. What is latest, resolved or first is found when they are read, so a batch that a crash made
a run write twice counts once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import coverage
from .sources.jsonl import append_jsonl, read_jsonl

CELL = "unit_key string, window_key string, facet_value string, probe string, date_from date, date_to date, depth int"
OBSERVED = "state string, result_count long, saturated boolean, item_set_hash string, unresolved long, run_id string, observed_at string"
SCHEMAS = {
    "items": "item_id string, unit_key string, run_id string, observed_at string, payload string, documents array<struct<document_id:string,status:string,bytes:bigint>>",
    "coverage": f"{CELL}, {OBSERVED}, phase string, dimensions map<string,string>",
    "checkpoints": f"{CELL}, {OBSERVED}",
    "probes": "unit_key string, probe string, n long, seen struct<batch:string,unit_key:string,item_id:string,place:int>",
    "offers": "unit_key string, probe string, position int",
    "requests": "request string, what string, gate string, attempt int, granted_ms long, outcome string, run_id string",
    "ledger": "item_id string, document_id string, reason string, observed_at string, resolved boolean, item string, doc string, run_id string",
}


@dataclass
class Stores:
    """folder: any path that Spark reads and writes. Batches have names that sort in the order they were written."""

    spark: SparkSession
    folder: str

    def _path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def append(self, name: str, rows: DataFrame, batch: str) -> None:
        append_jsonl(rows.select(*[f.strip().split(" ")[0] for f in _columns(SCHEMAS[name])]), self._path(name), batch)

    def read(self, name: str) -> DataFrame:
        return read_jsonl(self.spark, self._path(name), SCHEMAS[name]).withColumnRenamed("line_no", "ordinal")

    def checkpoints(self) -> DataFrame:
        """The latest checkpoint of each cell, ties to the later line."""
        return coverage.latest(self.read("checkpoints"), "unit_key").withColumn("unresolved", F.coalesce("unresolved", F.lit(0))).drop("ordinal")

    def items(self) -> DataFrame:
        """Each item once, as it was first written."""
        return coverage.first_seen(self.read("items"), "item_id", "ordinal")

    def fields(self, paths: dict[str, tuple[str, str]]) -> DataFrame:
        """Items with fields of their payloads: name -> (path, type), as ("$.parties[0].name", "string"). A payload may hold anything; a path that
        it lacks, or whose value isn't of the type, is null, and so is every field of a payload that is no JSON."""
        parsed = F.try_parse_json("payload")
        got = [F.try_variant_get(F.col("_bag"), path, kind).alias(name) for name, (path, kind) in paths.items()]
        return self.items().withColumn("_bag", parsed).select("item_id", "unit_key", *got)

    def payload_schema(self) -> str | None:
        """What all payloads hold together, as one type; null without items."""
        return self.items().agg(F.schema_of_variant_agg(F.try_parse_json("payload"))).first()[0]

    def coverage(self) -> DataFrame:
        """The log of all runs."""
        return self.read("coverage")

    def ledger(self) -> DataFrame:
        return self.read("ledger")

    def requests(self) -> DataFrame:
        """What passed a run's gate, and when: cells by their keys, documents by item and document."""
        return self.read("requests")

    def resolve(self, rows: DataFrame, run_id: str, observed_at: str, batch: str) -> None:
        """Entries that say a document is resolved; earlier entries stay."""
        none = F.lit(None).cast("string")
        self.append("ledger", rows.select("item_id", "document_id", none.alias("reason"), F.lit(observed_at).alias("observed_at"), F.lit(True).alias("resolved"), none.alias("item"), none.alias("doc"), F.lit(run_id).alias("run_id")), batch)

    def state(self, key: str) -> DataFrame:
        """(value, ordinal) appended under a key, in order."""
        return read_jsonl(self.spark, self._path(f"state/{key}"), "value string").withColumnRenamed("line_no", "ordinal")

    def append_state(self, key: str, values: DataFrame, batch: str) -> None:
        append_jsonl(values.select(F.col("value").cast("string").alias("value")), self._path(f"state/{key}"), batch)


def _columns(schema: str) -> list[str]:
    """A schema's columns; commas inside brackets part no columns."""
    out, deep = [""], 0
    for c in schema:
        deep += (c in "<(") - (c in ">)")
        if c == "," and not deep:
            out.append("")
        else:
            out[-1] += c
    return out
