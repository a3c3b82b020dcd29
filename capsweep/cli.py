"""Command line: a run over a table behind a cap, its forecast and bounds, retries of failed documents, and summaries."""

from __future__ import annotations

import argparse
import datetime as dt
import math
from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import cut
from .sources.capped import TableSource


@dataclass(frozen=True)
class Bounds:
    max_days: int | None = None
    max_items: int | None = None
    max_requests: int | None = 500
    max_documents: int | None = 10


def clamp(date_from: dt.date, date_to: dt.date, max_days: int | None) -> tuple[dt.date, dt.date]:
    if max_days is None or (date_to - date_from).days + 1 <= max_days:
        return date_from, date_to
    return date_from, date_from + dt.timedelta(days=max_days - 1)


def max_split_depth(date_from: dt.date, date_to: dt.date, floor: int = 20) -> int:
    days = (date_to - date_from).days + 1
    return max(floor, (0 if days <= 1 else math.ceil(math.log2(days))) + 2)


def forecast(date_from: dt.date, date_to: dt.date, cap: int | None, bounds: Bounds, spacing_ms: int = 500) -> dict:
    """Requests and seconds that a run may take; arithmetic alone."""
    span = (date_to - date_from).days + 1
    days = max(1, min(span, bounds.max_days if bounds.max_days is not None else span))
    items = 0 if cap is None else days * cap
    items = items if bounds.max_items is None else min(bounds.max_items, items)
    docs = items if bounds.max_documents is None else min(bounds.max_documents, items)
    total = days + items + docs
    total = total if bounds.max_requests is None else min(total, bounds.max_requests)
    return {"days": days, "items": items, "documents": docs, "requests": total, "seconds": total * spacing_ms / 1000}


def _count(value: str) -> int:
    n = int(value)
    if n < 0:
        raise argparse.ArgumentTypeError("a count can't be negative")
    return n


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("capsweep")
    sub = p.add_subparsers(dest="command", required=True)
    scrape = sub.add_parser("scrape", help="ask a source's cells and store what they hold")
    scrape.add_argument("--from", dest="date_from", type=dt.date.fromisoformat, required=True)
    scrape.add_argument("--to", dest="date_to", type=dt.date.fromisoformat, required=True)
    scrape.add_argument("--max-days", type=_count)
    scrape.add_argument("--max-items", type=_count)
    scrape.add_argument("--max-documents", type=_count, default=10)
    scrape.add_argument("--documents-per-item", type=_count)
    scrape.add_argument("--max-requests", type=lambda v: None if v == "unbounded" else _count(v), default=500)
    scrape.add_argument("--max-facet-values", type=_count, default=20)
    scrape.add_argument("--max-name-probes", type=_count, default=30)
    scrape.add_argument("--request-spacing", type=_count, default=500)
    scrape.add_argument("--cap", type=_count, default=30)
    scrape.add_argument("--dry-run", action="store_true")
    scrape.add_argument("--frontier", action="store_true", help="search for names that stored items give")
    scrape.add_argument("--source", help="Parquet of (item_id, day, facet, name), the table behind the cap")
    again = sub.add_parser("retry-failed", help="ask again for documents that the ledger has as failed")
    again.add_argument("--fetched", required=True, help="Parquet of (item_id, document_id, file_name, body, reason)")
    again.add_argument("--documents", help="folder where files are written")
    for command in (scrape, again):
        command.add_argument("--out", help="folder of the stores")
        command.add_argument("--run-id", default=None)
        command.add_argument("--log-level", choices=("debug", "info", "warn", "error"), default="info")
        command.add_argument("--log-folder", help="folder of the runs' logs as JSON lines; the console, if not given")
    again.set_defaults(needs=("out",))
    scrape.set_defaults(needs=("source", "out"))
    return p


def run_summary(counts: dict, broken: list[dict], checked: int = 0) -> list[str]:
    """Lines on a run: its cells by state, and where parts fall short of their whole."""
    lines = ["Run summary (measured, not certified):", *(f"  {k}: {counts[v]}" for k, v in (("complete", "complete"), ("truncated", "truncated"), ("failed", "failed"), ("unresolved items", "unresolved")))]
    if broken:
        lines += ["", "Parts with fewer items than their whole; these windows are incomplete, whatever their cells' states:"]
        for b in broken:
            scope = b["window_key"] if b["facet_value"] is None else f"{b['window_key']} | {b['facet_value']}"
            lines.append(f"  {scope}: whole {b['parent_count']}, parts {b['child_sum']}, missing {b['parent_count'] - b['child_sum']}")
    elif checked:
        lines += ["", f"Parts reach their whole in all {checked} windows and facets that were split."]
    return lines


def frontier_summary(seeds_processed: int, new_items: int) -> list[str]:
    return [
        "Frontier run summary:", f"  seeds processed: {seeds_processed}", f"  new items found: {new_items}", "",
        "What this run adds to coverage is not measured: seeds come from items already found, so it leads to what is connected with them and can't tell what it never saw.",
    ]


def printed(lines: list[str]) -> None:
    print("\n".join(lines))


def report(stores) -> list[str]:
    """The summary of all runs that the stores have seen."""
    from .operators import coverage

    log = stores.coverage()
    counts = coverage.summary(log).first().asDict()
    checked = coverage.partition_invariant(log)
    broken = [r.asDict() for r in coverage.broken(checked).orderBy("window_key", "facet_value").collect()]
    return run_summary(counts, broken, checked.count())


def main(argv: list[str] | None = None, spark=None) -> int:
    p = parser()
    a = p.parse_args(argv)
    if a.command == "scrape":
        date_from, date_to = clamp(a.date_from, a.date_to, a.max_days)
        if date_to < date_from:
            p.error("--to lies before --from")
        if a.dry_run:
            f = forecast(date_from, date_to, a.cap, Bounds(a.max_days, a.max_items, a.max_requests, a.max_documents), a.request_spacing)
            printed([f"{f['days']} days, {f['items']} items, {f['documents']} documents: {f['requests']} requests, about {f['seconds']:.0f} s"])
            return 0
    missing = [f"--{k}" for k in a.needs if getattr(a, k) is None]
    if missing:
        p.error(f"{a.command} needs {' and '.join(missing)}")

    import uuid

    from pyspark.sql import SparkSession

    from . import runlog
    from .plans import frontier, run, sweep
    from .plans.harvest import HarvestedTraversal
    from .stores import Stores

    spark = spark or SparkSession.builder.appName("capsweep").getOrCreate()
    stores, run_id = Stores(spark, a.out), a.run_id or uuid.uuid4().hex
    log = runlog.Redacting(runlog.JsonlLogger(a.log_folder, run_id, a.log_level) if a.log_folder else runlog.ConsoleLogger(a.log_level))
    if a.command == "retry-failed":
        fetched = spark.read.parquet(a.fetched).select("item_id", "document_id", "file_name", "body", "reason")
        none = F.lit("not fetched")
        fetch = lambda d: d.join(fetched.withColumn("_got", F.lit(True)), ["item_id", "document_id"], "left").withColumn("reason", F.when(F.col("_got").isNull(), none).otherwise(F.col("reason"))).drop("_got")
        good, bad = run.retry(stores, fetch, run_id, a.documents)
        printed([f"{good} documents resolved, {bad} failed again"])
        return 0
    source = TableSource(cut(spark.read.parquet(a.source).select(F.col("item_id").cast("string").alias("item_id"), F.col("day").cast("date").alias("day"), "facet", "name")), a.cap)
    if a.frontier:
        named = stores.items().select(F.get_json_object("payload", "$.name").alias("value"), "unit_key", "ordinal").where("value is not null")
        state = stores.checkpoints().select("unit_key", F.when(F.col("state").isin("truncated", "subdivided"), "truncated").otherwise("complete").alias("cell_state"))
        seeds = named.join(state, "unit_key", "left").groupBy("value").agg(F.min("ordinal").alias("ordinal"), F.max("cell_state").alias("cell_state")).withColumn("kind", F.lit("name"))
        none = F.lit(None).cast("string")
        cell = lambda s: s.select(F.col("value").alias("unit_key"), F.lit(f"{date_from}..{date_to}").alias("window_key"), none.alias("facet_value"), F.col("value").alias("probe"), F.lit(date_from).alias("date_from"), F.lit(date_to).alias("date_to"), F.lit(0).alias("depth"), "seed_no")
        got = frontier.crawl(source, seeds, ["name"], cell, a.max_requests)
        fresh = got.items.join(stores.items().select("item_id"), "item_id", "left_anti")
        at = run.SystemClock().now()
        found = fresh.withColumns({"unit_key": F.concat(F.lit("seed:"), F.col("seed_no").cast("string")), "run_id": F.lit(run_id), "observed_at": F.lit(at), "payload": F.lit("{}"), "documents": F.array().cast("array<struct<document_id:string,status:string,bytes:bigint>>")})
        found = cut(found)
        stores.append("items", found, f"{run_id}-{at.replace(':', '')}")
        printed(frontier_summary(got.seeds_processed, found.count()))
        return 0
    rows = source.rows
    facets = rows.select("facet").where("facet is not null").distinct().orderBy("facet").limit(a.max_facet_values)
    facets = facets.withColumn("position", F.row_number().over(Window.orderBy("facet")) - 1)
    traversal = HarvestedTraversal(cut(facets), max_facets=a.max_facet_values, max_probes=a.max_name_probes, stores=stores)
    tally = run.run(source, traversal, sweep.day_cells(spark, str(date_from), str(date_to)), stores, run_id, run.Limits(a.max_items, a.max_requests, a.max_documents, a.documents_per_item), max_depth=max_split_depth(date_from, date_to), log=log)
    printed([f"{tally.requests} requests, {tally.items} items", *report(stores)])
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
