import datetime as dt
import io
import json

import pytest
from pyspark.sql import functions as F

from capsweep import cli, queries, runlog
from capsweep.plans.frontier import crawl, harvest_seeds
from capsweep.plans.retry import document_outcomes, retry_failed
from capsweep.plans.sweep import Traversal, day_cells, sweep
from capsweep.sources.capped import TableSource
from capsweep.sources.documents import place
from capsweep.streaming.latest import latest_cells

LOW, HIGH = dt.date(2024, 1, 1), dt.date(2024, 1, 8)


def rows(spark, names):
    return spark.createDataFrame([(f"i{k:03d}", LOW + dt.timedelta(days=k % 8), "A", n) for k, n in enumerate(names)], "item_id string, day date, facet string, name string")


def seeds(spark, values):
    return spark.createDataFrame([(k, "name", v, s) for k, (v, s) in enumerate(values)], "ordinal int, kind string, value string, cell_state string")


def cell(s):
    none = F.lit(None).cast("string")
    return s.select(F.col("value").alias("unit_key"), F.lit("w").alias("window_key"), none.alias("facet_value"), F.col("value").alias("probe"), F.lit(LOW).alias("date_from"), F.lit(HIGH).alias("date_to"), F.lit(0).alias("depth"), "seed_no")


def brute(names, values, cap, window):
    """One seed after the other, full spans halved."""
    data = [(f"i{k:03d}", k % 8, n) for k, n in enumerate(names)]
    ranked = [v for v, s in values if s == "truncated"] + [v for v, s in values if s != "truncated"]
    seen, dry, done, asked = {}, 0, 0, 0
    for no, v in enumerate(ranked, 1):
        done, new, stack = done + 1, 0, [(0, 7)]
        while stack:
            a, b = stack.pop()
            asked += 1
            got = sorted(i for i, d, n in data if a <= d <= b and v.lower() in n.lower())[:cap]
            for i in got:
                if i not in seen:
                    seen[i], new = no, new + 1
            if len(got) >= cap and a < b:
                m = a + (b - a) // 2
                stack += [(a, m), (m + 1, b)]
        dry = 0 if new else dry + 1
        if dry >= window:
            break
    return seen, done, asked


@pytest.mark.parametrize("values", [
    [("ana", "complete"), ("bob", "truncated"), ("none", "complete"), ("ana", "complete"), ("eve", "complete")],
    [("x", "complete"), ("y", "complete"), ("ana", "truncated"), ("z", "complete"), ("bob", "complete")],
    [],
])
def test_frontier_as_one_by_one(spark, values):
    names = ["ana", "bob", "ana bob", "eve"] * 8
    want, done, asked = brute(names, values, 3, 3)
    got = crawl(TableSource(rows(spark, names), 3), seeds(spark, values), ["name"], cell, None, window=3)
    assert {r.item_id: r.seed_no for r in got.items.collect()} == want
    assert (got.seeds_processed, got.new_items) == (done, len(want))
    assert got.requests >= asked and got.ledger.isEmpty()


def test_frontier_budget_is_a_ceiling(spark):
    got = crawl(TableSource(rows(spark, ["ana"] * 30), 2), seeds(spark, [("ana", "complete")] * 4), ["name"], cell, 5, window=3)
    assert got.requests == 5 and got.new_items == got.items.count() > 0


def test_frontier_query_asks_every_seed(spark, tmp_path):
    n, days = 8, 16  # 15 lines of each name on each day: 31 requests for a seed
    spark.createDataFrame([(p, f"name{p}", 30) for p in range(n)], "p_partkey long, p_name string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    lines = [(d * 15 + k, p, p, "A", dt.datetime(2024, 1, 1) + dt.timedelta(days=d)) for d in range(days) for k in range(15) for p in range(n)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.item_id: r.seed_no for r in queries.frontier_crawl(spark, str(tmp_path)).collect()}
    assert got == {f"{o}-{k:02d}": p + 1 for o, k, p, _, _ in lines}


def test_frontier_failures_go_to_the_ledger(spark):
    class Failing:
        cap = 3

        def discover(self, cells):
            return cells.select("unit_key", F.lit(None).cast("string").alias("item_id"), F.lit("timeout").alias("reason"))

    got = crawl(Failing(), seeds(spark, [("a", "complete"), ("b", "complete")]), ["name"], cell, 9, window=5)
    assert sorted(r.item_id for r in got.ledger.collect()) == ["1#a", "2#b"] and (got.seeds_processed, got.new_items) == (2, 0)


def test_seeds_of_full_cells(spark):
    hits = spark.createDataFrame([("u", "A"), ("v", "B"), ("v", None)], "unit_key string, name string")
    cells = spark.createDataFrame([("u", True), ("v", False)], "unit_key string, saturated boolean")
    assert {(r.value, r.cell_state) for r in harvest_seeds(hits, cells, "name", "name").collect()} == {("A", "truncated"), ("B", "complete")}


def test_retry_writes_resolves_and_fails_anew(spark, tmp_path):
    t = "item_id string, document_id string, reason string, observed_at string, resolved boolean, item string, doc string"
    ledger = spark.createDataFrame([
        ("i", "1", "x", "t1", False, "{}", "{}"), ("i", "1", "x", "t2", False, "{}", "{}"), ("i", "2", "x", "t1", False, "{}", "{}"), ("i", "2", None, "t2", True, None, None),
        ("i", "3", "x", "t1", False, "{}", "{}"), ("i", "4", "x", "t1", False, None, None), ("i", None, "x", "t1", False, "{}", "{}"),
    ], t)
    fetch = lambda d: d.withColumns({"file_name": F.concat(F.lit("a/"), "document_id", F.lit(".pdf")), "body": F.encode(F.lit("%PDF-1"), "utf-8"), "reason": F.when(F.col("document_id") == "3", "HTTP 404")})
    good, bad = retry_failed(ledger, fetch, str(tmp_path))
    assert [tuple(r) for r in good.collect()] == [("i", "1", True, 6)]
    assert [(r.document_id, r.reason) for r in bad.collect()] == [("3", "HTTP 404")]
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["1.pdf"] and (tmp_path / "a/1.pdf").read_bytes() == b"%PDF-1"
    items = ledger.select("item_id", "document_id").distinct()
    assert {r.document_id: r.status for r in document_outcomes(items, good, bad).collect()} == {"1": "fetched", "2": None, "3": "failed", "4": None, None: None}


@pytest.mark.parametrize("name", ["/etc/x", "../x", "a/../../x", "."])
def test_names_stay_in_their_folder(name):
    with pytest.raises(ValueError):
        place("/d", name)


def test_resume_asks_children_of_split_cells_only(spark):
    source = TableSource(rows(spark, ["ana", "bob"] * 16), 3)
    dims = lambda c, vs: spark.createDataFrame([(v, i) for i, v in enumerate(vs)], f"{c} string, position int")
    traversal, cells = Traversal(dims("facet", ["A"]), dims("probe", ["ana", "bob"])), day_cells(spark, str(LOW), str(HIGH))
    full, items = sweep(source, traversal, cells)
    done = full.where("state = 'subdivided'")
    again, found = sweep(source, traversal, cells, done=done)
    assert {r.unit_key for r in again.collect()} == {r.unit_key for r in full.collect()} - {r.unit_key for r in done.collect()}
    assert {r.item_id for r in found.collect()} == {r.item_id for r in items.collect()}


def test_loggers(tmp_path):
    out = io.StringIO()
    runlog.emit(runlog.Redacting(runlog.ConsoleLogger("info", out)), "warn", "unit.saturated", cpf="1", n=2, x=None)
    runlog.emit(runlog.ConsoleLogger("info", out), "debug", "hidden")
    assert out.getvalue() == "WARN unit.saturated cpf=[REDACTED] n=2\n"
    runlog.emit(runlog.JsonlLogger(str(tmp_path), "r"), "info", "unit.started", k="é")
    assert json.loads((tmp_path / "run-r.jsonl").read_text()) == {"level": "info", "event": "unit.started", "fields": {"k": "é"}}
    runlog.emit(runlog.ConsoleLogger("info", None), "nonsense", "never raises")


def test_summaries():
    assert cli.run_summary({"complete": 1, "truncated": 2, "failed": 0, "unresolved": 3}, [{"window_key": "w", "facet_value": None, "parent_count": 30, "child_sum": 10}])[-1] == "  w: whole 30, parts 10, missing 20"
    assert cli.frontier_summary(2, 1)[1:3] == ["  seeds processed: 2", "  new items found: 1"]


def test_latest_cells_as_a_stream(spark, tmp_path):
    schema = "unit_key string, state string, result_count long, observed_at string, ordinal long"
    for k, part in enumerate([[("a", "failed", 0, "t2", 1)], [("a", "complete", 5, "t1", 2), ("b", "complete", 1, "t1", 3)], [("a", "truncated", 9, "t3", 4)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/p{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    last = {}
    q = latest_cells(stream).writeStream.outputMode("update").foreachBatch(lambda df, _: last.update({r.unit_key: r.state for r in df.collect()})).option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert last == {"a": "truncated", "b": "complete"}
