import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from capsweep import cli
from capsweep.operators import coverage, queues
from capsweep.plans.run import FixedClock, Limits, retry, run, tolerated
from capsweep.plans.sweep import Traversal, day_cells, sweep
from capsweep.sources.capped import TableSource
from capsweep.sources.jsonl import append_jsonl, read_jsonl
from capsweep.stores import Stores

LOW, HIGH = dt.date(2024, 1, 1), dt.date(2024, 1, 4)
ROWS = [(f"i{k:03d}", LOW + dt.timedelta(days=k % 3), "AB"[k % 2], ["DA SILVA", "DOS REIS"][k % 5 % 2]) for k in range(40)]


def table(spark):
    return spark.createDataFrame(ROWS, "item_id string, day date, facet string, name string")


def parts(spark, **options):
    dims = lambda c, vs: spark.createDataFrame([(v, i) for i, v in enumerate(vs)], f"{c} string, position int")
    return Traversal(dims("facet", ["A", "B"]), dims("probe", ["da silva", "dos reis"]), **options)


def cells(df):
    return {r.unit_key: (r.state, r.result_count, r.item_set_hash) for r in df.collect()}


def test_jsonl_folder_round_trip(spark, tmp_path):
    path = str(tmp_path / "x")
    for k in (1, 2, 2):
        append_jsonl(spark.range(k * 10, k * 10 + 3).withColumnRenamed("id", "a").coalesce(1), path, f"b{k}")
    got = read_jsonl(spark, path, "a long").orderBy("line_no").collect()
    assert [r.a for r in got] == [10, 11, 12, 20, 21, 22] and [r.line_no for r in got] == [1, 2, 3, 4, 5, 6]
    append_jsonl(spark.range(3).withColumnRenamed("id", "a"), path)
    assert read_jsonl(spark, path, "a long").count() == 9
    (tmp_path / "x/b3").mkdir()
    (tmp_path / "x/b3/torn.json").write_text('{"a":7}\n{"a":')
    assert read_jsonl(spark, path, "a long").count() == 10
    (tmp_path / "x/b3/torn.json").write_text('{"a":7}\n{"a":\n{"a":8}')
    with pytest.raises(ValueError):
        read_jsonl(spark, path, "a long")


def test_run_is_the_sweep_however_often_it_stops(spark, tmp_path):
    source, seeds = TableSource(table(spark), 3), day_cells(spark, str(LOW), str(HIGH))
    full, items = sweep(source, parts(spark), seeds)
    stores = Stores(spark, str(tmp_path / "s"))
    asked = []
    for k in range(9):
        t = run(source, parts(spark), seeds, stores, f"r{k}", Limits(max_requests=5), FixedClock(dt.datetime(2024, 1, 1 + k, tzinfo=dt.UTC)))
        asked.append(t.requests)
        if not t.requests:
            break
    assert asked[-1] == 0 and all(x <= 5 for x in asked) and sum(asked) == full.count()
    assert cells(stores.checkpoints()) == cells(full)
    assert {r.item_id for r in stores.items().collect()} == {r.item_id for r in items.collect()}
    log = stores.coverage()
    assert log.count() == full.count() and log.where("run_id = 'r0'").first().phase == "sweep"
    assert log.where("unit_key = '2024-01-01..2024-01-01|A'").first().dimensions == {"date": "2024-01-01..2024-01-01", "class": "A"}


class Flaky:
    """Cells of the second day need a second session, those of the third are told to wait twice, the fourth's are gone."""

    cap = 3

    def __init__(self, inner):
        self.inner, self.turn, self.renewed = inner, 0, 0

    def reprime(self):
        self.renewed += 1

    def discover(self, cells):
        self.turn += 1
        day = F.dayofmonth("date_from")
        bad = F.when((day == 2) & F.lit(not self.renewed), F.struct(F.lit("sessionExpired").alias("kind"), F.lit(None).cast("int").alias("status")))
        bad = bad.when((day == 3) & F.lit(self.turn <= 2), F.struct(F.lit("transient").alias("kind"), F.lit(429).alias("status"))).when(day == 4, F.struct(F.lit("permanentError").alias("kind"), F.lit(None).cast("int").alias("status")))
        told = cells.withColumn("bad", bad)
        failures = told.where("bad is not null").select("unit_key", F.lit(None).cast("string").alias("item_id"), "bad.kind", "bad.status", F.lit("notFound").alias("reason"), F.lit(7000).cast("long").alias("retry_after_ms"))
        good = self.inner.discover(told.where("bad is null").drop("bad"))
        lost = good.where("item_id = 'i000'").select("unit_key", F.lit("u1").alias("item_id"), F.lit("unresolved").alias("kind"), F.lit("hostDefect:x").alias("reason"))
        return good.unionByName(failures, allowMissingColumns=True).unionByName(lost, allowMissingColumns=True)


def test_failures_are_tried_again_and_accounted_for(spark, tmp_path):
    clock, stores = FixedClock(), Stores(spark, str(tmp_path / "s"))
    source = Flaky(TableSource(table(spark), None))
    source.cap = None
    t = run(source, parts(spark), day_cells(spark, str(LOW), str(HIGH)), stores, "r", Limits(max_requests=None), clock)
    got = cells(stores.checkpoints())
    assert {k[8:10]: v[0] for k, v in got.items()} == {"01": "complete", "02": "complete", "03": "complete", "04": "failed"}
    assert (t.retried, source.renewed, clock.slept) == (3, 1, [7000, 7000]) and t.requests == 4 + 2 + 1
    assert sorted((r.item_id, r.reason) for r in stores.ledger().collect()) == [("2024-01-04..2024-01-04", "notFound"), ("u1", "hostDefect:x")]
    assert coverage.summary(stores.coverage()).first().asDict() == {"complete": 3, "truncated": 0, "failed": 1, "unresolved": 1}


def test_documents_budgets_and_retry(spark, tmp_path):
    stores, clock = Stores(spark, str(tmp_path / "s")), FixedClock()
    docs = lambda items: items.select("item_id", F.explode(F.array(F.lit("d1"), F.lit("d2"), F.lit("d3"))).alias("document_id"))
    fetch = lambda d: d.select("item_id", "document_id", F.concat_ws("/", "item_id", "document_id").alias("file_name"), F.encode(F.lit("%PDF-1"), "utf-8").alias("body"), F.when(F.col("document_id") == "d2", "HTTP 503").alias("reason"))
    t = run(TableSource(table(spark), None), parts(spark), day_cells(spark, str(LOW), str(HIGH)), stores, "r", Limits(max_items=4, max_documents=6, documents_per_item=2), clock, docs, fetch, str(tmp_path / "files"))
    assert (t.items, t.documents, t.failed_documents) == (4, 6, 3) and t.requests == 4 + 6
    items = stores.items().orderBy("item_id").collect()
    assert [[d.status for d in r.documents] for r in items] == [["fetched", "failed"]] * 3 + [[]] and json.loads(items[0].payload) == {"facet": "A", "name": "DA SILVA"}
    assert sorted(p.name for p in (tmp_path / "files").rglob("d*")) == ["d1"] * 3
    assert retry(stores, lambda d: fetch(d).withColumn("reason", F.when(F.col("item_id") == "i000", "gone")), "again", None, FixedClock()) == (2, 1)
    assert coverage.unresolved_failures(stores.ledger()).select("item_id", "document_id").distinct().collect() == [("i000", "d2")]
    stores.append_state("seeds", spark.createDataFrame([("a",), ("b",)], "value string").coalesce(1), "b1")
    assert [r.value for r in stores.state("seeds").orderBy("ordinal").collect()] == ["a", "b"] and stores.state("none").count() == 0


def test_tolerance_of_rows(spark):
    rows = [
        ("u", 0, "a", 0, "hostDefect", None, "x"), ("u", 0, "a", 1, "ok", None, None), ("u", 1, "b", 0, "permanentError", None, "gone"), ("u", 1, "b", 1, "permanentError", None, "gone"), ("u", 1, "b", 2, "hostDefect", None, "end"), ("u", 1, "b", 3, "ok", None, None),
        ("v", 0, "c", 0, "ok", None, None), ("v", 1, "d", 0, "hostDefect", None, "x"), ("v", 1, "d", 1, "transient", 503, None), ("v", 2, "e", 0, "sessionExpired", None, None),
    ]
    got = tolerated(spark.createDataFrame(rows, "unit_key string, position int, item_id string, attempt int, kind string, status int, reason string").withColumn("detail", F.lit(None).cast("string")))
    assert [[tuple(r) for r in x.collect()] for x in got] == [[("u", 0, "a")], [("u", 1, "b", "hostDefect:end")], [("v", "transient", 503)]]


def test_invariant_of_incomparable_dimensions(spark):
    rows = [("w", None, 9, 1, {"date": "d"}), ("w", "A", 5, 2, {"date": "d", "class": "A"}), ("w", "A", 4, 3, {"date": "d", "region": "R"}), ("w", "A", 3, 4, {"date": "d", "class": "A", "name": "n"}), ("w", "A", 2, 5, {"date": "d", "region": "R", "name": "n"})]
    df = spark.createDataFrame([(f"{w}|{f}|{o}", w, f, n, "t", o, d) for w, f, n, o, d in rows], "unit_key string, window_key string, facet_value string, result_count long, observed_at string, ordinal int, dimensions map<string,string>")
    got = {r.facet_value: (r.parent_count, r.child_sum, r.holds) for r in coverage.partition_invariant(df).collect()}
    assert got == {None: (9, 9, True), "A": (4, 2, False)}  # the latest shallow row is region's; only its own children count


def test_gate_cools_down(spark):
    rng = [(k, 100 * k if k % 4 else 0, [None, 3000, 200, 0][k % 7 % 4]) for k in range(40)]
    want, last, free = {}, -10**9, -10**9
    for k, ready, cool in rng:
        last = max(ready, last + 500, free)
        want[k] = last
        free = max(free, last + (cool or 0))
    df = spark.createDataFrame(rng, "k int, ready long, cool long").withColumn("g", F.lit(1))
    assert {r.k: r.granted for r in queues.rate_gate(df, "ready", "k", 500, "g", "cool").collect()} == want


def test_used_probes_are_not_asked_again(spark):
    used = spark.createDataFrame([("2024-01-01..2024-01-01|A", "da silva")], "unit_key string, probe string")
    cell = spark.createDataFrame([("2024-01-01..2024-01-01|A", "2024-01-01..2024-01-01", "A", None, LOW, LOW, 1)], "unit_key string, window_key string, facet_value string, probe string, date_from date, date_to date, depth int")
    assert [(r.probe, r.parent_key) for r in parts(spark, used=used, max_probes=1).split(cell).collect()] == [("dos reis", "2024-01-01..2024-01-01|A")]
    assert parts(spark, max_probes=0).split(cell).count() == 0


def test_command_line_runs(spark, tmp_path, capsys):
    table(spark).write.parquet(str(tmp_path / "rows"))
    args = ["scrape", "--from", "2024-01-01", "--to", "2024-01-04", "--cap", "3", "--max-requests", "unbounded"]
    with pytest.raises(SystemExit):
        cli.main(args, spark)
    assert cli.main([*args, "--dry-run"], spark) == 0 and "4 days" in capsys.readouterr().out
    args += ["--source", str(tmp_path / "rows"), "--out", str(tmp_path / "out"), "--log-folder", str(tmp_path / "log"), "--run-id", "one"]
    assert cli.main(args, spark) == 0
    assert "Run summary" in capsys.readouterr().out and (tmp_path / "log/run-one.jsonl").exists()
    before = Stores(spark, str(tmp_path / "out")).items().count()
    assert cli.main([*args, "--frontier"], spark) == 0 and "Frontier run summary" in capsys.readouterr().out
    assert Stores(spark, str(tmp_path / "out")).items().count() >= before > 0
    spark.createDataFrame([], "item_id string, document_id string, file_name string, body binary, reason string").write.parquet(str(tmp_path / "fetched"))
    assert cli.main(["retry-failed", "--fetched", str(tmp_path / "fetched"), "--out", str(tmp_path / "out")], spark) == 0
    with pytest.raises(SystemExit):
        cli.main(["retry-failed", "--fetched", "x"], spark)
