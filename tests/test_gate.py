import datetime as dt
import json
import time

from pyspark.sql import functions as F

from capsweep.plans.run import FixedClock, Limits, run
from capsweep.plans.sweep import Traversal, day_cells
from capsweep.sources.capped import TableSource
from capsweep.stores import Stores
from capsweep.streaming.gate import NEVER, REQUEST, Gate, granted_stream

LOW = dt.date(2024, 1, 1)


def source(spark, days=4, cap=None, each=3):
    rows = [(f"i{d}{k}", LOW + dt.timedelta(days=d), "A", "n") for d in range(days) for k in range(each)]
    return TableSource(spark.createDataFrame(rows, "item_id string, day date, facet string, name string"), cap)


def no_split(spark):
    return Traversal(spark.createDataFrame([], "facet string, position int"), spark.createDataFrame([], "probe string, position int"))


def days(spark, n=4):
    return day_cells(spark, str(LOW), str(LOW + dt.timedelta(days=n - 1)))


class Waits:
    """Every cell is told to wait in the first `times` turns."""

    cap = None

    def __init__(self, inner, times):
        self.inner, self.times, self.turn, self.asked = inner, times, 0, []

    def discover(self, cells):
        self.turn += 1
        self.asked.append(cells.count())
        if self.turn > self.times:
            return self.inner.discover(cells)
        return cells.select("unit_key", F.lit(None).cast("string").alias("item_id"), F.lit("transient").alias("kind"), F.lit(429).alias("status"), F.lit(2000).cast("long").alias("retry_after_ms"))


def test_gate_is_a_queue_with_cooldowns(spark):
    want, last, until, gate = [], NEVER, NEVER, Gate(500)
    for turn, (ready, trips) in enumerate([([0, 0, 100, 5000], []), ([5100, 5000], [(5000, 3000), (5200, 9000), (8000, 1000)]), ([20000], [(9500, 100)])]):
        rows = [(f"{turn}{k}", at) for k, at in enumerate(ready)]
        for at, _, k, ms in sorted([(at, 0, "", ms) for at, ms in trips] + [(at, 1, k, None) for k, at in rows]):
            if ms is not None:
                until = at + ms if at >= until else until
                continue
            last = max(at, last + 500, until)
            want.append((k, last))
        given = spark.createDataFrame(trips, "at_ms long, cooldown_ms long").withColumn("gate", F.lit("all")) if trips else None
        got = gate.grant(spark.createDataFrame(rows, "k string, at_ms long"), "k", given)
        assert sorted((r.k, r.granted_ms) for r in got.collect()) == sorted(w for w in want if w[0][0] == str(turn))


def test_gates_are_apart_and_keep_their_states(spark):
    gate = Gate(500, F.col("host"))
    rows = lambda *r: spark.createDataFrame(r, "k string, host string, at_ms long")
    assert sorted((r.k, r.granted_ms) for r in gate.grant(rows(("a", "x", 0), ("b", "x", 0), ("c", "y", 0)), "k").collect()) == [("a", 0), ("b", 500), ("c", 0)]
    assert [(r.k, r.granted_ms) for r in gate.grant(rows(("d", "y", 0)), "k").collect()] == [("d", 500)]
    assert [(r.k, r.granted_ms) for r in gate.grant(rows(("e", "x", 0)), "k").collect()] == [("e", 1000)]
    assert gate.grant(rows(("e", "x", 0)).where("false"), "k").count() == 0


def test_a_stream_holds_requests_until_a_timer(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(REQUEST).json(str(tmp_path / "in"))
    query = granted_stream(stream, 100).writeStream.format("memory").queryName("granted").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()

    def send(name, rows):
        (tmp_path / f"{name}.tmp").write_text("\n".join(json.dumps(dict(zip(("gate", "key", "at_ms", "cooldown_ms"), r, strict=True))) for r in rows))
        (tmp_path / f"{name}.tmp").rename(tmp_path / f"in/{name}.json")

    def granted(keys, seconds=60):
        end = time.time() + seconds
        while time.time() < end:
            got = {r.key: r.granted_ms for r in spark.table("granted").collect()}
            if keys <= set(got):
                return got
            time.sleep(0.3)
        raise AssertionError(f"only {got} in {seconds} s")

    try:
        now = int(time.time() * 1000)
        send("1", [("g", "a", now, None), ("g", "b", now, None), ("h", "z", now, None)])
        first = granted({"a", "b", "z"})
        assert first["b"] - first["a"] == 100
        at = int(time.time() * 1000)
        send("2", [("g", None, at, 15000), ("g", "c", now, None), ("h", "y", now, None)])
        assert "c" not in granted({"y"}, 14)  # held, while another gate goes on
        assert granted({"c"})["c"] == at + 15000 and time.time() * 1000 >= at + 15000
    finally:
        query.stop()


def test_six_waits_end_complete(spark, tmp_path):
    stores, clock, asks = Stores(spark, str(tmp_path / "s")), FixedClock(), Waits(source(spark, 2), 6)
    t = run(asks, no_split(spark), days(spark, 2), stores, "r", Limits(max_requests=None), clock, gate=Gate(500))
    assert asks.asked == [2] * 7 and t.requests == 14 and stores.ledger().count() == 0
    assert {r.state for r in stores.checkpoints().collect()} == {"complete"} and stores.items().count() == 6
    log = [(r.attempt, r.outcome, r.granted_ms) for r in stores.requests().orderBy("granted_ms").collect()]
    assert [x[:2] for x in log] == [(1, "transient")] * 12 + [(1, "ok")] * 2
    gaps = [b[2] - a[2] for a, b in zip(log, log[1:], strict=False)]
    # the first answer's cooldown lasts past the second's
    assert gaps == [500, 1500] * 6 + [500] and clock.slept == [500] + [2000] * 6
    bounded = Stores(spark, str(tmp_path / "b"))
    assert run(Waits(source(spark, 2), 99), no_split(spark), days(spark, 2), bounded, "r", Limits(max_requests=5), FixedClock(), gate=Gate(500)).requests == 5
    assert bounded.checkpoints().count() == 0


def test_a_reached_ceiling_of_items_ends_the_run(spark, tmp_path):
    for most, cells in ((1, 1), (4, 2), (0, 0), (None, 30)):
        stores, asks = Stores(spark, str(tmp_path / f"s{most}")), Waits(source(spark, 30, 3), 0)
        asks.cap = 3
        t = run(asks, no_split(spark), days(spark, 30), stores, "r", Limits(max_items=most), FixedClock())
        assert (t.requests, t.items) == (cells, 90 if most is None else most) and stores.coverage().count() == cells


def test_documents_are_tried_again_under_the_gate(spark, tmp_path):
    stores, clock, seen = Stores(spark, str(tmp_path / "s")), FixedClock(), []

    def fetch(asked):
        seen.append(sorted((r.document_id, r.attempt) for r in asked.collect()))
        d, a = F.col("document_id"), F.col("attempt")
        kind = F.when((d == "late") & (a < 3), "transient").when(d == "never", "transient").when(d == "gone", "permanentError").otherwise("ok")
        return asked.select("item_id", "document_id", d.alias("file_name"), F.lit(b"%PDF-1").alias("body"), kind.alias("kind"), F.when(d == "never", 429).otherwise(503).alias("status"), F.when(d == "gone", "notFound").alias("reason"))

    docs = lambda items: items.select("item_id", F.explode(F.array(*map(F.lit, ("fine", "late", "never", "gone")))).alias("document_id"))
    t = run(source(spark, 1, None, 1), no_split(spark), days(spark, 1), stores, "r", Limits(max_requests=None, transient_cap=3), clock, docs, fetch, gate=Gate(500))
    assert seen == [[("fine", 1), ("gone", 1), ("late", 1), ("never", 1)], [("late", 2), ("never", 2)], [("late", 3), ("never", 3)], [("never", 4)]]
    assert (t.documents, t.failed_documents) == (4, 2)
    assert sorted((d.document_id, d.status) for d in stores.items().first().documents) == [("fine", "fetched"), ("gone", "failed"), ("late", "fetched"), ("never", "failed")]
    assert sorted((r.document_id, r.reason) for r in stores.ledger().collect()) == [("gone", "notFound"), ("never", "transient:429")]
    granted = [r.granted_ms for r in stores.requests().orderBy("granted_ms").collect()]
    assert len(granted) == 1 + 4 + 2 + 2 + 1 and all(b - a >= 500 for a, b in zip(granted, granted[1:], strict=False))


def test_rows_with_pages_of_their_own(spark, tmp_path):
    class Pages(TableSource):
        tries = 0

        def details(self, rows):
            self.tries += 1
            i, a = F.col("item_id"), F.col("attempt")
            kind = F.when(i == "i00", "hostDefect").when((i == "i01") & (a < 2), "permanentError").when((i == "i10") & (a == 1), "transient").when(i == "i10", "hostDefect").otherwise("ok")
            return rows.withColumns({"kind": kind, "status": F.lit(503), "reason": F.lit("why"), "detail": F.lit(None).cast("string")})

    stores, pages = Stores(spark, str(tmp_path / "s")), Pages(source(spark, 3).rows, None)
    run(pages, no_split(spark), days(spark, 3), stores, "r", Limits(transient_cap=0), FixedClock())
    assert pages.tries == 3
    assert {r.unit_key[:10]: (r.state, r.result_count, r.unresolved) for r in stores.checkpoints().collect()} == {"2024-01-01": ("complete", 2, 1), "2024-01-02": ("failed", 0, 0), "2024-01-03": ("complete", 3, 0)}
    assert sorted(r.item_id for r in stores.items().collect()) == ["i01", "i02", "i20", "i21", "i22"]
    assert sorted((r.item_id, r.reason) for r in stores.ledger().collect()) == [("2024-01-02..2024-01-02", "transient:503"), ("i00", "hostDefect:why")]
