"""A run: cells are asked level by level, what they hold is stored, and a cell's checkpoint is written last.

Each turn writes items, then the ledger, then coverage, then checkpoints, each as one batch. A crash between two of them leaves
cells without a checkpoint, which the next run asks again; stores count what is there twice once.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import backoff, decision, failure_reason, unresolved_reason
from ..operators.coverage import pending
from ..operators.queues import within_budget
from ..runlog import Logger, emit
from ..shared import cut, drop
from ..sources.capped import CappedSource
from ..sources.documents import write_documents
from ..stores import CELL, Stores
from ..streaming.gate import Gate
from .retry import retry_failed
from .sweep import Traversal, observe, with_children

CELL_COLUMNS = [c.split()[0] for c in CELL.split(", ")]
#: What a source's answer may say of a cell (item_id null) or of a row (kind unresolved), beside its items.
ANSWER = {"kind": "string", "status": "int", "reason": "string", "detail": "string", "retry_after_ms": "bigint"}
#: Outcomes that settle a row at once, and how often others are tried.
SETTLED, ROW_TRIES = ("ok", "transient", "sessionExpired"), 3


class Clock(Protocol):
    def now(self) -> str: ...

    def sleep(self, ms: float) -> None: ...


class SystemClock:
    def now(self) -> str:
        return dt.datetime.now(dt.UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")

    def sleep(self, ms: float) -> None:
        time.sleep(ms / 1000)


@dataclass
class FixedClock:
    """Time that passes only by sleeping."""

    at: dt.datetime = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    slept: list[float] = field(default_factory=list)

    def now(self) -> str:
        return self.at.isoformat(timespec="milliseconds").replace("+00:00", "Z")

    def sleep(self, ms: float) -> None:
        self.slept.append(ms)
        self.at += dt.timedelta(milliseconds=ms)


@dataclass(frozen=True)
class Limits:
    """Ceilings; None is none. Requests are cells asked and documents fetched; documents count when they are tried."""

    max_items: int | None = None
    max_requests: int | None = 500
    max_documents: int | None = 10
    documents_per_item: int | None = None
    transient_cap: int = 5
    defect_cap: int = 2
    session_cap: int = 1


@dataclass
class Tally:
    requests: int = 0
    items: int = 0
    documents: int = 0
    failed_documents: int = 0
    retried: int = 0
    batches: int = 0


def answers_of(source: CappedSource, cells: DataFrame) -> DataFrame:
    """The source's answer with all columns of ANSWER; rows without a kind are ok.

    A source with details(rows) is asked for each row's own page: rows(unit_key, item_id, ..., attempt) come back with kind,
    status, reason and detail, and are tried again as tolerated() says. Rows that stay unresolved come with their reason; a
    cell that a row aborts has that row's outcome and no rows.
    """
    got = with_answer(source.discover(cells))
    if not hasattr(source, "details"):
        return got
    rows = cut(got.where("item_id is not null and kind = 'ok'").drop(*ANSWER))
    order = Window.partitionBy("unit_key").orderBy("item_id")  # a cell's rows, at most its cap
    rest, tries, outcome = rows.withColumn("position", F.row_number().over(order)), [], ["kind", "status", "reason", "detail"]
    for attempt in range(ROW_TRIES):
        tried = cut(with_answer(source.details(rest.withColumn("attempt", F.lit(attempt)))).select(*rest.columns, F.lit(attempt).alias("attempt"), *outcome))
        tries.append(tried)
        rest = tried.where(~F.col("kind").isin(*SETTLED)).select(*rest.columns)
        if rest.isEmpty():
            break
    good, lost, aborted = tolerated(_union([t.select("unit_key", "position", "item_id", "attempt", *outcome) for t in tries]), ROW_TRIES - 1)
    found = _union([t.where("kind = 'ok'") for t in tries]).join(good, ["unit_key", "position", "item_id"], "left_semi").select(*rows.columns)
    none = F.lit(None).cast("string")
    parts = [found, lost.select("unit_key", "item_id", F.lit("unresolved").alias("kind"), "reason"), aborted.select("unit_key", none.alias("item_id"), "kind", "status"), got.where("item_id is null or kind <> 'ok'")]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return with_answer(whole)


def with_answer(rows: DataFrame) -> DataFrame:
    rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in ANSWER.items() if c not in rows.columns})
    return rows.withColumn("kind", F.coalesce("kind", F.lit("ok")))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _left(ceiling: int | None, used: int) -> int | None:
    return None if ceiling is None else max(0, ceiling - used)


def _ms(clock: Clock) -> int:
    return round(dt.datetime.fromisoformat(clock.now().replace("Z", "+00:00")).timestamp() * 1000)


@dataclass
class _Pacing:
    """What a run's turns share to keep pace: the gate, if there is one, and the answers that trip it next."""

    clock: Clock
    gate: Gate | None
    stores: Stores
    run_id: str
    trips: DataFrame | None = None

    def grant(self, rows: DataFrame, key: str) -> DataFrame:
        """rows(ready_ms), written; with a gate, each has its gate and granted_ms, in run time."""
        if self.gate is None:
            return cut(rows)
        now = _ms(self.clock)
        got = self.gate.grant(rows.withColumn("at_ms", F.greatest(F.lit(now).cast("long"), F.coalesce("ready_ms", F.lit(now)))), key, self.trips)
        self.trips = None
        return got

    def after(self, turn: DataFrame, failed: DataFrame, batch: str, what: str) -> None:
        """Time passes to the turn's last grant; failed(action, delay_ms) of it close their gates. Without a gate the longest delay is slept."""
        if self.gate is None:
            ms = failed.where("action <> 'stop'").agg(F.max("delay_ms")).first()[0]
            if ms:
                self.clock.sleep(ms)
            return
        last = turn.agg(F.max("granted_ms")).first()[0]
        if last is not None and last > _ms(self.clock):
            self.clock.sleep(last - _ms(self.clock))
        self.trips = cut(failed.where("action = 'requeue'").select("gate", F.col("granted_ms").alias("at_ms"), F.col("delay_ms").alias("cooldown_ms")))
        kind = F.coalesce("kind", F.lit("ok")).alias("outcome")
        log = turn.join(failed.select("_key", "kind"), "_key", "left").select(F.col("_key").alias("request"), F.lit(what).alias("what"), "gate", "attempt", "granted_ms", kind, F.lit(self.run_id).alias("run_id"))
        self.stores.append("requests", log, f"{batch}-{what}")


def run(
    source: CappedSource, traversal: Traversal, seeds: DataFrame, stores: Stores, run_id: str, limits: Limits = Limits(), clock: Clock | None = None,
    documents: Callable[[DataFrame], DataFrame] | None = None, fetch: Callable[[DataFrame], DataFrame] | None = None, folder: str | None = None,
    phase: str = "sweep", max_depth: int = 20, log: Logger | None = None, gate: Gate | None = None,
) -> Tally:
    """Ask seeds' cells and the children of those that are full, but for cells that the stores' checkpoints have done.

    The children of cells that an earlier run split are asked too. A cell that fails is asked again as decision() says, in a
    later turn, with its attempt counted, but one that was told to wait (429) begins anew: only the budget of requests bounds
    it. One that stops is failed. Requests are admitted by depth and key. The run ends when no item may be stored any more:
    where items have a ceiling and cells a cap, a turn asks no more cells than it takes to reach it.

    gate: requests of cells and documents pass it, and time passes to their grants; sources find a cell's granted_ms beside its columns.
    documents(items) gives (item_id, document_id, ...) of items, fetch its rows with file_name, body and reason (null: success), and may
    say kind, status, detail and retry_after_ms as a source does: a document is tried again as a cell is, a 429 counted, and fetch sees its attempt. folder is where
    files are written. source.reprime(), if it has that, renews a session.
    """
    clock, spark, tally = clock or SystemClock(), seeds.sparkSession, Tally()
    pacing = _Pacing(clock, gate, stores, run_id)
    done = cut(stores.checkpoints())
    again = traversal.split(done.where("state = 'subdivided'").select(*CELL_COLUMNS)).select(*CELL_COLUMNS)
    fresh = {"attempt": F.lit(1), "ready_ms": F.lit(None).cast("long")}
    queue = cut(pending(seeds.select(*CELL_COLUMNS).unionByName(again).dropDuplicates(["unit_key"]), done).withColumns(fresh))
    known = spark.createDataFrame([], "item_id string")
    while limits.max_items is None or tally.items < limits.max_items:
        room = _left(limits.max_requests, tally.requests)
        if limits.max_items is not None and source.cap:
            most = -(-(limits.max_items - tally.items) // source.cap)
            room = most if room is None else min(room, most)
        turn = pacing.grant((queue if room is None else queue.orderBy("depth", "unit_key").limit(room)).withColumn("_key", F.col("unit_key")), "_key")
        n = turn.count()
        if not n:
            break
        tally.requests += n
        at = clock.now()
        batch = f"{run_id}-{at.replace(':', '')}-{tally.batches:06d}"
        tally.batches += 1
        emit(log, "info", "batch.started", run=run_id, cells=n)
        told = [*CELL_COLUMNS, "granted_ms"] if gate else CELL_COLUMNS
        answer = cut(answers_of(source, turn.select(*told)))
        bad = answer.where("item_id is null and kind <> 'ok'").groupBy("unit_key").agg(F.min(F.struct("kind", "status", "reason", "detail", "retry_after_ms")).alias("o")).select("unit_key", "o.*")
        failed = cut(decided(turn.join(bad, "unit_key"), limits))
        stopped = failed.where("action = 'stop'")
        hits = answer.where("item_id is not null and kind = 'ok'")
        rows = answer.where("item_id is not null and kind = 'unresolved'")
        lost = rows.groupBy("unit_key").agg(F.count("*").alias("unresolved"))
        seen = observe(turn.join(bad, "unit_key", "left_anti").select(*CELL_COLUMNS), hits, source.cap).join(lost, "unit_key", "left").withColumn("unresolved", F.coalesce("unresolved", F.lit(0)))
        if "name" in hits.columns:
            traversal.observed(hits.select("unit_key", "item_id", "name"), batch)
        seen, children = with_children(seen, traversal, CELL_COLUMNS, max_depth)
        none = F.lit(None)
        seen = seen.unionByName(stopped.select(*CELL_COLUMNS, F.lit(0).cast("long").alias("result_count"), F.lit(False).alias("saturated"), F.lit("failed").alias("state"), none.cast("string").alias("item_set_hash"), F.lit(0).cast("long").alias("unresolved")))
        stamp = {"run_id": F.lit(run_id), "observed_at": F.lit(at)}
        emitted = failed.where("action <> 'stop'").agg(F.count("*").alias("n"), F.max("delay_ms").alias("ms"), F.bool_or(F.col("action") == "reprime").alias("reprime")).first()
        if emitted["n"]:
            tally.retried += emitted["n"]
            emit(log, "warn", "cells.retried", run=run_id, cells=emitted["n"], delay_ms=emitted["ms"])
            if emitted["reprime"] and hasattr(source, "reprime"):
                source.reprime()
        pacing.after(turn, failed, batch, "cell")

        before = known
        known, written = _store_items(hits, known, stores, limits, tally, batch, stamp, documents, fetch, folder, pacing, source)
        text = none.cast("string")
        ledger = rows.select("item_id", text.alias("document_id"), "reason").unionByName(written).withColumns({**stamp, "resolved": F.lit(False)})
        ledger = ledger.unionByName(stopped.select(F.col("unit_key").alias("item_id"), text.alias("document_id"), failure_reason(F.col("kind"), F.col("status"), F.col("reason"), F.col("detail")).alias("reason")).withColumns({**stamp, "resolved": F.lit(False)}))
        stores.append("ledger", ledger.withColumns({"item": F.when(F.col("document_id").isNotNull(), F.to_json(F.struct("item_id"))), "doc": F.when(F.col("document_id").isNotNull(), F.to_json(F.struct("document_id")))}), batch)
        record = cut(seen.withColumns(stamp))
        dimension = F.map_filter(F.create_map(F.lit("date"), F.col("window_key"), F.lit("class"), F.col("facet_value"), F.lit("name"), F.col("probe")), lambda _, v: v.isNotNull())
        stores.append("coverage", record.withColumns({"phase": F.lit(phase), "dimensions": dimension}), batch)
        stores.append("checkpoints", record, batch)  # last: a cell without one is asked again

        beyond = queue.join(turn.select("unit_key"), "unit_key", "left_anti") if room is not None and n == room else queue.where("false")
        after = children.select(*CELL_COLUMNS).withColumns(fresh).unionByName(repeated(failed).select(*CELL_COLUMNS, *fresh)).unionByName(beyond)
        old, queue = queue, cut(after)
        for table in (old, before, turn, failed, children, record, answer):  # a long run keeps one turn's tables
            drop(table)
    emit(log, "info", "run.ended", run=run_id, requests=tally.requests, items=tally.items)
    return tally


def decided(failed: DataFrame, limits: Limits) -> DataFrame:
    """failed(attempt, kind, status, retry_after_ms) with what to do next: action and delay_ms."""
    wait = backoff("exponential", F.col("attempt"), 1000, 2, cap=60_000)
    said = decision(F.col("kind"), F.col("status"), F.col("attempt"), wait, F.col("retry_after_ms"), limits.transient_cap, limits.defect_cap, limits.session_cap)
    return failed.withColumn("_d", said).select("*", "_d.action", "_d.delay_ms").drop("_d")


def repeated(failed: DataFrame, anew: bool = True) -> DataFrame:
    """Those of failed that are asked again, with their attempt and when they are ready. anew: one that was told to wait begins
    at its first attempt; the gate's cooldown holds it, so it has no delay of its own."""
    waits = F.col("action") == "requeue"
    ready = F.when(~waits, F.col("granted_ms") + F.col("delay_ms")) if "granted_ms" in failed.columns else F.lit(None).cast("long")
    attempt = F.when(waits, 1).otherwise(F.col("attempt") + 1) if anew else F.col("attempt") + 1
    return failed.where("action <> 'stop'").withColumns({"attempt": attempt.cast("int"), "ready_ms": ready})


def _fetched(asked: DataFrame, fetch: Callable[[DataFrame], DataFrame], limits: Limits, pacing: _Pacing, batch: str, source) -> DataFrame:
    """asked's rows as they settle: what fetch gave at the last try, a reason where it stopped. Each turn asks for those that are left."""
    key, columns = ["item_id", "document_id"], asked.columns
    left = asked.dropDuplicates(key).withColumns({"attempt": F.lit(1), "ready_ms": F.lit(None).cast("long")})
    settled, turns = [], 0
    while True:
        turn = pacing.grant(left.withColumn("_key", F.concat_ws("/", *key)), "_key")
        if turn.isEmpty():
            break
        got = fetch(turn.select(*columns, "attempt"))
        got = got.withColumns({c: F.lit(None).cast(t) for c, t in ANSWER.items() if c not in got.columns})
        got = got.withColumn("kind", F.when(F.col("reason").isNull(), F.coalesce("kind", F.lit("ok"))).otherwise(F.coalesce("kind", F.lit("permanentError"))))
        got = cut(got.select(*key, "file_name", "body", "kind", "status", "reason", "detail", "retry_after_ms"))
        own = [c for c in turn.columns if c not in got.columns]
        failed = cut(decided(turn.select(*key, *own).join(got.where("kind <> 'ok'").drop("file_name", "body"), key), limits))
        settled.append(got.where("kind = 'ok'").select(*key, "file_name", "body", F.lit(None).cast("string").alias("reason")))
        why = F.coalesce("reason", failure_reason(F.col("kind"), F.col("status"), F.col("reason"), F.col("detail")))
        settled.append(failed.where("action = 'stop'").select(*key, F.lit(None).cast("string").alias("file_name"), F.lit(None).cast("binary").alias("body"), why.alias("reason")))
        if not failed.where("action = 'reprime'").isEmpty() and hasattr(source, "reprime"):
            source.reprime()
        pacing.after(turn, failed, f"{batch}-{turns:03d}", "document")
        left = cut(repeated(failed, anew=False).select(*columns, "attempt", "ready_ms"))
        turns += 1
    return _union(settled) if settled else asked.select(*key, F.lit(None).cast("string").alias("file_name"), F.lit(None).cast("binary").alias("body"), F.lit(None).cast("string").alias("reason"))


def _store_items(hits, known, stores, limits, tally, batch, stamp, documents, fetch, folder, pacing, source) -> tuple[DataFrame, DataFrame]:
    """Write items that this run hasn't seen, with their documents' outcomes; (known items, failures of documents)."""
    extra = [c for c in hits.columns if c not in ("unit_key", "item_id", *ANSWER)]
    hits = hits.withColumn("item_id", F.col("item_id").cast("string"))
    fresh = hits.groupBy("item_id").agg(F.min(F.struct("unit_key", *extra)).alias("r")).join(known, "item_id", "left_anti").select("item_id", "r.*")
    room = _left(limits.max_items, tally.items)
    fresh = cut(fresh if room is None else fresh.orderBy("unit_key", "item_id").limit(room))
    tally.items += fresh.count()
    outcomes = fresh.sparkSession.createDataFrame([], "item_id string, document_id string, status string, bytes bigint, reason string")
    most = [x for x in (_left(limits.max_documents, tally.documents), _left(limits.max_requests, tally.requests)) if x is not None]
    if documents is not None and fetch is not None and (not most or min(most)):
        asked = cut(within_budget(documents(fresh), ["item_id", "document_id"], "item_id", min(most) if most else None, limits.documents_per_item))
        n = asked.count()
        tally.documents += n
        tally.requests += n
        tried = cut(_fetched(asked, fetch, limits, pacing, batch, source))
        good = tried.where("reason is null")
        if folder is not None:
            named = write_documents(good.where("file_name is not null").select("item_id", "document_id", "file_name", "body"), folder)
            good = cut(named.select("item_id", "document_id", "bytes"))
        else:
            good = good.select("item_id", "document_id", F.octet_length("body").cast("long").alias("bytes"))
        outcomes = good.withColumns({"status": F.lit("fetched"), "reason": F.lit(None).cast("string")}).unionByName(tried.where("reason is not null").select("item_id", "document_id", F.lit(None).cast("long").alias("bytes"), F.lit("failed").alias("status"), "reason"))
        outcomes = cut(outcomes.select("item_id", "document_id", "status", "bytes", "reason"))
        tally.failed_documents += outcomes.where("status = 'failed'").count()
    # an item without documents has an empty list of them
    each = outcomes.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("document_id", "status", "bytes"))).alias("documents"))
    payload = F.to_json(F.struct(*extra)) if extra else F.lit("{}")
    items = fresh.join(each, "item_id", "left").withColumns({**stamp, "payload": payload, "documents": F.coalesce("documents", F.array().cast("array<struct<document_id:string,status:string,bytes:bigint>>"))})
    stores.append("items", items, batch)
    return cut(known.unionByName(fresh.select("item_id"))), outcomes.where("status = 'failed'").select("item_id", "document_id", "reason")


def retry(stores: Stores, fetch: Callable[[DataFrame], DataFrame], run_id: str, folder: str | None = None, clock: Clock | None = None) -> tuple[int, int]:
    """(resolved, failed again) of the ledger's documents; both are appended to it."""
    at = (clock or SystemClock()).now()
    good, bad = (cut(x) for x in retry_failed(stores.ledger(), fetch, folder))
    batch = f"{run_id}-{at.replace(':', '')}-retry"
    stores.append("ledger", bad.withColumns({"run_id": F.lit(run_id), "observed_at": F.lit(at)}), f"{batch}-failed")
    stores.resolve(good, run_id, at, f"{batch}-resolved")
    return good.count(), bad.count()


def tolerated(attempts: DataFrame, cap: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items, unresolved, aborted) of attempts(unit_key, position, item_id, attempt, kind, status, reason, detail) at rows of cells.

    A row's first attempt that is ok, transient or sessionExpired settles it; others are tried again up to cap times,
    after which the row is unresolved, with the reason of its last try. The first row, by position, that settles as transient or sessionExpired
    aborts its cell with its outcome: none of the cell's rows count. attempt counts from 0; later ones than cap + 1 tries don't count.
    """
    row = ["unit_key", "position", "item_id"]
    tries = attempts.where(F.col("attempt") <= cap)
    settles = F.col("kind").isin(*SETTLED)
    what = F.struct("kind", "status", "reason", "detail")
    per = tries.groupBy(*row).agg(F.min_by(what, F.when(settles, F.col("attempt"))).alias("s"), F.max_by(what, "attempt").alias("l"))
    per = cut(per.select(*row, F.coalesce("s", "l").alias("o")).select(*row, "o.*"))  # all three results ask it
    aborted = per.where("kind in ('transient', 'sessionExpired')").groupBy("unit_key").agg(F.min(F.struct("position", "kind", "status")).alias("a")).select("unit_key", "a.kind", "a.status")
    rest = per.join(aborted.select("unit_key"), "unit_key", "left_anti")
    why = unresolved_reason(F.col("kind"), failure_reason(F.col("kind"), F.col("status"), F.col("reason"), F.col("detail")))
    return rest.where("kind = 'ok'").select(*row), rest.where("kind <> 'ok'").select(*row, why.alias("reason")), aborted
