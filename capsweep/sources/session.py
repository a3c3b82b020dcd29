"""Searches under sessions: a form page primes one, an expired one is primed anew and its search sent once more."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import responses as R
from ..shared import cut, drop
from .html import decode_body, form_state

STATE = "struct<action:string,view_state:string,fields:array<string>,trigger:string>"


def primed(pages: DataFrame) -> DataFrame:
    """(session, epoch, state, error) of form pages(session, epoch, headers, body); a page that lacks a part has an error and no state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states, errors = [], []
            for kind, body in zip(batch.column("content_type").to_pylist(), batch.column("body").to_pylist(), strict=True):
                try:
                    states.append(form_state(decode_body(body or b"", kind)))
                    errors.append(None)
                except ValueError as e:
                    states.append(None)
                    errors.append(str(e))
            kept = pa.struct([("action", pa.string()), ("view_state", pa.string()), ("fields", pa.list_(pa.string())), ("trigger", pa.string())])
            yield pa.RecordBatch.from_arrays([batch.column("session"), batch.column("epoch"), pa.array(states, kept), pa.array(errors, pa.string())], ["session", "epoch", "state", "error"])

    given = pages.select("session", F.col("epoch").cast("int").alias("epoch"), R.header(F.col("headers"), "content-type").alias("content_type"), "body")
    session = given.schema["session"].dataType.simpleString()
    return given.mapInArrow(run, f"session {session}, epoch int, state {STATE}, error string")


def replayed(searches: DataFrame, prime: Callable[[DataFrame], DataFrame], send: Callable[[DataFrame], DataFrame], ahead: int = 64) -> DataFrame:
    """searches(session, no, ...) with epoch, view_state, replayed, status, headers, body and outcome.

    no counts a session's searches from 0 without gaps. prime: (session, epoch) -> form pages (session, epoch, headers, body). send: searches with
    their session's state -> the same with status, headers and body. A session is primed when its first search is due. The first search that
    finds it expired primes the next epoch and is sent once more; that answer counts, whatever it is, and later searches go on in the new epoch.
    A session whose form page lacks a part ends there: what it has left to send is a host's defect, for a run to ask again.

    Epochs are joined one after the other, all sessions at once: of each, up to `ahead` searches are asked with its state, and what lies behind the
    first expired one is asked again. Sessions take as many rounds as they have epochs, or their searches divided by ahead; one session is one client's, which sends in turn.
    """
    at = cut(searches.groupBy("session").agg(F.lit(0).alias("epoch"), F.min("no").alias("at"), F.lit(False).alias("again")))
    at, old, settled = _with_states(at, prime), [at], []
    while not at.isEmpty():
        due = searches.join(at, "session").where((F.col("no") >= F.col("at")) & ((F.col("no") < F.col("at") + ahead) | F.col("error").isNotNull()))
        due = due.withColumn("replayed", F.col("again") & (F.col("no") == F.col("at"))).drop("at", "again")
        sent = send(due.where("error is null").drop("error"))
        view = R.response_view(F.col("status"), F.col("headers"), F.col("body"))
        sent = sent.withColumn("outcome", R.search_outcome(F.col("status"), F.col("headers"), view))
        lost = due.where("error is not null").withColumn("outcome", R.outcome("hostDefect", reason=F.col("error"))).drop("error")
        answers = cut(sent.unionByName(lost, allowMissingColumns=True))
        gone = (F.col("outcome.kind") == "sessionExpired") & ~F.col("replayed")
        stops = answers.groupBy("session").agg(F.min(F.when(gone, F.col("no"))).alias("stop"), F.max("no").alias("last"))
        after = cut(at.join(stops, "session").select("session", F.when(F.col("stop").isNotNull(), F.col("epoch") + 1).otherwise(F.col("epoch")).alias("epoch"), F.coalesce("stop", F.col("last") + 1).alias("at"), F.col("stop").isNotNull().alias("again"), "state", "error"))
        settled.append(answers.join(after.select("session", F.col("at").alias("_next")), "session").where(F.col("no") < F.col("_next")).drop("_next"))
        kept = after.where("not again and error is null")
        at = cut(kept.unionByName(_with_states(after.where("again").drop("state", "error"), prime)))
        old.append(at)
        # the sessions that have something left
        at = at.join(searches.groupBy("session").agg(F.max("no").alias("_end")), "session").where(F.col("at") <= F.col("_end")).drop("_end")
    for t in old:
        drop(t)
    if not settled:
        empty = searches.withColumns({"epoch": F.lit(0), "state": F.lit(None).cast(STATE), "replayed": F.lit(False)})
        settled.append(send(empty).withColumn("outcome", F.lit(None).cast(R.OUTCOME)).where("false"))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), settled)
    return whole.withColumn("view_state", F.col("state.view_state")).drop("state")


def _with_states(at: DataFrame, prime: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Sessions with the states that their form pages give; one that no page answers has an error."""
    got = primed(prime(at.select("session", "epoch")))
    found = at.join(got, ["session", "epoch"], "left")
    return found.withColumn("error", F.when(F.col("state").isNull(), F.coalesce("error", F.lit("no form page"))))
