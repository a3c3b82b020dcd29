"""The gate that every request passes: grants are spaced, and an answer that asks to wait closes it for a while.

One typed state for each gate holds its last grant and the end of its cooldown. The same processor works on a stream of
requests and, turn by turn, in a run, where the state that one turn leaves is the next one's initial state. A gate is by
its nature one queue: its requests of a turn meet in one task, as two numbers and a key each; different gates don't.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..shared import cut, drop

#: A request, ready at at_ms; or, where cooldown_ms isn't null, an answer of at_ms that closes the gate for so long.
REQUEST = "gate string, key string, at_ms long, cooldown_ms long"
GRANT = "gate string, key string, granted_ms long, last_ms long, until_ms long"
STATE = "last_ms long, until_ms long"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NEVER = -(1 << 60)


class Spacing(StatefulProcessor):
    """A grant is the latest of the request's own time, the last grant and the spacing, and the cooldown's end. A cooldown
    that is asked for during another changes nothing."""

    def __init__(self, spacing_ms: int):
        self.spacing = spacing_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("gate", STATE)

    def _load(self) -> tuple[int, int]:
        return tuple(self.kept.get()) if self.kept.exists() else (NEVER, NEVER)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self.kept.update((int(row["last_ms"]), int(row["until_ms"])))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, until = self._load()
        given = pd.concat(list(rows)).sort_values(["at_ms", "cooldown_ms", "key"], na_position="last")
        keys, granted = [], []
        for k, at, wait in zip(given["key"], given["at_ms"], given["cooldown_ms"], strict=True):
            if pd.notna(wait):
                until = int(at + wait) if at >= until else until
            else:
                last = max(int(at), last + self.spacing, until)
                keys.append(k)
                granted.append(last)
        self.kept.update((last, until))
        # grants, then the state that they leave
        yield pd.DataFrame({"gate": key[0], "key": pd.Series([*keys, None], dtype=object), "granted_ms": pd.array([*granted, None], dtype="Int64"), "last_ms": pd.array([None] * len(keys) + [last], dtype="Int64"), "until_ms": pd.array([None] * len(keys) + [until], dtype="Int64")})

    def close(self) -> None:
        pass


class Holding(Spacing):
    """For streams in processing time: requests that come while the gate is closed are held, and a timer at the cooldown's end lets them go."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.held = handle.getListState("held", "key string, at_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        last, until = self._load()
        given = pd.concat(list(rows)).sort_values(["at_ms", "cooldown_ms", "key"], na_position="last")
        for at, wait in zip(given["at_ms"], given["cooldown_ms"], strict=True):
            if pd.notna(wait) and at >= until:
                until = int(at + wait)
        self.kept.update((last, until))
        asked = given[given["cooldown_ms"].isna()]
        if now < until:
            if len(asked):
                self.held.appendList([(k, int(a)) for k, a in zip(asked["key"], asked["at_ms"], strict=True)])
            self.handle.registerTimer(until)
        elif len(asked):
            yield from super().handleInputRows(key, iter([asked]), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = list(self.held.get()) if self.held.exists() else []
        self.held.clear()
        if held:
            frame = pd.DataFrame({"key": [h[0] for h in held], "at_ms": [h[1] for h in held], "cooldown_ms": pd.array([None] * len(held), dtype="Int64")})
            yield from super().handleInputRows(key, iter([frame]), timerValues)


def _stateful(spark: SparkSession) -> None:
    spark.conf.set(PROVIDER, ROCKS)  # what typed states need; other stateful operators work with it too


def granted_stream(requests: DataFrame, spacing_ms: int) -> DataFrame:
    """(gate, key, granted_ms) of a stream of REQUEST rows. Its query needs a checkpoint folder, where its states live."""
    _stateful(requests.sparkSession)
    out = requests.groupBy("gate").transformWithStateInPandas(Holding(spacing_ms), GRANT, "Append", "ProcessingTime")
    return out.where("key is not null").select("gate", "key", "granted_ms")


@dataclass
class Gate:
    """A run's gates. by: the gate of a row of cells or documents, one for all if not given."""

    spacing_ms: int = 500
    by: Column | None = None
    _state: DataFrame | None = field(default=None, repr=False)

    def grant(self, rows: DataFrame, key: str, trips: DataFrame | None = None) -> DataFrame:
        """rows, each with a key of its own and at_ms, with gate and granted_ms, written. trips(gate, at_ms, cooldown_ms): answers since the last turn."""
        spark = rows.sparkSession
        _stateful(spark)
        rows = rows.withColumn("gate", self.by if self.by is not None else F.lit("all"))
        none = F.lit(None)
        given = rows.select("gate", F.col(key).alias("key"), "at_ms", none.cast("long").alias("cooldown_ms"))
        if trips is not None:
            given = given.unionByName(trips.select("gate", none.cast("string").alias("key"), "at_ms", F.col("cooldown_ms").cast("long")))
        before = spark.createDataFrame([], f"gate string, {STATE}") if self._state is None else self._state
        out = cut(given.groupBy("gate").transformWithStateInPandas(Spacing(self.spacing_ms), GRANT, "Append", "None", initialState=before.groupBy("gate")))
        state = out.where("key is null").select("gate", "last_ms", "until_ms")
        state = state.unionByName(before.join(state.select("gate"), "gate", "left_anti"))  # gates that had nothing to do keep theirs
        old, self._state = self._state, cut(state)
        grants = out.where("key is not null").select(F.col("key").alias(key), "granted_ms")
        back = cut(rows.join(grants, key))
        for done in (out, old):
            if done is not None:
                drop(done)
        return back
