"""Coverage as a stream: the latest observation of each cell, whatever order they come in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "unit_key string, state string, result_count long, observed_at string, ordinal long"
KEPT = "state string, result_count long, observed_at string, ordinal long"


def _newest(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = state.get if state.exists else None
    before = held
    for f in frames:
        r = f.sort_values(["observed_at", "ordinal"]).iloc[-1]
        if held is None or (r.observed_at, int(r.ordinal)) >= (held[2], held[3]):
            held = (r.state, int(r.result_count), r.observed_at, int(r.ordinal))
    if held is not None and held != before:
        state.update(held)
        yield pd.DataFrame({"unit_key": [key[0]], "state": [held[0]], "result_count": [held[1]], "observed_at": [held[2]], "ordinal": [held[3]]})


def latest_cells(records: DataFrame) -> DataFrame:
    """An update stream: a cell's row whenever a later observation of it arrives. One small state for each cell."""
    return records.select("unit_key", "state", "result_count", "observed_at", "ordinal").groupBy("unit_key").applyInPandasWithState(_newest, OUT, KEPT, "update", GroupStateTimeout.NoTimeout)


def once(records: DataFrame, at: str = "observed_ts", late: str = "1 day") -> DataFrame:
    """Repeats of one observation within the watermark go; a cell that comes back to an earlier state is observed anew."""
    return records.withWatermark(at, late).dropDuplicatesWithinWatermark(["unit_key", "state", "result_count", at])
