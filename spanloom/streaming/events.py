"""Extensions: analogues of corpus operators on unbounded tables. Each takes a streaming (or bounded) DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def time_buckets(rows: DataFrame, time: str, width: str, keys: Sequence[str] = (), late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts by window of time; rows later than ``late`` are left out."""
    return rows.withWatermark(time, late).groupBy(F.window(time, width, slide), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def sessions(rows: DataFrame, time: str, gap: str, keys: Sequence[str], late: str = "1 hour") -> DataFrame:
    return rows.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n")


def first_of_equals(rows: DataFrame, time: str, keys: Sequence[str], late: str = "1 hour") -> DataFrame:
    """The first row of each key within the time that is remembered."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def tag_runs(rows: DataFrame, key: str, order: str, value: str, time: str | None = None, late: str = "1 hour", idle: int = 3600) -> DataFrame:
    """Maximal runs of equal values by key, each given out when the next begins: key, value, first, last, n. State is one run a key.

    With ``time``, a run also ends where a key has no row for more than ``idle`` seconds of event time: a timer gives out the last
    run of such a key (once ``late`` has passed too), and its state goes. Without it, the last run of a key is kept for ever.
    """
    columns = [key, value, "first", "last", "n"]

    def step(k: tuple, batches, state: GroupState):
        if state.hasTimedOut:
            last = tuple(state.get)
            state.remove()
            yield pd.DataFrame([(k[0], *last[:4])], columns=columns)
            return
        run = list(state.get) if state.exists else None
        out = []
        new = pd.concat(list(batches)).sort_values(order)
        seen = [int(t.timestamp() * 1000) for t in new[time]] if time else [0] * len(new)
        for v, o, at in zip(new[value], new[order], seen, strict=True):
            if run and run[0] == v and at - run[4] <= 1000 * idle:
                run = [v, run[1], int(o), run[3] + 1, max(at, run[4])]
            else:
                if run:
                    out.append((k[0], *run[:4]))
                run = [v, int(o), int(o), 1, at]
        state.update(tuple(run))
        if time:
            state.setTimeoutTimestamp(max(run[4] + 1000 * idle, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame(out, columns=columns)

    kinds = dict(rows.dtypes)
    shape = f"{value} {kinds[value]}, first long, last long, n long"
    if time:
        rows = rows.withWatermark(time, late)
    return rows.groupBy(key).applyInPandasWithState(step, f"{key} {kinds[key]}, {shape}", f"{shape}, seen long", "append", GroupStateTimeout.EventTimeTimeout if time else GroupStateTimeout.NoTimeout)


def collect_new(rows: DataFrame, path: str, checkpoint: str, change: Callable[[DataFrame], DataFrame] = lambda x: x):
    """What is new since the last run goes through ``change`` and is appended, a folder for each batch, so that a repeated batch replaces its own rows."""

    def put(batch: DataFrame, nr: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{path}/batch={nr}")

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
