"""States that end: a key is remembered for a time, and rows of it in that time are suppressed."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def admitted_by(times: list[int], last: int | None, ttl: int) -> tuple[list[bool], int | None]:
    """Which of the times, in order, come at least ``ttl`` after the last one admitted; and the last admitted."""
    out = []
    for t in times:
        ok = last is None or t - last >= ttl
        out.append(ok)
        last = t if ok else last
    return out, last


def remember(events: DataFrame, key: str, at: str, ttl_seconds: int, lateness: str = "1 hour") -> DataFrame:
    """The rows of a stream that are not within ``ttl_seconds`` of the last admitted row of their key: repeated fetches, repeated items.

    One number a key is kept, until the watermark has passed its time to live. Rows later than the watermark count no more. A null key is a key of its own.
    """
    rows = events.withWatermark(at, lateness).withColumn("__key", F.coalesce(F.col(key).cast("string"), F.lit("\0")))
    schema = events.schema
    ttl = ttl_seconds * 1_000_000

    def step(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        # one micro-batch of one key; its rows come in parts
        got = pd.concat(list(batches)).sort_values(at, kind="stable")
        us = got[at].astype("datetime64[us]").astype("int64").tolist()
        ok, last = admitted_by(us, state.get[0] if state.exists else None, ttl)
        state.update((last,))
        state.setTimeoutTimestamp(max((last + ttl) // 1000, state.getCurrentWatermarkMs() + 1))
        yield got.loc[ok, schema.names]

    return rows.groupBy("__key").applyInPandasWithState(step, schema, "last long", "append", GroupStateTimeout.EventTimeTimeout)
