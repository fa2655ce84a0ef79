"""Structured Streaming: completeness per key, and counts per time window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def keyed_gather(arrivals: DataFrame, key: str, part: str, wanted: str, wait_ms: int | None = 3_600_000) -> DataFrame:
    """(key, arrived, complete): once per key, when as many distinct parts came as `wanted` says, or with complete
    false when no part came for `wait_ms`.  Parts that come twice count once; the state is a key's part numbers until it
    is given out, and a mark afterwards for as long again.  With wait_ms None nothing is given up and marks stay, which
    suits a bounded backlog (a trigger of availableNow ends only then: waiting times keep a stream busy).
    """

    def step(name: tuple, groups: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, done = state.get if state.exists else ([], False)
        if state.hasTimedOut:
            state.remove()
            if not done:
                yield pd.DataFrame({key: [name[0]], "arrived": [len(seen)], "complete": [False]})
            return
        have, need = set(seen), None
        for g in groups:
            have.update(g[part].dropna().astype(int).tolist())
            need = g[wanted].max() if need is None else max(need, g[wanted].max())
        now = not done and need is not None and len(have) >= need
        state.update(([] if done or now else sorted(have), done or now))
        if wait_ms is not None:
            state.setTimeoutDuration(wait_ms)
        if now:
            yield pd.DataFrame({key: [name[0]], "arrived": [len(have)], "complete": [True]})

    rows = arrivals.select(F.col(key).cast("long"), F.col(part).cast("long"), F.col(wanted).cast("long")).where(F.col(key).isNotNull())
    return rows.groupBy(key).applyInPandasWithState(
        step, f"{key} long, arrived long, complete boolean", "seen array<long>, done boolean", "append", GroupStateTimeout.NoTimeout if wait_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    )


def window_counts(stream: DataFrame, ts: str, kind: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per kind and time window; a window is closed `late` after its end."""
    w = F.window(ts, width)
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(w.alias("w"), F.col(kind)).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")
