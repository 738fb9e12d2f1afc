"""Structured streams: merging of token streams, refreshing of indices, and degrees over event time (an extension)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def merge_tokens(stream: DataFrame) -> DataFrame:
    """(kind, text, n) after each batch: the text so far of each kind of answer, of a stream (kind, seq, token)."""

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        text, n = state.get if state.exists else ("", 0)
        new = pd.concat(list(parts)).sort_values("seq")
        text, n = text + "".join(new.token), n + len(new)
        state.update((text, n))
        yield pd.DataFrame({"kind": [key[0]], "text": [text], "n": [n]})

    return stream.groupBy("kind").applyInPandasWithState(update, "kind string, text string, n bigint", "text string, n bigint", "update", GroupStateTimeout.NoTimeout)


def windowed_degrees(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """(start, event_type, users, events): events and approximate distinct users per window; later events than `late` are dropped."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("events"), F.approx_count_distinct("user_id").alias("users"))
    return w.select(F.col("w.start").alias("start"), "event_type", "users", "events")


def each_batch(stream: DataFrame, f: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None):
    """Runs f on each micro-batch; without an interval all that is there, then ends."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(f)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
