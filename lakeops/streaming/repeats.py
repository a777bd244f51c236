"""Copies that reach a stream in different batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def drop_repeats(stream: DataFrame, keys: Sequence[str], ts: str, within: str = "1 day") -> DataFrame:
    """The first row of every key; copies that come up to ``within`` later are dropped.

    The state holds a key until the watermark, the greatest event time less ``within``, has
    passed the first row's time by ``within``, so it is bounded by the keys of that
    span, not by the stream's length. What a copy after that meets: if it carries its first
    row's time it is older than the watermark and dropped as late; with a newer time it is
    a new row. Rows without a time or key: rows with a null key are copies of each other,
    rows with a null time are never late.

    Which of several copies stays, if they differ, depends on arrival.
    """
    at = F.col(ts).cast("timestamp")  # watermarks need an instant
    timed = stream.withColumn("_at", at).withWatermark("_at", within)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_at")
