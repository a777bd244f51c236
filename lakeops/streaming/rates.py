"""Event rates over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def windowed_rate(
    increments: DataFrame,
    ts: str,
    value: str,
    by: Sequence[str],
    window_seconds: int,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Per-second rate of counter increments per window.

    Works on a batch and on a stream. On a stream the watermark closes a window once
    ``lateness`` has passed, which bounds the state; later rows are dropped.
    """
    return (
        increments.withColumn(ts, F.col(ts).cast("timestamp"))  # watermarks need an instant
        .withWatermark(ts, lateness)
        .groupBy(*by, F.window(ts, f"{window_seconds} seconds"))
        .agg(F.sum(value).alias("increase"))
        .select(
            *by,
            F.col("window.start").alias("window_start"),
            "increase",
            (F.col("increase") / float(window_seconds)).alias("rate"),
        )
    )
