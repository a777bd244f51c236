"""Counter increases over a live stream of readings."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "last double, seen_ms bigint, waiting string"


def counter_steps(
    readings: DataFrame,
    ts: str,
    value: str,
    series: Sequence[str],
    tie: Sequence[str] = (),
    lateness: str = "10 minutes",
    idle: str = "1 day",
) -> DataFrame:
    """Every reading's increase over the one before it in its series: (series, ts, step).

    As in ``metrics.counter_rate`` a reading below the one before it is a restart and counts
    in full, and the first reading of a series counts nothing. The state of a series is its
    last reading and the readings that wait: a reading is compared once the watermark has
    passed it, so readings that come in any order within ``lateness`` give the steps of the
    batch form; later ones are dropped. A series is forgotten, and starts anew, when the
    watermark has passed its last reading by ``idle`` and no other has come. The state is thus one value for each series that is alive and
    the readings of the last ``lateness``; a micro-batch's rows of one series are worked on by
    one task, so ``maxFilesPerTrigger`` or its like bounds what that task sees.

    Python is needed for arbitrary state; rows travel in Arrow batches. A null reading or
    time counts nothing. ``tie`` orders readings of the same time; numbers only.
    """
    spark = readings.sparkSession
    idle_ms = _milliseconds(spark, idle)
    kinds = readings.schema
    at = F.col(ts).cast("timestamp")
    order = F.array(*[F.col(t).cast("bigint") for t in tie]).cast("array<bigint>")
    narrow = readings.select(
        *series, at.alias(ts), F.unix_micros(at).alias("_at"), order.alias("_tie"), F.col(value).cast("double").alias("_value")
    ).where(F.col(ts).isNotNull() & F.col("_value").isNotNull())
    keys = ", ".join(f"`{c}` {kinds[c].dataType.simpleString()}" for c in series)
    return (
        narrow.withWatermark(ts, lateness)
        .groupBy(*series)
        .applyInPandasWithState(
            _stepper(list(series), idle_ms),
            f"{keys}, _at bigint, step double",
            STATE,
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
        .select(*series, F.timestamp_micros("_at").alias(ts), "step")
    )


def _milliseconds(spark, interval: str) -> int:
    micros = F.timestamp_diff("MICROSECOND", F.timestamp_seconds(F.lit(0)), F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {interval}"))
    return spark.range(1).select(micros).first()[0] // 1000


def _stepper(series: list[str], idle_ms: int) -> Callable:
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, seen, waiting = None, 0, []
        if state.exists:
            last, seen, text = state.get
            waiting = [(r[0], tuple(r[1]), r[2]) for r in json.loads(text)]
        if not state.hasTimedOut:
            for frame in frames:
                rows = zip(frame["_at"], frame["_tie"], frame["_value"])
                waiting += [(int(at), tuple(int(t) for t in tie), float(v)) for at, tie, v in rows]
        waiting.sort()
        watermark = state.getCurrentWatermarkMs()
        times, steps = [], []
        for at, _, v in waiting:
            if at // 1000 >= watermark:
                break
            steps.append(0.0 if last is None else v - last if v >= last else v)
            times.append(at)
            last, seen = v, at // 1000
        waiting = waiting[len(steps) :]
        if not waiting and watermark > seen + idle_ms:
            state.remove()  # also when it was never stored
        else:
            state.update((last, seen, json.dumps(waiting)))
            # the next reading that waits, or else the end of the series
            due = waiting[0][0] // 1000 + 1 if waiting else seen + idle_ms + 1
            state.setTimeoutTimestamp(max(due, watermark + 1))
        if steps:
            out = pd.DataFrame({c: [k] * len(steps) for c, k in zip(series, key)})
            out["_at"], out["step"] = times, steps
            yield out

    return run
