"""Job metrics as rows ``(ts, name, labels, value)`` and the panels built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.functions.numeric import percentage
from lakeops.functions.times import Moment
from lakeops.operators.ordered import previous_value
from lakeops.schemas import METRIC_SAMPLES

# Metric names
RECORDS_PROCESSED = "pipeline_records_processed_total"
QUALITY_FAILURES = "pipeline_data_quality_failures_total"
TABLE_ROWS = "pipeline_delta_table_rows"
TASK_STATUS = "pipeline_task_status_total"

UP_DOWN = {1.0: "UP", 0.0: "DOWN"}


def samples(
    spark: SparkSession, as_of: Moment, rows: Sequence[tuple[str, Mapping[str, str], float]]
) -> DataFrame:
    """Samples a job reports about itself: a handful of ``(name, labels, value)``."""
    df = spark.createDataFrame(
        [(name, dict(labels), float(value)) for name, labels, value in rows],
        "name string, labels map<string,string>, value double",
    )
    return df.select(
        F.lit(str(as_of)).cast("timestamp").alias("ts"), "name", "labels", "value"
    ).to(METRIC_SAMPLES)


def append_samples(df: DataFrame, path: str, run: str | None = None) -> None:
    """Add samples; those of a named run replace what that run stored before."""
    if run is None:
        df.write.mode("append").parquet(path)
    else:
        df.write.mode("overwrite").parquet(f"{path}/run={run}")


def label(name: str) -> Column:
    return F.try_element_at("labels", F.lit(name)).alias(name)


def records_by_layer(samples: DataFrame) -> DataFrame:
    """Records processed per layer and table."""
    return (
        samples.where(F.col("name") == RECORDS_PROCESSED)
        .groupBy(label("layer"), label("table"))
        .agg(F.sum("value").alias("records"))
    )


def gauge_latest(
    samples: DataFrame,
    by: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    tie: Sequence[str] = (),
    mapping: Mapping[float, str] | None = None,
) -> DataFrame:
    """The newest value per series, with a text if the value is mapped to one."""
    newest = F.max_by(value, F.struct(ts, *tie) if tie else F.col(ts))
    out = samples.groupBy(*by).agg(newest.alias("value"), F.max(ts).alias("last_ts"))
    if mapping is None:
        return out
    text = F.lit(None).cast("string")
    for number, name in mapping.items():
        text = F.when(F.col("value") == number, name).otherwise(text)
    return out.withColumn("state", text)


def failure_status(reports: DataFrame, warn: float = 1, fail: float = 5) -> DataFrame:
    """Total failures and their colour; nothing reported at all reads as a pass."""
    total = F.sum("failures")
    return reports.agg(
        F.coalesce(total.cast("bigint"), F.lit(0).cast("bigint")).alias("failures"),
        F.when(total >= fail, "red").when(total >= warn, "yellow").otherwise("green").alias("colour"),
        F.when(total.isNull() | (total < warn), "PASS").otherwise("FAIL").alias("state"),
    )


def counter_rate(
    samples: DataFrame,
    ts: str,
    value: str,
    series: Sequence[str],
    window_seconds: int,
    tie: Sequence[str] = (),
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Increase and per-second rate of counters per time window.

    A reading below the one before it in its series is a restart and counts in full;
    the first reading of a series has nothing to be compared with and counts nothing.
    Series are summed over ``by`` (default: each by itself).
    """
    # only what is needed is stored on the way
    needed = list(dict.fromkeys([*series, ts, *tie, value, *(by or ())]))
    read = samples.where(F.col(value).isNotNull()).select(*needed)
    stepped = previous_value(read, series, [ts, *tie], value, "_before")
    step = (
        F.when(F.col("_before").isNull(), 0.0)
        .when(F.col(value) >= F.col("_before"), F.col(value) - F.col("_before"))
        .otherwise(F.col(value))
    )
    return (
        stepped.groupBy(*(series if by is None else by), F.window(ts, f"{window_seconds} seconds"))
        .agg(F.sum(step).alias("increase"))
        .withColumn("rate", F.col("increase") / float(window_seconds))
        .withColumn("window_start", F.col("window.start"))
        .drop("window")
    )


def mean_stage_duration(
    samples: DataFrame, stage: str, seconds: str, ts: str | None = None, window_seconds: int | None = None
) -> DataFrame:
    """Runs, total and mean duration per stage, or per stage and time window."""
    windowed = ts is not None and window_seconds is not None
    window = [F.window(ts, f"{window_seconds} seconds")] if windowed else []
    out = samples.groupBy(stage, *window).agg(
        F.count(seconds).alias("runs"),
        F.sum(seconds).alias("total_seconds"),
        (F.sum(seconds) / F.nullif(F.count(seconds), F.lit(0))).alias("mean_seconds"),
    )
    return out.withColumn("window_start", F.col("window.start")).drop("window") if windowed else out


def success_rate(
    samples: DataFrame, ts: str, succeeded: Column, window_seconds: int, by: Sequence[str] = ()
) -> DataFrame:
    """Percentage of successful runs per window."""
    return (
        samples.groupBy(*by, F.window(ts, f"{window_seconds} seconds"))
        .agg(
            F.count(F.lit(1)).alias("runs"),
            percentage(F.count_if(succeeded), F.count(F.lit(1))).alias("success_pct"),
        )
        .withColumn("window_start", F.col("window.start"))
        .drop("window")
    )


def request_outcome(samples: DataFrame, failed: Column, by: Sequence[str] = ()) -> DataFrame:
    """Requests, errors, and successes as their difference."""
    counted = samples.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(failed).alias("errors")
    )
    return counted.withColumn("successful", F.col("requests") - F.col("errors"))
