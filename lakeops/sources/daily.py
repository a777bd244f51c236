"""Per-day ingest: parallel arrays, CSV files by date, one-day slices, backfill."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from lakeops.functions.times import Moment, calendar_day, iso_day
from lakeops.session import Scratch, materialise
from lakeops.sources.tables import balanced, read_or_none, replace_partitions

LEDGER = "day date, rows bigint"


def parallel_arrays_to_rows(df: DataFrame, struct_col: str) -> DataFrame:
    """``{"time": [..], "t_max": [..]}`` to one row per position, other columns kept."""
    fields = df.schema[struct_col].dataType.fieldNames()
    rest = [c for c in df.columns if c != struct_col]
    zipped = F.arrays_zip(*[F.col(f"{struct_col}.{f}").alias(f) for f in fields])
    return df.select(*rest, F.inline(zipped).alias(*fields))


def write_daily_csv(df: DataFrame, path: str, date_col: str) -> None:
    """CSV with a header under one directory per date; no rows, no directory."""
    (
        balanced(df, [date_col])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy(date_col)
        .csv(path)
    )


def read_daily_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def day_slice(df: DataFrame, ts: str, day: Moment) -> DataFrame:
    """Rows in the half-open interval ``[day, day + 1)``; both bounds reach the scan."""
    return between_days(df, ts, day, day)


def between_days(df: DataFrame, ts: str, start: Moment, end: Moment) -> DataFrame:
    """Rows from the first moment of ``start`` to the last of ``end``."""
    first = calendar_day(start).cast("timestamp_ntz")
    after = F.date_add(calendar_day(end), 1).cast("timestamp_ntz")
    return df.where((F.col(ts) >= first) & (F.col(ts) < after))


def backfill_days(df: DataFrame, ts: str, start: Moment, end: Moment, path: str) -> DataFrame:
    """Load every day of an inclusive range in one job, replacing those days.

    Returns one status row per requested day; a day without data is ``skipped`` and
    whatever an earlier run stored for it stays.
    """
    spark = df.sparkSession
    with Scratch(spark, "backfill") as scratch:
        loaded = scratch.store(between_days(df, ts, start, end).withColumn("date", iso_day(F.col(ts))))
        replace_partitions(loaded, path, ["date"])
        arrived = materialise(loaded.groupBy("date").agg(F.count(F.lit(1)).alias("arrived")), "arrived")
    requested = spark.range(1).select(
        F.explode(F.sequence(calendar_day(start), calendar_day(end))).alias("day")
    )
    per_day = (
        spark.read.schema(loaded.schema)
        .parquet(path)
        .where(F.col("date").between(str(start)[:10], str(end)[:10]))
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        requested.select(F.date_format("day", "yyyy-MM-dd").alias("date"))
        .join(per_day, "date", "left")
        .join(arrived, "date", "left")
        .select(
            "date",
            F.coalesce("n", F.lit(0)).alias("stored_rows"),
            F.when(F.col("arrived").isNull(), "skipped").otherwise("success").alias("status"),
        )
    )


def missing_spans(requested: DataFrame, loaded: DataFrame) -> DataFrame:
    """start, after, days: the requested days that are not loaded, as few half-open spans.

    Gaps and islands: among the missing days in order, a day less its number is the same
    for all days of an unbroken run. ``requested`` and ``loaded`` hold a date ``day``; days are few
    (a century has 36,525), so one window orders them.
    """
    missing = requested.select("day").distinct().join(loaded.select("day").distinct(), "day", "left_anti")
    number = F.row_number().over(W.orderBy("day"))
    island = F.date_sub("day", number).alias("island")
    return (
        missing.select("day", island)
        .groupBy("island")
        .agg(F.min("day").alias("start"), F.date_add(F.max("day"), 1).alias("after"), F.count(F.lit(1)).alias("days"))
        .drop("island")
    )


def catch_up(df: DataFrame, ts: str, start: Moment, end: Moment, path: str, ledger: str) -> DataFrame:
    """Load the days of an inclusive range that the ledger lacks; start, after, days, rows of each span.

    Only the missing spans are read: their bounds reach the scan, and days that are loaded
    are left alone. The ledger is a table of loaded days, those without data included, and
    is written after the data: a run that dies in between loads its spans again and replaces them.
    """
    spark = df.sparkSession
    requested = spark.range(1).select(F.explode(F.sequence(calendar_day(start), calendar_day(end))).alias("day"))
    known = read_or_none(spark, ledger, LEDGER)
    known = spark.createDataFrame([], LEDGER) if known is None else known
    spans = materialise(missing_spans(requested, known), "spans")
    wanted = spans.orderBy("start").collect()  # at most one for every second day
    if not wanted:
        return spans.withColumn("rows", F.lit(0).cast("bigint"))
    inside = reduce(
        Column.__or__,
        [
            (F.col(ts) >= F.lit(s["start"]).cast("timestamp_ntz")) & (F.col(ts) < F.lit(s["after"]).cast("timestamp_ntz"))
            for s in wanted
        ],
    )
    with Scratch(spark, "catch-up") as scratch:
        loaded = scratch.store(df.where(inside).withColumn("date", iso_day(F.col(ts))))
        replace_partitions(loaded, path, ["date"])
        per_day = materialise(loaded.groupBy(F.to_date("date").alias("day")).agg(F.count(F.lit(1)).alias("n")), "arrived")
    days = spans.select("start", F.explode(F.sequence("start", F.date_sub("after", 1))).alias("day"))
    counted = materialise(days.join(per_day, "day", "left").select("start", "day", F.coalesce("n", F.lit(0)).alias("n")), "caught")
    counted.select("day", F.col("n").alias("rows")).write.mode("append").parquet(ledger)
    rows = counted.groupBy(F.col("start").alias("_start")).agg(F.sum("n").alias("rows"))
    return spans.join(rows, F.col("start") == F.col("_start")).drop("_start")
