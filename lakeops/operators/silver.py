"""Typed silver projection and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeops.functions.times import Moment, iso_day
from lakeops.operators.rules import not_stored


def to_silver_schema(
    df: DataFrame, run_date: str | None, as_of: Moment, bad_casts: str = "fail"
) -> DataFrame:
    """Cast raw sales to their silver types and stamp the run.

    ``run_date`` is the partition of every row; without it the partition is the day of
    the sale itself. A value that does not cast fails the job, or becomes null (and so
    a reject) with ``bad_casts="null"``.
    """

    def cast(column: str, kind: str):
        c = F.col(column)
        return (c.try_cast(kind) if bad_casts == "null" else c.cast(kind)).alias(column)

    typed = df.select(
        cast("transaction_id", "string"),
        cast("customer_id", "bigint"),
        cast("product_id", "bigint"),
        cast("quantity", "bigint"),
        cast("unit_price", "double"),
        cast("total_amount", "double"),
        cast("transaction_timestamp", "timestamp_ntz"),
        "payment_method",
        cast("store_id", "bigint"),
        "status",
    )
    day = iso_day(F.col("transaction_timestamp")) if run_date is None else F.lit(run_date)
    return typed.withColumns(
        {
            "processed_at": F.lit(str(as_of)).cast("timestamp"),
            "partition_date": day,
        }
    )


def keep_first(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, then by all columns.

    An aggregation rather than a window, so copies collapse before the shuffle and a
    key that holds a third of the rows costs no more than any other. Rows without a
    key are not copies of each other and all stay.
    """
    first = order or []
    columns = first + [c for c in df.columns if c not in first]
    # a row without a key gets one of its own, so that the input is read once
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return (
        df.withColumn("_alone", alone)
        .groupBy(key, "_alone")
        .agg(F.min(F.struct(*columns)).alias("_row"))
        .select([F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def anti_dedup(
    new: DataFrame,
    existing: DataFrame | None,
    key: str,
    scope: str = "partition",
    within_batch: bool = False,
    partition_col: str = "partition_date",
) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet.

    ``scope="partition"`` looks only at stored rows of the same partition,
    ``scope="table"`` at all of them. Copies inside ``new`` stay unless
    ``within_batch`` is set.
    """
    if scope not in ("partition", "table"):
        raise ValueError(f"unknown scope {scope!r}")
    fresh = new
    if existing is not None:
        on = [key, partition_col] if scope == "partition" else [key]
        fresh = not_stored(new, existing, on)
    return keep_first(fresh, key) if within_batch else fresh
