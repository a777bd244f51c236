"""Order-dependent values over groups of any size.

A plain window sends a whole group to one task. Here rows are range-partitioned by
(group, order), so a big group is cut into slices of even size; each slice is worked on
by itself and what crosses a slice border is carried over. Every border cuts at most
one group, so there are fewer carried rows than slices: that bounds the broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lakeops.session import materialise


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "n"
) -> DataFrame:
    """Number the rows of every group from 1. ``order`` must be total within a group."""
    sliced = _slices(df, keys, order)
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_slice", F.sum("_rows").over(before).alias("_offset"))
        .where("_offset > 0")
    )
    within = F.row_number().over(W.partitionBy("_slice", *keys).orderBy(*order))
    numbered = sliced.withColumn("_local", within)
    return _carry(numbered, carried, keys, "_offset").select(
        *df.columns,
        (F.col("_local") + F.coalesce("_offset", F.lit(0))).cast("bigint").alias(out),
    )


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "previous"
) -> DataFrame:
    """The value of the row before, within the group. ``order`` must be total."""
    sliced = _slices(df, keys, order)
    last = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
        .select(
            *keys,
            "_slice",
            F.lag("_last").over(W.partitionBy(*keys).orderBy("_slice")).alias("_carried"),
        )
        .where("_carried IS NOT NULL")
    )
    w = W.partitionBy("_slice", *keys).orderBy(*order)
    local = sliced.withColumns({"_lag": F.lag(value).over(w), "_local": F.row_number().over(w)})
    return _carry(local, last, keys, "_carried").select(
        *df.columns,
        F.when(F.col("_local") == 1, F.col(f"_carried.{value}"))
        .otherwise(F.col("_lag"))
        .alias(out),
    )


def _slices(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    # the cut must be the same for everything derived from it, hence the stored copy
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys, *order)
    return materialise(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def _carry(rows: DataFrame, carried: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    renamed = {k: f"_c_{k}" for k in [*keys, "_slice"]}
    small = carried.withColumnsRenamed(renamed).select(*renamed.values(), column)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
    return rows.join(F.broadcast(small), same, "left")
