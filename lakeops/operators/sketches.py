"""Approximate distinct counts from sketches that are stored by day.

A sketch of a day is some kilobytes however many customers the day has, and the sketch of
several days is the union of theirs: the customers of any week or month come from the
stored sketches, without reading the sales again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Log2 of a sketch's registers: 16,384 of them, 16 KB at most, less for few values.
LG_K = 14


def error_bound(lg_k: int = LG_K, deviations: float = 6.0) -> float:
    """Relative error that a united sketch stays within, at so many standard deviations.

    Of estimates within three deviations one in 370 is outside, so a table of some hundred
    periods would hold one; within six it is one in 500 million.
    """
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def daily_sketches(
    df: DataFrame, counted: str, day: str = "partition_date", by: Sequence[str] = (), lg_k: int = LG_K
) -> DataFrame:
    """day, ``by``, rows, sketch: one row for each day and group. Nulls are not counted.

    Sketches are merged on the map side, so a day that holds a third of all rows costs no
    more shuffle than any other.
    """
    return df.groupBy(day, *by).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(counted, F.lit(lg_k)).alias("sketch"))


def distinct_over(sketches: DataFrame, period: Column, by: Sequence[str] = (), name: str = "period") -> DataFrame:
    """Rows and estimated distinct values of every period, which is an expression over the days."""
    return (
        sketches.groupBy(period.alias(name), *by)
        .agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
    )
