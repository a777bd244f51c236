"""Dashboard questions over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeops.functions.numeric import TOTAL, money_avg, money_sum
from lakeops.functions.times import Moment, calendar_day


def latest(df: DataFrame, order_col: str, value_col: str) -> DataFrame:
    """The value of the newest row."""
    return df.orderBy(F.desc(order_col)).limit(1).select(value_col)


def newest(df: DataFrame, order_col: str) -> str | None:
    """The greatest value of a column, one row; with it a partitioned table can be pruned."""
    return df.agg(F.max(order_col)).first()[0]


def latest_fraction(df: DataFrame, order_col: str, percent_col: str) -> DataFrame:
    return latest(df, order_col, percent_col).select(
        (F.col(percent_col) / 100.0).alias(percent_col)
    )


def trend(df: DataFrame, order_col: str, *value_cols: str, last: int | None = None) -> DataFrame:
    """The whole series ascending, or the ``last`` newest rows, newest first."""
    series = df.select(order_col, *value_cols)
    if last is None:
        return series.orderBy(order_col)
    return series.orderBy(F.desc(order_col)).limit(last)


def top_k(df: DataFrame, metric: str, k: int, *tie: str) -> DataFrame:
    """The ``k`` largest rows; ``tie`` columns make the order total."""
    return df.orderBy(F.desc(metric), *tie).limit(k)


def on_day(df: DataFrame, col: str, day: Moment) -> DataFrame:
    """Rows whose date text is the given day; the text itself is compared, so that a
    table partitioned by it is pruned."""
    return df.where(F.col(col) == str(day)[:10])


def last_n_days(df: DataFrame, col: str, n: int, as_of: Moment) -> DataFrame:
    """Rows whose date is at most ``n`` days before ``as_of``."""
    return df.where(F.to_date(col) >= F.date_sub(calendar_day(as_of), n))


def revenue_by_category(performance: DataFrame, day: Moment | None = None) -> DataFrame:
    """Revenue per category, of one day if given."""
    rows = performance if day is None else on_day(performance, "data_date", day)
    return (
        rows.groupBy("category")
        .agg(money_sum(F.col("revenue"), TOTAL).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def value_distribution(segments: DataFrame, day: Moment | None = None) -> DataFrame:
    """Customers and mean spend per value tier, of one day if given."""
    rows = segments if day is None else on_day(segments, "data_date", day)
    return rows.groupBy("value_tier").agg(
        F.count(F.lit(1)).alias("customer_count"),
        money_avg(F.col("total_spend"), TOTAL).alias("avg_spend"),
    )


def weekly_revenue(summary: DataFrame, n: int = 12) -> DataFrame:
    """Revenue of the newest ``n`` weeks, weeks starting on Monday."""
    week = F.to_date(F.date_trunc("week", F.to_date("partition_date")))
    return (
        summary.groupBy(week.alias("week"))
        .agg(money_sum(F.col("total_revenue"), TOTAL).alias("weekly_revenue"))
        .orderBy(F.desc("week"))
        .limit(n)
    )


def category_performance(performance: DataFrame, as_of: Moment, n_days: int = 30) -> DataFrame:
    """Products, revenue and mean revenue per category over the last days."""
    return (
        last_n_days(performance, "data_date", n_days, as_of)
        .groupBy("category")
        .agg(
            F.count_distinct("product_id").alias("product_count"),
            money_sum(F.col("revenue"), TOTAL).alias("total_revenue"),
            money_avg(F.col("revenue"), TOTAL).alias("avg_product_revenue"),
        )
    )


def cross_layer_join(performance: DataFrame, summary: DataFrame) -> DataFrame:
    """Revenue of the day, once for every product row of that day, per category.

    Both sides are aggregated to the date first: n product rows and the day's revenue
    meet as one row each, and the repetition is a multiplication.
    """
    rows = performance.groupBy(F.col("data_date").alias("partition_date"), "category").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    days = summary.groupBy("partition_date").agg(
        money_sum(F.col("total_revenue"), TOTAL).alias("_revenue")
    )
    return (
        rows.join(days, "partition_date")
        .groupBy("category")
        .agg(money_sum(F.col("_revenue"), TOTAL, F.col("_rows")).alias("category_revenue"))
        .orderBy(F.desc("category_revenue"), "category")
    )
