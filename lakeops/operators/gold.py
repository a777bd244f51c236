"""Business aggregates over silver sales.

Facts are aggregated by the dimension's id before the join, so what meets the
dimension is one row per id: a best-selling product costs no more than the others, and
no broadcast has to be forced; the planner broadcasts by measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakeops.functions.numeric import money_avg, money_sum, percentage
from lakeops.functions.times import Moment, iso_day, wall_clock

VALUE_TIERS = ((1000, "High Value"), (500, "Medium Value"))
LOWEST_TIER = "Low Value"


# Distinct counts of the daily summary, and what they count.
DISTINCT = {"total_transactions": "transaction_id", "unique_customers": "customer_id"}


def daily_sales_summary(sales: DataFrame, distinct: Sequence[str] = tuple(DISTINCT)) -> DataFrame:
    """One row per partition date over all statuses.

    Each of the ``distinct`` counts is aggregated by itself, so a task holds a day and an id
    for every row; counted together they would be held twice, with all the sums. Scans and
    shuffles before it that read the same columns are run once.
    """
    completed = F.count_if(F.col("status") == "completed")
    out = sales.groupBy("partition_date").agg(
        money_sum(F.col("total_amount")).alias("total_revenue"),
        money_avg(F.col("total_amount")).alias("avg_transaction_value"),
        F.sum("quantity").alias("total_items_sold"),
        completed.alias("completed_transactions"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled_transactions"),
        percentage(completed, F.count(F.lit(1))).alias("completion_rate"),
    )
    shown = out.columns
    for name in distinct:
        ids = sales.groupBy("partition_date").agg(F.count_distinct(DISTINCT[name]).alias(name))
        ids = ids.withColumnRenamed("partition_date", "_day")
        out = out.join(ids, F.col("partition_date").eqNullSafe(F.col("_day"))).drop("_day")
    return out.select(shown[0], *distinct, *shown[1:])


def completed_on(sales: DataFrame, day: str | None) -> DataFrame:
    """Completed sales, of one day if given; the day prunes the partitioned table."""
    done = sales.where(F.col("status") == "completed")
    return done if day is None else done.where(F.col("partition_date") == day)


def product_performance(
    sales: DataFrame, products: DataFrame, day: str | None = None, per_day: bool = False
) -> DataFrame:
    """Counts, units, revenue and prices per product.

    ``day`` restricts to one day, ``per_day`` gives one row per product and day; both
    add ``data_date``.
    """
    keys = ["product_id"] + (["partition_date"] if per_day else [])
    facts = (
        completed_on(sales, day)
        .groupBy(*keys)
        .agg(
            F.count("transaction_id").alias("transaction_count"),
            F.sum("quantity").alias("units_sold"),
            money_sum(F.col("total_amount")).alias("revenue"),
            F.avg("unit_price").alias("avg_selling_price"),
            F.min("unit_price").alias("min_price"),
            F.max("unit_price").alias("max_price"),
        )
    )
    out = _with_dimension(facts, products, "product_id", ["product_name", "category"]).select(
        "product_id",
        "product_name",
        "category",
        (F.col("transaction_count") * F.col("_copies")).alias("transaction_count"),
        (F.col("units_sold") * F.col("_copies")).alias("units_sold"),
        (F.col("revenue") * F.col("_copies")).alias("revenue"),
        "avg_selling_price",
        "min_price",
        "max_price",
        *([F.col("partition_date").alias("data_date")] if per_day else []),
    )
    return out if per_day or day is None else out.withColumn("data_date", F.lit(day))


def customer_segments(
    sales: DataFrame,
    customers: DataFrame,
    day: str | None = None,
    tiers: Sequence[tuple[float, str]] = VALUE_TIERS,
    default: str = LOWEST_TIER,
    attributes: Sequence[str] = ("customer_name", "customer_segment", "city", "country"),
) -> DataFrame:
    """Purchases, spend and value tier per customer."""
    facts = (
        completed_on(sales, day)
        .groupBy("customer_id")
        .agg(
            F.count("transaction_id").alias("purchase_count"),
            money_sum(F.col("total_amount")).alias("total_spend"),
            money_avg(F.col("total_amount")).alias("avg_order_value"),
            F.max("transaction_timestamp").alias("last_purchase_date"),
            F.min("transaction_timestamp").alias("first_purchase_date"),
        )
    )
    out = _with_dimension(facts, customers, "customer_id", list(attributes)).select(
        "customer_id",
        *attributes,
        (F.col("purchase_count") * F.col("_copies")).alias("purchase_count"),
        (F.col("total_spend") * F.col("_copies")).alias("total_spend"),
        "avg_order_value",
        "last_purchase_date",
        "first_purchase_date",
    )
    out = out.withColumn("value_tier", value_tier("total_spend", tiers, default))
    return out if day is None else out.withColumn("data_date", F.lit(day))


def value_tier(column: str, tiers: Sequence[tuple[float, str]], default: str):
    """The first tier whose limit the value exceeds, in the order given."""
    (limit, label), *rest = tiers
    expr = F.when(F.col(column) > limit, label)
    for limit, label in rest:
        expr = expr.when(F.col(column) > limit, label)
    return expr.otherwise(default)


def _with_dimension(
    facts: DataFrame, dimension: DataFrame, key: str, attributes: list[str]
) -> DataFrame:
    """Attach attributes. A dimension row stored n times counts n times, as in a join
    before the aggregation; ``_copies`` carries the n."""
    # one shuffle by the key serves both the grouping and the join
    rows = dimension.repartition(key).groupBy(key, *attributes).agg(F.count(F.lit(1)).alias("_copies"))
    return facts.join(rows, key)


def stamp(df: DataFrame, as_of: Moment) -> DataFrame:
    """Add ``created_at`` and, where missing, ``data_date``, as stored in gold."""
    out = df.withColumn("created_at", F.lit(str(as_of)).cast("timestamp"))
    if "data_date" in df.columns:
        return out
    return out.withColumn("data_date", iso_day(wall_clock(as_of)))
