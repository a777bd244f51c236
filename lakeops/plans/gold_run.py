"""Refresh the gold tables of one day from the silver table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from lakeops.functions.times import Moment
from lakeops.operators import gold
from lakeops.schemas import SALES_SILVER, STEP_STATUS
from lakeops.sources.tables import read_or_none
from lakeops.sources.upsert import upsert

# table -> (merge keys, partition columns); fixed values
GOLD_TABLES = {
    "daily_sales_summary": (["data_date"], ["partition_date"]),
    "product_performance": (["product_id", "data_date"], ["data_date"]),
    "customer_segments": (["customer_id", "data_date"], ["data_date"]),
}


def run_gold(
    spark: SparkSession,
    silver: str,
    root: str,
    day: str,
    products: DataFrame,
    customers: DataFrame,
    as_of: Moment | None = None,
    tiers: Sequence[tuple[float, str]] = gold.VALUE_TIERS,
    customer_attributes: Sequence[str] = ("customer_name", "customer_segment", "city", "country"),
) -> DataFrame:
    """Aggregate one day of silver into three gold tables, each on its own.

    The day is read once and kept while three jobs share it; Spark recomputes what a
    lost executor held. A table that fails does not stop the others. Returns one status
    row per table: ``success``, ``skipped`` (no rows) or ``failed``.
    """
    table = read_or_none(spark, silver, SALES_SILVER)
    if table is None:
        return _statuses(spark, [(t, "skipped", 0, "no silver data") for t in GOLD_TABLES])
    sales = table.where(table["partition_date"] == day).persist(StorageLevel.MEMORY_AND_DISK)
    stamp_at = as_of or day

    builds: dict[str, Callable[[], DataFrame]] = {
        "daily_sales_summary": lambda: gold.daily_sales_summary(sales),
        "product_performance": lambda: gold.product_performance(sales, products, day),
        "customer_segments": lambda: gold.customer_segments(
            sales, customers, day, tiers, attributes=customer_attributes
        ),
    }

    def refresh(name: str) -> tuple[str, str, int, str | None]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        keys, parts = GOLD_TABLES[name]
        try:
            built = gold.stamp(builds[name](), stamp_at)
            if name == "daily_sales_summary":
                built = built.drop("data_date").withColumn("data_date", built["partition_date"])
            result = upsert(spark, built, f"{root}/{name}", keys, parts)
            rows = result.updated + result.inserted
            return name, "success" if rows else "skipped", rows, None
        except Exception as e:  # reported in the status row, the other tables go on
            return name, "failed", 0, f"{type(e).__name__}: {e}"

    try:
        with ThreadPoolExecutor(max_workers=len(builds)) as pool:
            jobs = [pool.submit(inheritable_thread_target(spark)(refresh), name) for name in builds]
            return _statuses(spark, [j.result() for j in jobs])
    finally:
        sales.unpersist()


def overall_status(statuses: Sequence[str]) -> str:
    if any(s == "failed" for s in statuses):
        return "partial_failure"
    return "skipped" if all(s == "skipped" for s in statuses) else "success"


def _statuses(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, STEP_STATUS)
