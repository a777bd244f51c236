"""Layer-wide operations: inventory, archive, monthly tables, SQL registration."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.functions.numeric import money_sum
from lakeops.sources.tables import replace_partitions


def lake_inventory(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Objects and bytes per layer, from file listings; no content is read."""
    files = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.lit(layer).alias("layer"), "path", "length")
        for layer, path in layers.items()
    ]
    return (
        reduce(DataFrame.unionByName, files)
        .groupBy("layer")
        .agg(F.count(F.lit(1)).alias("objects"), F.sum("length").alias("bytes"))
    )


def used_gigabytes(inventory: DataFrame) -> DataFrame:
    return inventory.agg((F.sum("bytes") / F.lit(1024.0**3)).alias("used_gb"))


def archive_year(df: DataFrame, date_col: str, year: int, path: str) -> None:
    """Copy one year to the archive, laid out by year and month."""
    # a half-open range, which the scan can be handed
    first, after = (F.lit(f"{y:04d}-01-01").cast("date").cast("timestamp_ntz") for y in (year, year + 1))
    dated = df.where((F.col(date_col) >= first) & (F.col(date_col) < after)).select(
        "*",
        F.date_format(date_col, "yyyy").alias("year"),
        F.date_format(date_col, "MM").alias("month"),
    )
    replace_partitions(dated, path, ["year", "month"])


def monthly_metrics(df: DataFrame, ts: str, amount: str) -> DataFrame:
    return df.groupBy(F.date_format(ts, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("records"), money_sum(F.col(amount)).alias("total_amount")
    )


def register_table(spark: SparkSession, db: str, name: str, path: str) -> None:
    """Make a Parquet location a catalog table, and its partitions known to it."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{db}`.`{name}` USING parquet LOCATION '{path}'")
    partitioned = any(c.isPartition for c in spark.catalog.listColumns(f"`{db}`.`{name}`"))
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE `{db}`.`{name}`")


def list_tables(spark: SparkSession, db: str) -> DataFrame:
    """Tables of the catalog; a session's temporary views are not among them."""
    listed = spark.sql(f"SHOW TABLES IN `{db}`").where("NOT isTemporary")
    return listed.select(F.col("tableName").alias("table_name"))


@contextmanager
def batch_view(df: DataFrame, label: str = "batch") -> Iterator[str]:
    """The name under which SQL sees ``df``; the view goes at the end, also on failure.

    A query made inside is analysed there, so it can be run after the view has gone.
    """
    name = f"{label}_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)
