"""Partitioned Parquet tables: read, append, replace, count."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist on whatever file system it names?"""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_or_none(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table, or None when it does not exist yet. Any other problem is raised."""
    if not path_exists(spark, path):
        return None
    try:
        return read_table(spark, path, schema)
    except AnalysisException as e:  # gone since we looked
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_partition(
    spark: SparkSession, path: str, column: str, value: str, schema: T.StructType | None = None
) -> DataFrame:
    """One partition; the filter prunes directories before any file is opened."""
    return read_table(spark, path, schema).where(F.col(column) == F.lit(value))


def balanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, but split a big one over several tasks.

    The rebalance hint lets AQE merge small and split skewed partitions by size, so a
    partition that holds a third of the data is still written in parallel.
    """
    return df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str], one: bool = False) -> None:
    """Create the table on first use, append afterwards.

    ``one``: all rows are of one partition, so there is nothing to bring together and every
    task writes the rows it has, without a shuffle.
    """
    (df if one else balanced(df, partition_cols)).write.mode("append").partitionBy(*partition_cols).parquet(path)


def create_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """First write of a table: whatever was there is replaced as a whole."""
    (
        balanced(df, partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], one: bool = False) -> None:
    """Replace exactly the partitions that occur in ``df``; ``one`` as in ``append_partitioned``."""
    (
        (df if one else balanced(df, partition_cols))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def table_size(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows per table. Counting reads file footers only, no column data."""
    counts = [
        read_table(spark, path).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, counts)
