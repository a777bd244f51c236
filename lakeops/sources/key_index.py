"""The keys of a table, bucketed and sorted, so that asking for them moves only the batch.

An anti-join with the whole table shuffles every stored key in every run. Here keys are
stored a second time, in Parquet files laid out in buckets by the key: a batch is
shuffled to the same buckets and meets the stored keys where they lie.

The index is files under a folder that holds its number of buckets; any session can open it.
Each key is stored with the batch that brought it. A batch that is repeated after a failure
does not see its own keys, so that it writes what it wrote before.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.session import new_scratch, remove


class KeyIndex:
    """An open index. ``buckets`` is fixed when the folder is first used."""

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str = "string", buckets: int = 64):
        self.spark, self.path, self.key, self.kind, self.buckets = spark, path.rstrip("/"), key, kind, buckets
        self.schema = f"`{key}` {kind}, batch bigint"
        self.folder = f"{self.path}/buckets-{buckets}"
        self.table = "key_index_" + hashlib.md5(self.folder.encode()).hexdigest()
        self._open()

    def _open(self) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{self.table}` ({self.schema}) USING parquet"
            f" CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.folder}'"
        )

    def stored(self, but: int | None = None) -> DataFrame:
        """key, batch of what is stored, without what the batch ``but`` brought."""
        rows = self.spark.table(self.table)
        return rows if but is None else rows.where(F.col("batch") != but)

    def fresh(self, new: DataFrame, batch: int | None = None) -> DataFrame:
        """Rows of ``new`` whose key no other batch has stored; a null key matches nothing.

        The stored side is neither shuffled nor made distinct: a semi-join does not care how
        often a key is there. If it is small enough Spark broadcasts it instead.
        """
        return new.join(self.stored(batch).select(self.key), self.key, "left_anti")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Store the keys of a batch. Keys that are stored twice do no harm."""
        keys = rows.where(F.col(self.key).isNotNull()).select(F.col(self.key).cast(self.kind).alias(self.key), F.lit(batch).cast("bigint").alias("batch"))
        self._write(keys.repartition(self.buckets, self.key))

    def _write(self, keys: DataFrame) -> None:
        self.spark.catalog.refreshTable(self.table)
        writer = keys.write.format("parquet").mode("append").bucketBy(self.buckets, self.key).sortBy(self.key)
        writer.option("path", self.folder).saveAsTable(self.table)

    def files(self) -> int:
        return len(self.spark.table(self.table).inputFiles())

    def compact(self) -> None:
        """One file a bucket again, every key once, with the first batch that brought it.

        The new files are complete in a folder of their own before the old ones go; a run
        that dies in between leaves a folder ``compacted`` that the next call takes over.
        """
        whole = f"{self.path}/compacted"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        done = hadoop(f"{whole}/_SUCCESS")
        fs = done.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(done):
            remove(self.spark, whole)
            temporary = f"{self.table}_compacted"
            self.spark.sql(f"DROP TABLE IF EXISTS `{temporary}`")
            once = self.stored().groupBy(self.key).agg(F.min("batch").alias("batch"))
            writer = once.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
            writer.option("path", whole).saveAsTable(temporary)
            self.spark.sql(f"DROP TABLE `{temporary}`")  # the files of an external table stay
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.table}`")
        remove(self.spark, self.folder)
        fs.rename(hadoop(whole), hadoop(self.folder))
        self._open()
        self.spark.catalog.refreshTable(self.table)


def temporary_index(spark: SparkSession, key: str, kind: str = "string", buckets: int = 64) -> KeyIndex:
    """An index in the scratch area."""
    return KeyIndex(spark, new_scratch(spark, "keys"), key, kind, buckets)
