"""Incremental ingest of landed files: each file is handed to the handler once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.rules import accept, sales_rules
from lakeops.operators.silver import anti_dedup, keep_first, to_silver_schema
from lakeops.schemas import SALES_SILVER
from lakeops.session import Scratch
from lakeops.sources.key_index import KeyIndex
from lakeops.sources.tables import append_partitioned, read_or_none, replace_partitions


def ingest_incremental(
    spark: SparkSession,
    src: str,
    schema: T.StructType,
    checkpoint: str,
    handler: Callable[[DataFrame, int], None],
    trigger: str = "availableNow",
    max_files: int | None = None,
) -> StreamingQuery:
    """Feed new JSON files under ``src`` to ``handler``.

    ``trigger="availableNow"`` drains what is there and ends; any other value is a
    processing-time interval for a job that keeps watching. A batch that failed half
    way is handed over again, so the handler must be idempotent.
    """
    # every run lands in a directory of its own below src
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    writer = (
        reader.json(src)
        .writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
    )
    if trigger == "availableNow":
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.trigger(processingTime=trigger).start()


def silver_handler(
    path: str,
    as_of: str,
    max_product_id: int | None = None,
    run_date: str | None = None,
    partition_cols: tuple[str, ...] = ("partition_date",),
    scope: str = "partition",
    within_batch: bool = True,
) -> Callable[[DataFrame, int], None]:
    """Clean a batch, drop what the table already holds, append the rest.

    The anti-join against the stored keys makes a replayed batch write nothing new. The
    batch is parsed once, by the job that writes.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        clean = accept(to_silver_schema(batch, run_date, as_of), sales_rules(as_of, max_product_id))
        stored = read_or_none(batch.sparkSession, path, SALES_SILVER)
        if stored is not None and scope == "partition" and run_date is not None:
            stored = stored.where(F.col("partition_date") == run_date)
        fresh = anti_dedup(clean, stored, "transaction_id", scope, within_batch)
        one = run_date is not None and partition_cols == ("partition_date",)
        append_partitioned(fresh, path, list(partition_cols), one)

    return handle


def indexed_handler(
    path: str,
    index: KeyIndex,
    as_of: str,
    max_product_id: int | None = None,
    run_date: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """As ``silver_handler`` over the whole table, but the stored keys stay where they lie.

    The table has a partition column ``batch`` beside the day. A batch handed over again
    ignores the keys it has stored itself and replaces its own partitions, so it
    leaves what it left the first time.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        typed = to_silver_schema(batch, run_date, as_of)
        with Scratch(spark, "batch") as scratch:
            clean = accept(typed, sales_rules(as_of, max_product_id))
            fresh = scratch.store(keep_first(index.fresh(clean, batch_id), "transaction_id"))
            if fresh.isEmpty():
                return
            mine = fresh.withColumn("batch", F.lit(batch_id))
            replace_partitions(mine, path, ["partition_date", "batch"], one=run_date is not None)
            index.add(fresh, batch_id)

    return handle
