"""One key, id or partition holds a third of all rows: whole and right results."""

import os

import pytest
from pyspark.sql import functions as F

from lakeops.operators import checks as dq, envelope_checks as ec, gold
from lakeops.operators.ordered import number_rows
from lakeops.operators.silver import anti_dedup, keep_first
from lakeops.sources.tables import append_partitioned
from tests.helpers import AS_OF, rows

N = 9000


@pytest.fixture(scope="module")
def hot(spark):
    """Rows 0, 3, 6, ... share one id, product, customer and day."""
    third = F.col("id") % 3 == 0
    return (
        spark.range(N)
        .repartition(6)
        .select(
            F.when(third, F.lit("hot")).otherwise(F.concat(F.lit("t"), "id")).alias("transaction_id"),
            F.when(third, F.lit(1)).otherwise(F.col("id") % 50 + 1).alias("product_id"),
            F.when(third, F.lit(1)).otherwise(F.col("id") % 70 + 1).alias("customer_id"),
            F.lit(2).cast("bigint").alias("quantity"),
            (F.col("id") / 100).alias("unit_price"),
            (F.col("id") / 50).alias("total_amount"),
            F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("transaction_timestamp"),
            F.lit("completed").alias("status"),
            F.when(third, "2024-01-01").otherwise("2024-01-02").alias("partition_date"),
        )
    )


def test_keep_first(hot):
    got = keep_first(hot, "transaction_id", ["transaction_timestamp"])
    assert got.count() == N - N // 3 + 1
    assert got.where("transaction_id = 'hot'").first()["unit_price"] == 0.0


def test_anti_dedup(hot):
    stored = hot.where("transaction_id = 'hot' OR total_amount < 20")
    fresh = anti_dedup(hot, stored, "transaction_id", scope="table")
    want = [i for i in range(N) if i % 3 and i / 50 >= 20]
    assert fresh.count() == len(want)


def test_summary_and_products(spark, hot):
    by_day = {r["partition_date"]: r for r in gold.daily_sales_summary(hot).collect()}
    assert by_day["2024-01-01"]["total_transactions"] == 1
    assert by_day["2024-01-02"]["total_transactions"] == N - N // 3
    assert by_day["2024-01-01"]["total_revenue"] == sum(range(0, N, 3)) / 50
    products = spark.range(1, 51).select(
        F.col("id").alias("product_id"), F.lit("p").alias("product_name"), F.lit("c").alias("category")
    )
    got = {r["product_id"]: r for r in gold.product_performance(hot, products).collect()}
    mine = [i for i in range(N) if i % 3 == 0 or i % 50 == 0]
    assert got[1]["transaction_count"] == len(mine)
    assert got[1]["revenue"] == sum(mine) / 50
    assert sum(r["transaction_count"] for r in got.values()) == N


def test_duplicates(spark, hot):
    report = dq.run_checks(hot, [dq.no_duplicates("unique", "transaction_id")], AS_OF)
    assert report.first()["value"] == 1.0
    env = hot.select(
        F.lit("s").alias("stream"),
        F.col("transaction_id").alias("raw_id"),
        F.lit("").alias("extracted_at"),
        F.create_map(F.lit("k"), F.lit("")).alias("data"),
        F.array().cast("array<string>").alias("missing_fields"),
    )
    score = ec.stream_report(env, AS_OF).first()
    assert (score["total_records"], score["duplicate_ids"], score["warnings"]) == (N, 1, 1)


def test_versions(hot):
    got = number_rows(hot, ["transaction_id"], ["transaction_timestamp"], "version")
    assert got.count() == N
    top = got.where("transaction_id = 'hot'").agg(F.max("version"), F.count_distinct("version"))
    assert tuple(top.first()) == (N // 3, N // 3)


def test_a_big_partition_is_written_by_several_tasks(spark, hot, path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64KB")
    try:
        append_partitioned(hot, path + "/t", ["partition_date"])
    finally:
        spark.conf.set(key, before)
    files = [f for f in os.listdir(path + "/t/partition_date=2024-01-02") if f.endswith(".parquet")]
    assert len(files) > 1
    assert rows(spark.read.parquet(path + "/t").groupBy("partition_date").count()) == [
        ("2024-01-01", N // 3),
        ("2024-01-02", N - N // 3),
    ]
