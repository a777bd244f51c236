import pytest

from lakeops.operators.silver import anti_dedup, keep_first
from tests.helpers import plan, rows, silver


def test_partition_scope_looks_at_the_same_day_only(spark):
    new = silver(spark, {}, {}, {})
    same_day = silver(spark, {})
    other_day = silver(spark, {}, {}, run_date="2024-05-09")
    stored = same_day.unionByName(other_day)
    by_day = anti_dedup(new, stored, "transaction_id")
    assert rows(by_day, "transaction_id") == [("t2",), ("t3",)]
    anywhere = anti_dedup(new, stored, "transaction_id", scope="table")
    assert rows(anywhere, "transaction_id") == [("t3",)]


def test_no_table_yet_means_everything_is_new(spark):
    new = silver(spark, {}, {})
    assert anti_dedup(new, None, "transaction_id").count() == 2


def test_copies_in_the_batch_stay_unless_asked(spark):
    new = silver(
        spark,
        {"transaction_id": "x", "quantity": 3, "total_amount": 30.0},
        {"transaction_id": "x"},
        {"transaction_id": "y"},
    )
    assert anti_dedup(new, None, "transaction_id").count() == 3
    once = anti_dedup(new, None, "transaction_id", within_batch=True)
    assert rows(once, "transaction_id", "quantity") == [("x", 2), ("y", 2)]


def test_rows_without_a_key_are_not_copies(spark):
    df = silver(spark, {"transaction_id": None}, {"transaction_id": None}, {})
    assert keep_first(df, "transaction_id").count() == 3


def test_keep_first_by_order(spark):
    df = silver(
        spark,
        {"transaction_id": "x", "transaction_timestamp": "2024-05-10T11:00:00", "store_id": 1},
        {"transaction_id": "x", "transaction_timestamp": "2024-05-10T09:00:00", "store_id": 2},
    )
    assert rows(keep_first(df, "transaction_id", ["transaction_timestamp"]), "store_id") == [(2,)]


def test_keep_first_aggregates_before_the_shuffle(spark):
    p = plan(keep_first(silver(spark, {}), "transaction_id"))
    assert "Window" not in p
    assert p.index("partial_min") > p.index("Exchange")  # printed from the top: below it


def test_unknown_scope(spark):
    with pytest.raises(ValueError, match="scope"):
        anti_dedup(silver(spark, {}), None, "transaction_id", scope="galaxy")


def test_small_batch_does_not_shuffle_the_table(spark, path):
    silver(spark, {}, {}).write.parquet(f"{path}/stored")
    silver(spark, {}).write.parquet(f"{path}/new")
    stored, new = spark.read.parquet(f"{path}/stored"), spark.read.parquet(f"{path}/new")
    p = plan(anti_dedup(new, stored, "transaction_id", scope="table"))
    assert "SortMergeJoin" not in p
    assert "BroadcastHashJoin" in p
