import json
import os

import pytest
from pyspark.sql import functions as F

from lakeops.operators.rules import Rule
from lakeops.schemas import SALES_RAW
from lakeops.sources import daily, layers, tables
from lakeops.sources.json_files import land_raw, load_dimension, read_json
from tests.helpers import SALE, at, plan, rows, sales, silver


def test_land_and_read_back(spark, path):
    raw = sales(spark, {}, {"customer_id": None, "status": ""})
    landed = land_raw(raw, path, "sales", "20240510_120000")
    assert (landed.count, landed.status) == (2, "success")
    assert landed.path.endswith("/sales/sales_20240510_120000.json")
    assert rows(read_json(spark, landed.path, SALES_RAW)) == rows(raw)


def test_landed_lines_are_gzipped_in_files_of_bounded_length(spark, path, monkeypatch):
    monkeypatch.setattr("lakeops.sources.json_files.FILE_ROWS", 2)
    landed = land_raw(sales(spark, {}, {}, {}, {}, {}).coalesce(1), path, "sales", "1")
    files = [f for f in os.listdir(landed.path) if f.startswith("part-")]
    assert landed.count == 5 and len(files) == 3 and all(f.endswith(".json.gz") for f in files)
    assert read_json(spark, landed.path, SALES_RAW).count() == 5


def test_landing_nothing_is_skipped(spark, path):
    assert land_raw(sales(spark, {}).limit(0), path, "sales", "1").status == "skipped"


def test_top_level_array_and_pretty_json(spark, path):
    with open(path + "/array.json", "w") as f:
        json.dump([SALE, SALE], f)
    with open(path + "/pretty.json", "w") as f:
        json.dump([SALE], f, indent=2)
    assert read_json(spark, path + "/array.json", SALES_RAW).count() == 2
    pretty = read_json(spark, path + "/pretty.json", SALES_RAW, multi_line=True)
    assert rows(pretty, "transaction_id", "quantity") == [("t1", 2)]


def test_dimension_loads_once_and_only_if_valid(spark, path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    named = [Rule("name_present", F.col("name").isNotNull())]
    with pytest.raises(Exception, match="invalid dimension row"):
        load_dimension(df, path + "/d", named)
    assert load_dimension(df.limit(1), path + "/d", named) == "loaded"
    assert load_dimension(df, path + "/d", named) == "skipped"
    assert spark.read.json(path + "/d").count() == 1


def test_read_or_none(spark, path):
    assert tables.read_or_none(spark, path + "/nothing") is None
    os.makedirs(path + "/empty")
    with pytest.raises(Exception):  # there, but not a table
        tables.read_or_none(spark, path + "/empty")


def test_partition_filter_prunes_directories(spark, path):
    t = path + "/t"
    tables.append_partitioned(silver(spark, {}), t, ["partition_date"])
    tables.append_partitioned(silver(spark, {}, run_date="2024-05-09"), t, ["partition_date"])
    day = tables.read_partition(spark, t, "partition_date", "2024-05-09")
    assert day.count() == 1
    assert "PartitionFilters: [isnotnull(partition_date" in plan(day.select("transaction_id"))
    assert dict(tables.read_table(spark, t).dtypes)["partition_date"] == "string"
    size = tables.table_size(spark, {"sales": t})
    assert rows(size) == [("sales", 2)]
    assert "ReadSchema: struct<>" in plan(size)


def test_create_replaces_and_replace_keeps_other_partitions(spark, path):
    t = path + "/t"
    make = lambda *r: spark.createDataFrame(list(r), "v int, p string")
    tables.create_partitioned(make((1, "a"), (2, "b")), t, ["p"])
    tables.replace_partitions(make((3, "b")), t, ["p"])
    assert rows(tables.read_table(spark, t)) == [(1, "a"), (3, "b")]
    tables.create_partitioned(make((4, "c")), t, ["p"])
    assert rows(tables.read_table(spark, t)) == [(4, "c")]
    tables.write_parquet(make((5, "d")), path + "/plain")
    assert rows(tables.read_table(spark, path + "/plain")) == [(5, "d")]


def test_writes_are_rebalanced(spark):
    p = plan(tables.balanced(silver(spark, {}), ["partition_date"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in p


def test_parallel_arrays(spark):
    df = spark.createDataFrame(
        [("x", (["2024-01-01", "2024-01-02"], [1.0, None]))],
        "place string, daily struct<time:array<string>,t_max:array<double>>",
    )
    got = daily.parallel_arrays_to_rows(df, "daily")
    assert rows(got) == [("x", "2024-01-01", 1.0), ("x", "2024-01-02", None)]
    assert got.columns == ["place", "time", "t_max"]


EVENTS = "ts timestamp_ntz, n int"


def events(spark, *pairs):
    return spark.createDataFrame([(at(t), n) for t, n in pairs], EVENTS)


def test_day_slice_is_half_open(spark, path):
    df = events(
        spark,
        ("2024-01-01 23:59:59.999999", 0),
        ("2024-01-02 00:00:00", 1),
        ("2024-01-02 23:59:59.999999", 2),
        ("2024-01-03 00:00:00", 3),
    )
    assert rows(daily.day_slice(df, "ts", "2024-01-02"), "n") == [(1,), (2,)]
    df.write.parquet(path + "/e")
    p = plan(daily.day_slice(spark.read.parquet(path + "/e"), "ts", "2024-01-02"))
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in p and "LessThan(ts,2024-01-03T00:00)" in p


def test_backfill_replaces_days_and_reports_gaps(spark, path):
    t = path + "/t"
    first = events(spark, ("2024-01-05 10:00:00", 1), ("2024-01-06 10:00:00", 2))
    got = daily.backfill_days(first, "ts", "2024-01-05", "2024-01-07", t)
    assert rows(got) == [
        ("2024-01-05", 1, "success"),
        ("2024-01-06", 1, "success"),
        ("2024-01-07", 0, "skipped"),
    ]
    again = events(spark, ("2024-01-05 11:00:00", 5), ("2024-01-05 12:00:00", 6), ("2024-02-01 00:00:00", 9))
    rerun = daily.backfill_days(again, "ts", "2024-01-05", "2024-01-06", t)
    assert rows(rerun) == [("2024-01-05", 2, "success"), ("2024-01-06", 1, "skipped")]
    assert rows(tables.read_table(spark, t), "n") == [(2,), (5,), (6,)]


def test_daily_csv(spark, path):
    df = spark.createDataFrame([(1.5, "2024-01-01"), (2.5, "2024-01-02")], "close double, date string")
    daily.write_daily_csv(df, path + "/csv", "date")
    assert sorted(d for d in os.listdir(path + "/csv") if "=" in d) == ["date=2024-01-01", "date=2024-01-02"]
    assert rows(daily.read_daily_csv(spark, path + "/csv", df.schema)) == rows(df)
    daily.write_daily_csv(df.limit(0), path + "/none", "date")
    assert not [d for d in os.listdir(path + "/none") if "=" in d]


def test_inventory_reads_no_content(spark, path):
    os.makedirs(path + "/bronze/x")
    for name, size in (("a", 10), ("x/b", 30)):
        with open(f"{path}/bronze/{name}", "wb") as f:
            f.write(b"." * size)
    inventory = layers.lake_inventory(spark, {"bronze": path + "/bronze"})
    assert rows(inventory) == [("bronze", 2, 40)]
    assert "content" not in plan(inventory)
    assert layers.used_gigabytes(inventory).first()[0] == 40 / 1024**3


def test_archive_and_months(spark, path):
    df = events(spark, ("2023-12-31 23:00:00", 1), ("2024-01-01 00:00:00", 2), ("2024-03-05 00:00:00", 3))
    layers.archive_year(df, "ts", 2024, path + "/archive")
    assert sorted(os.listdir(path + "/archive/year=2024")) == ["month=01", "month=03"]
    months = layers.monthly_metrics(df, "ts", "n")
    assert rows(months) == [("2023-12", 1, 1.0), ("2024-01", 1, 2.0), ("2024-03", 1, 3.0)]


def test_register_and_list_tables(spark, path):
    tables.append_partitioned(silver(spark, {}), path + "/sales", ["partition_date"])
    tables.write_parquet(silver(spark, {}), path + "/flat")
    db = "lake_" + os.path.basename(path).replace("-", "_")
    layers.register_table(spark, db, "sales", path + "/sales")
    layers.register_table(spark, db, "flat", path + "/flat")
    layers.register_table(spark, db, "flat", path + "/flat")  # again is fine
    with layers.batch_view(layers.list_tables(spark, db)) as view:
        assert rows(layers.list_tables(spark, db)) == [("flat",), ("sales",)]
        listed = spark.sql(f"SELECT table_name FROM {view}")
    assert rows(listed) == [("flat",), ("sales",)]
    assert view not in [t.name for t in spark.catalog.listTables()]
    assert spark.sql(f"SELECT count(*) FROM {db}.sales").first()[0] == 1
    silver(spark, {}).createOrReplaceTempView("sales_view")
    assert spark.sql("SELECT count(*) FROM sales_view").first()[0] == 1
    spark.sql(f"DROP DATABASE {db} CASCADE")
