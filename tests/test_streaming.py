import pytest
from pyspark.sql import functions as F

from lakeops.schemas import SALES_RAW, SALES_SILVER
from lakeops.session import Scratch
from lakeops.sources.json_files import land_raw
from lakeops.sources.tables import read_or_none, read_table
from lakeops.streaming.ingest import ingest_incremental, silver_handler
from lakeops.streaming.rates import windowed_rate
from tests.helpers import AS_OF, at, rows, sales


def ingest(spark, path, checkpoint="c", handler=None):
    handler = handler or silver_handler(f"{path}/silver", AS_OF, 50, "2024-05-10")
    return ingest_incremental(spark, f"{path}/sales", SALES_RAW, f"{path}/{checkpoint}", handler)


def stored(spark, path):
    return rows(read_table(spark, f"{path}/silver", SALES_SILVER), "transaction_id")


def test_each_run_sees_new_files_only(spark, path):
    seen = []

    def handler(batch, batch_id):
        seen.append(batch.count())

    land_raw(sales(spark, {}, {}), path, "sales", "1")
    ingest(spark, path, handler=handler)
    land_raw(sales(spark, {}), path, "sales", "2")
    ingest(spark, path, handler=handler)
    ingest(spark, path, handler=handler)
    assert seen == [2, 1]


def test_incremental_equals_batch(spark, path):
    a = sales(spark, {}, {"quantity": 0}, {})
    b = sales(spark, {}, {"transaction_id": "new"})
    land_raw(a, path, "sales", "1")
    ingest(spark, path)
    land_raw(b, path, "sales", "2")
    ingest(spark, path)
    assert stored(spark, path) == [("new",), ("t1",), ("t3",)]


def test_replaying_everything_writes_nothing(spark, path):
    land_raw(sales(spark, {}, {}), path, "sales", "1")
    ingest(spark, path)
    once = stored(spark, path)
    ingest(spark, path, checkpoint="lost-checkpoint")
    assert stored(spark, path) == once


def test_batch_without_clean_rows(spark, path):
    land_raw(sales(spark, {"quantity": 0}), path, "sales", "1")
    ingest(spark, path)
    table = read_or_none(spark, f"{path}/silver", SALES_SILVER)
    assert table is None or table.isEmpty()


def never(*_):
    raise AssertionError("not needed")


def test_a_dated_batch_is_written_without_a_shuffle_or_a_copy(spark, path, monkeypatch):
    monkeypatch.setattr("lakeops.sources.tables.balanced", never)
    monkeypatch.setattr(Scratch, "store", never)
    handle = silver_handler(f"{path}/silver", AS_OF, 50, "2024-05-10", within_batch=False)
    handle(sales(spark, {}, {}, {"quantity": 0}), 0)
    handle(sales(spark, {}, {}, {}), 1)
    assert stored(spark, path) == [("t1",), ("t2",), ("t3",)]


def test_a_dated_batch_is_written_without_a_shuffle_over_the_whole_table(spark, path, monkeypatch):
    monkeypatch.setattr("lakeops.sources.tables.balanced", never)
    for day, rows_ in (("2024-05-09", [{}, {}]), ("2024-05-10", [{}, {}, {}, {"transaction_id": "t3"}])):
        silver_handler(f"{path}/silver", AS_OF, 50, day, scope="table")(sales(spark, *rows_), 0)
    assert stored(spark, path) == [("t1",), ("t2",), ("t3",)]


def test_a_batch_with_days_of_its_own_is_still_balanced(spark, path, monkeypatch):
    monkeypatch.setattr("lakeops.sources.tables.balanced", never)
    with pytest.raises(AssertionError):
        silver_handler(f"{path}/silver", AS_OF, 50)(sales(spark, {}), 0)


def test_watching_job(spark, path):
    land_raw(sales(spark, {}), path, "sales", "1")
    handler = silver_handler(f"{path}/silver", AS_OF, 50, "2024-05-10")
    query = ingest_incremental(
        spark, f"{path}/sales", SALES_RAW, f"{path}/c", handler, trigger="1 second", max_files=1
    )
    try:
        query.processAllAvailable()
        assert stored(spark, path) == [("t1",)]
    finally:
        query.stop()


def test_windowed_rate_on_a_stream_closes_windows(spark, path):
    def land(*events):
        df = spark.createDataFrame([(at(f"2024-01-01 {t}"), "a", v) for t, v in events], "ts timestamp_ntz, s string, v double")
        df.coalesce(1).write.mode("append").parquet(path + "/in")

    schema = "ts timestamp_ntz, s string, v double"
    land(("10:10:00", 30.0), ("10:50:00", 6.0))
    stream = spark.readStream.schema(schema).parquet(path + "/in")
    rates = windowed_rate(stream, "ts", "v", ["s"], 3600, lateness="10 minutes")

    def drain():
        q = (
            rates.writeStream.outputMode("append")
            .option("checkpointLocation", path + "/c")
            .trigger(availableNow=True)
            .format("parquet")
            .start(path + "/out")
        )
        q.awaitTermination()

    drain()
    land(("12:30:00", 1.0))
    drain()
    land(("10:20:00", 99.0))  # too late: its window is closed
    drain()
    out = spark.read.parquet(path + "/out").where(F.col("window_start") == at("2024-01-01 10:00:00"))
    assert rows(out, "s", "increase", "rate") == [("a", 36.0, 0.01)]
