"""Operators read their input once, and filters reach the scan."""

from pyspark.sql import functions as F

from lakeops.functions.times import ISO_MOMENT, parse_iso
from lakeops.operators import envelope_checks as ec, reports, rules as r, silver as sl
from lakeops.sources import envelopes as ev, layers
from lakeops.sources.tables import append_partitioned, read_table
from tests.helpers import AS_OF, at, plan, rows, silver


def stored(spark, path, name, df):
    df.write.parquet(f"{path}/{name}")
    return spark.read.parquet(f"{path}/{name}")


def scans(df, path=""):
    return sum("FileScan" in line and path in line for line in plan(df).splitlines())


def test_funnel_reads_each_side_once(spark, path):
    new, old = (stored(spark, path, n, silver(spark, {}, {"quantity": 0}, {"transaction_id": None})) for n in ("new", "old"))
    out = r.funnel(new, r.sales_rules(AS_OF), old, "transaction_id")
    assert scans(out) == 2
    assert out.first().asDict() == {"records_read": 3, "records_cleaned": 1, "records_written": 0, "duplicates_removed": 1}
    alone = r.funnel(new, r.sales_rules(AS_OF), None, "transaction_id")
    assert scans(alone) == 1 and alone.first()["records_written"] == 1


def test_dedup_reads_each_side_once(spark, path):
    new = stored(spark, path, "new", silver(spark, {}, {"transaction_id": None}, {"transaction_id": None}, {}))
    old = stored(spark, path, "old", silver(spark, {}, {}))
    fresh = sl.anti_dedup(new, old, "transaction_id", scope="table")
    assert scans(fresh) == 2 and rows(fresh, "transaction_id") == [("t4",), (None,), (None,)]
    first = sl.keep_first(new.unionByName(new.where("false")), "transaction_id")
    assert scans(sl.keep_first(new, "transaction_id")) == 1
    assert rows(first, "transaction_id") == [("t1",), ("t4",), (None,), (None,)]


def test_completeness_parses_once(spark, path):
    df = spark.createDataFrame([("s", 1, "", None), ("s", 2, "x", None), ("t", 3, "x", "y")], "stream string, id long, a string, b string")
    ev.write_jsonl_gz(ev.wrap_envelope(df, "id", "a"), f"{path}/e")
    out = ec.completeness(ev.read_envelope(spark, f"{path}/e"))
    assert scans(out) == 1
    assert rows(out) == [("s", "a", 1, 50.0, True), ("s", "b", 2, 0.0, True)]


def test_stored_days_are_pruned(spark, path):
    days = spark.createDataFrame([("2024-05-09", "x", 1.0), ("2024-05-10", "x", 2.0)], "data_date string, category string, revenue double")
    append_partitioned(days, f"{path}/gold", ["data_date"])
    gold = read_table(spark, f"{path}/gold")
    assert reports.newest(gold, "data_date") == "2024-05-10"
    today = reports.revenue_by_category(gold, AS_OF)
    assert rows(today) == [("x", 2.0)]
    assert "PartitionFilters: [isnotnull(data_date" in plan(today)


def test_archive_year_hands_a_range_to_the_scan(spark, path):
    sales = [silver(spark, {"transaction_timestamp": f"{d}T00:00:00"}) for d in ("2023-01-01", "2023-12-31", "2024-01-01", "2022-12-31")]
    t = stored(spark, path, "t", sales[0].unionByName(sales[1]).unionByName(sales[2]).unionByName(sales[3]))
    layers.archive_year(t, "transaction_timestamp", 2023, f"{path}/a")
    assert rows(spark.read.parquet(f"{path}/a"), "year", "month") == [("2023", "01"), ("2023", "12")]


def test_iso_forms(spark):
    texts = {
        "2024-05-10T10:00:00.123456789Z": "2024-05-10 10:00:00.123456",
        "20240510T100000": "2024-05-10 10:00:00",
        "20240510T100000,5+0200": "2024-05-10 10:00:00.500000",
        "2024-05-10": "2024-05-10 00:00:00",
        "2024-05-10 10": "2024-05-10 10:00:00",
        "2024-05-10T10:20+02": "2024-05-10 10:20:00",
    }
    bad = ["", "yesterday", "2024-13-01", "2024-05-10T25:00", "10:00", "2024-05-10T", None]
    df = spark.createDataFrame([(t,) for t in [*texts, *bad]], "t string")
    got = {x["t"]: x["v"] for x in df.select("t", parse_iso(F.col("t")).alias("v")).collect()}
    assert got == {**{k: at(v) for k, v in texts.items()}, **dict.fromkeys(bad)}


def test_iso_text_is_matched_once(spark):
    df = spark.createDataFrame([("x",)], "t string").select(parse_iso(F.col("t")).alias("v"))
    assert plan(df).count(ISO_MOMENT) == 1


def test_iso_text_with_marks_and_line_ends(spark):
    good = {"2024-05-10\n": "2024-05-10 00:00:00", "20240510T1020\r\n": "2024-05-10 10:20:00"}
    bad = ["#2024-05-10 10:00:00.5#", "x#2024-05-10#", "2024-05-10#", "#", "2024-05-10\n\n", " :", "::", "2024-05-10 :."]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
    got = {x["t"]: x["v"] for x in df.select("t", parse_iso(F.col("t")).alias("v")).collect()}
    assert got == {**{k: at(v) for k, v in good.items()}, **dict.fromkeys(bad)}
