import pytest
from pyspark.sql import functions as F

from lakeops.operators import rules as r
from lakeops.operators.silver import to_silver_schema
from tests.helpers import AS_OF, plan, rows, sales, silver

# one row per defect, and the rule it must break
DEFECTS = {
    "null_customer": ({"customer_id": None}, ["customer_id_present"]),
    "invalid_product": ({"product_id": 9500}, ["product_in_range"]),
    "product_zero": ({"product_id": 0}, ["product_in_range"]),
    "negative_amount": ({"total_amount": -20.0}, ["total_amount_positive", "total_matches"]),
    "future_date": ({"transaction_timestamp": "2024-05-11T00:00:00"}, ["not_in_future"]),
    "invalid_status": ({"status": "UNKNOWN"}, ["status_valid"]),
    "null_status": ({"status": None}, ["status_valid"]),
    "zero_quantity": ({"quantity": 0}, ["quantity_positive", "total_matches"]),
    "mismatched_total": ({"total_amount": 21.0}, ["total_matches"]),
    "invalid_payment": ({"payment_method": "bitcoin"}, ["payment_method_valid"]),
    "null_payment": ({"payment_method": None}, ["payment_method_valid"]),
    "null_timestamp": ({"transaction_timestamp": None}, ["transaction_timestamp_present"]),
    "null_id": ({"transaction_id": None}, ["transaction_id_present"]),
    "null_product": ({"product_id": None}, ["product_id_present"]),
    "null_quantity": ({"quantity": None}, ["quantity_positive", "total_matches"]),
    "null_amount": ({"total_amount": None}, ["total_amount_positive", "total_matches"]),
}


def test_every_defect_has_its_reason(spark):
    df = silver(spark, {}, *[change for change, _ in DEFECTS.values()])
    flagged = r.with_reject_reasons(df, r.sales_rules(AS_OF, r.EXAMPLE_PRODUCTS))
    got = [row["reject_reasons"] for row in flagged.collect()]
    assert got == [[], *[reasons for _, reasons in DEFECTS.values()]]


def test_accept_and_quarantine_split_the_input(spark):
    df = silver(spark, {}, {}, *[change for change, _ in DEFECTS.values()])
    rules = r.sales_rules(AS_OF, r.EXAMPLE_PRODUCTS)
    kept, rejected = r.accept(df, rules), r.quarantine(df, rules)
    assert kept.count() == 2
    assert rejected.count() == len(DEFECTS)
    assert rows(kept.unionByName(rejected.drop("reject_reasons"))) == rows(df)
    assert rows(r.accept(kept, rules)) == rows(kept)  # cleaning is idempotent


def test_total_tolerance_is_inclusive(spark):
    df = silver(spark, {"total_amount": 20.009}, {"total_amount": 20.02})
    assert rows(r.accept(df, r.sales_rules(AS_OF, r.EXAMPLE_PRODUCTS)), "transaction_id") == [("t1",)]


def test_timestamp_equal_to_now_is_not_future(spark):
    df = silver(spark, {"transaction_timestamp": "2024-05-10T12:00:00"})
    assert r.accept(df, r.sales_rules(AS_OF, r.EXAMPLE_PRODUCTS)).count() == 1


def test_reject_counts_include_zero(spark):
    df = silver(spark, {}, {"quantity": 0}, {"status": "ERROR"})
    counts = dict(rows(r.reject_counts(df, r.sales_rules(AS_OF, r.EXAMPLE_PRODUCTS))))
    assert counts["quantity_positive"] == 1 and counts["status_valid"] == 1
    assert counts["customer_id_present"] == 0
    assert len(counts) == 11


def test_reject_counts_scan_once(spark):
    p = plan(r.reject_counts(silver(spark, {}), r.sales_rules(AS_OF, r.EXAMPLE_PRODUCTS)))
    assert p.count("Scan ExistingRDD") == 1


def test_funnel(spark):
    raw = silver(spark, {}, {}, {"quantity": 0}, {})
    stored = silver(spark, {}).select("transaction_id")  # holds t1
    got = r.funnel(raw, r.sales_rules(AS_OF, r.EXAMPLE_PRODUCTS), stored, "transaction_id").first().asDict()
    assert got == {
        "records_read": 4,
        "records_cleaned": 3,
        "records_written": 2,
        "duplicates_removed": 1,
    }
    first = r.funnel(raw, r.sales_rules(AS_OF, r.EXAMPLE_PRODUCTS), None, "transaction_id").first()
    assert first["records_written"] == 3


def test_sale_model_has_no_clock_and_no_upper_product(spark):
    df = sales(
        spark,
        {"product_id": 9999, "transaction_timestamp": "2999-01-01T00:00:00"},
        {"store_id": 0},
        {"unit_price": 0.0, "total_amount": 0.0},
    )
    flagged = r.with_reject_reasons(df, r.sale_model_rules())
    assert [x["reject_reasons"] for x in flagged.collect()] == [
        [],
        ["store_id_positive"],
        ["unit_price_positive", "total_amount_positive"],
    ]


def test_dimension_rules(spark):
    products = spark.createDataFrame(
        [(1, "a", "c", 1.0, 0), (0, "a", "c", 1.0, 1), (2, None, "c", 0.0, -1)],
        "product_id long, product_name string, category string, base_price double, stock_quantity long",
    )
    flagged = r.with_reject_reasons(products, r.product_rules())
    assert [x["reject_reasons"] for x in flagged.collect()] == [
        [],
        ["product_id_positive"],
        ["product_name_present", "base_price_positive", "stock_quantity_not_negative"],
    ]
    customers = spark.createDataFrame(
        [(1, "n", "e", "p", "c", "k", "2024-01-01", s) for s in ("Premium", "Regular", "New", "VIP")],
        "customer_id long, customer_name string, email string, phone string, city string,"
        " country string, signup_date string, customer_segment string",
    )
    assert r.accept(customers, r.customer_rules()).count() == 3


def test_bad_cast_fails_or_rejects(spark):
    raw = sales(spark, {}, {"transaction_timestamp": "yesterday"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        to_silver_schema(raw, "2024-05-10", AS_OF).collect()
    lenient = to_silver_schema(raw, "2024-05-10", AS_OF, bad_casts="null")
    assert rows(r.accept(lenient, r.sales_rules(AS_OF, r.EXAMPLE_PRODUCTS)), "transaction_id") == [("t1",)]


def test_silver_schema_stamps_run(spark):
    df = silver(spark, {}, run_date="2024-05-09")
    assert df.first()["partition_date"] == "2024-05-09"
    by_event = to_silver_schema(sales(spark, {}), None, AS_OF)
    assert by_event.first()["partition_date"] == "2024-05-10"
    assert dict(df.dtypes)["transaction_timestamp"] == "timestamp_ntz"
    assert df.select(F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss")).first()[0] == AS_OF
