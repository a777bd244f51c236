from pyspark.sql import functions as F

from lakeops.operators import gold, reports
from tests.helpers import at, plan, rows, silver

PRODUCTS = "product_id long, product_name string, category string"
CUSTOMERS = "customer_id long, customer_name string, customer_segment string, city string, country string"


def test_daily_summary_counts_every_status(spark):
    df = silver(
        spark,
        {"total_amount": 0.1},
        {"total_amount": 0.2, "status": "cancelled"},
        {"total_amount": 0.3, "status": "pending", "customer_id": 2, "transaction_id": "t1"},
    )
    got = gold.daily_sales_summary(df).first().asDict()
    assert got == {
        "partition_date": "2024-05-10",
        "total_transactions": 2,
        "unique_customers": 2,
        "total_revenue": 0.6,  # exact, where adding the doubles gives 0.6000000000000001
        "avg_transaction_value": 0.6 / 3,
        "total_items_sold": 6,
        "completed_transactions": 1,
        "cancelled_transactions": 1,
        "completion_rate": 33.33,
    }


def test_daily_summary_counts_each_id_by_itself(spark):
    df = silver(spark, {}, {"customer_id": None}, {"transaction_id": None})
    df = df.unionByName(df.withColumn("partition_date", F.lit(None).cast("string")))
    counted = gold.daily_sales_summary(df)
    assert "Expand" not in plan(counted)  # which holds every row once for each of the ids
    assert rows(counted, "total_transactions", "unique_customers", "total_items_sold") == [(2, 1, 6), (2, 1, 6)]
    assert gold.daily_sales_summary(df, ()).columns == [c for c in counted.columns if c not in gold.DISTINCT]


def test_product_performance_inner_join_completed_only(spark):
    df = silver(
        spark,
        {"unit_price": 10.0},
        {"unit_price": 20.0, "total_amount": 40.0},
        {"status": "pending"},
        {"product_id": 77},
    )
    products = spark.createDataFrame([(1, "pen", "office"), (2, "cup", "home")], PRODUCTS)
    got = gold.product_performance(df, products)
    assert rows(got) == [(1, "pen", "office", 2, 4, 60.0, 15.0, 10.0, 20.0)]
    assert gold.product_performance(df, products, day="2024-05-09").count() == 0
    dated = gold.product_performance(df, products, day="2024-05-10").first()
    assert dated["data_date"] == "2024-05-10"


def test_dimension_stored_twice_counts_twice(spark):
    """Aggregating before the join must equal joining before aggregating."""
    df = silver(spark, {}, {"total_amount": 30.0, "quantity": 3})
    products = spark.createDataFrame([(1, "pen", "office")] * 2 + [(1, "pen", "desk")], PRODUCTS)
    got = gold.product_performance(df, products).drop("avg_selling_price")
    naive = (
        df.join(products, "product_id")
        .groupBy("product_id", "product_name", "category")
        .agg(
            F.count("transaction_id"),
            F.sum("quantity"),
            F.sum("total_amount"),
            F.min("unit_price"),
            F.max("unit_price"),
        )
    )
    assert rows(got) == rows(naive)


def test_facts_are_aggregated_before_the_join(spark):
    products = spark.createDataFrame([(1, "pen", "office")], PRODUCTS)
    p = plan(gold.product_performance(silver(spark, {}), products))
    join = p.index("Join")
    assert p.index("partial_sum") > join  # below the join in the tree


def test_customer_tiers_are_strict_and_ordered(spark):
    df = silver(
        spark,
        {"customer_id": 1, "total_amount": 1000.01},
        {"customer_id": 2, "total_amount": 1000.0},
        {"customer_id": 3, "total_amount": 500.0},
        {"customer_id": 4, "total_amount": 500.01},
    )
    customers = spark.createDataFrame(
        [(i, f"c{i}", "New", "x", "y") for i in range(1, 6)], CUSTOMERS
    )
    got = gold.customer_segments(df, customers)
    assert rows(got, "customer_id", "value_tier") == [
        (1, "High Value"),
        (2, "Medium Value"),
        (3, "Low Value"),
        (4, "Medium Value"),
    ]


def test_customer_purchase_dates(spark):
    df = silver(
        spark,
        {"transaction_timestamp": "2024-05-10T08:00:00"},
        {"transaction_timestamp": "2024-05-10T09:00:00", "total_amount": 25.0},
    )
    customers = spark.createDataFrame([(1, "c", "New", "x", "y")], CUSTOMERS)
    got = gold.customer_segments(df, customers, day="2024-05-10").first()
    assert got["first_purchase_date"] == at("2024-05-10 08:00:00")
    assert got["last_purchase_date"] == at("2024-05-10 09:00:00")
    assert (got["purchase_count"], got["total_spend"], got["avg_order_value"]) == (2, 45.0, 22.5)


def _summary(spark, *values):
    return spark.createDataFrame(list(values), "partition_date string, total_revenue double")


def test_latest_trend_and_top(spark):
    df = _summary(spark, ("2024-01-02", 5.0), ("2024-01-03", 1.0), ("2024-01-01", 9.0))
    assert reports.latest(df, "partition_date", "total_revenue").first()[0] == 1.0
    assert reports.latest_fraction(df, "partition_date", "total_revenue").first()[0] == 0.01
    ascending = [r[0] for r in reports.trend(df, "partition_date", "total_revenue").collect()]
    assert ascending == ["2024-01-01", "2024-01-02", "2024-01-03"]
    newest = [r[0] for r in reports.trend(df, "partition_date", "total_revenue", last=2).collect()]
    assert newest == ["2024-01-03", "2024-01-02"]
    best = [r[1] for r in reports.top_k(df, "total_revenue", 2, "partition_date").collect()]
    assert best == [9.0, 5.0]
    assert "TakeOrderedAndProject" in plan(reports.top_k(df, "total_revenue", 2))


def test_weeks_start_on_monday(spark):
    # 2024-01-07 is a Sunday, 2024-01-08 a Monday
    df = _summary(spark, ("2024-01-07", 1.0), ("2024-01-08", 2.0), ("2024-01-14", 4.0))
    got = [(str(r[0]), r[1]) for r in reports.weekly_revenue(df).collect()]
    assert got == [("2024-01-08", 6.0), ("2024-01-01", 1.0)]


def test_last_days_are_inclusive(spark):
    df = _summary(spark, ("2024-04-10", 1.0), ("2024-04-09", 1.0), ("2024-05-10", 1.0))
    kept = reports.last_n_days(df, "partition_date", 30, "2024-05-10")
    assert rows(kept, "partition_date") == [("2024-04-10",), ("2024-05-10",)]


def test_cross_layer_join_repeats_the_day_for_every_product(spark):
    performance = spark.createDataFrame(
        [("a", "d1"), ("a", "d1"), ("b", "d1"), ("a", "d2"), ("a", "d3")],
        "category string, data_date string",
    )
    summary = _summary(spark, ("d1", 10.0), ("d2", 1.0), ("d2", 2.0))
    naive = (
        performance.join(summary, performance.data_date == summary.partition_date)
        .groupBy("category")
        .agg(F.sum("total_revenue"))
    )
    assert rows(reports.cross_layer_join(performance, summary)) == rows(naive)


def test_value_distribution(spark):
    df = spark.createDataFrame(
        [("High Value", 10.0), ("High Value", 20.0), ("Low Value", 1.0)],
        "value_tier string, total_spend double",
    )
    assert rows(reports.value_distribution(df)) == [("High Value", 2, 15.0), ("Low Value", 1, 1.0)]
