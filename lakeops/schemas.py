"""Explicit schemas of the layer tables; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

SALES_RAW = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("transaction_timestamp", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("base_price", T.DoubleType()),
        T.StructField("stock_quantity", T.LongType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("signup_date", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
    ]
)

# Event times are wall-clock (no zone), run times are instants.
SALES_SILVER = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("transaction_timestamp", T.TimestampNTZType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("partition_date", T.StringType()),
    ]
)

METRIC_SAMPLES = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("name", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)

PROMPTS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField(
            "config",
            T.StructType(
                [
                    T.StructField("model", T.StringType()),
                    T.StructField("temperature", T.DoubleType()),
                    T.StructField("max_tokens", T.LongType()),
                ]
            ),
        ),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

# Gold tables as they are stored; a table that no run has filled yet is read with these.
GOLD_TABLES = {
    "daily_sales_summary": "partition_date string, total_transactions bigint, unique_customers bigint,"
    " total_revenue double, avg_transaction_value double, total_items_sold bigint,"
    " completed_transactions bigint, cancelled_transactions bigint, completion_rate double,"
    " created_at timestamp, data_date string",
    "product_performance": "product_id bigint, product_name string, category string,"
    " transaction_count bigint, units_sold bigint, revenue double, avg_selling_price double,"
    " min_price double, max_price double, created_at timestamp, data_date string",
    "customer_segments": "customer_id bigint, customer_name string, customer_segment string, city string,"
    " country string, purchase_count bigint, total_spend double, avg_order_value double,"
    " last_purchase_date timestamp_ntz, first_purchase_date timestamp_ntz, value_tier string,"
    " created_at timestamp, data_date string",
}

LINEAGE_EDGES = T.StructType(
    [
        T.StructField("src", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("dst", T.StringType()),
    ]
)

STEP_STATUS = T.StructType(
    [
        T.StructField("step", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("detail", T.StringType()),
    ]
)
