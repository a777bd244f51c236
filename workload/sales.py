"""Cleaning, gold and dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.functions.numeric import round_half_up
from lakeops.operators import gold, reports, rules as r, silver
from lakeops.operators.rules import Rule
from workload import fixtures as fx
from workload.registry import (
    BUYERS,
    CLEAN,
    PARTS,
    RAW,
    RULE_SQL,
    SALE_COLUMNS,
    MEAN_DIGITS,
    SEGMENTS,
    SUMMARY,
    half_up,
    money,
    performance,
    query,
)

SPLIT = "2000-01-01"  # sales before it play the table that is already there


def sales_rules(spark: SparkSession, d: str) -> list[Rule]:
    return r.sales_rules(fx.AS_OF, fx.max_product_id(spark, d))


def typed(spark: SparkSession, d: str) -> DataFrame:
    return silver.to_silver_schema(fx.sales_raw(spark, d), None, fx.AS_OF)


def clean(spark: SparkSession, d: str) -> DataFrame:
    return r.accept(typed(spark, d), sales_rules(spark, d)).drop("processed_at")


def shown(df: DataFrame, *more: str) -> DataFrame:
    """Sales columns in a form that compares the same everywhere."""
    sold_at = F.col("transaction_timestamp").cast("string").alias("sold_at")
    first = ["transaction_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount"]
    return df.select(*first, sold_at, "payment_method", "store_id", "status", *more)


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    old = F.col("partition_date") < SPLIT
    return df.where(old), df.where(~old)


# --- cleaning -------------------------------------------------------------------------


@query("silver_clean", f"WITH {CLEAN} SELECT {SALE_COLUMNS}, partition_date FROM clean")
def _(spark, d):
    return shown(clean(spark, d), "partition_date")


def _reject_sql(source: str, rules: dict[str, str], label: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {label}'{n}' AS rule, COUNT(*) FILTER (WHERE NOT coalesce({p}, FALSE)) AS rejected"
        f" FROM {source}"
        for n, p in rules.items()
    )


@query("reject_reasons", f"WITH {RAW} {_reject_sql('sales_raw', RULE_SQL)}")
def _(spark, d):
    return r.reject_counts(typed(spark, d), sales_rules(spark, d))


_REASONS = ", ".join(
    f"CASE WHEN NOT coalesce({p}, FALSE) THEN '{n}' END" for n, p in RULE_SQL.items()
)


@query(
    "quarantined_rows",
    f"""WITH {RAW}, flagged AS (SELECT *, concat_ws(',', {_REASONS}) AS reasons FROM sales_raw)
    SELECT {SALE_COLUMNS}, reasons FROM flagged WHERE reasons <> ''""",
)
def _(spark, d):
    rejected = r.quarantine(typed(spark, d), sales_rules(spark, d))
    return shown(rejected.withColumn("reasons", F.array_join("reject_reasons", ",")), "reasons")


FUNNEL = f"""WITH {CLEAN}, old AS (SELECT DISTINCT transaction_id FROM clean WHERE partition_date < '{SPLIT}'),
    n AS (SELECT (SELECT COUNT(*) FROM sales_raw) AS records_read,
                 (SELECT COUNT(*) FROM clean) AS records_cleaned,
                 (SELECT COUNT(*) FROM clean WHERE transaction_id NOT IN
                    (SELECT transaction_id FROM old)) AS records_written)
    SELECT *, records_cleaned - records_written AS duplicates_removed FROM n"""


@query("silver_funnel", FUNNEL)
def _(spark, d):
    stored, _new = split(clean(spark, d))
    return r.funnel(typed(spark, d), sales_rules(spark, d), stored, "transaction_id")


_SEGMENTS_ALLOWED = ("BUILDING", "MACHINERY", "HOUSEHOLD")
_PRODUCT_SQL = {
    "product_id_positive": "product_id > 0",
    "product_name_present": "product_name IS NOT NULL",
    "category_present": "category IS NOT NULL",
    "base_price_positive": "base_price > 0",
    "stock_quantity_not_negative": "stock_quantity >= 0",
}
_CUSTOMER_SQL = {
    "customer_id_positive": "customer_id > 0",
    "customer_name_present": "customer_name IS NOT NULL",
    "city_present": "city IS NOT NULL",
    "country_present": "country IS NOT NULL",
    "customer_segment_valid": f"customer_segment IN {_SEGMENTS_ALLOWED}",
}


@query(
    "dimension_validate",
    f"""WITH {PARTS}, {BUYERS}
    {_reject_sql("products", _PRODUCT_SQL, "'products' AS table_name, ")} UNION ALL
    {_reject_sql("customers", _CUSTOMER_SQL, "'customers' AS table_name, ")}""",
)
def _(spark, d):
    buyers = r.customer_rules(_SEGMENTS_ALLOWED, ("customer_name", "city", "country"))
    checked = {
        "products": r.reject_counts(fx.products(spark, d), r.product_rules()),
        "customers": r.reject_counts(fx.customers(spark, d), buyers),
    }
    parts = [df.select(F.lit(name).alias("table_name"), "*") for name, df in checked.items()]
    return parts[0].unionByName(parts[1])


_SALE_SQL = {
    "transaction_id_present": "transaction_id IS NOT NULL",
    "customer_id_positive": "customer_id > 0",
    "product_id_positive": "product_id > 0",
    "quantity_positive": "quantity > 0",
    "unit_price_positive": "unit_price > 0",
    "total_amount_positive": "total_amount > 0",
    "transaction_timestamp_present": "transaction_timestamp IS NOT NULL",
    "store_id_positive": "store_id > 0",
    "total_matches": RULE_SQL["total_matches"],
    "payment_method_valid": RULE_SQL["payment_method_valid"],
    "status_valid": RULE_SQL["status_valid"],
}


@query("sale_model_validate", f"WITH {RAW} {_reject_sql('sales_raw', _SALE_SQL)}")
def _(spark, d):
    return r.reject_counts(fx.sales_raw(spark, d), r.sale_model_rules())


# --- de-duplication -------------------------------------------------------------------


@query(
    "dedup_against_existing",
    f"""WITH {CLEAN} SELECT {SALE_COLUMNS}, partition_date FROM clean n
    WHERE partition_date >= '{SPLIT}' AND NOT EXISTS (
      SELECT 1 FROM clean o WHERE o.partition_date < '{SPLIT}'
        AND o.transaction_id = n.transaction_id)""",
)
def _(spark, d):
    stored, new = split(clean(spark, d))
    return shown(silver.anti_dedup(new, stored, "transaction_id", scope="table"), "partition_date")


@query(
    "dedup_in_partition",
    f"""WITH {CLEAN}, sales AS (SELECT *, strftime(transaction_timestamp, '%Y') AS sale_year FROM clean)
    SELECT {SALE_COLUMNS}, sale_year FROM sales n
    WHERE payment_method = 'cash' AND NOT EXISTS (
      SELECT 1 FROM sales o WHERE o.payment_method <> 'cash'
        AND o.sale_year = n.sale_year AND o.transaction_id = n.transaction_id)""",
)
def _(spark, d):
    sales = clean(spark, d).withColumn("sale_year", F.date_format("transaction_timestamp", "yyyy"))
    cash = F.col("payment_method") == "cash"
    fresh = silver.anti_dedup(
        sales.where(cash), sales.where(~cash), "transaction_id", partition_col="sale_year"
    )
    return shown(fresh, "sale_year")


@query(
    "dedup_keep_first",
    f"""WITH {CLEAN}, ranked AS (SELECT *, row_number() OVER (
        PARTITION BY transaction_id ORDER BY transaction_timestamp, customer_id, product_id,
          quantity, unit_price, total_amount, payment_method, store_id, status) AS n FROM clean)
    SELECT {SALE_COLUMNS} FROM ranked WHERE n = 1""",
)
def _(spark, d):
    return shown(silver.keep_first(clean(spark, d), "transaction_id", ["transaction_timestamp"]))


# --- gold -----------------------------------------------------------------------------


def summary(spark, d, distinct=tuple(gold.DISTINCT)) -> DataFrame:
    return gold.daily_sales_summary(clean(spark, d), distinct)


def per_day(spark, d) -> DataFrame:
    return gold.product_performance(clean(spark, d), fx.products(spark, d), per_day=True)


@query("daily_sales_summary", f"WITH {CLEAN}, {SUMMARY} SELECT * FROM summary")
def _(spark, d):
    return summary(spark, d)


def priced(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_selling_price", round_half_up(F.col("avg_selling_price"), MEAN_DIGITS))


@query(
    "product_performance",
    f"""WITH {CLEAN}, {PARTS}, {performance()}
    SELECT * FROM performance""",
)
def _(spark, d):
    return priced(gold.product_performance(clean(spark, d), fx.products(spark, d)))


@query(
    "customer_segments",
    f"""WITH {CLEAN}, {BUYERS}, {SEGMENTS}
    SELECT * REPLACE (strftime(last_purchase_date, '%Y-%m-%d %H:%M:%S') AS last_purchase_date,
      strftime(first_purchase_date, '%Y-%m-%d %H:%M:%S') AS first_purchase_date) FROM segments""",
)
def _(spark, d):
    out = gold.customer_segments(clean(spark, d), fx.customers(spark, d), tiers=fx.TIERS)
    for c in ("last_purchase_date", "first_purchase_date"):
        out = out.withColumn(c, F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    return out


# --- dashboards -----------------------------------------------------------------------


def _newest(column: str, expr: str | None = None) -> str:
    return (
        f"WITH {CLEAN}, {SUMMARY} SELECT {expr or column} AS {column} FROM summary"
        " ORDER BY partition_date DESC LIMIT 1"
    )


@query("kpi_total_revenue", _newest("total_revenue"))
def _(spark, d):
    return reports.latest(summary(spark, d, ()), "partition_date", "total_revenue")


@query("kpi_total_transactions", _newest("total_transactions"))
def _(spark, d):
    return reports.latest(summary(spark, d, ["total_transactions"]), "partition_date", "total_transactions")


@query("kpi_unique_customers", _newest("unique_customers"))
def _(spark, d):
    return reports.latest(summary(spark, d, ["unique_customers"]), "partition_date", "unique_customers")


@query("kpi_completion_rate", _newest("completion_rate", "completion_rate / 100.0::DOUBLE"))
def _(spark, d):
    return reports.latest_fraction(summary(spark, d, ()), "partition_date", "completion_rate")


@query(
    "daily_revenue_trend",
    f"WITH {CLEAN}, {SUMMARY} SELECT partition_date, total_revenue FROM summary ORDER BY 1",
)
def _(spark, d):
    return reports.trend(summary(spark, d, ()), "partition_date", "total_revenue")


@query(
    "revenue_last7",
    f"""WITH {CLEAN}, {SUMMARY} SELECT partition_date, total_revenue, total_transactions
    FROM summary ORDER BY 1 DESC LIMIT 7""",
)
def _(spark, d):
    return reports.trend(
        summary(spark, d, ["total_transactions"]), "partition_date", "total_revenue", "total_transactions", last=7
    )


@query(
    "top10_products",
    f"""WITH {CLEAN}, {PARTS}, {performance(day=repr(fx.AS_OF_DAY))}
    SELECT product_id, product_name, category, revenue, units_sold FROM performance
    ORDER BY revenue DESC, product_id LIMIT 10""",
)
def _(spark, d):
    day = gold.product_performance(clean(spark, d), fx.products(spark, d), fx.AS_OF_DAY)
    best = reports.top_k(reports.on_day(day, "data_date", fx.AS_OF), "revenue", 10, "product_id")
    return best.select("product_id", "product_name", "category", "revenue", "units_sold")


@query(
    "revenue_by_category",
    f"""WITH {CLEAN}, {PARTS}, {performance()}
    SELECT category, {money("revenue", 28)} AS revenue FROM performance
    GROUP BY category ORDER BY revenue DESC, category""",
)
def _(spark, d):
    return reports.revenue_by_category(
        gold.product_performance(clean(spark, d), fx.products(spark, d))
    )


@query(
    "value_distribution",
    f"""WITH {CLEAN}, {BUYERS}, {SEGMENTS}
    SELECT value_tier, COUNT(*) AS customer_count,
      {money("total_spend", 28)} / COUNT(total_spend) AS avg_spend
    FROM segments GROUP BY value_tier""",
)
def _(spark, d):
    return reports.value_distribution(
        gold.customer_segments(clean(spark, d), fx.customers(spark, d), tiers=fx.TIERS)
    )


@query(
    "weekly_revenue",
    f"""WITH {CLEAN}, {SUMMARY}
    SELECT strftime(date_trunc('week', CAST(partition_date AS DATE)), '%Y-%m-%d') AS week,
      {money("total_revenue", 28)} AS weekly_revenue
    FROM summary GROUP BY 1 ORDER BY 1 DESC LIMIT 12""",
)
def _(spark, d):
    weeks = reports.weekly_revenue(summary(spark, d, ()))
    return weeks.withColumn("week", F.date_format("week", "yyyy-MM-dd"))


@query(
    "category_performance_30d",
    f"""WITH {CLEAN}, {PARTS}, {performance(per_day=True)}
    SELECT category, COUNT(DISTINCT product_id) AS product_count,
      {money("revenue", 28)} AS total_revenue,
      {money("revenue", 28)} / COUNT(revenue) AS avg_product_revenue
    FROM performance
    WHERE CAST(data_date AS DATE) >= DATE '{fx.AS_OF_DAY}' - INTERVAL '30' DAY
    GROUP BY category""",
)
def _(spark, d):
    return reports.category_performance(per_day(spark, d), fx.AS_OF, 30)


@query(
    "cross_layer_join",
    f"""WITH {CLEAN}, {PARTS}, {performance(per_day=True)}, {SUMMARY},
    rows_of AS (SELECT category, data_date, count(*) AS n FROM performance GROUP BY ALL)
    SELECT category, CAST(sum(n * CAST(total_revenue AS DECIMAL(24, 4))) AS DOUBLE) AS category_revenue
    FROM rows_of, summary WHERE data_date = partition_date
    GROUP BY category ORDER BY 2 DESC, 1""",
)
def _(spark, d):
    return reports.cross_layer_join(per_day(spark, d), summary(spark, d, ()))


@query(
    "monthly_metrics",
    f"""WITH {CLEAN} SELECT strftime(transaction_timestamp, '%Y-%m') AS month,
      COUNT(*) AS records, {money("total_amount")} AS total_amount FROM clean GROUP BY 1""",
)
def _(spark, d):
    from lakeops.sources.layers import monthly_metrics

    return monthly_metrics(clean(spark, d), "transaction_timestamp", "total_amount")


@query(
    "scalar_functions",
    f"""SELECT event_id, CAST(event_id AS VARCHAR) AS id_text, CAST(value AS BIGINT) AS whole,
      {half_up("value / 7.0::DOUBLE")} AS rounded, abs(value - 250.0::DOUBLE) AS distance,
      value / NULLIF(event_id % 5, 0) AS ratio,
      CASE WHEN value > 300 THEN 'high' WHEN value > 150 THEN 'mid' ELSE 'low' END AS band,
      event_type IN ('view', 'click') AND value BETWEEN 10 AND 400 AS wanted,
      event_type NOT IN ('error') AS fine,
      strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y%m%d_%H%M%S') AS stamp,
      strftime(date_trunc('week', ts), '%Y-%m-%d') AS week,
      strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day,
      strftime(ts - INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:%S') AS earlier,
      date_diff('microsecond', ts, TIMESTAMP '{fx.EVENTS_AS_OF}') / 3.6e9::DOUBLE AS age_hours,
      json_extract_string(props, '$.k') AS k,
      props LIKE '%"k"%' AS has_k, FALSE AS has_other,
      CASE WHEN length(event_type) > 4 THEN left(event_type, 4) || '...' ELSE event_type END
        AS shortened,
      length(event_type) AS n_chars, event_type || ', ' || CAST(user_id AS VARCHAR) AS joined,
      'Hi ' || event_type || ' #' || CAST(user_id AS VARCHAR) || ' {{{{other}}}}' AS rendered
    FROM events""".replace("{{{{", "{{").replace("}}}}", "}}"),
)
def _(spark, d):
    from lakeops.functions import text, times

    fields = F.from_json("props", "map<string,string>")
    ts, value = F.col("ts"), F.col("value")
    as_of = times.wall_clock(fx.EVENTS_AS_OF)
    filled = F.create_map(
        F.lit("who"), F.col("event_type"), F.lit("id"), F.col("user_id").cast("string")
    )
    return fx.table(spark, d, "events").select(
        "event_id",
        F.col("event_id").cast("string").alias("id_text"),
        F.rint(value).cast("bigint").alias("whole"),
        round_half_up(value / 7.0).alias("rounded"),
        F.abs(value - 250.0).alias("distance"),
        (value / F.nullif(F.col("event_id") % 5, F.lit(0))).alias("ratio"),
        F.when(value > 300, "high").when(value > 150, "mid").otherwise("low").alias("band"),
        (F.col("event_type").isin("view", "click") & value.between(10, 400)).alias("wanted"),
        (~F.col("event_type").isin("error")).alias("fine"),
        times.iso_day(ts).alias("day"),
        times.run_stamp(ts).alias("stamp"),
        F.date_format(F.date_trunc("week", ts), "yyyy-MM-dd").alias("week"),
        F.date_format(F.date_add(F.to_date(ts), 1), "yyyy-MM-dd").alias("next_day"),
        times.iso_text(ts - F.make_dt_interval(mins=F.lit(90))).alias("earlier"),
        times.hours_between(times.parse_iso(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), as_of)
        .alias("age_hours"),
        F.try_element_at(fields, F.lit("k")).alias("k"),
        F.map_contains_key(fields, "k").alias("has_k"),
        F.map_contains_key(fields, "other").alias("has_other"),
        text.preview(F.col("event_type"), 4).alias("shortened"),
        F.length("event_type").cast("bigint").alias("n_chars"),
        F.array_join(F.array("event_type", F.col("user_id").cast("string")), ", ").alias("joined"),
        text.render(F.lit("Hi {{who}} #{{ id }} {{other}}"), filled).alias("rendered"),
    )
