"""Collects queries together with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.session import configure
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def cte(name: str, view: list[tuple[str, str]], source: str) -> str:
    columns = ", ".join(f"{expr} AS {column}" for column, expr in view)
    return f"{name} AS (SELECT {columns} FROM {source})"


def money(column: str, digits: int = 18) -> str:
    """Exact sum of a money column as a double; 28 digits for amounts that are sums."""
    return f"CAST(SUM(CAST({column} AS DECIMAL({digits}, 4))) AS DOUBLE)"


def half_up(expr: str, digits: int = 2) -> str:
    scale = 10**digits
    return f"(floor(({expr}) * {scale}.0::DOUBLE + 0.5::DOUBLE) / {scale}.0::DOUBLE)"


RAW = cte("sales_raw", fx.SALES, "lineitem JOIN orders ON l_orderkey = o_orderkey")
PARTS = cte("products", fx.PRODUCTS, "part")
BUYERS = cte(
    "customers",
    fx.CUSTOMERS,
    "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)

RULE_SQL = {
    "transaction_id_present": "transaction_id IS NOT NULL",
    "customer_id_present": "customer_id IS NOT NULL",
    "product_id_present": "product_id IS NOT NULL",
    "transaction_timestamp_present": "transaction_timestamp IS NOT NULL",
    "not_in_future": "transaction_timestamp IS NULL"
    f" OR transaction_timestamp <= TIMESTAMP '{fx.AS_OF}'",
    "quantity_positive": "quantity > 0",
    "total_amount_positive": "total_amount > 0",
    "total_matches": "abs(total_amount - quantity * unit_price) <= 0.01",
    "payment_method_valid": "payment_method IN ('credit_card', 'debit_card', 'cash', 'digital_wallet')",
    "status_valid": "status IN ('completed', 'pending', 'cancelled')",
    "product_in_range": "product_id IS NULL OR"
    " (product_id > 0 AND product_id <= (SELECT count(*) FROM part))",
}
_KEEP = " AND ".join(f"({p})" for p in RULE_SQL.values())
CLEAN = (
    f"{RAW}, clean AS (SELECT *, strftime(transaction_timestamp, '%Y-%m-%d') AS partition_date"
    f" FROM sales_raw WHERE {_KEEP})"
)
SALE_COLUMNS = (
    "transaction_id, customer_id, product_id, quantity, unit_price, total_amount,"
    " strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS sold_at,"
    " payment_method, store_id, status"
)

# Gold tables, from their definitions: facts are folded by id, then meet the dimension.
# Means of plain numbers depend on the order of summation; queries and SQL round them.
MEAN_DIGITS = 6


def mean(column: str) -> str:
    return half_up(f"avg({column})", MEAN_DIGITS)


SUMMARY = f"""by_day AS (
  SELECT partition_date AS day, count(*) AS n, count(*) FILTER (status = 'completed') AS done,
    count(*) FILTER (status = 'cancelled') AS dropped, sum(quantity)::BIGINT AS items,
    {money("total_amount")} AS revenue, count(total_amount) AS priced
  FROM clean GROUP BY day),
who AS (SELECT partition_date AS day, count(DISTINCT transaction_id) AS sales, count(DISTINCT customer_id) AS buyers
  FROM clean GROUP BY day),
summary AS (SELECT day AS partition_date, sales AS total_transactions, buyers AS unique_customers,
    revenue AS total_revenue, revenue / priced AS avg_transaction_value, items AS total_items_sold,
    done AS completed_transactions, dropped AS cancelled_transactions,
    {half_up("100.0::DOUBLE * done / n")} AS completion_rate
  FROM by_day JOIN who USING (day))"""


def performance(per_day: bool = False, day: str | None = None) -> str:
    """``day`` is an SQL expression."""
    keys = "product_id, partition_date AS data_date" if per_day else "product_id"
    only = f" AND partition_date = {day}" if day else ""
    shown = ", data_date" if per_day else ""
    return f"""sold AS (
  SELECT {keys}, count(transaction_id) AS n, sum(quantity)::BIGINT AS units, {money("total_amount")} AS earned,
    {mean("unit_price")} AS price, min(unit_price) AS least, max(unit_price) AS most
  FROM clean WHERE status = 'completed'{only} GROUP BY ALL),
performance AS (SELECT product_id, product_name, category, n AS transaction_count, units AS units_sold,
    earned AS revenue, price AS avg_selling_price, least AS min_price, most AS max_price{shown}
  FROM products JOIN sold USING (product_id))"""


def segments(day: str | None = None) -> str:
    only = f" AND partition_date = {day}" if day else ""
    levels = " ".join(f"WHEN spent > {limit} THEN '{name}'" for limit, name in fx.TIERS)
    return f"""bought AS (
  SELECT customer_id, count(transaction_id) AS n, {money("total_amount")} AS spent, count(total_amount) AS priced,
    max(transaction_timestamp) AS newest, min(transaction_timestamp) AS oldest
  FROM clean WHERE status = 'completed'{only} GROUP BY customer_id),
segments AS (SELECT customer_id, customer_name, customer_segment, city, country, n AS purchase_count,
    spent AS total_spend, spent / priced AS avg_order_value, newest AS last_purchase_date,
    oldest AS first_purchase_date, CASE {levels} ELSE 'Low Value' END AS value_tier
  FROM customers JOIN bought USING (customer_id))"""


SEGMENTS = segments()
