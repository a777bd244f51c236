"""Reading, writing, merging and incremental loading, each compared with its end state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from lakeops.functions.numeric import money_sum, round_half_up
from lakeops.operators import reports, silver
from lakeops.operators.checks import silver_sales_checks
from lakeops.operators.rules import accept, customer_rules, sales_rules
from lakeops.plans.gold_run import run_gold
from lakeops.plans.sales_run import SalesConfig, run_sales
from lakeops.schemas import GOLD_TABLES, SALES_RAW, SALES_SILVER
from lakeops.session import materialise, new_scratch
from lakeops.sources import daily, layers, tables
from lakeops.sources.json_files import land_raw, read_json
from lakeops.sources.upsert import upsert
from lakeops.streaming.ingest import ingest_incremental, silver_handler
from workload import fixtures as fx
from workload.registry import (
    BUYERS,
    CLEAN,
    MEAN_DIGITS,
    PARTS,
    RAW,
    SALE_COLUMNS,
    SUMMARY,
    money,
    performance,
    query,
    segments,
)
from workload.sales import SPLIT, clean, shown, split

_MONTHLY = f"{CLEAN}, monthly AS (SELECT *, strftime(transaction_timestamp, '%Y-%m') AS sale_month FROM clean)"


def monthly(spark, d) -> DataFrame:
    return clean(spark, d).withColumn("sale_month", F.date_format("transaction_timestamp", "yyyy-MM"))


@query("json_roundtrip", f"WITH {RAW} SELECT {SALE_COLUMNS} FROM sales_raw")
def _(spark, d):
    root = new_scratch(spark, "bronze")
    landed = land_raw(fx.sales_raw(spark, d), root, "sales", "20010630_000000")
    back = read_json(spark, landed.path, SALES_RAW)
    return shown(silver.to_silver_schema(back, None, fx.AS_OF))


@query("partition_scan", f"WITH {_MONTHLY} SELECT {SALE_COLUMNS}, sale_month FROM monthly WHERE sale_month = '2000-01'")
def _(spark, d):
    path = new_scratch(spark, "silver")
    sales = monthly(spark, d)
    tables.append_partitioned(sales, path, ["sale_month"])
    return shown(tables.read_partition(spark, path, "sale_month", "2000-01", sales.schema), "sale_month")


_TABLES = ("customer", "documents", "events", "lineitem", "orders", "part")


@query(
    "table_size",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _TABLES
    ),
)
def _(spark, d):
    return tables.table_size(spark, {t: f"{d}/{t}.parquet" for t in _TABLES})


@query("append_partitioned", f"WITH {_MONTHLY} SELECT {SALE_COLUMNS}, sale_month FROM monthly")
def _(spark, d):
    path = new_scratch(spark, "silver")
    sales = monthly(spark, d)
    for part in split(sales):
        tables.append_partitioned(part, path, ["sale_month"])
    return shown(tables.read_table(spark, path), "sale_month")


# --- upsert ---------------------------------------------------------------------------

_BY_PRODUCT = f"""SELECT product_id, strftime(transaction_timestamp, '%Y') AS sale_year,
  COUNT(*) AS sales, {money("total_amount")} AS revenue FROM clean"""


@query(
    "upsert_merge",
    f"""WITH {CLEAN},
    target AS ({_BY_PRODUCT} WHERE partition_date < '{SPLIT}' GROUP BY 1, 2),
    source AS ({_BY_PRODUCT} WHERE partition_date >= '1999-01-01' GROUP BY 1, 2)
    SELECT * FROM source UNION ALL
    SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s
      WHERE s.product_id = t.product_id AND s.sale_year = t.sale_year)""",
)
def _(spark, d):
    path = new_scratch(spark, "gold")
    sales = clean(spark, d)
    year = F.date_format("transaction_timestamp", "yyyy").alias("sale_year")

    def measured(df: DataFrame) -> DataFrame:
        return df.groupBy("product_id", year).agg(
            F.count("*").alias("sales"), money_sum(F.col("total_amount")).alias("revenue")
        )

    keys, parts = ["product_id", "sale_year"], ["sale_year"]
    upsert(spark, measured(sales.where(F.col("partition_date") < SPLIT)), path, keys, parts)
    upsert(spark, measured(sales.where(F.col("partition_date") >= "1999-01-01")), path, keys, parts)
    return tables.read_table(spark, path)


_LAST_SALE = "SELECT store_id, MAX(strftime(transaction_timestamp, '%Y')) AS last_year, COUNT(*) AS sales FROM clean"


@query(
    "upsert_moves_partition",
    f"""WITH {CLEAN},
    target AS ({_LAST_SALE} WHERE partition_date < '{SPLIT}' GROUP BY store_id),
    source AS ({_LAST_SALE} WHERE partition_date >= '{SPLIT}' GROUP BY store_id)
    SELECT * FROM source UNION ALL
    SELECT * FROM target WHERE store_id NOT IN (SELECT store_id FROM source)""",
)
def _(spark, d):
    path = new_scratch(spark, "gold")
    sales = clean(spark, d)

    def measured(df: DataFrame) -> DataFrame:
        last = F.max(F.date_format("transaction_timestamp", "yyyy"))
        return df.groupBy("store_id").agg(last.alias("last_year"), F.count("*").alias("sales"))

    for part in (F.col("partition_date") < SPLIT, F.col("partition_date") >= SPLIT):
        upsert(spark, measured(sales.where(part)), path, ["store_id"], ["last_year"])
    return tables.read_table(spark, path)


# --- incremental ----------------------------------------------------------------------

RUN_DATES = ("2001-06-28", "2001-06-29", "2001-06-30")
_ORDER = (
    "customer_id, product_id, quantity, unit_price, total_amount, transaction_timestamp,"
    " payment_method, store_id, status"
)


INGESTED_ONCE = f"""WITH {CLEAN}, ranked AS (SELECT *, store_id % 3 AS run, row_number() OVER (
        PARTITION BY transaction_id ORDER BY store_id % 3, {_ORDER}) AS n FROM clean)
    SELECT {SALE_COLUMNS}, CASE run WHEN 0 THEN '{RUN_DATES[0]}' WHEN 1 THEN '{RUN_DATES[1]}'
      ELSE '{RUN_DATES[2]}' END AS run_date FROM ranked WHERE n = 1"""


@query("incremental_ingest", INGESTED_ONCE)
def _(spark, d):
    root = new_scratch(spark, "incremental")
    raw, n = fx.sales_raw(spark, d), fx.max_product_id(spark, d)
    for i, run_date in enumerate(RUN_DATES):
        land_raw(raw.where(F.col("store_id") % 3 == i), root, "sales", run_date.replace("-", ""))
        handler = silver_handler(f"{root}/silver", fx.AS_OF, n, run_date, scope="table")
        ingest_incremental(spark, f"{root}/sales", SALES_RAW, f"{root}/checkpoint", handler)
    stored = tables.read_table(spark, f"{root}/silver", SALES_SILVER)
    return shown(stored.withColumn("run_date", F.col("partition_date")), "run_date")


@query("idempotent_rerun", f"WITH {CLEAN} SELECT {SALE_COLUMNS} FROM clean")
def _(spark, d):
    root = new_scratch(spark, "rerun")
    land_raw(fx.sales_raw(spark, d), root, "sales", "20010630")
    handler = silver_handler(
        f"{root}/silver", fx.AS_OF, fx.max_product_id(spark, d), fx.AS_OF_DAY, within_batch=False
    )
    for attempt in ("first", "again"):
        ingest_incremental(spark, f"{root}/sales", SALES_RAW, f"{root}/{attempt}", handler)
    return shown(tables.read_table(spark, f"{root}/silver", SALES_SILVER))


# --- daily files ----------------------------------------------------------------------


@query(
    "parallel_arrays_to_rows",
    """WITH zipped AS (SELECT vec_id, unnest(range(len(embedding))) AS position,
         unnest(embedding) AS v FROM embeddings)
    SELECT vec_id, position, CAST(v AS DOUBLE) AS value FROM zipped""",
)
def _(spark, d):
    vectors = fx.table(spark, d, "embeddings")
    position = F.sequence(F.lit(0).cast("bigint"), F.size("embedding").cast("bigint") - 1)
    nested = vectors.select(
        "vec_id", F.struct(position.alias("position"), F.col("embedding").alias("value")).alias("daily")
    )
    rows = daily.parallel_arrays_to_rows(nested, "daily")
    return rows.withColumn("value", F.col("value").cast("double"))


_EVENT_FIELDS = "event_id, user_id, event_type, value"


@query(
    "csv_daily_roundtrip",
    f"SELECT {_EVENT_FIELDS}, strftime(ts, '%Y-%m-%d') AS date FROM events",
)
def _(spark, d):
    path = new_scratch(spark, "csv")
    events = fx.table(spark, d, "events").select(
        "event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("date")
    )
    daily.write_daily_csv(events, path, "date")
    return daily.read_daily_csv(spark, path, events.schema)


@query(
    "day_slice",
    f"""SELECT {_EVENT_FIELDS} FROM events
    WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'""",
)
def _(spark, d):
    day = daily.day_slice(fx.table(spark, d, "events"), "ts", "2024-01-15")
    return day.select("event_id", "user_id", "event_type", "value")


@query(
    "backfill_days",
    """WITH days AS (SELECT strftime(unnest(generate_series(DATE '2023-12-30', DATE '2024-02-03',
         INTERVAL 1 DAY)), '%Y-%m-%d') AS date),
    loaded AS (SELECT strftime(ts, '%Y-%m-%d') AS date, COUNT(*) AS n FROM events GROUP BY 1)
    SELECT date, coalesce(n, 0) AS stored_rows,
      CASE WHEN n IS NULL THEN 'skipped' ELSE 'success' END AS status
    FROM days LEFT JOIN loaded USING (date)""",
)
def _(spark, d):
    events = fx.table(spark, d, "events")
    path = new_scratch(spark, "backfill")
    return daily.backfill_days(events, "ts", "2023-12-30", "2024-02-03", path)


# --- layers ---------------------------------------------------------------------------


@query(
    "partition_inventory",
    f"WITH {_MONTHLY} SELECT sale_month, COUNT(*) AS row_count FROM monthly GROUP BY 1",
)
def _(spark, d):
    """Rows per partition of a stored table, counted from what was written."""
    path = new_scratch(spark, "silver")
    tables.append_partitioned(monthly(spark, d), path, ["sale_month"])
    stored = tables.read_table(spark, path)
    return stored.groupBy("sale_month").agg(F.count("*").alias("row_count"))


@query(
    "used_storage",
    f"WITH {CLEAN} SELECT 'sales' AS layer, TRUE AS plausible, COUNT(*) AS row_count FROM clean",
)
def _(spark, d):
    """Gigabytes of a table that was just stored: between a byte and a kilobyte a row."""
    path = new_scratch(spark, "used")
    tables.write_parquet(clean(spark, d), f"{path}/sales")
    used = layers.used_gigabytes(layers.lake_inventory(spark, {"sales": f"{path}/sales"}))
    n = tables.table_size(spark, {"sales": f"{path}/sales"})
    size = F.col("used_gb") * 1024.0**3 / F.col("row_count")
    both = n.join(F.broadcast(used), F.lit(True), "left")  # one row each
    return both.select(F.col("table_name").alias("layer"), size.between(1, 1024).alias("plausible"), "row_count")


@query("parquet_upload", f"WITH {RAW} SELECT {SALE_COLUMNS} FROM sales_raw")
def _(spark, d):
    path = new_scratch(spark, "upload")
    typed = silver.to_silver_schema(fx.sales_raw(spark, d), None, fx.AS_OF)
    for _ in range(2):  # the second upload replaces the first
        tables.write_parquet(typed, path)
    return shown(tables.read_table(spark, path))


@query(
    "catalog_tables",
    f"""WITH {_MONTHLY}, counted AS (SELECT sale_month, COUNT(*) AS n FROM monthly GROUP BY 1)
    SELECT 'sales' AS table_name, sale_month, n FROM counted UNION ALL
    SELECT 'months', sale_month, 1 FROM counted""",
)
def _(spark, d):
    """Registered locations, their listing, and a batch that SQL sees as a view."""
    root, db = new_scratch(spark, "catalog"), f"lake_{uuid.uuid4().hex[:12]}"
    tables.append_partitioned(monthly(spark, d), f"{root}/sales", ["sale_month"])
    tables.write_parquet(monthly(spark, d).select("sale_month").distinct(), f"{root}/months")
    for name in ("sales", "months"):
        layers.register_table(spark, db, name, f"{root}/{name}")
    with layers.batch_view(layers.list_tables(spark, db)) as view:
        return spark.sql(f"""
            SELECT t.table_name, c.sale_month, c.n FROM {view} t JOIN (
              SELECT 'sales' AS table_name, sale_month, COUNT(*) AS n FROM `{db}`.sales GROUP BY sale_month UNION ALL
              SELECT 'months', sale_month, COUNT(*) FROM `{db}`.months GROUP BY sale_month) c
            ON t.table_name = c.table_name""")


@query(
    "archive_year",
    f"""WITH {CLEAN} SELECT {SALE_COLUMNS}, strftime(transaction_timestamp, '%Y') AS year,
      strftime(transaction_timestamp, '%m') AS month
    FROM clean WHERE year(transaction_timestamp) = 1999""",
)
def _(spark, d):
    path = new_scratch(spark, "archive")
    layers.archive_year(clean(spark, d), "transaction_timestamp", 1999, path)
    return shown(tables.read_table(spark, path), "year", "month")


# --- composed jobs --------------------------------------------------------------------

_DONE = "(SELECT * FROM clean WHERE status = 'completed')"
_GOLD_COUNTS = f"""
  SELECT 'daily_sales_summary' AS step, 'success' AS status, CAST(1 AS BIGINT) AS rows UNION ALL
  SELECT 'product_performance', 'success', (SELECT COUNT(DISTINCT product_id) FROM {_DONE} s
    WHERE product_id IN (SELECT product_id FROM products)) UNION ALL
  SELECT 'customer_segments', 'success', (SELECT COUNT(DISTINCT customer_id) FROM {_DONE} s
    WHERE customer_id IN (SELECT customer_id FROM customers))"""


# The newest day, on which nothing may be completed, and the newest before it on which something is.
_NEWEST = "(SELECT max(partition_date) FROM clean)"
_FULL = f"(SELECT max(partition_date) FROM clean WHERE status = 'completed' AND partition_date < {_NEWEST})"


def _gold_of(spark, d) -> str:
    """Folder of the gold tables of two days, each filled by a run of its own from a silver table."""
    root = new_scratch(spark, "gold-run")
    typed = silver.to_silver_schema(fx.sales_raw(spark, d), None, fx.AS_OF)
    sales = accept(typed, sales_rules(fx.AS_OF, fx.max_product_id(spark, d)))
    per_day = materialise(sales.groupBy("partition_date").agg(F.bool_or(F.col("status") == "completed").alias("done")), "days")
    newest = reports.newest(per_day, "partition_date")
    full = reports.newest(per_day.where(F.col("done") & (F.col("partition_date") < newest)), "partition_date")
    days = [day for day in (full, newest) if day is not None]
    if not days:
        return f"{root}/gold"
    # bounds on the time of sale reach the scan
    sales = daily.between_days(sales, "transaction_timestamp", min(days), max(days))
    tables.append_partitioned(sales, f"{root}/silver", ["partition_date"])
    dims = fx.products(spark, d), fx.customers(spark, d)
    for day in days:
        ran = run_gold(spark, f"{root}/silver", f"{root}/gold", day, *dims, f"{day} 12:00:00", fx.TIERS).collect()
        failed = [f"{r['step']}: {r['detail']}" for r in ran if r["status"] == "failed"]
        if failed:
            raise RuntimeError(f"gold run of {day} failed: {'; '.join(failed)}")
    return f"{root}/gold"


def _gold_table(spark, root: str, name: str) -> DataFrame:
    """A gold table; one that no run has filled has no rows."""
    stored = tables.read_or_none(spark, f"{root}/{name}")
    return spark.createDataFrame([], GOLD_TABLES[name]) if stored is None else stored


def _day_gold(day: str) -> str:
    """Rows of all three gold tables of a day: table, id, numbers, tier, stamps."""
    return f"""SELECT * FROM (WITH {SUMMARY}, {performance(day=day)}, {segments(day)},
    rows_of AS (SELECT 'daily_sales_summary' AS table_name, 0 AS id, total_transactions AS n, total_revenue AS amount,
        avg_transaction_value AS mean, '' AS tier FROM summary WHERE partition_date = {day} UNION ALL
      SELECT 'product_performance', product_id, transaction_count, revenue, avg_selling_price, '' FROM performance UNION ALL
      SELECT 'customer_segments', customer_id, purchase_count, total_spend, avg_order_value, value_tier FROM segments)
    SELECT *, {day} AS data_date, {day} || ' 12:00:00' AS created_at FROM rows_of)"""


@query("gold_run", f"WITH {CLEAN}, {PARTS}, {BUYERS} " + " UNION ALL ".join(_day_gold(day) for day in (_FULL, _NEWEST)))
def _(spark, d):
    """What the runs of two days stored."""
    root = _gold_of(spark, d)
    columns = {
        "daily_sales_summary": (F.lit(0).cast("bigint"), "total_transactions", "total_revenue", "avg_transaction_value", F.lit("")),
        "product_performance": ("product_id", "transaction_count", "revenue", "avg_selling_price", F.lit("")),
        "customer_segments": ("customer_id", "purchase_count", "total_spend", "avg_order_value", "value_tier"),
    }
    parts = []
    for name, (key, n, amount, mean, tier) in columns.items():
        stored = _gold_table(spark, root, name)
        mean = F.col(mean) if name != "product_performance" else round_half_up(F.col(mean), MEAN_DIGITS)
        at = F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at")
        key, tier = (F.col(c) if isinstance(c, str) else c for c in (key, tier))
        parts.append(
            stored.select(
                F.lit(name).alias("table_name"), key.alias("id"), F.col(n).alias("n"), F.col(amount).alias("amount"),
                mean.alias("mean"), tier.alias("tier"), "data_date", at,
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "gold_dashboard",
    f"""WITH {CLEAN}, {PARTS}, {BUYERS}, {SUMMARY}, {performance(day=_NEWEST)}, {segments(_NEWEST)},
    newest AS (SELECT * FROM summary WHERE partition_date = {_NEWEST})
    SELECT 'total_revenue' AS panel, '' AS item, total_revenue AS value FROM newest UNION ALL
    SELECT 'total_transactions', '', CAST(total_transactions AS DOUBLE) FROM newest UNION ALL
    SELECT 'unique_customers', '', CAST(unique_customers AS DOUBLE) FROM newest UNION ALL
    SELECT 'completion_rate', '', completion_rate / 100.0::DOUBLE FROM newest UNION ALL
    SELECT 'revenue_by_category', category, {money("revenue", 28)} FROM performance GROUP BY category UNION ALL
    SELECT 'customers_by_tier', value_tier, CAST(COUNT(*) AS DOUBLE) FROM segments GROUP BY value_tier UNION ALL
    SELECT 'spend_by_tier', value_tier, {money("total_spend", 28)} / COUNT(*) FROM segments GROUP BY value_tier""",
)
def _(spark, d):
    """The panels of the newest day, read from stored gold tables of which they open one partition."""
    root = _gold_of(spark, d)
    summary, performance_, segments_ = (
        _gold_table(spark, root, t) for t in ("daily_sales_summary", "product_performance", "customer_segments")
    )
    day = reports.newest(summary, "partition_date")
    shown_day = reports.on_day(summary, "partition_date", day)

    def panel(name: str, df: DataFrame, item: str | None, value: str) -> DataFrame:
        item = F.lit("") if item is None else F.col(item)
        return df.select(F.lit(name).alias("panel"), item.alias("item"), F.col(value).cast("double").alias("value"))

    tiers = reports.value_distribution(segments_, day)
    parts = [
        *[panel(c, shown_day, None, c) for c in ("total_revenue", "total_transactions", "unique_customers")],
        panel("completion_rate", reports.latest_fraction(shown_day, "partition_date", "completion_rate"), None, "completion_rate"),
        panel("revenue_by_category", reports.revenue_by_category(performance_, day), "category", "revenue"),
        panel("customers_by_tier", tiers, "value_tier", "customer_count"),
        panel("spend_by_tier", tiers, "value_tier", "avg_spend"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "upsert_repeated",
    f"""WITH {CLEAN},
    target AS ({_LAST_SALE} WHERE partition_date < '{SPLIT}' GROUP BY store_id),
    source AS ({_LAST_SALE} WHERE partition_date >= '{SPLIT}' GROUP BY store_id)
    SELECT * FROM source UNION ALL
    SELECT * FROM target WHERE store_id NOT IN (SELECT store_id FROM source)""",
)
def _(spark, d):
    """A merge that died after writing the new partitions and before taking away the old rows."""
    path = new_scratch(spark, "gold")
    sales = clean(spark, d)

    def measured(df: DataFrame) -> DataFrame:
        last = F.max(F.date_format("transaction_timestamp", "yyyy"))
        return df.groupBy("store_id").agg(last.alias("last_year"), F.count("*").alias("sales"))

    upsert(spark, measured(sales.where(F.col("partition_date") < SPLIT)), path, ["store_id"], ["last_year"])
    source = materialise(measured(sales.where(F.col("partition_date") >= SPLIT)), "source")
    tables.append_partitioned(source, path, ["last_year"])  # as far as it came
    upsert(spark, source, path, ["store_id"], ["last_year"])
    return tables.read_table(spark, path)


@query(
    "sales_run",
    f"""WITH {CLEAN}, {PARTS}, {BUYERS}, repeated AS (
      SELECT COUNT(*) AS n FROM (SELECT 1 FROM clean GROUP BY transaction_id HAVING COUNT(*) > 1))
    SELECT 'ingest_to_bronze' AS step, 'success' AS status, (SELECT COUNT(*) FROM sales_raw) AS rows UNION ALL
    SELECT 'load_products', 'loaded', 0 UNION ALL
    SELECT 'load_customers', 'loaded', 0 UNION ALL
    SELECT 'transform_to_silver', 'success', (SELECT COUNT(*) FROM clean) UNION ALL
    SELECT 'validate_quality', CASE WHEN n > 0 THEN 'failed' ELSE 'success' END,
      CASE WHEN n > 0 THEN 1 ELSE 0 END FROM repeated UNION ALL
    SELECT 'aggregate_to_gold', 'success', 0 UNION ALL {_GOLD_COUNTS}""",
)
def _(spark, d):
    root = new_scratch(spark, "sales-run")
    wide = silver_sales_checks(
        max_rows=10**15,
        max_product_id=10**15,
        max_customer_id=10**15,
        amount_range=(0, 1e9),
        quantity_range=(0, 1e9),
        max_amount=1e12,
        fresh_hours=1e9,
    )
    cfg = SalesConfig(
        bronze=f"{root}/bronze",
        silver=f"{root}/silver",
        gold=f"{root}/gold",
        metrics=f"{root}/metrics",
        as_of=fx.AS_OF,
        max_product_id=fx.max_product_id(spark, d),
        checks=wide,
        tiers=fx.TIERS,
        customer_rules=customer_rules(
            ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
            ("customer_name", "city", "country"),
        ),
    )
    out = run_sales(spark, cfg, fx.sales_raw(spark, d), fx.products(spark, d), fx.customers(spark, d))
    return out.select("step", "status", "rows")


@query(
    "sales_run_repeated",
    f"""WITH {CLEAN}
    SELECT 'bronze' AS layer, '' AS status, (SELECT COUNT(*) FROM sales_raw) AS n, CAST(NULL AS DOUBLE) AS amount UNION ALL
    SELECT 'silver', status, COUNT(*), {money("total_amount")} FROM clean GROUP BY status""",
)
def _(spark, d):
    """What two runs under one stamp leave in bronze and silver: what one would."""
    root = new_scratch(spark, "sales-again")
    cfg = SalesConfig(
        bronze=f"{root}/bronze", silver=f"{root}/silver", gold=f"{root}/gold", metrics=f"{root}/metrics",
        as_of=fx.AS_OF, max_product_id=fx.max_product_id(spark, d), checks_enabled=False, aggregate=False,
        customer_rules=customer_rules(
            ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), ("customer_name", "city", "country")
        ),
    )
    inputs = fx.sales_raw(spark, d), fx.products(spark, d), fx.customers(spark, d)
    for _ in range(2):
        run_sales(spark, cfg, *inputs)
    stored = tables.read_table(spark, f"{root}/silver/sales", SALES_SILVER)
    bronze = spark.read.option("recursiveFileLookup", True).text(f"{root}/bronze/sales").agg(
        F.lit("bronze").alias("layer"), F.lit("").alias("status"), F.count("*").alias("n"), F.lit(None).cast("double").alias("amount")
    )
    kept = stored.groupBy(F.lit("silver").alias("layer"), "status").agg(
        F.count("*").alias("n"), money_sum(F.col("total_amount")).alias("amount")
    )
    return bronze.unionByName(kept)
