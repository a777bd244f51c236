"""State over streams, stored keys and sketches, nested records, catch-up, agreement, SQL functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from lakeops.functions.numeric import round_half_up
from lakeops.functions.sql import register_functions
from lakeops.operators import annotations as an, nested, rules as r, sketches
from lakeops.schemas import SALES_RAW, SALES_SILVER
from lakeops.session import materialise, new_scratch
from lakeops.sources import daily, layers, tables
from lakeops.sources.envelopes import DATA, EXTRACTED_AT, RAW_ID
from lakeops.sources.json_files import land_raw
from lakeops.sources.key_index import KeyIndex
from lakeops.streaming.counters import counter_steps
from lakeops.streaming.ingest import indexed_handler, ingest_incremental
from lakeops.streaming.repeats import drop_repeats
from workload import fixtures as fx
from workload.lake import INGESTED_ONCE, RUN_DATES
from workload.registry import BUYERS, CLEAN, SEGMENTS, cte, half_up, query
from workload.sales import FUNNEL, SPLIT, clean, sales_rules, shown, split, typed

# --- streams --------------------------------------------------------------------------


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what a stream has so far to a Parquet table."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


_SAMPLES = cte("samples", fx.SAMPLES, "events")
_HOUR = "date_trunc('hour', ts)"
#: Samples are landed week by week; of the last six hours of a week some come a week later.
_LATENESS = 12
_WEEKS = 6


@query(
    "counter_rate_stream",
    f"""WITH {_SAMPLES}, stepped AS (SELECT *, lag(counter) OVER (
        PARTITION BY stage, table_name ORDER BY ts, event_id) AS before FROM samples),
    steps AS (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN counter >= before
        THEN counter - before ELSE counter END AS step FROM stepped)
    SELECT stage, strftime({_HOUR}, '%Y-%m-%d %H:%M:%S') AS window_start, SUM(step) AS increase,
      SUM(step) / 3600.0::DOUBLE AS rate FROM steps
    WHERE {_HOUR} + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM samples) - INTERVAL {_LATENESS} HOUR GROUP BY 1, 2""",
)
def _(spark, d):
    """The hours that the watermark has passed, as ``counter_rate`` has them."""
    root = new_scratch(spark, "counters")
    read = fx.samples(spark, d).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "stage", "table_name", "counter")
    seconds = F.unix_timestamp("ts") - F.unix_timestamp(F.lit("2024-01-01").cast("timestamp"))
    week = F.floor(seconds / (7 * 86400))
    late = (seconds % (7 * 86400) >= 7 * 86400 - 6 * 3600) & (F.col("event_id") % 3 == 0)
    landing = F.least(F.greatest(week + late.cast("int"), F.lit(0)), F.lit(_WEEKS - 1))
    stored = materialise(read.withColumn("_week", landing), "samples")
    for i in range(_WEEKS):
        stored.where(F.col("_week") == i).drop("_week").write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(read.schema).parquet(f"{root}/landed")
        steps = counter_steps(stream, "ts", "counter", ["stage", "table_name"], ["event_id"], f"{_LATENESS} hours", "60 days")
        drain(steps, f"{root}/steps", f"{root}/checkpoint")
    steps = spark.read.schema("stage string, table_name string, ts timestamp, step double").parquet(f"{root}/steps")
    closed = read.agg((F.max("ts") - F.expr(f"INTERVAL {_LATENESS} HOURS")).alias("until")).first()["until"]
    hours = steps.groupBy("stage", F.window("ts", "1 hour")).agg(F.sum("step").alias("increase"))
    return hours.where(F.col("window.end") <= F.lit(closed)).select(
        "stage", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "increase", (F.col("increase") / 3600.0).alias("rate")
    )


@query("stream_without_repeats", "SELECT event_id, user_id, event_type FROM events")
def _(spark, d):
    """Every seventh event is sent again with the next batch, and some a third time."""
    root = new_scratch(spark, "repeats")
    events = fx.table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    batch = F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 5)
    stored = materialise(events.withColumn("_batch", batch), "events")
    first, last = stored.agg(F.min("_batch"), F.max("_batch")).first()
    for i in range(first, last + 1):
        again = (F.col("_batch") == i - 1) & (F.col("event_id") % 7 == 0)
        third = (F.col("_batch") == i - 2) & (F.col("event_id") % 21 == 0)
        sent = stored.where((F.col("_batch") == i) | again | third).drop("_batch")
        sent.write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/landed")
        drain(drop_repeats(stream, ["event_id"], "ts", "15 days"), f"{root}/once", f"{root}/checkpoint")
    return spark.read.schema(events.schema).parquet(f"{root}/once").select("event_id", "user_id", "event_type")


@query("incremental_indexed", INGESTED_ONCE)
def _(spark, d):
    """As ``incremental_ingest``, against bucketed keys; the last batch is handed over twice."""
    root = new_scratch(spark, "indexed")
    raw, n = fx.sales_raw(spark, d), fx.max_product_id(spark, d)
    index = KeyIndex(spark, f"{root}/keys", "transaction_id", buckets=8)
    again = None
    for i, run_date in enumerate(RUN_DATES):
        land_raw(raw.where(F.col("store_id") % 3 == i), root, "sales", run_date.replace("-", ""))
        handler = indexed_handler(f"{root}/silver", index, fx.AS_OF, n, run_date)

        def handle(batch, batch_id, handler=handler):
            nonlocal again
            handler(batch, batch_id)
            again = batch_id

        ingest_incremental(spark, f"{root}/sales", SALES_RAW, f"{root}/checkpoint", handle)
    last = spark.read.schema(SALES_RAW).json(f"{root}/sales/*{RUN_DATES[-1].replace('-', '')}*")
    handler(last, again)
    index.compact()
    stored = tables.read_table(spark, f"{root}/silver", T.StructType([*SALES_SILVER.fields, T.StructField("batch", T.LongType())]))
    known = stored.join(index.stored().select("transaction_id"), "transaction_id", "left_semi")
    return shown(known.withColumn("run_date", F.col("partition_date")), "run_date")


# --- sketches -------------------------------------------------------------------------

_CLOSE = sketches.error_bound()


@query(
    "unique_customers_weekly",
    f"""WITH {CLEAN} SELECT strftime(date_trunc('week', transaction_timestamp), '%Y-%m-%d') AS week, COUNT(*) AS sales,
      COUNT(DISTINCT customer_id) AS customers, TRUE AS estimate_within_bound FROM clean GROUP BY 1""",
)
def _(spark, d):
    """Customers of every week from stored daily sketches, held against the exact count."""
    sales = clean(spark, d)
    path = new_scratch(spark, "sketches")
    tables.write_parquet(sketches.daily_sketches(sales, "customer_id"), path)
    week = F.date_format(F.date_trunc("week", F.to_date("partition_date")), "yyyy-MM-dd")
    estimated = sketches.distinct_over(tables.read_table(spark, path), week, name="week")
    exact = sales.groupBy(week.alias("week")).agg(F.count_distinct("customer_id").alias("customers"))
    close = F.abs(F.col("distinct_values") - F.col("customers")) <= F.ceil(_CLOSE * F.col("customers"))
    return estimated.join(exact, "week").select("week", F.col("rows").alias("sales"), "customers", close.alias("estimate_within_bound"))


# --- nested records -------------------------------------------------------------------

# (path, absent when, null when, empty when); a parent that is absent or null has no children
_NESTED = {
    "id": ("false", "false", "false"),
    "user": ("event_id % 10 = 0", "event_id % 10 = 1", "false"),
    "user.login": ("event_id % 6 = 0", "event_id % 6 = 1", "event_id % 6 = 2"),
    "user.plan": ("false", "event_id % 4 = 3", "false"),
    "user.plan.name": ("event_id % 5 = 0", "false", "event_id % 5 = 1"),
}


def _nested_text() -> str:
    """The JSON text of an event, as a Spark SQL expression."""

    def member(path: str, value: str) -> str:
        absent, null, empty = _NESTED[path]
        name = path.rpartition(".")[2]
        return f"""CASE WHEN {absent} THEN NULL WHEN {null} THEN '"{name}":null' WHEN {empty} THEN '"{name}":""'
            ELSE concat('"{name}":', {value}) END"""

    name = member("user.plan.name", """'"basic"'""")
    plan = member("user.plan", f"concat('{{', concat_ws(',', '\"seats\":2', {name}), '}}')")
    login = member("user.login", "concat('\"u', user_id, '\"')")
    user = member("user", f"concat('{{', concat_ws(',', {login}, {plan}), '}}')")
    record = f"concat('{{', concat_ws(',', concat('\"id\":', event_id), {user}), '}}')"
    return f"""concat('{{"{RAW_ID}":"', event_id, '","{EXTRACTED_AT}":"2024-01-01T00:00:00","{DATA}":', {record}, '}}')"""


def _nested_sql() -> str:
    rows, alive = [], {"": "TRUE"}
    for path, (absent, null, empty) in [*_NESTED.items(), ("user.plan.seats", ("false", "false", "false"))]:
        parent = alive[path.rpartition(".")[0]]
        alive[path] = f"{parent} AND NOT ({absent}) AND NOT ({null})"
        count = lambda c: f"COUNT(*) FILTER ({parent} AND {c})"
        there = f"NOT ({absent}) AND NOT ({null})"
        rows.append(
            f"SELECT event_type AS stream, '{path}' AS path, COUNT(*) FILTER ({parent}) AS parents, {count(f'({absent})')} AS absent,"
            f" {count(f'NOT ({absent}) AND ({null})')} AS nulls, {count(f'{there} AND ({empty})')} AS empty,"
            f" {count(f'{there} AND NOT ({empty})')} AS filled FROM events GROUP BY event_type"
        )
    return " UNION ALL ".join(rows)


@query("nested_completeness", _nested_sql())
def _(spark, d):
    lines = fx.table(spark, d, "events").selectExpr("event_type AS stream", f"{_nested_text()} AS value")
    path = new_scratch(spark, "nested")
    lines.write.partitionBy("stream").option("compression", "gzip").text(path)
    return nested.completeness_by_path(nested.open_nested(spark.read.text(path)))


# --- counts during the write ----------------------------------------------------------


@query("funnel_observed", FUNNEL)
def _(spark, d):
    stored, _new = split(clean(spark, d))
    path = new_scratch(spark, "observed")
    counts = r.observed_funnel(
        typed(spark, d), sales_rules(spark, d), stored, "transaction_id", lambda df: tables.write_parquet(df, path)
    )
    kept = tables.read_table(spark, path).agg(F.count(F.lit(1)).alias("records_written"))
    names = ("records_read", "records_cleaned", "duplicates_removed")
    return kept.select("records_written", *[F.lit(counts[n]).cast("bigint").alias(n) for n in names])


# --- catch-up -------------------------------------------------------------------------

_SPANS = "(DATE '2023-12-30', DATE '2024-01-03', 4), (DATE '2024-01-06', DATE '2024-01-10', 4), (DATE '2024-01-11', DATE '2024-02-04', 24)"


@query(
    "catch_up",
    f"""WITH spans(start, after, days) AS (VALUES {_SPANS})
    SELECT strftime(start, '%Y-%m-%d') AS start, strftime(after, '%Y-%m-%d') AS after, days,
      (SELECT COUNT(*) FROM events WHERE ts >= start AND ts < after) AS rows,
      (SELECT COUNT(*) FROM events WHERE ts >= DATE '2023-12-30' AND ts < DATE '2024-02-04') AS stored_rows FROM spans""",
)
def _(spark, d):
    """Two days' loads are there; the third call loads what they left out, the fourth nothing."""
    events, root = fx.table(spark, d, "events"), new_scratch(spark, "catch-up")
    load = lambda a, b: daily.catch_up(events, "ts", a, b, f"{root}/days", f"{root}/ledger")
    load("2024-01-03", "2024-01-05")
    load("2024-01-10", "2024-01-10")
    caught = load("2023-12-30", "2024-02-03").unionByName(load("2023-12-30", "2024-02-03"))
    schema = T.StructType([*events.schema.fields, T.StructField("date", T.StringType())])
    stored = tables.read_or_none(spark, f"{root}/days", schema)
    stored = 0 if stored is None else stored.count()
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return caught.select(day("start"), day("after"), "days", "rows", F.lit(stored).cast("bigint").alias("stored_rows"))


# --- agreement ------------------------------------------------------------------------

_GIVEN = """given AS (
  SELECT doc_id, 'first' AS annotator, quality AS label FROM labels UNION ALL
  SELECT doc_id, 'second', CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END FROM labels UNION ALL
  SELECT doc_id, 'third', CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN 2 ELSE quality END FROM labels)"""


@query(
    "chance_corrected_agreement",
    f"""WITH {_GIVEN}, cells AS (SELECT doc_id, label, COUNT(*) AS n FROM given WHERE label IS NOT NULL GROUP BY 1, 2),
    items AS (SELECT doc_id, SUM(n) AS m, SUM(n * (n - 1)) AS pairs FROM cells GROUP BY 1 HAVING SUM(n) > 1),
    seen AS (SELECT COUNT(*) AS items, SUM(m) AS n, AVG(pairs / (m * (m - 1))) AS agreement,
      SUM(m * (1 - pairs / (m * (m - 1)))) / SUM(m) AS apart FROM items),
    classes AS (SELECT label, SUM(n) AS n FROM cells JOIN items USING (doc_id) GROUP BY 1),
    chance AS (SELECT SUM(CAST(n AS DOUBLE) * n) AS squares FROM classes)
    SELECT items, CAST(n AS BIGINT) AS annotations, {half_up("agreement", 6)} AS agreement,
      {half_up("(agreement - squares / (n * n)) / (1 - squares / (n * n))", 6)} AS fleiss_kappa,
      {half_up("1 - apart / (1 - (squares - n) / (n * (n - 1)))", 6)} AS krippendorff_alpha FROM seen, chance""",
)
def _(spark, d):
    labels = fx.table(spark, d, "labels")
    second = F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END")
    third = F.expr("CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN 2 ELSE quality END")
    given = labels.select("doc_id", F.explode(F.array(F.col("quality").cast("bigint"), second.cast("bigint"), third.cast("bigint"))).alias("label"))
    out = an.chance_corrected(an.class_counts(given, "doc_id", "label"))
    rounded = [round_half_up(F.col(c), 6).alias(c) for c in ("agreement", "fleiss_kappa", "krippendorff_alpha")]
    return out.select("items", "annotations", *rounded)


@query(
    "productivity_by_day",
    """WITH per_day AS (SELECT event_type AS annotator, CAST(ts AS DATE) AS day, COUNT(*) AS annotations FROM events GROUP BY 1, 2)
    SELECT annotator, strftime(day, '%Y-%m-%d') AS day, annotations,
      CAST(SUM(annotations) OVER (PARTITION BY annotator ORDER BY day) AS BIGINT) AS total FROM per_day""",
)
def _(spark, d):
    out = an.productivity_by_day(fx.table(spark, d, "events"), "event_type", "ts")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


# --- SQL functions --------------------------------------------------------------------


@query("segments_in_sql", f"WITH {CLEAN}, {BUYERS}, {SEGMENTS} SELECT customer_id, purchase_count, total_spend, {half_up('avg_order_value')} AS avg_order_value, value_tier FROM segments")
def _(spark, d):
    """Customer segments in plain SQL over views, with the registered functions."""
    register_functions(spark, fx.TIERS)
    with layers.batch_view(clean(spark, d), "sales") as sales, layers.batch_view(fx.customers(spark, d), "customers") as customers:
        return spark.sql(f"""
            SELECT customer_id, purchase_count, total_spend, half_up(total_spend / priced, 2) AS avg_order_value,
              value_tier(total_spend) AS value_tier
            FROM (SELECT customer_id, COUNT(transaction_id) AS purchase_count, CAST(SUM(money(total_amount)) AS DOUBLE) AS total_spend,
                COUNT(total_amount) AS priced FROM {sales} WHERE status = 'completed' GROUP BY customer_id)
            JOIN {customers} USING (customer_id)""")
