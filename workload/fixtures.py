"""Inputs of the registered queries, derived from the given tables.

A view is a list of (column, expression) over base tables. The expressions are read by
both engines, so query and oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = "2001-06-30 00:00:00"
AS_OF_DAY = AS_OF[:10]
EVENTS_AS_OF = "2024-02-01 00:00:00"
TIERS = ((500000, "High Value"), (250000, "Medium Value"))

_DEFECT = "(l_orderkey * 7 + l_linenumber * 13) % 100"

SALES = [
    ("transaction_id", "concat(l_orderkey, '-', l_linenumber)"),
    ("customer_id", f"CASE WHEN {_DEFECT} = 0 THEN NULL ELSE o_custkey + 1 END"),
    ("product_id", f"CASE WHEN {_DEFECT} = 1 THEN -1 - l_partkey ELSE l_partkey + 1 END"),
    ("quantity", f"CASE WHEN {_DEFECT} = 2 THEN 0 ELSE CAST(l_quantity AS BIGINT) END"),
    ("unit_price", "l_extendedprice / l_quantity"),
    (
        "total_amount",
        f"CASE WHEN {_DEFECT} = 3 THEN -l_extendedprice"
        f" WHEN {_DEFECT} = 4 THEN l_extendedprice + 1 ELSE l_extendedprice END",
    ),
    ("transaction_timestamp", f"CASE WHEN {_DEFECT} = 5 THEN NULL ELSE l_shipdate END"),
    (
        "payment_method",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'debit_card'"
        " WHEN '3-MEDIUM' THEN 'cash' WHEN '4-NOT SPECIFIED' THEN 'digital_wallet'"
        " ELSE 'bitcoin' END",
    ),
    ("store_id", "l_suppkey + 1"),
    (
        "status",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'"
        " ELSE 'cancelled' END",
    ),
]

PRODUCTS = [
    ("product_id", "p_partkey + 1"),
    ("product_name", "p_name"),
    ("category", "p_type"),
    ("base_price", "p_retailprice"),
    ("stock_quantity", "CAST(p_size AS BIGINT)"),
]

CUSTOMERS = [
    ("customer_id", "c_custkey + 1"),
    ("customer_name", "c_name"),
    ("customer_segment", "c_mktsegment"),
    ("city", "r_name"),
    ("country", "n_name"),
]

# One stream per event type; ids repeat in one stream, a field has gaps in all.
ENVELOPES = [
    ("stream", "event_type"),
    (
        "raw_id",
        "CASE WHEN event_type = 'error' AND event_id % 50 = 0 THEN 'shared'"
        " ELSE concat(event_id, '') END",
    ),
    ("user_id", "user_id"),
    ("note", "CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 9 = 0 THEN NULL ELSE props END"),
    ("hint", "CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END"),
]

# Landed lines of two streams are damaged: fields of the envelope are missing, ids empty,
# times written in other ISO forms or not readable. (what is wrong, which events)
DAMAGE = [
    ("no_time", "event_type = 'click' AND event_id % 37 = 0"),
    ("no_id", "event_type = 'click' AND event_id % 41 = 1"),
    ("no_data", "event_type = 'signup' AND event_id % 43 = 2"),
    ("empty_id", "event_type = 'signup' AND event_id % 47 = 3"),
    ("compact_time", "event_id % 5 = 1"),
    ("nano_time", "event_id % 5 = 2"),
    ("bad_time", "event_id % 53 = 4"),
]

# Samples of a running job: counters that restart, stage durations, check failures.
SAMPLES = [
    ("event_id", "event_id"),
    ("ts", "ts"),
    ("layer", "CASE WHEN event_type IN ('view', 'click') THEN 'bronze'"
              " WHEN event_type = 'purchase' THEN 'gold' ELSE 'silver' END"),
    ("table_name", "concat('t', user_id % 17)"),
    ("stage", "event_type"),
    ("counter", "CAST(event_id % 700 AS DOUBLE)"),
    ("records", "CAST(event_id % 100 AS DOUBLE)"),
    ("seconds", "value"),
    ("failed", "event_type = 'error'"),
    ("up", "CAST(event_id % 2 AS DOUBLE)"),
]

METRIC_NAMES = [
    ("event_id", "event_id"),
    (
        "raw_name",
        "CASE event_id % 13"
        " WHEN 0 THEN concat('airflow.dagrun.', event_type, '.r', user_id, '.duration')"
        " WHEN 1 THEN concat('airflow.dagrun.', event_type, '.r', user_id, '.success')"
        " WHEN 2 THEN concat('airflow.dagrun.', event_type, '.r', user_id, '.failed')"
        " WHEN 3 THEN concat('airflow.task.', event_type, '.t', user_id, '.r', event_id, '.duration')"
        " WHEN 4 THEN concat('airflow.task.', event_type, '.t', user_id, '.r', event_id, '.failed')"
        " WHEN 5 THEN 'airflow.scheduler.heartbeat'"
        " WHEN 6 THEN 'airflow.executor.open_slots'"
        " WHEN 7 THEN concat('airflow.pool.used_slots.p', user_id)"
        " WHEN 8 THEN concat('airflow.dag_processing.last_duration.f', user_id)"
        " WHEN 9 THEN concat('airflow.ti.', event_type, '.t', user_id, '.r', event_id, '.2.duration')"
        " WHEN 10 THEN concat('airflow.', event_type)"
        " WHEN 11 THEN concat('airflow.', event_type, '.unknown')"
        " ELSE concat('other.', event_type) END",
    ),
]

# Every assistant turn is the next version of its conversation's prompt.
PROMPTS = [
    ("name", "concat('conv_', conv_id % 23)"),
    ("prompt", "concat('Q: {{pergunta}} / ', text, ' / {{ pergunta }} {{nome}}')"),
    ("created_at", "conv_id * 1000 + turn"),
    ("temperature", "CASE WHEN turn % 3 = 0 THEN NULL ELSE 0.5 END"),
    ("label", "CASE WHEN turn % 4 = 1 THEN 'v1' ELSE 'v2' END"),
]
PROMPT_INPUTS = [
    ("name", "concat('conv_', conv_id % 23)"),
    ("conv_id", "conv_id"),
    ("turn", "turn"),
    ("question", "text"),
]

ANNOTATIONS = [
    ("doc_id", "labels.doc_id"),
    ("annotator", "source"),
    ("lang", "lang"),
    ("quality", "quality"),
    ("not_toxic", "1 - toxic"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project(df: DataFrame, view: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in view])


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    # two fact tables: a shuffled join that spills at any size, and that spreads the work
    # of everything after it over all cores even when a table is one small file
    return project(lines.join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey")), SALES)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "part"), PRODUCTS)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    return project(joined, CUSTOMERS)


def max_product_id(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "part").count()


def envelope_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    records = project(events, [*ENVELOPES, ("ts", "ts")])
    return records.withColumn(
        "extracted_at", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ).drop("ts")


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stream, value): envelopes as text, some of them damaged."""
    from lakeops.sources.envelopes import DATA, EXTRACTED_AT, RAW_ID

    events = project(table(spark, sf_dir, "events"), [*ENVELOPES, ("ts", "ts"), *DAMAGE])
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    compact = F.date_format("ts", "yyyyMMdd'T'HHmmss.SSSSSS")
    time = (
        F.when(F.col("bad_time"), "yesterday")
        .when(F.col("compact_time"), compact)
        .when(F.col("nano_time"), F.concat(plain, F.lit("789Z")))
        .otherwise(plain)
    )
    raw_id = F.when(F.col("empty_id"), "").otherwise(F.col("raw_id"))
    quoted = lambda c: F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    data = F.to_json(F.struct("raw_id", "user_id", "note", "hint"), {"ignoreNullFields": "false"})
    fields = [
        F.when(~F.col("no_id"), F.concat(F.lit(f'"{RAW_ID}":'), quoted(raw_id))),
        F.when(~F.col("no_time"), F.concat(F.lit(f'"{EXTRACTED_AT}":'), quoted(time))),
        F.when(~F.col("no_data"), F.concat(F.lit(f'"{DATA}":'), data)),
    ]
    line = F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*fields)), ","), F.lit("}"))
    return events.select("stream", line.alias("value"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), SAMPLES)


def metric_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), METRIC_NAMES)


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    settings = F.struct(
        F.col("temperature").cast("double").alias("temperature"),
        F.lit(None).cast("bigint").alias("max_tokens"),
    )
    return project(turns, PROMPTS).select(
        "name", "prompt", "created_at", settings.alias("config"), F.array("label").alias("labels")
    )


def prompt_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    return project(turns, PROMPT_INPUTS)


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    joined = labels.join(documents.withColumnRenamed("doc_id", "d_id"), F.expr("doc_id = d_id"))
    return project(joined, [("doc_id", "doc_id"), *ANNOTATIONS[1:]])


def lineage_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stocking a part reads its suppliers; an order reads its parts, writes its customer."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    nothing = F.array().cast("array<string>")

    def job(df: DataFrame, task: str, reads: str | None, writes: str | None) -> DataFrame:
        side = lambda e: nothing if e is None else F.array(F.expr(e))
        return df.select(
            F.expr(task).alias("task"), side(reads).alias("reads"), side(writes).alias("writes")
        )

    stock = "concat('stock:', l_partkey)"
    parts = [
        job(lines, stock, "concat('supplier:', l_suppkey)", "concat('part:', l_partkey)"),
        job(lines, "concat('order:', l_orderkey)", "concat('part:', l_partkey)", None),
        job(orders, "concat('order:', o_orderkey)", None, "concat('customer:', o_custkey)"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
