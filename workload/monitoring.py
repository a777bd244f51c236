"""Metric, lineage and prompt queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.numeric import round_half_up
from lakeops.operators import lineage, metric_names, metrics, prompts as pr
from lakeops.streaming.rates import windowed_rate
from workload import fixtures as fx
from workload.registry import cte, half_up, query

_SAMPLES = cte("samples", fx.SAMPLES, "events")
_HOUR = "date_trunc('hour', ts)"


@query(
    "counter_rate",
    f"""WITH {_SAMPLES}, stepped AS (SELECT *, lag(counter) OVER (
        PARTITION BY stage, table_name ORDER BY ts, event_id) AS before FROM samples),
    steps AS (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN counter >= before
        THEN counter - before ELSE counter END AS step FROM stepped)
    SELECT stage, strftime({_HOUR}, '%Y-%m-%d %H:%M:%S') AS window_start, SUM(step) AS increase,
      SUM(step) / 3600.0::DOUBLE AS rate FROM steps GROUP BY 1, 2""",
)
def _(spark, d):
    out = metrics.counter_rate(
        fx.samples(spark, d), "ts", "counter", ["stage", "table_name"], 3600, ["event_id"], ["stage"]
    )
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "windowed_rate",
    f"""WITH {_SAMPLES} SELECT layer, strftime({_HOUR}, '%Y-%m-%d %H:%M:%S') AS window_start,
      SUM(records) AS increase, SUM(records) / 3600.0::DOUBLE AS rate FROM samples GROUP BY 1, 2""",
)
def _(spark, d):
    out = windowed_rate(fx.samples(spark, d), "ts", "records", ["layer"], 3600)
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "records_by_layer",
    f'WITH {_SAMPLES} SELECT layer, table_name AS "table", SUM(records) AS records FROM samples GROUP BY 1, 2',
)
def _(spark, d):
    labels = F.create_map(
        F.lit("layer"), F.col("layer"), F.lit("table"), F.col("table_name")
    ).alias("labels")
    named = F.lit(metrics.RECORDS_PROCESSED).alias("name")
    return metrics.records_by_layer(
        fx.samples(spark, d).select("ts", named, labels, F.col("records").alias("value"))
    )


@query(
    "gauge_latest",
    f"""WITH {_SAMPLES} SELECT table_name, arg_max(up, struct_pack(t := ts, e := event_id)) AS value,
      strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_ts,
      CASE arg_max(up, struct_pack(t := ts, e := event_id)) WHEN 1 THEN 'UP' WHEN 0 THEN 'DOWN' END AS state
    FROM samples GROUP BY 1""",
)
def _(spark, d):
    out = metrics.gauge_latest(
        fx.samples(spark, d), ["table_name"], value="up", tie=["event_id"], mapping=metrics.UP_DOWN
    )
    return out.withColumn("last_ts", F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "failure_status",
    f"""WITH {_SAMPLES}, n AS (SELECT table_name, COUNT(*) AS failures FROM samples WHERE failed GROUP BY 1)
    SELECT CAST(coalesce(SUM(failures), 0) AS BIGINT) AS failures,
      CASE WHEN SUM(failures) >= 5 THEN 'red' WHEN SUM(failures) >= 1 THEN 'yellow' ELSE 'green' END AS colour,
      CASE WHEN coalesce(SUM(failures), 0) < 1 THEN 'PASS' ELSE 'FAIL' END AS state FROM n""",
)
def _(spark, d):
    failures = fx.samples(spark, d).where("failed").groupBy("table_name")
    return metrics.failure_status(failures.agg(F.count("*").alias("failures")))


@query(
    "mean_stage_duration",
    f"""WITH {_SAMPLES} SELECT stage, COUNT(seconds) AS runs, {half_up("SUM(seconds)", 4)} AS total_seconds,
      {half_up("SUM(seconds) / COUNT(seconds)", 4)} AS mean_seconds FROM samples GROUP BY 1""",
)
def _(spark, d):
    out = metrics.mean_stage_duration(fx.samples(spark, d), "stage", "seconds")
    for c in ("total_seconds", "mean_seconds"):
        out = out.withColumn(c, round_half_up(F.col(c), 4))
    return out


@query(
    "stage_duration_hourly",
    f"""WITH {_SAMPLES} SELECT stage, strftime({_HOUR}, '%Y-%m-%d %H:%M:%S') AS window_start, COUNT(seconds) AS runs,
      {half_up("SUM(seconds) / COUNT(seconds)", 4)} AS mean_seconds FROM samples GROUP BY 1, 2""",
)
def _(spark, d):
    out = metrics.mean_stage_duration(fx.samples(spark, d), "stage", "seconds", "ts", 3600)
    at = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return out.select("stage", at, "runs", round_half_up(F.col("mean_seconds"), 4).alias("mean_seconds"))


@query(
    "success_rate",
    f"""WITH {_SAMPLES} SELECT layer, strftime({_HOUR}, '%Y-%m-%d %H:%M:%S') AS window_start,
      COUNT(*) AS runs,
      {half_up("100.0::DOUBLE * COUNT(*) FILTER (WHERE NOT failed) / COUNT(*)")} AS success_pct
    FROM samples GROUP BY 1, 2""",
)
def _(spark, d):
    out = metrics.success_rate(fx.samples(spark, d), "ts", ~F.col("failed"), 3600, ["layer"])
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "request_outcome",
    f"""WITH {_SAMPLES} SELECT table_name, COUNT(*) AS requests, COUNT(*) FILTER (WHERE failed) AS errors,
      COUNT(*) - COUNT(*) FILTER (WHERE failed) AS successful FROM samples GROUP BY 1""",
)
def _(spark, d):
    return metrics.request_outcome(fx.samples(spark, d), F.col("failed"), ["table_name"])


_PART = "split_part(raw_name, '.', {})".format
_RUN = f"'dag_id=' || {_PART(3)} || ',run_id=' || {_PART(4)}"
_TASK = f"'dag_id=' || {_PART(3)} || ',task_id=' || {_PART(4)} || ',run_id=' || {_PART(5)}"
_KIND = "event_id % 13"


@query(
    "metric_name_mapping",
    f"""WITH {cte("names", fx.METRIC_NAMES, "events")}
    SELECT event_id, CASE {_KIND} WHEN 0 THEN 'airflow_dagrun_duration' WHEN 1 THEN 'airflow_dagrun_success'
        WHEN 2 THEN 'airflow_dagrun_failed' WHEN 3 THEN 'airflow_task_duration'
        WHEN 4 THEN 'airflow_task_failed' WHEN 5 THEN 'airflow_scheduler_heartbeat'
        WHEN 6 THEN 'airflow_executor_open_slots' WHEN 7 THEN 'airflow_pool_used_slots'
        WHEN 8 THEN 'airflow_dag_processing_last_duration' WHEN 9 THEN 'airflow_ti_duration'
        ELSE replace(raw_name, '.', '_') END AS metric,
      CASE WHEN {_KIND} <= 2 THEN {_RUN} WHEN {_KIND} <= 4 THEN {_TASK}
        WHEN {_KIND} = 7 THEN 'pool=' || {_PART(4)} WHEN {_KIND} = 8 THEN 'dag_file=' || {_PART(4)}
        WHEN {_KIND} = 9 THEN {_TASK} || ',try_number=2'
        WHEN {_KIND} = 10 THEN 'type=' || {_PART(2)} ELSE '' END AS labels,
      {_KIND} <= 10 AS matched FROM names""",
)
def _(spark, d):
    mapped = metric_names.map_metric_names(fx.metric_names(spark, d), "raw_name")
    pairs = F.transform(F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return mapped.select("event_id", "metric", F.array_join(pairs, ",").alias("labels"), "matched")


# --- lineage --------------------------------------------------------------------------

_EDGES = """edges AS (
  SELECT DISTINCT 'supplier:' || l_suppkey AS src, 'stock:' || l_partkey AS task, NULL AS dst FROM lineitem UNION ALL
  SELECT DISTINCT NULL, 'stock:' || l_partkey, 'part:' || l_partkey FROM lineitem UNION ALL
  SELECT DISTINCT 'part:' || l_partkey, 'order:' || l_orderkey, NULL FROM lineitem UNION ALL
  SELECT DISTINCT NULL, 'order:' || o_orderkey, 'customer:' || o_custkey FROM orders)"""


@query("lineage_edges", f"WITH {_EDGES} SELECT * FROM edges")
def _(spark, d):
    return lineage.lineage_edges(fx.lineage_jobs(spark, d))


def _closure(start: str, into: str, out_of: str) -> str:
    return f"""WITH RECURSIVE {_EDGES}, hops AS (SELECT a.{into} AS x, b.{out_of} AS y
        FROM edges a JOIN edges b ON a.task = b.task WHERE a.{into} IS NOT NULL AND b.{out_of} IS NOT NULL),
      reach AS (SELECT '{start}' AS dataset, 0 AS depth UNION
        SELECT y, depth + 1 FROM reach JOIN hops ON dataset = x)
    SELECT dataset, MIN(depth) AS depth FROM reach WHERE depth > 0 GROUP BY 1"""


@query("lineage_impact", _closure("supplier:7", "src", "dst"))
def _(spark, d):
    edges = lineage.lineage_edges(fx.lineage_jobs(spark, d))
    return lineage.lineage_impact(edges, "supplier:7")


@query("lineage_root_cause", _closure("customer:5", "dst", "src"))
def _(spark, d):
    edges = lineage.lineage_edges(fx.lineage_jobs(spark, d))
    return lineage.lineage_impact(edges, "customer:5", "upstream")


# --- prompts --------------------------------------------------------------------------

_PROMPTS = f"""{cte("raw_prompts", fx.PROMPTS, "conversations WHERE role = 'assistant'")},
  prompts AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY created_at, prompt) AS version
    FROM raw_prompts)"""
_INPUTS = cte("inputs", fx.PROMPT_INPUTS, "conversations WHERE role = 'user'")


def _newest(label: str | None = None) -> str:
    keep = f"WHERE label = '{label}'" if label else ""
    return f"(SELECT * FROM prompts {keep} QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1)"


def _filled(column: str) -> str:
    return f"replace(replace({column}, '{{{{pergunta}}}}', question), '{{{{ pergunta }}}}', question)"


def versioned(spark, d):
    return pr.version_prompts(fx.prompts(spark, d))


@query("prompt_versions", f"WITH {_PROMPTS} SELECT name, version, created_at, prompt FROM prompts")
def _(spark, d):
    return versioned(spark, d).select("name", "version", "created_at", "prompt")


@query(
    "prompt_new_version",
    f"""WITH {_PROMPTS} SELECT name, version, label AS labels, concat(label, ', t', version % 3) AS tags,
      CASE WHEN length(prompt) > 40 THEN left(prompt, 40) || '...' ELSE prompt END AS preview,
      length(prompt) AS length FROM prompts""",
)
def _(spark, d):
    """A further version takes its label from the first of its tags."""
    tagged = versioned(spark, d).withColumn(
        "tags", F.concat("labels", F.array(F.concat(F.lit("t"), (F.col("version") % 3).cast("string"))))
    )
    shown = pr.listing(pr.new_version(tagged.drop("labels")), preview_chars=40)
    return shown.withColumn("length", F.col("length").cast("bigint"))


@query(
    "prompt_by_label",
    f"""WITH {_PROMPTS} SELECT 'v1' AS asked, name, version, prompt, coalesce(CAST(temperature AS DOUBLE), 0.7) AS temperature,
      300 AS max_tokens FROM {_newest("v1")}
    UNION ALL SELECT 'latest', name, version, prompt, coalesce(CAST(temperature AS DOUBLE), 0.7), 300 FROM {_newest()}""",
)
def _(spark, d):
    registry = versioned(spark, d)
    columns = ["name", "version", "prompt", "temperature", "max_tokens"]
    found = [
        pr.prompt_by_label(registry, label).select(F.lit(label).alias("asked"), *columns)
        for label in ("v1", pr.LATEST)
    ]
    return found[0].unionByName(found[1])


@query(
    "prompt_render",
    f"""WITH {_PROMPTS}, {_INPUTS} SELECT i.conv_id, i.turn, name, {_filled("prompt")} AS rendered
    FROM inputs i JOIN {_newest()} p USING (name)""",
)
def _(spark, d):
    newest = pr.prompt_by_label(versioned(spark, d))
    out = pr.render(newest, fx.prompt_inputs(spark, d), {"pergunta": F.col("question")})
    return out.select("conv_id", "turn", "name", "rendered")


@query(
    "prompt_compare",
    f"""WITH {_PROMPTS}, {_INPUTS}, sides AS (SELECT i.conv_id, i.turn, name,
        {_filled("a.prompt")} AS text_a, {_filled("b.prompt")} AS text_b
      FROM inputs i JOIN {_newest("v1")} a USING (name) JOIN {_newest("v2")} b USING (name))
    SELECT *, length(text_a) AS length_a, length(text_b) AS length_b,
      CASE WHEN length(text_a) > 200 THEN left(text_a, 200) || '...' ELSE text_a END AS preview_a,
      CASE WHEN length(text_b) > 200 THEN left(text_b, 200) || '...' ELSE text_b END AS preview_b
    FROM sides""",
)
def _(spark, d):
    variables = {"pergunta": F.col("question")}
    out = pr.compare(versioned(spark, d), fx.prompt_inputs(spark, d), variables, "v1", "v2")
    return out.drop("question")
