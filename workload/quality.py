"""Table checks, envelope checks, promotion and annotation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from lakeops.functions.numeric import round_half_up
from lakeops.operators import annotations as an, checks as dq, envelope_checks as ec
from lakeops.plans.gated import check_and_promote
from lakeops.session import new_scratch
from lakeops.sources import envelopes as ev
from workload import fixtures as fx
from workload.registry import CLEAN, MEAN_DIGITS, RAW, cte, half_up, query
from workload.sales import clean

# --- table checks ---------------------------------------------------------------------


def _check_sql(source: str, bounds: dict) -> str:
    """One SELECT per silver check: (name, metric, value, passes)."""
    count = "CAST(COUNT(*) FILTER (WHERE {}) AS DOUBLE)"
    units = "AVG({0})"
    low_a, high_a = bounds.get("amount_range", (50, 2000))
    low_q, high_q = bounds.get("quantity_range", (1, 10))
    zero = "v <= 0"
    age = (
        f"date_diff('microsecond', MAX(transaction_timestamp), TIMESTAMP '{fx.AS_OF}')"
        " / 3.6e9::DOUBLE"
    )
    no_columns = "0.0::DOUBLE"
    repeated = (
        f"(SELECT CAST(COUNT(*) AS DOUBLE) FROM (SELECT 1 FROM {source}"
        " WHERE transaction_id IS NOT NULL GROUP BY transaction_id HAVING COUNT(*) > 1))"
    )
    checks = [
        ("Table has data", "row_count", "CAST(COUNT(*) AS DOUBLE)", "v > 0"),
        ("Prevent data explosion", "row_count", "CAST(COUNT(*) AS DOUBLE)",
         f"v < {bounds.get('max_rows', 10000)}"),
        ("Ensure sales schema integrity", "schema", no_columns, zero),
        ("No missing transaction IDs", "missing_count", count.format("transaction_id IS NULL"), zero),
        ("No missing customer IDs", "missing_count", count.format("customer_id IS NULL"), zero),
        ("No missing product IDs", "missing_count", count.format("product_id IS NULL"), zero),
        ("No missing timestamps", "missing_count",
         count.format("transaction_timestamp IS NULL"), zero),
        ("No negative quantities", "failed_rows", count.format("quantity <= 0"), zero),
        ("No negative amounts", "failed_rows", count.format("total_amount <= 0"), zero),
        ("No zero quantities", "failed_rows", count.format("quantity = 0"), zero),
        ("Total amount matches calculation", "failed_rows",
         count.format("abs(total_amount - quantity * unit_price) > 0.01::DOUBLE"), zero),
        ("No duplicate transactions", "duplicate_count", repeated, zero),
        ("Data is recent (within 2 hours)", "freshness", age, f"v < {bounds.get('fresh_hours', 2)}"),
        ("Valid payment methods", "failed_rows", count.format(
            "payment_method NOT IN ('credit_card', 'debit_card', 'cash', 'digital_wallet')"), zero),
        ("Valid status values", "failed_rows",
         count.format("status NOT IN ('completed', 'pending', 'cancelled')"), zero),
        ("Average transaction value in expected range", "avg", units.format("total_amount"),
         f"v >= {low_a} AND v <= {high_a}"),
        ("Average quantity in expected range", "avg", units.format("quantity"),
         f"v >= {low_q} AND v <= {high_q}"),
        ("No extremely high transactions (fraud detection)", "max", "MAX(total_amount)",
         f"v < {bounds.get('max_amount', 5000)}"),
        ("Product ID in valid range", "failed_rows", count.format(
            f"product_id < 1 OR product_id > {bounds.get('max_product_id', 50)}"), zero),
        ("Customer ID in valid range", "failed_rows", count.format(
            f"customer_id < 1 OR customer_id > {bounds.get('max_customer_id', 1000)}"), zero),
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{metric}' AS metric, {half_up('v', MEAN_DIGITS)} AS value, {passes} AS passed"
        f" FROM (SELECT {value} AS v{'' if value in (repeated, no_columns) else f' FROM {source}'})"
        for name, metric, value, passes in checks
    )
    counted = "metric IN ('missing_count', 'failed_rows', 'duplicate_count')"
    return (
        f"report AS (SELECT *, CASE WHEN {counted} THEN CAST(value AS BIGINT) ELSE 0 END"
        f" AS failed_rows FROM ({rows}))"
    )


EXAMPLE = dq.silver_sales_checks(**dq.EXAMPLE_BOUNDS)


def rounded(report: DataFrame) -> DataFrame:
    return report.withColumn("value", round_half_up(F.col("value"), MEAN_DIGITS))


@query("dq_report", f"WITH {CLEAN}, {_check_sql('clean', {})} SELECT * FROM report")
def _(spark, d):
    return rounded(dq.run_checks(clean(spark, d), EXAMPLE, fx.AS_OF))


_WIDE = {
    "max_rows": 10**12,
    "max_product_id": 10**6,
    "max_customer_id": 10**9,
    "amount_range": (50, 200000),
    "quantity_range": (1, 100),
    "fresh_hours": 2,
    "max_amount": 1000000,
}


@query(
    "dq_report_widened",
    f"WITH {CLEAN}, {_check_sql('clean', _WIDE)} SELECT * FROM report",
)
def _(spark, d):
    return rounded(dq.run_checks(clean(spark, d), dq.silver_sales_checks(**_WIDE), fx.AS_OF))


@query(
    "dq_failed_checks",
    f"WITH {RAW}, {_check_sql('sales_raw', _WIDE)} SELECT check_name, failed_rows FROM report WHERE NOT passed",
)
def _(spark, d):
    report = dq.run_checks(fx.sales_raw(spark, d), dq.silver_sales_checks(**_WIDE), fx.AS_OF)
    return report.where(~F.col("passed")).select("check_name", "failed_rows")


@query(
    "dq_summary",
    f"""WITH {CLEAN}, {_check_sql('clean', {})}
    SELECT CASE WHEN COUNT(*) FILTER (WHERE NOT passed) > 0 THEN 'failed' ELSE 'success' END AS status,
      COUNT(*) AS checks_run, COUNT(*) FILTER (WHERE NOT passed) AS checks_failed,
      string_agg(check_name, '; ' ORDER BY check_name) FILTER (WHERE NOT passed) AS failed_checks
    FROM report""",
)
def _(spark, d):
    report = dq.run_checks(clean(spark, d), EXAMPLE, fx.AS_OF)
    names = F.array_join("failed_checks", "; ")
    return dq.summarise(report).withColumn("failed_checks", names)


@query(
    "dq_failure_counts",
    f"""WITH {CLEAN}, {_check_sql('clean', {})}, again AS (
      WITH {_check_sql('sales_raw', _WIDE)} SELECT * FROM report)
    SELECT check_name, COUNT(*) AS failures FROM (SELECT * FROM report UNION ALL SELECT * FROM again)
    WHERE NOT passed GROUP BY check_name""",
)
def _(spark, d):
    first = dq.run_checks(clean(spark, d), EXAMPLE, fx.AS_OF)
    second = dq.run_checks(fx.sales_raw(spark, d), dq.silver_sales_checks(**_WIDE), fx.AS_OF)
    return dq.failure_counts(first.unionByName(second))


_DOCUMENT_CHECKS = (
    dq.row_count("documents exist", above=0),
    dq.no_missing("text present", "text"),
    dq.no_missing("language present", "lang"),
    dq.no_duplicates("document id unique", "doc_id"),
    dq.no_duplicates("text unique", "text"),
    dq.no_failed_rows("length matches text", "n_chars <> length(text)"),
    dq.average("mean length in range", "n_chars", 1, 100000),
    dq.maximum("no oversized text", "n_chars", 100000),
)


@query(
    "integrity_rules",
    """SELECT 'documents exist' AS check_name, CAST(COUNT(*) AS DOUBLE) AS value, COUNT(*) > 0 AS passed FROM documents UNION ALL
    SELECT 'text present', COUNT(*) FILTER (WHERE text IS NULL), COUNT(*) FILTER (WHERE text IS NULL) = 0 FROM documents UNION ALL
    SELECT 'language present', COUNT(*) FILTER (WHERE lang IS NULL), COUNT(*) FILTER (WHERE lang IS NULL) = 0 FROM documents UNION ALL
    SELECT 'document id unique', COUNT(*), COUNT(*) = 0 FROM (SELECT 1 FROM documents GROUP BY doc_id HAVING COUNT(*) > 1) UNION ALL
    SELECT 'text unique', COUNT(*), COUNT(*) = 0 FROM (SELECT 1 FROM documents GROUP BY text HAVING COUNT(*) > 1) UNION ALL
    SELECT 'length matches text', COUNT(*) FILTER (WHERE n_chars <> length(text)), COUNT(*) FILTER (WHERE n_chars <> length(text)) = 0 FROM documents UNION ALL
    SELECT 'mean length in range', floor(AVG(n_chars) * 1e6 + 0.5) / 1e6, CAST(SUM(n_chars) AS DOUBLE) / COUNT(n_chars) BETWEEN 1 AND 100000 FROM documents UNION ALL
    SELECT 'no oversized text', MAX(n_chars), MAX(n_chars) < 100000 FROM documents""",
)
def _(spark, d):
    report = rounded(dq.run_checks(fx.table(spark, d, "documents"), _DOCUMENT_CHECKS, fx.AS_OF))
    return report.select("check_name", "value", "passed")


# --- envelopes ------------------------------------------------------------------------

_ENV = cte("env", [*fx.ENVELOPES, ("ts", "ts")], "events")
# what is left of the damaged lines
_LEFT = (
    cte("marked", [*fx.ENVELOPES, ("ts", "ts"), *fx.DAMAGE], "events")
    + """, env AS (SELECT * REPLACE (CASE WHEN no_id THEN NULL WHEN empty_id THEN '' ELSE raw_id END AS raw_id),
      CAST(no_id AS INTEGER) + CAST(no_time AS INTEGER) + CAST(no_data AS INTEGER) AS lacking,
      raw_id AS inner_id, CASE WHEN no_time OR bad_time THEN NULL ELSE ts END AS known_ts FROM marked)"""
)
_ENV_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS extracted_at"


def envelopes(spark, d) -> DataFrame:
    """Envelopes as they read back from their JSON text."""
    wrapped = ev.wrap_envelope(fx.envelope_records(spark, d), "raw_id", "extracted_at")
    return ev.open_envelope(ev.to_lines(wrapped))


def landed(spark, d) -> DataFrame:
    """Damaged lines, written and read back."""
    path = new_scratch(spark, "damaged")
    ev.write_lines_gz(fx.damaged_lines(spark, d), path, "overwrite")
    return ev.read_envelope(spark, path)


@query("envelope_wrap", f"WITH {_ENV} SELECT stream, raw_id, {_ENV_TEXT}, user_id, note FROM env")
def _(spark, d):
    wrapped = ev.wrap_envelope(fx.envelope_records(spark, d), "raw_id", "extracted_at")
    return wrapped.select(
        "stream",
        F.col(ev.RAW_ID).alias("raw_id"),
        F.col(ev.EXTRACTED_AT).alias("extracted_at"),
        F.col(f"{ev.DATA}.user_id").alias("user_id"),
        F.col(f"{ev.DATA}.note").alias("note"),
    )


@query(
    "envelope_read",
    f"""WITH {_ENV} SELECT stream, raw_id, {_ENV_TEXT}, CAST(user_id AS VARCHAR) AS user_id, note,
      TRUE AS has_note, FALSE AS has_ts, 0 AS missing FROM env""",
)
def _(spark, d):
    path = new_scratch(spark, "envelopes")
    wrapped = ev.wrap_envelope(fx.envelope_records(spark, d), "raw_id", "extracted_at")
    ev.write_jsonl_gz(wrapped, path)
    back = ev.read_envelope(spark, path)
    return back.select(
        "stream",
        "raw_id",
        "extracted_at",
        F.try_element_at("data", F.lit("user_id")).alias("user_id"),
        F.try_element_at("data", F.lit("note")).alias("note"),
        F.map_contains_key("data", "note").alias("has_note"),
        F.map_contains_key("data", "ts").alias("has_ts"),
        F.size("missing_fields").alias("missing"),
    )


@query("stream_counts", "SELECT event_type AS stream, COUNT(*) AS records FROM events GROUP BY 1")
def _(spark, d):
    # whatever streams there are, from one scan
    return ev.stream_counts(fx.table(spark, d, "events").select(F.col("event_type").alias("stream")))


@query(
    "envelope_damage",
    f"""WITH {_LEFT} SELECT stream, raw_id, CAST(lacking AS BIGINT) AS lacking, no_data AS without_data FROM env""",
)
def _(spark, d):
    return landed(spark, d).select(
        "stream", "raw_id", F.size("missing_fields").cast("bigint").alias("lacking"), F.col("data").isNull().alias("without_data")
    )


@query(
    "duplicate_ids",
    f"WITH {_LEFT} SELECT stream, raw_id, COUNT(*) AS copies FROM env GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def _(spark, d):
    return ec.duplicate_ids(landed(spark, d))


_GAPS = """gaps AS (SELECT stream, field, COUNT(*) FILTER (WHERE NOT no_data AND (v IS NULL OR v = '')) AS missing,
    COUNT(*) AS records FROM (
      SELECT stream, 'note' AS field, note AS v, no_data FROM env UNION ALL
      SELECT stream, 'hint', hint, no_data FROM env UNION ALL
      SELECT stream, 'raw_id', inner_id, no_data FROM env UNION ALL
      SELECT stream, 'user_id', CAST(user_id AS VARCHAR), no_data FROM env)
    GROUP BY 1, 2 HAVING missing > 0)"""
_FILLED = "(records - missing) / records::DOUBLE * 100.0::DOUBLE"


@query(
    "completeness",
    f"""WITH {_LEFT}, {_GAPS} SELECT stream, field, missing, {half_up(_FILLED)} AS completeness_pct,
      {_FILLED} < 80 AS low FROM gaps""",
)
def _(spark, d):
    return ec.completeness(landed(spark, d))


_AGE = f"avg(date_diff('microsecond', known_ts, TIMESTAMP '{fx.EVENTS_AS_OF}') / 3.6e9::DOUBLE)"


@query(
    "mean_age_hours",
    f"WITH {_LEFT} SELECT stream, {half_up(_AGE, 4)} AS mean_age_hours FROM env GROUP BY 1",
)
def _(spark, d):
    out = ec.mean_age_hours(landed(spark, d), fx.EVENTS_AS_OF)
    return out.withColumn("mean_age_hours", round_half_up(F.col("mean_age_hours"), 4))


_SCORES = f"""per_id AS (SELECT stream, raw_id, COUNT(*) AS n, SUM(CAST(lacking > 0 AS INTEGER)) AS broken FROM env GROUP BY 1, 2),
  counted AS (SELECT stream, CAST(SUM(n) AS BIGINT) AS total_records, CAST(SUM(broken) AS BIGINT) AS schema_errors,
    COUNT(*) FILTER (WHERE n > 1) AS duplicate_ids FROM per_id GROUP BY 1),
  scores AS (SELECT *, schema_errors + duplicate_ids AS errors,
    {half_up("(total_records - schema_errors - duplicate_ids) / total_records::DOUBLE * 100.0::DOUBLE")} AS quality_score,
    schema_errors + duplicate_ids = 0 AS passed FROM counted)"""


@query("quality_score", f"WITH {_LEFT}, {_SCORES} SELECT * FROM scores")
def _(spark, d):
    return ec.quality_score(landed(spark, d))


_REPORT = f"""{_GAPS}, {_SCORES},
    ages AS (SELECT stream, {half_up(_AGE, 4)} AS mean_age_hours FROM env GROUP BY 1),
    warned AS (SELECT stream, COUNT(*) AS fields_with_gaps,
      COUNT(*) FILTER (WHERE {_FILLED} < 80) AS warnings FROM gaps GROUP BY 1),
    report AS (SELECT s.*, mean_age_hours, coalesce(fields_with_gaps, 0) AS fields_with_gaps,
      coalesce(warnings, 0) AS warnings
    FROM scores s JOIN ages USING (stream) LEFT JOIN warned USING (stream))"""


def short_age(report: DataFrame) -> DataFrame:
    return report.withColumn("mean_age_hours", round_half_up(F.col("mean_age_hours"), 4))


@query("dq_stream_report", f"WITH {_LEFT}, {_REPORT} SELECT * FROM report")
def _(spark, d):
    return short_age(ec.stream_report(landed(spark, d), fx.EVENTS_AS_OF))


def _gate(spark, d, times: int = 1):
    root = new_scratch(spark, "gate")
    ev.write_lines_gz(fx.damaged_lines(spark, d), f"{root}/bronze/run", "overwrite")
    for _ in range(times):
        result = check_and_promote(spark, f"{root}/bronze/run", root, fx.EVENTS_AS_OF)
    return root, result


@query("stored_report", f"WITH {_LEFT}, {_REPORT} SELECT * FROM report")
def _(spark, d):
    """The report rows as the gate stored them, after a run that was repeated."""
    root, result = _gate(spark, d, times=2)
    stored = spark.read.schema(result.report.schema).json(f"{root}/logs/dq_reports").drop("run")
    return short_age(stored)


@query(
    "stored_details",
    f"""WITH {_LEFT}, {_GAPS}
    SELECT stream, 'schema' AS kind, concat_ws(': ', raw_id, concat_ws(',', CASE WHEN no_id THEN '{ev.RAW_ID}' END,
        CASE WHEN no_time THEN '{ev.EXTRACTED_AT}' END, CASE WHEN no_data THEN '{ev.DATA}' END)) AS item,
      1 AS occurrences, NULL AS share FROM env WHERE lacking > 0 UNION ALL
    SELECT stream, 'duplicate', coalesce(raw_id, ''), COUNT(*), NULL FROM env GROUP BY stream, raw_id HAVING COUNT(*) > 1 UNION ALL
    SELECT stream, CASE WHEN {_FILLED} < 80 THEN 'warning' ELSE 'gap' END, field, missing, {half_up(_FILLED)} FROM gaps""",
)
def _(spark, d):
    root, _result = _gate(spark, d)
    kinds = "stream string, kind string, item string, occurrences bigint, share double"
    return spark.read.schema(kinds).json(f"{root}/logs/dq_details").drop("run")


@query(
    "promote_passed",
    f"""WITH {_LEFT}, {_SCORES} SELECT stream, raw_id, note FROM env
    WHERE stream IN (SELECT stream FROM scores WHERE passed)""",
)
def _(spark, d):
    root, _result = _gate(spark, d, times=2)  # repeating a run promotes nothing twice
    silver = spark.read.parquet(f"{root}/silver")
    return silver.select("stream", "raw_id", F.try_element_at("data", F.lit("note")).alias("note"))


@query(
    "promotion_rate",
    f"""WITH {_LEFT}, {_SCORES} SELECT COUNT(*) AS total_streams,
      COUNT(*) FILTER (WHERE passed) AS promoted_streams,
      {half_up("COUNT(*) FILTER (WHERE passed) / COUNT(*)::DOUBLE * 100.0::DOUBLE")} AS promotion_rate,
      CAST(SUM(total_records) AS BIGINT) AS total_records FROM scores""",
)
def _(spark, d):
    return ec.promotion_rate(ec.quality_score(landed(spark, d)))


@query(
    "gated_run",
    f"""WITH {_LEFT}, {_SCORES} SELECT stream, '2024-02-01 00:00:00' AS promoted_at, '{ec.PROMOTER}' AS promoted_by,
      quality_score, total_records AS record_count FROM scores WHERE passed""",
)
def _(spark, d):
    _root, result = _gate(spark, d)
    at = F.date_format("promoted_at", "yyyy-MM-dd HH:mm:ss").alias("promoted_at")
    return result.promoted.select("stream", at, "promoted_by", "quality_score", "record_count")


# --- annotations ----------------------------------------------------------------------

_ANN = cte("ann", fx.ANNOTATIONS, "labels JOIN documents ON labels.doc_id = documents.doc_id")


@query(
    "class_distribution",
    f"""WITH {_ANN}, cells AS (SELECT 'quality' AS column_name, CAST(quality AS VARCHAR) AS class FROM ann
      UNION ALL SELECT 'not_toxic', CAST(not_toxic AS VARCHAR) FROM ann
      UNION ALL SELECT 'lang', lang FROM ann),
    n AS (SELECT column_name, class, COUNT(*) AS n FROM cells WHERE class IS NOT NULL GROUP BY 1, 2)
    SELECT *, {half_up("100.0::DOUBLE * n / SUM(n) OVER (PARTITION BY column_name)")} AS share_pct FROM n""",
)
def _(spark, d):
    return an.class_distribution(fx.annotations(spark, d), ["quality", "not_toxic", "lang"])


@query("annotation_productivity", f"WITH {_ANN} SELECT annotator, COUNT(*) AS annotations FROM ann GROUP BY 1")
def _(spark, d):
    return an.annotation_productivity(fx.annotations(spark, d), ["annotator"])


@query(
    "annotation_normalise",
    f"""WITH {_ANN} SELECT CAST(doc_id AS VARCHAR) AS doc_id, annotator, CAST(quality AS DOUBLE) AS quality,
      CAST(NULL AS VARCHAR) AS remark FROM ann""",
)
def _(spark, d):
    wanted = T.StructType.fromDDL("doc_id string, annotator string, quality double, remark string")
    return an.normalise_annotations(fx.annotations(spark, d), wanted)


@query(
    "agreement_rate",
    f"""WITH {_ANN} SELECT annotator, COUNT(*) AS items,
      {half_up("100.0::DOUBLE * COUNT(*) FILTER (WHERE quality = not_toxic) / COUNT(*)")} AS agreement_pct
    FROM ann WHERE quality IS NOT NULL AND not_toxic IS NOT NULL GROUP BY 1""",
)
def _(spark, d):
    return an.agreement_rate(fx.annotations(spark, d), "quality", "not_toxic", ["annotator"])
