"""Quality of enveloped streams, all streams at once, and the gate to silver.

Input is what ``read_envelope`` returns plus a ``stream`` column. Errors are records
that lack an envelope field and ids that occur more than once; a stream passes when it
has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions.numeric import round_half_up
from lakeops.functions.times import Moment, hours_between, parse_iso, wall_clock
from lakeops.sources.tables import balanced

LOW_COMPLETENESS = 80.0
PROMOTER = "quality_gate"


def schema_violations(env: DataFrame) -> DataFrame:
    """Records that lack an envelope field, with the fields they lack."""
    return env.where(F.size("missing_fields") > 0).select(
        "stream", "raw_id", "extracted_at", "missing_fields"
    )


def duplicate_ids(env: DataFrame) -> DataFrame:
    """Ids that occur more than once in a stream; a missing id counts as one id."""
    return (
        env.groupBy("stream", "raw_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def completeness(env: DataFrame, warn_below: float = LOW_COMPLETENESS) -> DataFrame:
    """Share of records whose field is filled, for fields with at least one gap.

    A null or empty value is a gap; a record without the key is not.
    """
    return _gaps(env).select(
        "stream",
        "field",
        "missing",
        round_half_up(_filled()).alias("completeness_pct"),
        (_filled() < warn_below).alias("low"),
    )


def _gaps(env: DataFrame) -> DataFrame:
    """Nulls and empty texts per stream and field, beside the stream's records.

    One pass: every record adds a row without a field that counts it. Fields without any
    gap do not appear.
    """
    empty = F.map_keys(F.map_filter("data", lambda _, v: v.isNull() | (v == "")))
    counted = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(empty, F.array().cast("array<string>")))
    by_field = (
        env.select("stream", F.explode(counted).alias("field"))
        .groupBy("stream", "field")
        .agg(F.count(F.lit(1)).alias("missing"))
    )
    records = F.max(F.when(F.col("field").isNull(), F.col("missing"))).over(Window.partitionBy("stream"))
    return by_field.withColumn("total_records", records).where(F.col("field").isNotNull())


def _filled() -> Column:
    total = F.col("total_records")
    return (total - F.col("missing")) / total * 100.0


def mean_age_hours(env: DataFrame, as_of: Moment) -> DataFrame:
    """Mean age of records with a readable extraction time; null when there is none."""
    age = hours_between(parse_iso(F.col("extracted_at")), wall_clock(as_of))
    return env.groupBy("stream").agg(F.avg(age).alias("mean_age_hours"))


def quality_score(env: DataFrame) -> DataFrame:
    """Records, errors, score and verdict per stream.

    Grouped by id first, which collapses copies before the shuffle, then by stream.
    """
    return _scores(_per_id(env))


def _per_id(env: DataFrame, *more) -> DataFrame:
    return env.groupBy("stream", "raw_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.size("missing_fields") > 0).alias("incomplete"),
        *more,
    )


def _scores(per_id: DataFrame, *more) -> DataFrame:
    records = F.sum("n")
    schema_errors = F.sum("incomplete")
    repeated = F.count_if(F.col("n") > 1)
    errors = schema_errors + repeated
    return per_id.groupBy("stream").agg(
        records.alias("total_records"),
        schema_errors.alias("schema_errors"),
        repeated.alias("duplicate_ids"),
        errors.alias("errors"),
        round_half_up((records - errors) / records * 100.0).alias("quality_score"),
        (errors == 0).alias("passed"),
        *more,
    )


def stream_report(
    env: DataFrame, as_of: Moment, warn_below: float = LOW_COMPLETENESS
) -> DataFrame:
    """The full report, one row per stream: score, age, gaps, warnings, verdict."""
    age = hours_between(parse_iso(F.col("extracted_at")), wall_clock(as_of))
    scores = _scores(
        _per_id(env, F.sum(age).alias("age_sum"), F.count(age).alias("age_n")),
        (F.sum("age_sum") / F.nullif(F.sum("age_n"), F.lit(0))).alias("mean_age_hours"),
    )
    # one row per stream meets the stream's few fields with gaps, and folds back to one
    return (
        scores.join(_gaps(env).drop("total_records"), "stream", "left")
        .groupBy(*scores.columns)
        .agg(
            F.count("field").alias("fields_with_gaps"),
            F.count_if(_filled() < warn_below).alias("warnings"),
        )
    )


def report_details(env: DataFrame, warn_below: float = LOW_COMPLETENESS) -> DataFrame:
    """What the report counts, one row each: stream, kind, item, occurrences, share.

    ``schema``: a record that lacks fields, the item names them; ``duplicate``: an id and its
    copies; ``gap``: a field with its empty values and its share of filled ones, ``warning``
    if that share is low. Rows, not lists: a stream may have millions of errors.
    """
    nothing = F.lit(None).cast("double")
    one = F.lit(1).cast("bigint")
    lacking = schema_violations(env).select(
        "stream",
        F.lit("schema").alias("kind"),
        F.concat_ws(": ", "raw_id", F.array_join("missing_fields", ",")).alias("item"),
        one.alias("occurrences"),
        nothing.alias("share"),
    )
    copies = duplicate_ids(env).select(
        "stream", F.lit("duplicate"), F.coalesce("raw_id", F.lit("")), "copies", nothing
    )
    gaps = completeness(env, warn_below).select(
        "stream", F.when(F.col("low"), "warning").otherwise("gap"), "field", "missing", "completeness_pct"
    )
    return lacking.union(copies).union(gaps)


def write_report(report: DataFrame, path: str, as_of: Moment, source: str, run: str) -> None:
    """Store the report rows of a run, stamped with its time and what was checked.

    Repeating the run replaces its rows and nobody else's.
    """
    stamped = report.select(
        F.lit(str(as_of)).cast("timestamp").alias("timestamp"),
        F.lit(source).alias("bronze_file"),
        "*",
    )
    stamped.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/run={run}")


def passed_records(records: DataFrame, report: DataFrame) -> DataFrame:
    """Records of the streams that passed. ``report`` has one row per stream; give it
    as a stored table, so its size is known and the join needs no shuffle."""
    return records.join(report.where("passed").select("stream"), "stream", "left_semi")


def promote_passed(
    records: DataFrame,
    report: DataFrame,
    path: str,
    as_of: Moment,
    source: str = "bronze",
    run: str = "once",
) -> DataFrame:
    """Copy passed streams to silver; returns one metadata row per promoted stream.

    The table is laid out by run and stream; repeating a run replaces what it promoted,
    also if it promotes less now.
    """
    promoted = passed_records(records, report)
    (
        balanced(promoted, ["stream"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("stream")
        .parquet(f"{path}/run={run}")
    )
    return report.where("passed").select(
        "stream",
        F.lit(str(as_of)).cast("timestamp").alias("promoted_at"),
        F.lit(PROMOTER).alias("promoted_by"),
        F.lit(source).alias("source"),
        "quality_score",
        F.col("total_records").alias("record_count"),
    )


def promotion_rate(report: DataFrame) -> DataFrame:
    """Streams, promoted streams and their share; 0 when there are no streams."""
    total, passed = F.count(F.lit(1)), F.count_if("passed")
    return report.agg(
        total.alias("total_streams"),
        passed.alias("promoted_streams"),
        F.when(total == 0, 0.0)
        .otherwise(round_half_up(passed / F.nullif(total, F.lit(0)) * 100.0))
        .alias("promotion_rate"),
        F.coalesce(F.sum("total_records"), F.lit(0).cast("bigint")).alias("total_records"),
    )
