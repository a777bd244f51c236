"""Enveloped records: ``{raw id, extraction time, data object}`` as gzip JSON lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.sources.tables import balanced

# The field names of the envelope.
RAW_ID = "_airbyte_raw_id"
EXTRACTED_AT = "_airbyte_extracted_at"
DATA = "_airbyte_data"
REQUIRED_FIELDS = (RAW_ID, EXTRACTED_AT, DATA)

#: Rows of one landed file at most. A gzip file is read by one task.
FILE_ROWS = 100_000

_AS_MAP = "map<string,string>"
_STRICT = {"mode": "FAILFAST"}


def wrap_envelope(df: DataFrame, id_col: str, extracted_col: str) -> DataFrame:
    """Put every record into an envelope; a missing id or time becomes empty text.

    A ``stream`` column, if any, stays outside the envelope.
    """
    record = [c for c in df.columns if c != "stream"]
    outside = ["stream"] if "stream" in df.columns else []
    return df.select(
        *outside,
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias(RAW_ID),
        F.coalesce(F.col(extracted_col).cast("string"), F.lit("")).alias(EXTRACTED_AT),
        F.struct(*record).alias(DATA),
    )


def union_streams(streams: dict[str, DataFrame]) -> DataFrame:
    """All streams as one DataFrame with a ``stream`` column; empty ones vanish."""
    tagged = [df.withColumn("stream", F.lit(name)) for name, df in streams.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def stream_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("stream").agg(F.count(F.lit(1)).alias("records"))


def to_lines(df: DataFrame) -> DataFrame:
    """Every row as one JSON text ``value``; nulls are written, not left out.

    Streams of different shapes can be united as lines without gaining each other's
    fields.
    """
    record = [c for c in df.columns if c != "stream"]
    outside = ["stream"] if "stream" in df.columns else []
    text = F.to_json(F.struct(*record), {"ignoreNullFields": "false"})
    return df.select(*outside, text.alias("value"))


def write_lines_gz(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Write ``(stream, value)`` as gzip text under ``stream=<name>`` directories.

    ``mode="overwrite"`` replaces the whole folder: right for a folder that one run owns,
    so that repeating the run does not double its records. Gzip files do not split on reading,
    so their size is balanced on writing and none has more than ``FILE_ROWS`` lines: a
    stream is read by as many tasks as it has files.
    """
    (
        balanced(lines, ["stream"])
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy("stream")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_ROWS)
        .text(path)
    )


def write_jsonl_gz(
    df: DataFrame, path: str, stream: str | None = None, mode: str = "append"
) -> None:
    """Write rows as gzip JSON lines; ``stream`` names them unless a column does."""
    tagged = df if stream is None else df.withColumn("stream", F.lit(stream))
    write_lines_gz(to_lines(tagged), path, mode)


def read_envelope(spark: SparkSession, path: str) -> DataFrame:
    """Read envelopes as ``(stream, raw_id, extracted_at, data, missing_fields)``.

    ``data`` is a map of text, which keeps an absent key, a null and an empty text
    apart. A line that is not JSON fails the job.
    """
    lines = spark.read.text(path)
    return open_envelope(lines)


def open_envelope(lines: DataFrame) -> DataFrame:
    """Parse a ``value`` column of JSON text, keeping the other columns."""
    rest = [c for c in lines.columns if c != "value"]
    parsed = lines.select(*rest, F.from_json("value", _AS_MAP, _STRICT).alias("fields"))
    missing = F.filter(
        F.array(*[F.lit(f) for f in REQUIRED_FIELDS]),
        lambda f: ~F.map_contains_key(F.col("fields"), f),
    )
    return parsed.select(
        *rest,
        F.try_element_at("fields", F.lit(RAW_ID)).alias("raw_id"),
        F.try_element_at("fields", F.lit(EXTRACTED_AT)).alias("extracted_at"),
        F.from_json(F.try_element_at("fields", F.lit(DATA)), _AS_MAP, _STRICT).alias("data"),
        missing.alias("missing_fields"),
    )
