"""Raw JSON: landing, reading back, and load-once dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.operators.rules import Rule, all_hold
from lakeops.sources.tables import path_exists


#: Rows of one landed file at most. A gzip file is read by one task.
FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class LandResult:
    path: str | None
    count: int
    status: str


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Read JSON under a fixed schema.

    JSON lines and one-line arrays need no option and split across tasks. Use
    ``multi_line`` only for pretty-printed files: each is then read by one task.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def land_raw(df: DataFrame, root: str, table: str, run_stamp: str) -> LandResult:
    """Write one run's records, unvalidated, to their own stamped location.

    A run that is repeated under its stamp replaces what it wrote. The count is that of
    the landed lines. Lines are gzipped, a seventh of their plain size for sales; as such a file does
    not split, none has more than ``FILE_ROWS`` lines.
    """
    path = f"{root}/{table}/{table}_{run_stamp}.json"
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    writer.option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).json(path)
    count = df.sparkSession.read.text(path).count()
    return LandResult(path, count, "success" if count else "skipped")


def load_dimension(df: DataFrame, path: str, rules: Sequence[Rule]) -> str:
    """Write a dimension once; a row that breaks a rule fails the whole load."""
    if path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        return "skipped"
    broken = F.concat(
        F.lit("invalid dimension row: "), F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    )
    valid = df.where(F.when(all_hold(rules), F.lit(True)).otherwise(F.raise_error(broken).cast("boolean")))
    valid.write.mode("overwrite").json(path)
    return "loaded"
