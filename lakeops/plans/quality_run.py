"""Check a stored table and say how it went."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, types as T

from lakeops.functions.times import Moment
from lakeops.operators import checks as dq
from lakeops.session import materialise
from lakeops.sources.tables import read_or_none


@dataclass(frozen=True)
class QualityResult:
    """``status`` is success, failed, skipped or error; the report has a row per check."""

    status: str
    reason: str | None = None
    failed_checks: list[str] = field(default_factory=list)
    report: DataFrame | None = None


def check_table(
    spark: SparkSession,
    path: str,
    checks: Sequence[dq.Check],
    as_of: Moment,
    schema: T.StructType | None = None,
    enabled: bool = True,
    fail_on_error: bool = False,
    where: Column | None = None,
) -> QualityResult:
    """Run checks on a table, or on the rows ``where`` holds. With ``fail_on_error`` failed checks and errors are raised."""
    if not enabled:
        return QualityResult("skipped", "disabled")
    table = read_or_none(spark, path, schema)
    if table is None:
        return QualityResult("skipped", "table_not_found")
    table = table if where is None else table.where(where)
    if table.isEmpty():
        return QualityResult("skipped", "empty_table")
    try:
        report = materialise(dq.run_checks(table, checks, as_of, columnar=True), "check-report")
    except Exception as e:  # a check that cannot be evaluated
        if fail_on_error:
            raise
        return QualityResult("error", f"{type(e).__name__}: {e}")
    failed = dq.failed_names(report)
    if failed and fail_on_error:
        raise dq.ChecksFailed(f"{len(failed)} check(s) failed: {failed}")
    return QualityResult("failed" if failed else "success", None, failed, report)
