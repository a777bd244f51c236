"""Enveloped streams: land in bronze, check, promote what passed, summarise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeops.functions.times import Moment
from lakeops.operators.envelope_checks import (
    promote_passed,
    promotion_rate,
    report_details,
    stream_report,
    write_report,
)
from lakeops.session import Scratch, materialise
from lakeops.sources.envelopes import (
    read_envelope,
    to_lines,
    union_streams,
    wrap_envelope,
    write_lines_gz,
)


@dataclass(frozen=True)
class GateResult:
    report: DataFrame
    promoted: DataFrame
    summary: DataFrame


def run_gated_promotion(
    spark: SparkSession,
    streams: dict[str, DataFrame],
    root: str,
    as_of: Moment,
    id_col: str,
    extracted_col: str,
    run_stamp: str,
) -> GateResult:
    """One run over all streams. The check report is stored before the gate uses it."""
    bronze = f"{root}/bronze/{run_stamp}"
    lines = {
        name: to_lines(wrap_envelope(records, id_col, extracted_col))
        for name, records in streams.items()
    }
    write_lines_gz(union_streams(lines), bronze, "overwrite")
    return check_and_promote(spark, bronze, root, as_of)


def check_and_promote(spark: SparkSession, bronze: str, root: str, as_of: Moment) -> GateResult:
    """The part after landing: everything derives from the landed files.

    ``bronze`` is the folder of one run; its name stands for the run, and checking it again
    replaces report, details, promoted records and promotions of that run.

    The gzip text is unpacked and parsed once; checks and promotion read the stored
    columns they need.
    """
    run = bronze.rstrip("/").rsplit("/", 1)[-1]
    with Scratch(spark, "gate") as scratch:
        landed = scratch.store(read_envelope(spark, bronze))
        report = materialise(stream_report(landed, as_of), "stream-report")
        write_report(report, f"{root}/logs/dq_reports", as_of, bronze, run)
        write_report(report_details(landed), f"{root}/logs/dq_details", as_of, bronze, run)
        promoted = promote_passed(landed, report, f"{root}/silver", as_of, bronze, run)
        promoted.write.mode("overwrite").json(f"{root}/logs/promotions/run={run}")
    return GateResult(report, promoted, promotion_rate(report))
