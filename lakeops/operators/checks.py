"""Declarative table checks, evaluated together.

The input is evaluated once. All row-level metrics come out of one aggregation; only
duplicate counts need a shuffle of their own, of one column, long texts as digests.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions.times import Moment, hours_between, wall_clock
from lakeops.operators.rules import PAYMENT_METHODS, SALE_STATUSES, TOTAL_TOLERANCE
from lakeops.session import materialise

METRICS = (
    "row_count",
    "schema",
    "missing_count",
    "failed_rows",
    "duplicate_count",
    "freshness",
    "avg",
    "max",
)


@dataclass(frozen=True)
class Check:
    """A metric and the bounds it must keep.

    ``above`` and ``below`` are strict, ``at_least`` and ``at_most`` inclusive. A metric
    without a value (no rows, all null) fails every bound.
    """

    name: str
    metric: str
    column: str | None = None
    condition: str | None = None
    required: tuple[str, ...] = ()
    above: float | None = None
    below: float | None = None
    at_least: float | None = None
    at_most: float | None = None

    def __post_init__(self):
        if self.metric not in METRICS:
            raise ValueError(f"unknown metric {self.metric!r}")

    def holds(self, value: Column) -> Column:
        bounds = []
        if self.above is not None:
            bounds.append(value > self.above)
        if self.below is not None:
            bounds.append(value < self.below)
        if self.at_least is not None:
            bounds.append(value >= self.at_least)
        if self.at_most is not None:
            bounds.append(value <= self.at_most)
        # Spark orders NaN above all numbers: it must not pass a lower bound
        number = ~F.isnan(value) if bounds else F.lit(True)
        return F.coalesce(reduce(Column.__and__, bounds, number), F.lit(False))


def row_count(name: str, **bounds: float) -> Check:
    return Check(name, "row_count", **bounds)


def required_columns(name: str, *columns: str) -> Check:
    return Check(name, "schema", required=columns, at_most=0)


def no_missing(name: str, column: str) -> Check:
    return Check(name, "missing_count", column, at_most=0)


def no_failed_rows(name: str, condition: str) -> Check:
    return Check(name, "failed_rows", condition=condition, at_most=0)


def no_duplicates(name: str, column: str) -> Check:
    return Check(name, "duplicate_count", column, at_most=0)


def fresh_within(name: str, column: str, hours: float) -> Check:
    return Check(name, "freshness", column, below=hours)


def average(name: str, column: str, low: float, high: float) -> Check:
    return Check(name, "avg", column, at_least=low, at_most=high)


def maximum(name: str, column: str, below: float) -> Check:
    return Check(name, "max", column, below=below)


# The bounds of the small example data set.
EXAMPLE_BOUNDS = {
    "max_rows": 10000,
    "max_product_id": 50,
    "max_customer_id": 1000,
    "amount_range": (50, 2000),
    "quantity_range": (1, 10),
    "max_amount": 5000,
    "fresh_hours": 2,
}


def silver_sales_checks(
    max_rows: int | None = None,
    max_product_id: int | None = None,
    max_customer_id: int | None = None,
    amount_range: tuple[float, float] | None = None,
    quantity_range: tuple[float, float] | None = None,
    max_amount: float | None = None,
    fresh_hours: float | None = None,
) -> list[Check]:
    """The checks of the silver sales table; a check whose bound is not given is left out.

    The names are fixed values. ``silver_sales_checks(**EXAMPLE_BOUNDS)`` gives all twenty.
    """
    payments = ", ".join(f"'{p}'" for p in PAYMENT_METHODS)
    statuses = ", ".join(f"'{s}'" for s in SALE_STATUSES)
    given = lambda bound, make: [] if bound is None else [make(bound)]
    product = "product_id < 1" if max_product_id is None else f"product_id < 1 OR product_id > {max_product_id}"
    customer = "customer_id < 1" if max_customer_id is None else f"customer_id < 1 OR customer_id > {max_customer_id}"
    return [
        row_count("Table has data", above=0),
        *given(max_rows, lambda n: row_count("Prevent data explosion", below=n)),
        required_columns(
            "Ensure sales schema integrity",
            "transaction_id",
            "customer_id",
            "product_id",
            "quantity",
            "unit_price",
            "total_amount",
            "transaction_timestamp",
            "payment_method",
            "status",
        ),
        no_missing("No missing transaction IDs", "transaction_id"),
        no_missing("No missing customer IDs", "customer_id"),
        no_missing("No missing product IDs", "product_id"),
        no_missing("No missing timestamps", "transaction_timestamp"),
        no_failed_rows("No negative quantities", "quantity <= 0"),
        no_failed_rows("No negative amounts", "total_amount <= 0"),
        no_failed_rows("No zero quantities", "quantity = 0"),
        no_failed_rows(
            "Total amount matches calculation",
            f"abs(total_amount - quantity * unit_price) > {TOTAL_TOLERANCE}D",
        ),
        no_duplicates("No duplicate transactions", "transaction_id"),
        *given(fresh_hours, lambda h: fresh_within("Data is recent (within 2 hours)", "transaction_timestamp", h)),
        no_failed_rows("Valid payment methods", f"payment_method NOT IN ({payments})"),
        no_failed_rows("Valid status values", f"status NOT IN ({statuses})"),
        *given(amount_range, lambda r: average("Average transaction value in expected range", "total_amount", *r)),
        *given(quantity_range, lambda r: average("Average quantity in expected range", "quantity", *r)),
        *given(max_amount, lambda m: maximum("No extremely high transactions (fraud detection)", "total_amount", m)),
        no_failed_rows("Product ID in valid range", product),
        no_failed_rows("Customer ID in valid range", customer),
    ]


class ChecksFailed(ValueError):
    """Raised when checks fail and the caller asked for that."""


def run_checks(
    df: DataFrame, checks: Sequence[Check], as_of: Moment, fail_on_error: bool = False, columnar: bool = False
) -> DataFrame:
    """One row per check: ``check_name, metric, value, passed, failed_rows``.

    A check on a column the table lacks fails with a null value. ``columnar``: ``df`` reads a
    columnar table as it lies, so it is not stored again.
    """
    present = set(df.columns)
    lacking = {c.name for c in checks if c.column is not None and c.column not in present}
    counted = [c for c in checks if c.metric == "duplicate_count" and c.name not in lacking]
    if counted and not columnar:
        # stored once: each duplicate count then reads one column of it, the rest another few
        names = sorted({n for c in checks for n in _reads(c, df.columns)})
        stored = materialise(df.select(*names), "checked")
    else:
        stored = df
    plain = [c for c in checks if c not in counted]
    metrics = [
        F.lit(None).cast("double") if c.name in lacking else _aggregate(df, c, as_of).cast("double") for c in plain
    ]
    totals = stored.agg(F.count(F.lit(1)).alias("_rows"), *[m.alias(f"m{i}") for i, m in enumerate(metrics)])
    parts = [totals.select(F.inline(F.array(*[_line(c, F.col(f"m{i}")) for i, c in enumerate(plain)])))] if plain else []
    for column in dict.fromkeys(c.column for c in counted):
        own = [_line(c, F.col("v")) for c in counted if c.column == column]
        parts.append(_duplicates(stored, column).select(F.inline(F.array(*own))))
    report = reduce(DataFrame.unionByName, parts)

    if fail_on_error:
        failed = failed_names(report)
        if failed:
            raise ChecksFailed(f"{len(failed)} check(s) failed: {failed}")
    return report


def failed_names(report: DataFrame) -> list[str]:
    """Names of failed checks; a report has one row per check, so this is small."""
    return [r["check_name"] for r in report.where(~F.col("passed")).collect()]


def summarise(report: DataFrame) -> DataFrame:
    """``status, checks_run, checks_failed, failed_checks`` in one row."""
    failed = F.count_if(~F.col("passed"))
    names = F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("check_name"))))
    return report.agg(
        F.when(failed > 0, "failed").otherwise("success").alias("status"),
        F.count(F.lit(1)).alias("checks_run"),
        failed.alias("checks_failed"),
        names.alias("failed_checks"),
    )


def failure_counts(reports: DataFrame) -> DataFrame:
    """Failures per check over stored reports."""
    return (
        reports.where(~F.col("passed"))
        .groupBy("check_name")
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def _aggregate(df: DataFrame, check: Check, as_of: Moment) -> Column | None:
    column = None if check.column is None else F.col(check.column)
    if check.metric == "row_count":
        return F.count(F.lit(1))
    if check.metric == "schema":
        return F.lit(len(set(check.required) - set(df.columns)))
    if check.metric == "missing_count":
        return F.count_if(column.isNull())
    if check.metric == "failed_rows":
        return F.count_if(F.expr(check.condition))
    if check.metric == "freshness":
        return hours_between(F.max(column), wall_clock(as_of))
    if check.metric == "avg":
        return F.avg(column)
    if check.metric == "max":
        return F.max(column)
    return None  # duplicate_count has a job of its own


def _duplicates(df: DataFrame, column: str) -> DataFrame:
    """How many distinct values occur more than once; texts longer than half their digest by that.

    A digest has 64 characters, so it never equals a text that is compared itself.
    """
    text, key = df.schema[column].dataType.simpleString() == "string", F.col(column)
    key = F.when(F.octet_length(key) <= 32, key).otherwise(F.sha2(key, 256)) if text else key
    copies = df.where(F.col(column).isNotNull()).groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.count_if(F.col("n") > 1).cast("double").alias("v"))


def _reads(check: Check, columns: Sequence[str]) -> list[str]:
    """The columns a check reads, as far as they are there."""
    if check.condition is None:
        return [check.column] if check.column in columns else []
    words = set(re.findall(r"\w+", check.condition.lower()))
    return [c for c in columns if c.lower() in words]


def _line(check: Check, value: Column) -> Column:
    counts_rows = check.metric in ("missing_count", "failed_rows", "duplicate_count")
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.metric).alias("metric"),
        value.alias("value"),
        check.holds(value).alias("passed"),
        (value.cast("bigint") if counts_rows else F.lit(0).cast("bigint")).alias("failed_rows"),
    )
