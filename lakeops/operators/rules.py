"""Named row rules: accept, quarantine with reasons, count, and the cleaning funnel."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lakeops.functions.times import Moment, wall_clock

# Fixed values
PAYMENT_METHODS = ("credit_card", "debit_card", "cash", "digital_wallet")
SALE_STATUSES = ("completed", "pending", "cancelled")
CUSTOMER_SEGMENTS = ("Premium", "Regular", "New")
TOTAL_TOLERANCE = 0.01


@dataclass(frozen=True)
class Rule:
    """A row obeys the rule when ``keep`` is true; false and null both break it."""

    name: str
    keep: Column

    @property
    def broken(self) -> Column:
        return ~F.coalesce(self.keep, F.lit(False))


def _positive(column: str) -> Rule:
    return Rule(f"{column}_positive", F.col(column) > 0)


def _present(column: str) -> Rule:
    return Rule(f"{column}_present", F.col(column).isNotNull())


def _total_matches() -> Rule:
    gap = F.abs(F.col("total_amount") - F.col("quantity") * F.col("unit_price"))
    return Rule("total_matches", gap <= TOTAL_TOLERANCE)


# Fixed value: the number of products of the small example data set.
EXAMPLE_PRODUCTS = 50


def sales_rules(as_of: Moment, max_product_id: int | None = None) -> list[Rule]:
    """Rules a raw sale must obey to enter the silver table.

    Without ``max_product_id`` product ids have no upper bound.
    """
    product = F.col("product_id")
    ts = F.col("transaction_timestamp")
    in_range = product > 0 if max_product_id is None else (product > 0) & (product <= max_product_id)
    return [
        _present("transaction_id"),
        _present("customer_id"),
        _present("product_id"),
        _present("transaction_timestamp"),
        # a missing value is reported by its own rule above, not a second time here
        Rule("not_in_future", ts.isNull() | (ts <= wall_clock(as_of))),
        _positive("quantity"),
        _positive("total_amount"),
        _total_matches(),
        Rule("payment_method_valid", F.col("payment_method").isin(*PAYMENT_METHODS)),
        Rule("status_valid", F.col("status").isin(*SALE_STATUSES)),
        Rule("product_in_range", product.isNull() | in_range),
    ]


def sale_model_rules() -> list[Rule]:
    """Rules of the sale record model: no clock and no upper product bound."""
    return [
        _present("transaction_id"),
        _positive("customer_id"),
        _positive("product_id"),
        _positive("quantity"),
        _positive("unit_price"),
        _positive("total_amount"),
        _present("transaction_timestamp"),
        _positive("store_id"),
        _total_matches(),
        Rule("payment_method_valid", F.col("payment_method").isin(*PAYMENT_METHODS)),
        Rule("status_valid", F.col("status").isin(*SALE_STATUSES)),
    ]


def product_rules() -> list[Rule]:
    return [
        _positive("product_id"),
        _present("product_name"),
        _present("category"),
        _positive("base_price"),
        Rule("stock_quantity_not_negative", F.col("stock_quantity") >= 0),
    ]


def customer_rules(
    segments: Sequence[str] = CUSTOMER_SEGMENTS,
    required: Sequence[str] = (
        "customer_name",
        "email",
        "phone",
        "city",
        "country",
        "signup_date",
    ),
) -> list[Rule]:
    return [
        _positive("customer_id"),
        *[_present(c) for c in required],
        Rule("customer_segment_valid", F.col("customer_segment").isin(*segments)),
    ]


def all_hold(rules: Sequence[Rule]) -> Column:
    """True or false, never null."""
    return ~reduce(Column.__or__, [r.broken for r in rules])


def accept(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that obey every rule, as plain conjuncts the scan can be handed."""
    return df.where(reduce(Column.__and__, [r.keep for r in rules]))


def with_reject_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reasons``: the names of the rules a row breaks, in rule order."""
    reasons = F.array_compact(F.array(*[F.when(r.broken, F.lit(r.name)) for r in rules]))
    return df.withColumn("reject_reasons", reasons)


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break at least one rule, with their reasons.

    The filter tests the rules themselves, so reasons are only built for rejects.
    """
    return with_reject_reasons(df.where(~all_hold(rules)), rules)


def reject_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows broken per rule, zero included, from one aggregation over the input."""
    totals = df.agg(*[F.count_if(r.broken).alias(r.name) for r in rules])
    pairs = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("rejected")) for r in rules]
    )
    return totals.select(F.inline(pairs))


def not_stored(new: DataFrame, existing: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``new`` without a match in ``existing``; a null key matches nothing.

    Both sides are evaluated once. The stored keys are reduced to distinct ones first, so
    that a key stored many times is sent once; the batch itself is not shuffled if they
    are few enough for Spark to broadcast them.
    """
    keys = list(on)
    return new.join(existing.select(*keys).distinct(), keys, "left_anti")


def funnel(
    raw: DataFrame, rules: Sequence[Rule], existing: DataFrame | None, key: str
) -> DataFrame:
    """Records read, cleaned, written, and removed as already stored.

    The input is flagged once and meets the distinct stored keys in a left join, which
    neither drops nor repeats a row.
    """
    flagged = raw.select(F.col(key).alias("_key"), all_hold(rules).alias("_clean"))
    if existing is None:
        found = flagged.withColumn("_stored", F.lit(False))
    else:
        stored = existing.select(F.col(key).alias("_key"), F.lit(True).alias("_stored")).distinct()
        found = flagged.join(stored, "_key", "left")
    new = F.col("_clean") & F.col("_stored").isNull() if existing is not None else F.col("_clean")
    return found.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if("_clean").alias("records_cleaned"),
        F.count_if(new).alias("records_written"),
    ).withColumn("duplicates_removed", F.col("records_cleaned") - F.col("records_written"))


def observed_funnel(
    raw: DataFrame, rules: Sequence[Rule], existing: DataFrame | None, key: str, store: Callable[[DataFrame], None]
) -> dict[str, int]:
    """``store`` the rows that are clean and new; the counts of ``funnel`` from that same job.

    Observed metrics ride on the write, so the input is read once. Spark counts each
    partition of the job that ends well once; only a stage that has to run again after its
    output was lost with an executor may count twice, which ``funnel`` never does. The
    join's input is counted before it, so ``store`` must read its frame once.
    """
    read, cleaned, written = (Observation(f"{n}-{uuid.uuid4().hex}") for n in ("read", "cleaned", "written"))
    count = F.count(F.lit(1)).alias("n")
    clean = accept(raw.observe(read, count), rules).observe(cleaned, count)
    fresh = clean if existing is None else not_stored(clean, existing, [key])
    store(fresh.observe(written, count))
    n = {"records_read": read.get["n"], "records_cleaned": cleaned.get["n"], "records_written": written.get["n"]}
    return {**n, "duplicates_removed": n["records_cleaned"] - n["records_written"]}
