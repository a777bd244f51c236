"""The whole sales flow: land, load dimensions, clean, check, aggregate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.operators import checks as dq, gold, lineage, metrics
from lakeops.operators.rules import Rule, accept, customer_rules, product_rules, sales_rules
from lakeops.operators.silver import anti_dedup, to_silver_schema
from lakeops.plans.gold_run import GOLD_TABLES, overall_status, run_gold
from lakeops.plans.quality_run import check_table
from lakeops.schemas import SALES_RAW, SALES_SILVER, STEP_STATUS
from lakeops.session import Scratch
from lakeops.sources.json_files import LandResult, land_raw, load_dimension, read_json
from lakeops.sources.tables import append_partitioned, read_or_none, table_size


@dataclass(frozen=True)
class SalesConfig:
    """Where the layers are and what the run is about."""

    bronze: str
    silver: str
    gold: str
    metrics: str
    as_of: str
    max_product_id: int | None = None
    checks: Sequence[dq.Check] = field(default_factory=dq.silver_sales_checks)
    checks_enabled: bool = True
    check_scope: str = "table"
    fail_on_error: bool = False
    aggregate: bool = True
    tiers: Sequence[tuple[float, str]] = gold.VALUE_TIERS
    customer_rules: Sequence[Rule] | None = None

    @property
    def run_date(self) -> str:
        return self.as_of[:10]

    @property
    def run_stamp(self) -> str:
        """yyyyMMdd_HHmmss of the run's time; the same run has the same stamp."""
        return dt.datetime.fromisoformat(self.as_of).strftime("%Y%m%d_%H%M%S")

    def lineage_jobs(self) -> list[tuple[str, list[str], list[str]]]:
        raw, sales = f"{self.bronze}/sales", f"{self.silver}/sales"
        gold_tables = [f"{self.gold}/{t}" for t in GOLD_TABLES]
        return [
            ("ingest_to_bronze", [], [raw]),
            ("transform_to_silver", [raw], [sales]),
            ("validate_quality", [sales], []),
            ("aggregate_to_gold", [sales], gold_tables),
        ]


def run_sales(
    spark: SparkSession,
    cfg: SalesConfig,
    raw: DataFrame,
    products: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """One run. ``raw`` holds the new sales in the raw schema, dimensions load once.

    Returns a status row per step, also appended to the metrics table together with
    record counts, check failures and table sizes.
    """
    steps: list[tuple[str, str, int, str | None]] = []
    samples: list[tuple[str, dict[str, str], float]] = []

    landed = land_raw(raw, cfg.bronze, "sales", cfg.run_stamp)
    steps.append(("ingest_to_bronze", landed.status, landed.count, landed.path))
    if landed.status == "skipped":
        return _finish(spark, cfg, steps, samples)
    samples.append(_processed("bronze", "sales", landed.count))

    dimensions = {"products": products, "customers": customers}
    rules = {"products": product_rules(), "customers": cfg.customer_rules or customer_rules()}
    for name, df in dimensions.items():
        status = load_dimension(df, f"{cfg.bronze}/dimensions/{name}.json", rules[name])
        steps.append((f"load_{name}", status, 0, None))
    stored = {
        name: read_json(spark, f"{cfg.bronze}/dimensions/{name}.json", df.schema)
        for name, df in dimensions.items()
    }

    silver_path = f"{cfg.silver}/sales"
    counts = _to_silver(spark, cfg, landed, silver_path)
    detail = ", ".join(f"{k}={v}" for k, v in counts.items())
    steps.append(("transform_to_silver", "success", counts["written"], detail))
    samples.append(_processed("silver", "sales", counts["written"]))

    # "partition" keeps the cost of a run from growing with the table's history
    only = F.col("partition_date") == cfg.run_date if cfg.check_scope == "partition" else None
    checked = check_table(
        spark, silver_path, cfg.checks, cfg.as_of, SALES_SILVER, cfg.checks_enabled, where=only
    )
    failed = checked.failed_checks
    detail = "; ".join(failed) or checked.reason
    samples += [(metrics.QUALITY_FAILURES, {"check_name": c}, 1.0) for c in failed]
    steps.append(("validate_quality", checked.status, len(failed), detail))
    if checked.status in ("failed", "error") and cfg.fail_on_error:
        _finish(spark, cfg, steps, samples)
        raise dq.ChecksFailed(f"checks {checked.status}: {detail}")

    if cfg.aggregate:
        results = run_gold(
            spark,
            silver_path,
            cfg.gold,
            cfg.run_date,
            stored["products"],
            stored["customers"],
            cfg.as_of,
            cfg.tiers,
        ).collect()
        steps.append(
            ("aggregate_to_gold", overall_status([r["status"] for r in results]), 0, None)
        )
        done = [r for r in results if r["status"] == "success"]
        for r in results:
            steps.append((r["step"], r["status"], r["rows"], r["detail"]))
            if r["status"] == "success":
                samples.append(_processed("gold", r["step"], r["rows"]))
        if done:
            sizes = table_size(spark, {r["step"]: f"{cfg.gold}/{r['step']}" for r in done})
            samples += [
                (metrics.TABLE_ROWS, {"table_name": s["table_name"]}, s["row_count"])
                for s in sizes.collect()
            ]
    else:
        steps.append(("aggregate_to_gold", "skipped", 0, "not scheduled"))
    return _finish(spark, cfg, steps, samples)


def _to_silver(spark: SparkSession, cfg: SalesConfig, landed: LandResult, path: str) -> dict[str, int]:
    """Clean, de-duplicate and append one landed file.

    Counts come from file footers, so they stay exact when a stage runs again after losing
    an executor: those written are what the run's partition has gained. Clean rows are
    stored on the way only if there are stored ones to compare them with.
    """
    rules = sales_rules(cfg.as_of, cfg.max_product_id)
    typed = to_silver_schema(read_json(spark, landed.path, SALES_RAW), cfg.run_date, cfg.as_of)
    with Scratch(spark, "silver") as scratch:
        clean, today = accept(typed, rules), F.col("partition_date") == cfg.run_date
        stored = read_or_none(spark, path, SALES_SILVER)
        before = 0 if stored is None else stored.where(today).count()
        if before:
            clean = scratch.store(clean)
            fresh = anti_dedup(clean, stored.where(today), "transaction_id")
        else:
            fresh = clean
        append_partitioned(fresh, path, ["partition_date"], one=True)
        stored = read_or_none(spark, path, SALES_SILVER)
        written = 0 if stored is None else stored.where(today).count() - before
        cleaned = clean.count() if before else written
    return {
        "read": landed.count,
        "cleaned": cleaned,
        "written": written,
        "duplicates": cleaned - written,
    }


def _processed(layer: str, table: str, n: int) -> tuple[str, dict[str, str], float]:
    return metrics.RECORDS_PROCESSED, {"layer": layer, "table": table}, float(n)


def _finish(spark, cfg: SalesConfig, steps: list, samples: list) -> DataFrame:
    samples = samples + [
        (metrics.TASK_STATUS, {"operation": step, "status": status}, 1.0)
        for step, status, _, _ in steps
    ]
    metrics.append_samples(metrics.samples(spark, cfg.as_of, samples), f"{cfg.metrics}/samples", cfg.run_stamp)
    edges = lineage.lineage_edges(lineage.declare(spark, cfg.lineage_jobs()))
    edges.write.mode("overwrite").parquet(f"{cfg.metrics}/lineage")
    return spark.createDataFrame(steps, STEP_STATUS)
