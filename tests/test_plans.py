import pytest

from lakeops.operators import checks as dq
from lakeops.plans.gold_run import GOLD_TABLES, overall_status, run_gold
from lakeops.plans.quality_run import check_table
from lakeops.plans.sales_run import SalesConfig, run_sales
from lakeops.schemas import CUSTOMERS, PRODUCTS
from lakeops.sources.tables import append_partitioned, read_table
from tests.helpers import AS_OF, rows, sales, silver

DAY = "2024-05-10"


def dims(spark):
    products = spark.createDataFrame([(1, "pen", "office", 1.0, 5)], PRODUCTS)
    customers = spark.createDataFrame(
        [(1, "Ana", "a@x", "1", "city", "land", "2024-01-01", "New")], CUSTOMERS
    )
    return products, customers


def test_gold_run_is_idempotent(spark, path):
    append_partitioned(silver(spark, {}, {}), path + "/silver", ["partition_date"])
    append_partitioned(silver(spark, {}, run_date="2024-05-09"), path + "/silver", ["partition_date"])
    for _ in range(2):
        out = run_gold(spark, path + "/silver", path + "/gold", DAY, *dims(spark), AS_OF)
        assert rows(out, "step", "status", "rows") == sorted((t, "success", 1) for t in GOLD_TABLES)
    daily = read_table(spark, path + "/gold/daily_sales_summary")
    assert rows(daily, "partition_date", "data_date", "total_transactions") == [(DAY, DAY, 2)]
    run_gold(spark, path + "/silver", path + "/gold", "2024-05-09", *dims(spark), AS_OF)
    assert daily.sparkSession.read.parquet(path + "/gold/daily_sales_summary").count() == 2


def test_gold_run_without_silver_or_rows(spark, path):
    out = run_gold(spark, path + "/none", path + "/gold", DAY, *dims(spark))
    assert {r["status"] for r in out.collect()} == {"skipped"}
    append_partitioned(silver(spark, {}, run_date="2024-05-09"), path + "/silver", ["partition_date"])
    out = run_gold(spark, path + "/silver", path + "/gold", DAY, *dims(spark))
    assert {r["status"] for r in out.collect()} == {"skipped"}
    # a day without completed sales leaves nothing behind that a later day trips over
    append_partitioned(silver(spark, {"status": "pending"}), path + "/silver", ["partition_date"])
    out = run_gold(spark, path + "/silver", path + "/gold", DAY, *dims(spark))
    assert {r["step"]: r["status"] for r in out.collect()}["product_performance"] == "skipped"
    out = run_gold(spark, path + "/silver", path + "/gold", "2024-05-09", *dims(spark))
    assert {r["status"] for r in out.collect()} == {"success"}


def test_sales_run_can_be_repeated_under_its_stamp(spark, path):
    def state():
        lines = spark.read.option("recursiveFileLookup", True).text(path + "/bronze/sales").count()
        samples = rows(spark.read.parquet(path + "/metrics/samples"), "name", "value")
        return lines, rows(read_table(spark, path + "/silver/sales").drop("processed_at")), samples

    raw = sales(spark, {}, {}, {"quantity": 0})
    run_sales(spark, config(path), raw, *dims(spark))
    lines, silver_rows, samples = state()
    run_sales(spark, config(path), raw, *dims(spark))
    assert state()[:2] == (lines, silver_rows)
    assert len(state()[2]) == len(samples)


def test_check_scope_of_a_run(spark, path):
    old = {"total_amount": 100.0, "unit_price": 50.0, "transaction_timestamp": "2024-05-09T11:00:00"}
    append_partitioned(silver(spark, {**old, "status": "?"}, run_date="2024-05-09"), path + "/silver/sales", ["partition_date"])
    fresh = sales(spark, {**old, "transaction_timestamp": "2024-05-10T11:00:00"})
    for scope, want in (("table", "failed"), ("partition", "success")):
        out = run_sales(spark, config(path, check_scope=scope), fresh, *dims(spark))
        assert status(out)["validate_quality"][0] == want


def test_one_failing_table_does_not_stop_the_others(spark, path):
    append_partitioned(silver(spark, {}), path + "/silver", ["partition_date"])
    products, customers = dims(spark)
    out = run_gold(spark, path + "/silver", path + "/gold", DAY, products.drop("category"), customers)
    got = {r["step"]: r["status"] for r in out.collect()}
    assert got == {
        "daily_sales_summary": "success",
        "product_performance": "failed",
        "customer_segments": "success",
    }
    assert overall_status(list(got.values())) == "partial_failure"
    assert overall_status(["skipped", "success"]) == "success"
    assert overall_status(["skipped", "skipped"]) == "skipped"


def config(path, **kw):
    return SalesConfig(
        bronze=path + "/bronze",
        silver=path + "/silver",
        gold=path + "/gold",
        metrics=path + "/metrics",
        as_of=kw.pop("as_of", AS_OF),
        checks=kw.pop("checks", dq.silver_sales_checks(**dq.EXAMPLE_BOUNDS)),
        **kw,
    )


def status(df):
    return {r["step"]: (r["status"], r["rows"]) for r in df.collect()}


def test_sales_run_and_rerun(spark, path):
    raw = sales(spark, {}, {}, {"quantity": 0})
    got = status(run_sales(spark, config(path), raw, *dims(spark)))
    assert got["ingest_to_bronze"] == ("success", 3)
    assert got["load_products"] == ("loaded", 0)
    assert got["transform_to_silver"] == ("success", 2)
    assert got["validate_quality"][0] == "failed"  # the mean amount is below 50
    assert got["aggregate_to_gold"] == ("success", 0)

    later = config(path, as_of="2024-05-10 13:00:00", aggregate=False)
    again = run_sales(spark, later, raw, *dims(spark))
    detail = {r["step"]: r["detail"] for r in again.collect()}
    got = status(again)
    assert got["load_products"] == ("skipped", 0)
    assert got["transform_to_silver"] == ("success", 0)
    assert detail["transform_to_silver"] == "read=3, cleaned=2, written=0, duplicates=2"
    assert got["aggregate_to_gold"] == ("skipped", 0)
    assert read_table(spark, path + "/silver/sales").count() == 2

    samples = spark.read.parquet(path + "/metrics/samples")
    names = {r[0] for r in samples.select("name").distinct().collect()}
    assert names == {
        "pipeline_records_processed_total",
        "pipeline_data_quality_failures_total",
        "pipeline_delta_table_rows",
        "pipeline_task_status_total",
    }
    assert spark.read.parquet(path + "/metrics/lineage").count() == 8


def test_nothing_to_do(spark, path):
    out = run_sales(spark, config(path), sales(spark, {}).limit(0), *dims(spark))
    assert status(out) == {"ingest_to_bronze": ("skipped", 0)}


def test_only_a_repeated_run_stores_the_clean_rows_on_the_way(spark, path, monkeypatch):
    from lakeops.session import Scratch

    stores, store = [], Scratch.store
    monkeypatch.setattr("lakeops.sources.tables.balanced", lambda *_: pytest.fail("not needed"))
    monkeypatch.setattr(Scratch, "store", lambda self, df: stores.append(1) or store(self, df))
    raw = sales(spark, {}, {}, {"quantity": 0})
    for n, written, times in ((raw, 2, 0), (raw, 0, 1), (sales(spark, {}, {}, {}), 1, 2)):
        ran = run_sales(spark, config(path, checks_enabled=False, aggregate=False), n, *dims(spark))
        assert status(ran)["transform_to_silver"] == ("success", written)
        assert len(stores) == times
    assert read_table(spark, path + "/silver/sales").count() == 3


def test_a_stored_table_is_checked_as_it_lies(spark, path, monkeypatch):
    monkeypatch.setattr("lakeops.operators.checks.materialise", lambda *_: pytest.fail("stored again"))
    long = "x" * 40
    ids = [{"transaction_id": t} for t in ("a", "a", "b", long, long, "c" * 32, "c" * 32)]
    silver(spark, *ids).write.parquet(path + "/t")
    checked = check_table(spark, path + "/t", [dq.no_duplicates("copies", "transaction_id")], AS_OF)
    assert (checked.status, checked.report.first()["value"]) == ("failed", 3.0)


def test_check_table_outcomes(spark, path):
    checks = dq.silver_sales_checks(**dq.EXAMPLE_BOUNDS)
    t = path + "/t"
    assert check_table(spark, t, checks, AS_OF).reason == "table_not_found"
    assert check_table(spark, t, checks, AS_OF, enabled=False).reason == "disabled"
    silver(spark, {}).limit(0).write.parquet(t)
    assert check_table(spark, t, checks, AS_OF).reason == "empty_table"
    silver(spark, {"total_amount": 100.0, "unit_price": 50.0}).write.mode("append").parquet(t)
    late = check_table(spark, t, checks, AS_OF)
    assert late.status == "failed" and late.failed_checks == ["Data is recent (within 2 hours)"]
    assert check_table(spark, t, checks, "2024-05-10 11:00:00").status == "success"
    broken = [dq.no_failed_rows("bad", "no_such_column > 1")]
    assert check_table(spark, t, broken, AS_OF).status == "error"
    with pytest.raises(Exception, match="no_such_column"):
        check_table(spark, t, broken, AS_OF, fail_on_error=True)


def test_checks_can_stop_the_run(spark, path):
    cfg = config(path, fail_on_error=True)
    with pytest.raises(dq.ChecksFailed):
        run_sales(spark, cfg, sales(spark, {}), *dims(spark))
    assert spark.read.parquet(path + "/metrics/samples").count() > 0
