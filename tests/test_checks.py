import pytest

from lakeops.operators import checks as dq
from lakeops.operators.metrics import failure_status
from tests.helpers import AS_OF, plan, rows, silver


ALL = dq.silver_sales_checks(**dq.EXAMPLE_BOUNDS)


def report(spark, df, checks=None):
    out = dq.run_checks(df, checks or ALL, AS_OF)
    return {r["check_name"]: r for r in out.collect()}


# an average purchase must lie between 50 and 2000
GOOD = {
    "total_amount": 100.0,
    "unit_price": 50.0,
    "transaction_timestamp": "2024-05-10T11:00:00",
}


def test_clean_table_passes_all_twenty(spark):
    got = report(spark, silver(spark, GOOD, GOOD))
    assert len(got) == 20
    assert [n for n, r in got.items() if not r["passed"]] == []


@pytest.mark.parametrize(
    "change, failing",
    [
        ({"customer_id": None}, {"No missing customer IDs"}),
        ({"transaction_id": None}, {"No missing transaction IDs"}),
        ({"product_id": None}, {"No missing product IDs"}),
        ({"transaction_timestamp": None}, {"No missing timestamps"}),
        (
            {"quantity": -1},
            {"No negative quantities", "Total amount matches calculation"},
        ),
        (
            {"quantity": 0},
            {
                "No negative quantities",
                "No zero quantities",
                "Total amount matches calculation",
            },
        ),
        ({"total_amount": 101.0}, {"Total amount matches calculation"}),
        (
            {"total_amount": -100.0},
            {"No negative amounts", "Total amount matches calculation"},
        ),
        ({"payment_method": "bitcoin"}, {"Valid payment methods"}),
        ({"payment_method": None}, set()),  # an unknown condition is not a failure
        ({"status": ""}, {"Valid status values"}),
        ({"product_id": 51}, {"Product ID in valid range"}),
        ({"customer_id": 1001}, {"Customer ID in valid range"}),
        ({"customer_id": 0}, {"Customer ID in valid range"}),
        ({"transaction_id": "t1"}, {"No duplicate transactions"}),
        (
            {"unit_price": 3000.0, "total_amount": 6000.0},
            {
                "Average transaction value in expected range",
                "No extremely high transactions (fraud detection)",
            },
        ),
    ],
)
def test_each_defect_fails_its_checks(spark, change, failing):
    others = [GOOD] * 9
    got = report(spark, silver(spark, *others, {**GOOD, **change}))
    bad = {n for n, r in got.items() if not r["passed"]}
    # one bad amount in ten may or may not move the mean out of its range
    assert bad - {"Average transaction value in expected range"} == failing - {
        "Average transaction value in expected range"
    }


def test_freshness_is_strict(spark):
    old = {**GOOD, "transaction_timestamp": "2024-05-10T10:00:00"}
    got = report(spark, silver(spark, old))["Data is recent (within 2 hours)"]
    assert got["value"] == 2.0 and not got["passed"]


def test_empty_table(spark):
    got = report(spark, silver(spark, GOOD).limit(0))
    assert not got["Table has data"]["passed"]
    assert got["Average quantity in expected range"]["value"] is None
    assert not got["Average quantity in expected range"]["passed"]


def test_missing_column_fails_schema_and_its_own_checks(spark):
    df = silver(spark, GOOD).drop("customer_id")
    checks = [
        dq.required_columns("schema", "customer_id", "status"),
        dq.no_missing("ids", "customer_id"),
        dq.no_duplicates("unique", "customer_id"),
    ]
    got = report(spark, df, checks)
    assert got["schema"]["value"] == 1.0
    assert not any(r["passed"] for r in got.values())


def test_duplicate_count_counts_values_not_rows(spark):
    df = silver(spark, *[{**GOOD, "transaction_id": i} for i in ("a", "a", "a", "b", "b", "c")])
    got = report(spark, df)["No duplicate transactions"]
    assert (got["value"], got["failed_rows"]) == (2.0, 2)


def test_fail_on_error(spark):
    df = silver(spark, {**GOOD, "status": "?"})
    with pytest.raises(dq.ChecksFailed, match="Valid status values"):
        dq.run_checks(df, ALL, AS_OF, fail_on_error=True)


def test_summary_and_counts(spark):
    df = silver(spark, {**GOOD, "status": "?"})
    out = dq.run_checks(df, ALL, AS_OF)
    got = dq.summarise(out).first().asDict()
    assert got == {
        "status": "failed",
        "checks_run": 20,
        "checks_failed": 1,
        "failed_checks": ["Valid status values"],
    }
    counts = dq.failure_counts(out.unionByName(out))
    assert rows(counts) == [("Valid status values", 2)]
    assert failure_status(counts).first().asDict() == {
        "failures": 2,
        "colour": "yellow",
        "state": "FAIL",
    }
    assert failure_status(counts.limit(0)).first()["state"] == "PASS"


def test_row_level_checks_share_one_scan(spark, path):
    silver(spark, GOOD).write.parquet(path + "/t")
    table = spark.read.parquet(path + "/t")
    checks = [c for c in ALL if c.metric != "duplicate_count"]
    assert plan(dq.run_checks(table, checks, AS_OF)).count("FileScan") == 1
    p = plan(dq.run_checks(table, ALL, AS_OF))
    scans = [line for line in p.splitlines() if "FileScan" in line]
    # both read what was stored of the input, which itself was read once
    assert len(scans) == 2 and not any(f"{path}/t" in s for s in scans)
    assert any("ReadSchema: struct<transaction_id:string>" in s for s in scans)


def test_bounds_that_are_not_given_check_nothing(spark):
    names = {c.name for c in dq.silver_sales_checks()}
    assert len(names) == 15 and "Prevent data explosion" not in names
    got = report(spark, silver(spark, {**GOOD, "product_id": 51}), dq.silver_sales_checks())
    assert all(r["passed"] for r in got.values())


def test_averages_are_plain_and_nan_fails(spark):
    df = spark.createDataFrame([(1e-5, 1e16, float("nan")), (1e-5, 1e16, 1.0)], "a double, b double, c double")
    checks = [dq.average("a", "a", 1e-6, 1e-4), dq.average("b", "b", 1e15, 1e17), dq.average("c", "c", 0, 5), dq.Check("d", "max", "c", above=0)]
    got = report(spark, df, checks)
    assert got["a"]["passed"] and got["a"]["value"] == 1e-5
    assert got["b"]["passed"] and got["b"]["value"] == 1e16
    assert not got["c"]["passed"] and not got["d"]["passed"]


def test_unknown_metric():
    with pytest.raises(ValueError, match="metric"):
        dq.Check("x", "median")
