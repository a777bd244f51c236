"""Small hand-made inputs and plan inspection."""

from __future__ import annotations

from datetime import datetime

AS_OF = "2024-05-10 12:00:00"

SALE = {
    "transaction_id": "t1",
    "customer_id": 1,
    "product_id": 1,
    "quantity": 2,
    "unit_price": 10.0,
    "total_amount": 20.0,
    "transaction_timestamp": "2024-05-10T10:00:00",
    "payment_method": "cash",
    "store_id": 1,
    "status": "completed",
}


def sales(spark, *changes):
    """Raw sales: one clean row per dict, with that dict's changes applied."""
    from lakeops.schemas import SALES_RAW

    rows = []
    for i, change in enumerate(changes, 1):
        row = {**SALE, "transaction_id": f"t{i}", **change}
        rows.append(tuple(row[f] for f in SALES_RAW.fieldNames()))
    return spark.createDataFrame(rows, SALES_RAW)


def silver(spark, *changes, run_date="2024-05-10"):
    from lakeops.operators.silver import to_silver_schema

    return to_silver_schema(sales(spark, *changes), run_date, AS_OF)


def rows(df, *cols):
    df = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in df.collect()], key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)
