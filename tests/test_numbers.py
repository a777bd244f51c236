"""Properties of the arithmetic, over many values."""

from decimal import Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.functions.numeric import TOTAL, money_avg, money_sum, percentage, round_half_up

cents = st.integers(min_value=-10_000_000, max_value=10_000_000)


@settings(max_examples=15, deadline=None)
@given(values=st.lists(cents, min_size=1, max_size=40))
def test_money_is_exact_in_any_order(spark, values):
    amounts = [v / 100 for v in values]
    df = spark.createDataFrame([(a,) for a in amounts], "x double").repartition(3)
    got = df.agg(money_sum(F.col("x")), money_avg(F.col("x"))).first()
    exact = float(sum(Decimal(v) for v in values) / 100)
    assert got[0] == exact
    assert got[1] == exact / len(values)


def test_rounding_and_percentages(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 0), (1, 8)], "a long, b long")
    got = [r[0] for r in df.select(percentage(F.col("a"), F.col("b"))).collect()]
    assert got == [33.33, 66.67, None, 12.5]
    halves = spark.createDataFrame([(0.125,), (-0.125,), (2.5,)], "x double")
    assert [r[0] for r in halves.select(round_half_up(F.col("x"))).collect()] == [0.13, -0.12, 2.5]


def test_money_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(money_sum(F.col("x"))).first()[0] is None
    assert df.where("false").agg(money_avg(F.col("x"))).first()[0] is None


def test_large_totals_and_odd_amounts(spark):
    df = spark.createDataFrame([(1e13 + 0.25,)] * 4000, "x double").repartition(3)
    assert df.agg(money_sum(F.col("x"))).first()[0] == 4e16 + 1000
    small = spark.createDataFrame([(1e16, 3), (2.5, 2)], "x double, n long")
    got = small.agg(money_sum(F.col("x"), TOTAL), money_sum(F.col("x"), TOTAL, F.col("n"))).first()
    assert got == (1e16 + 2.5, 3e16 + 5)
    nan = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert nan.agg(money_sum(F.col("x"))).first()[0] != nan.agg(money_sum(F.col("x"))).first()[0]
    inf = spark.createDataFrame([(1.0,), (float("inf"),)], "x double")
    assert inf.agg(money_avg(F.col("x"))).first()[0] == float("inf")
