"""Slicing must give what a plain window gives, also when one group is most of the data."""

import random

from pyspark.sql import Window as W, functions as F

from lakeops.operators.ordered import number_rows, previous_value
from tests.helpers import rows


def skewed(spark, n=600):
    rng = random.Random(7)
    data = [
        ("hot" if i % 3 else rng.choice(["a", "b", None, "c"]), rng.randrange(1000), i, rng.choice([i, None]))
        for i in range(n)
    ]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, t int, id int, v int").repartition(3)


def test_number_rows_equals_row_number(spark):
    df = skewed(spark)
    want = df.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy("t", "id")).cast("bigint"))
    assert rows(number_rows(df, ["g"], ["t", "id"], "n")) == rows(want)


def test_previous_value_equals_lag(spark):
    df = skewed(spark)
    want = df.withColumn("p", F.lag("v").over(W.partitionBy("g").orderBy("t", "id")))
    assert rows(previous_value(df, ["g"], ["t", "id"], "v", "p")) == rows(want)


def test_hot_group_is_cut_and_little_is_carried(spark):
    from lakeops.operators import ordered

    sliced = ordered._slices(skewed(spark), ["g"], ["t", "id"])
    per_slice = sliced.where("g = 'hot'").groupBy("_slice").count().collect()
    assert len(per_slice) >= 2
    total = sum(r["count"] for r in per_slice)
    assert max(r["count"] for r in per_slice) < total


def test_one_row_and_no_rows(spark):
    df = skewed(spark).limit(1)
    assert [r["n"] for r in number_rows(df, ["g"], ["t", "id"], "n").collect()] == [1]
    assert number_rows(df.where("false"), ["g"], ["t", "id"], "n").count() == 0
    assert previous_value(df, ["g"], ["t", "id"], "v", "p").first()["p"] is None
