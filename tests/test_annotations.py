from pyspark.sql import types as T

from lakeops.operators import annotations as an
from tests.helpers import rows


def test_annotations(spark):
    df = spark.createDataFrame(
        [("u", 1, 1), ("u", 1, 0), ("w", 0, 0), ("w", None, 0)], "who string, a int, b int"
    )
    assert rows(an.class_distribution(df, ["a", "b"])) == [
        ("a", "0", 1, 33.33),
        ("a", "1", 2, 66.67),
        ("b", "0", 3, 75.0),
        ("b", "1", 1, 25.0),
    ]
    assert rows(an.annotation_productivity(df, ["who"])) == [("u", 2), ("w", 2)]
    assert rows(an.agreement_rate(df, "a", "b")) == [(3, 66.67)]
    assert rows(an.agreement_rate(df, "a", "b", ["who"])) == [("u", 2, 50.0), ("w", 1, 100.0)]


def test_normalise(spark):
    df = spark.createDataFrame([("7", "x", True)], "id string, label string, extra boolean")
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("label", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    got = an.normalise_annotations(df, schema)
    assert rows(got) == [(7, "x", None)] and got.schema == schema
