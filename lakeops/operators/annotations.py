"""Annotation analytics: normalisation, classes, productivity, agreement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from lakeops.functions.numeric import percentage


def normalise_annotations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a fixed schema; a column that is absent becomes null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def class_distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count and share of every class of every annotated column."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("class"))
            for c in cols
        ]
    )
    counts = (
        df.select(F.inline(cells))
        .where(F.col("class").isNotNull())
        .groupBy("column_name", "class")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("column_name").agg(F.sum("n").alias("total"))
    return counts.join(totals, "column_name").select(
        "column_name", "class", "n", percentage(F.col("n"), F.col("total")).alias("share_pct")
    )


def annotation_productivity(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("annotations"))


def agreement_rate(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of items on which two annotations agree; unannotated items do not count."""
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return both.groupBy(*by).agg(
        F.count(F.lit(1)).alias("items"),
        percentage(F.count_if(F.col(a) == F.col(b)), F.count(F.lit(1))).alias("agreement_pct"),
    )


def class_counts(df: DataFrame, item: str, label: str) -> DataFrame:
    """item, class, n: how many annotations give an item a class; nulls are no annotation."""
    given = df.where(F.col(label).isNotNull())
    return given.groupBy(F.col(item).alias("item"), F.col(label).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("n"))


def chance_corrected(counts: DataFrame) -> DataFrame:
    """items, annotations, agreement, fleiss_kappa, krippendorff_alpha: one row.

    ``counts`` as from ``class_counts``, for any number of annotators; items may lack
    annotations, and those with fewer than two say nothing and are left out. Fleiss'
    kappa is the form for varying numbers of annotators, alpha the nominal one. Both are
    null where all annotations are of one class, or there are none.

    Items fold to how often each (annotations, agreeing pairs) occurs and each class to its
    sum, so a class that holds most annotations is summed before the shuffle.
    """
    sizes = counts.groupBy("item").agg(
        F.sum("n").alias("m"), F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"), F.collect_list(F.struct("class", "n")).alias("classes")
    )
    paired = sizes.where("m > 1")
    shapes = paired.groupBy("m", "pairs").agg(F.count(F.lit(1)).alias("items"))
    # sums of whole numbers until the last division, so that their order does not matter
    same = F.col("pairs") / (F.col("m") * (F.col("m") - 1))
    observed = shapes.agg(
        F.sum("items").alias("items"),
        F.coalesce(F.sum(F.col("items") * F.col("m")), F.lit(0)).alias("annotations"),
        F.sum(F.col("items") * same).alias("_same"),
        F.sum(F.col("items") * F.col("m") * (1 - same)).alias("_apart"),
    )
    by_class = paired.select(F.inline("classes")).groupBy("class").agg(F.sum("n").alias("n"))
    expected = by_class.agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("_squares"))
    parts = observed.unionByName(expected, allowMissingColumns=True)  # a row each, put side by side
    both = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    n = F.col("annotations")
    by_chance = F.col("_squares") / (F.nullif(n, F.lit(0)).cast("double") * n)
    agreement = F.col("_same") / F.nullif(F.col("items"), F.lit(0))
    disagreement = F.col("_apart") / F.nullif(n, F.lit(0))
    differing = 1 - (F.col("_squares") - n) / F.nullif(n.cast("double") * (n - 1), F.lit(0.0))
    return both.select(
        F.coalesce("items", F.lit(0)).alias("items"),
        "annotations",
        agreement.alias("agreement"),
        ((agreement - by_chance) / F.nullif(1 - by_chance, F.lit(0.0))).alias("fleiss_kappa"),
        (1 - disagreement / F.nullif(differing, F.lit(0.0))).alias("krippendorff_alpha"),
    )


def productivity_by_day(df: DataFrame, annotator: str, ts: str) -> DataFrame:
    """Annotations of each annotator and day, and how many that annotator has made up to it."""
    per_day = df.groupBy(F.col(annotator).alias("annotator"), F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("annotations"))
    so_far = F.sum("annotations").over(W.partitionBy("annotator").orderBy("day"))  # a row for each day
    return per_day.withColumn("total", so_far)
