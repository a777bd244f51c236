"""Mixing sources to target weights.

Every source gets a word budget. Whole epochs of a source come first; what remains of the
budget is filled by weighted sampling without replacement after Efraimidis and Spirakis:
each document draws u ** (1 / weight) from a hash of its id and text, documents are taken
from the largest key down, and the prefix sum of their sizes decides where to stop, at the
border that comes nearest to the budget.

No source is ever sorted in one task. Keys lie in (0, 1), so they fall into equal buckets;
sizes are summed by source and bucket (partial sums first), and the prefix sum over buckets
finds the one that holds the border. That bucket is cut into as many again in the same way,
and only the rows of the small bucket with the border, about one in ``BUCKETS`` squared of a
source, are sorted. The outcome for a source is one cut (key, id), and a document compares
itself with its source's cut.

Defined cases: a null text has size 0; a null source is a source of its own, ordered last;
null ids sort before others; a null weight is 1; documents with the same id and text share
their key, so they go in or stay out together; an empty table gives an empty result; other
columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lakeops.llm.frames import materialise
from lakeops.llm.words import hidden, space_words, text_of
from lakeops.operators.ordered import number_rows

BUCKETS = 1 << 12
MAX_EPOCHS = 3


def word_count(text: str) -> Column:
    return F.size(space_words(text_of(text))).cast("bigint")


def uniform(*columns: Column, seed: int = 17) -> Column:
    """A number in (0, 1) that depends on the columns and the seed alone."""
    told = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(told), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from one row per source (source, source_size).

    Targets share the total by weight; a source stops at ``max_epochs`` times its size and
    what it leaves is shared again by weight, until nobody is above. Each round is one
    aggregation over the sources and sends two numbers to the driver; the level only rises,
    so a source that has stopped stays so, and the rounds end when none stops any more.
    """
    placed = sizes.withColumns({
        "_null": F.col("source").isNull(),
        "_bytes": F.encode(F.coalesce("source", F.lit("")), "UTF-8"),
    })
    ranked = number_rows(placed.withColumn("_all", F.lit(0)), ["_all"], ["_null", "_bytes"], "_n")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_n") - 1) % len(weights) + 1).cast("int"))
    weighted = materialise(
        ranked.select("source", "source_size", weight.alias("weight"), (max_epochs * F.col("source_size")).alias("most")),
        "targets",
    )
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("most")
        full, left, n = weighted.agg(
            F.sum(F.when(over, F.col("most"))), F.sum(F.when(~over, F.col("weight"))), F.count(F.when(over, 1))
        ).first()
        if n == stopped or not left:
            break
        level, stopped = (total - (full or 0)) / left, n
    target = F.least(F.col("weight") * F.lit(level), F.col("most").cast("double"))
    return weighted.select("source", "source_size", target.alias("target"))


def mix_plan(rows: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, epochs, and the cut (cut_key, cut_id).

    ``rows`` has source, size, key, id. A document above or at the cut is taken once more
    than ``epochs``; without a cut (null) none is.
    """
    scaled = F.col("key") * BUCKETS  # a power of two, so this and what follows is exact
    rows = rows.withColumn("bucket", _floored(scaled))
    rows = rows.withColumn("fine", _floored((scaled - F.col("bucket")) * BUCKETS))
    by_bucket = materialise(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    sizes = by_bucket.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = materialise(
        targets.withColumn("epochs", F.least(epochs, F.lit(max_epochs)).cast("bigint")).withColumn(
            "rest", F.col("target") - F.col("epochs") * F.col("source_size")
        ),
        "plan",
    )
    start = plan.select(F.col("source").alias("_source"), F.lit(0).cast("bigint").alias("before"), "rest").where("rest > 0")
    of_source = F.col("source").eqNullSafe(F.col("_source"))
    coarse = _border(by_bucket.join(start, of_source), "bucket").withColumnRenamed("bucket", "_bucket")
    by_fine = (
        rows.join(coarse, of_source & (F.col("bucket") == F.col("_bucket")))
        .groupBy("source", "_source", "_bucket", "fine", "before", "rest")
        .agg(F.sum("size").alias("words"))
    )
    border = materialise(_border(by_fine, "fine").withColumnRenamed("fine", "_fine"), "borders")
    # only these rows are sorted: one small bucket of each source
    same = of_source & (F.col("bucket") == F.col("_bucket")) & (F.col("fine") == F.col("_fine"))
    step = W.partitionBy("source").orderBy(F.desc("key"), F.desc("id"))
    inside = (
        rows.join(border, same)
        .groupBy("source", "key", "id", "before", "rest")
        .agg(F.sum("size").alias("size"))
        .withColumn("through", F.col("before") + F.sum("size").over(step))
    )
    # taken while the border is nearer after the document than before it; a source's first
    # document of the small bucket may fall out, then the cut is that bucket's upper edge
    taken = F.col("through") - F.col("size") / 2 <= F.col("rest")
    cut = inside.groupBy("source").agg(F.min(F.when(taken, F.struct("key", "id"))).alias("low"))
    edge = (F.col("_bucket") + (F.col("_fine") + 1) / F.lit(float(BUCKETS))) / F.lit(float(BUCKETS))
    edges = border.select(F.col("_source").alias("_s"), edge.alias("edge"))
    cuts = cut.join(edges, F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("_source"),
        F.coalesce(F.col("low.key"), F.col("edge")).alias("cut_key"),
        F.when(F.col("low").isNotNull(), F.col("low.id")).alias("cut_id"),
    )
    return materialise(
        plan.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "source_size", "target", "epochs", "cut_key", "cut_id"
        ),
        "mix-plan",
    )


def _floored(scaled: Column) -> Column:
    return F.least(scaled.cast("int"), F.lit(BUCKETS - 1))


def _border(parts: DataFrame, part: str) -> DataFrame:
    """The one ``part`` of each source that holds the border, and the words ``before`` it.

    ``parts``: source, words, before (words above all parts), rest; ``BUCKETS`` rows of a
    source meet here at most, however many documents it has.
    """
    down = W.partitionBy("source").orderBy(F.desc(part))
    above = parts.withColumn("before", F.col("before") + F.sum("words").over(down) - F.col("words"))
    return above.where("before < rest AND before + words >= rest").drop("source", "words")


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    quality: Column | None = None,
    weights: Sequence[float] = (1.0, 2.0, 3.0),
    seed: int = 17,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """row (the document's own columns, or those to ``keep``), size, source_size, target, copies, taken.

    ``quality`` is a positive weight per document; by default it lies between a half and
    two and is highest where words have a usual length. The keyed rows are stored once;
    the plan reads only their numbers.
    """
    flat = docs.select(
        hidden(docs if keep is None else docs.select(*keep)),
        F.col(f"`{source}`").alias("source"),
        F.col(f"`{doc_id}`").cast("bigint").alias("id"),
        text_of(f"`{text}`").alias("t"),
        (F.lit(None).cast("double") if quality is None else F.coalesce(quality, F.lit(1.0))).alias("given"),
    ).withColumn("size", word_count("t"))
    weight = default_quality(F.col("t"), F.col("size")) if quality is None else F.col("given")
    u = uniform(F.col("id"), F.md5("t"), seed=seed)
    keyed = materialise(
        flat.select("row", "source", "id", "size", F.round(F.pow(u, 1 / weight), 15).alias("key")), "mix-keys"
    )
    plan = mix_plan(keyed.select("source", "id", "size", "key"), weights).withColumnRenamed("source", "_source")
    joined = keyed.join(plan, F.col("source").eqNullSafe(F.col("_source")), "left")
    return joined.select("row", "size", "source_size", "target", copies().alias("copies")).withColumn(
        "taken", F.col("size") * F.col("copies")
    )


def copies() -> Column:
    low = F.coalesce(F.col("cut_id"), F.lit(-(1 << 63)))
    own = F.coalesce(F.col("id"), F.lit(-(1 << 63)))
    above = (F.col("key") > F.col("cut_key")) | ((F.col("key") == F.col("cut_key")) & (own >= low))
    return F.col("epochs") + F.when(F.coalesce(above, F.lit(False)), 1).otherwise(0)


def default_quality(text: Column, words: Column) -> Column:
    """Between 0.5 and 2, highest at seven characters a word with its space."""
    mean = F.length(text) / F.greatest(words, F.lit(1))
    return F.round(0.5 + 1.5 / (1 + F.abs(mean - 7) / 4), 6)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with their own columns, each as often as it is taken."""
    return (
        mix(docs, **options)
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("n"))
        .select("row.*")
    )
