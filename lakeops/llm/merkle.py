"""Merkle manifest of a dataset: a nested-struct rollup over rank digits.

Every row is a leaf, H of its fields. The leaves of a group, in order, form a tree with a
fan of eight; the groups' tops, in order, form one more. A row's rank is written in base
eight and cut into a block number and ``DIGITS`` digits. Within a block the digit columns are
grouped away one after the other, lowest first: each grouping nests the children as an array
of structs and makes their node. All groupings of a block run in one stage, since rows are
dealt out by the block. A tree of more than one block goes on with the blocks' nodes as the
next tier's leaves.

Proofs come down the same way and need no join: a block's row meets the row that its parent
emitted for it in one grouping, then a nested transform lists the siblings level by level
and an explode gives one row a child. No row ever holds more than 8 ** DIGITS children,
however large a group is.

Defined cases: a null field is written as "-"; a null group is a group of its own and comes
first; null ids come first; rows with the same id are ordered by their leaf, so equal rows
may change places without any effect; an empty table gives an empty result; columns that
are neither fields nor kept are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.frames import materialise, small_side
from lakeops.llm.words import ascii_lower
from lakeops.operators.ordered import number_rows

FAN = 8
#: Digits of a rank within a block: 512 leaves, some 80 KB.
DIGITS = 3
BLOCK = FAN**DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"


def leaf_hash(fields: Sequence[Column]) -> Column:
    """H of the fields, each as its UTF-8 byte count, a colon and its value, or "-" if null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda h, level: F.sha2(F.concat(level["left"], h, level["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """H of all siblings, level by level upward, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def lowered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text with A-Z lower-cased in every row whose decimal id has a crc32 that 3 divides; else null."""
    return F.when(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 3 == 0, ascii_lower(F.col(f"`{text}`")))


def manifest(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    text: str = "text",
    altered: Column | None = None,
) -> DataFrame:
    """row (the columns ``keep``), leaf, subroot, root, proof and altered_leaf of every row.

    proof lists the siblings to the left and right on each level, joined, from the leaf's
    upward. altered_leaf is the leaf of the row with ``altered`` as its text, null where
    ``altered`` is null.
    """
    altered = F.lit(None).cast("string") if altered is None else altered
    columns = [F.col(f"`{f}`") for f in fields]
    other = [altered if f == text else c for f, c in zip(fields, columns)]
    leaves = docs.select(
        F.col(f"`{group}`").alias("k"),
        F.col(f"`{order}`").alias("o"),
        leaf_hash(columns).alias("h"),
        F.struct(
            F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
            F.when(altered.isNotNull(), leaf_hash(other)).alias("altered_leaf"),
        ).alias("p"),
    )
    leaves = materialise(leaves, "leaves")  # ranking reads it twice, the texts only once
    tree = _tree(_ranked(leaves, ["k"], ["o", "h"]))
    # the tops of all groups; a top lies in the tier that has its whole group in one block
    tops = [
        tier.where(F.col("n") <= BLOCK).select("k", "h", F.lit(i).alias("tier")) for i, tier in enumerate(tree)
    ]
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    roots = roots.select(F.lit(0).alias("k"), F.col("k").alias("o"), "h", F.struct(F.col("k").alias("group"), "tier").alias("p"))
    over = _tree(_ranked(materialise(roots, "roots"), ["k"], ["o"]))
    start = [
        t.where(F.col("n") <= BLOCK).select("k", "block", F.array().cast(PATH).alias("path"), F.struct(F.col("h").alias("root")).alias("up"))
        for t in over
    ]
    groups = materialise(_emit(over, start), "groups")
    start = [
        groups.where(F.col("p.tier") == i).select(
            F.col("p.group").alias("k"), F.lit(0).cast("bigint").alias("block"), "path",
            F.struct(F.col("h").alias("subroot"), F.col("up.root").alias("root")).alias("up"),
        )
        for i in range(len(tree))
    ]
    return _emit(tree, start).select(
        "p.row", F.col("h").alias("leaf"), "up.subroot", "up.root", F.col("path").alias("proof"), "p.altered_leaf"
    )


def _ranked(nodes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """k, r (rank from 0), n (nodes of the tree), h, p. Spark orders text by its UTF-8 bytes, nulls first."""
    numbered = number_rows(nodes, keys, order, "_n")
    sizes = materialise(nodes.groupBy(F.col("k").alias("_k")).agg(F.count(F.lit(1)).alias("n")), "sizes")
    return numbered.join(small_side(sizes), F.col("k").eqNullSafe(F.col("_k"))).select("k", (F.col("_n") - 1).alias("r"), "n", "h", "p")


def _tree(nodes: DataFrame) -> list[DataFrame]:
    """The tiers, lowest first, each a stored table: k, block, n (nodes it started from), h, kids."""
    tiers = []
    while True:
        tiers.append(materialise(_roll(nodes), "tier"))
        above = tiers[-1].where(F.col("n") > BLOCK)
        if above.isEmpty():
            return tiers
        nodes = above.select("k", F.col("block").alias("r"), F.ceil(F.col("n") / BLOCK).alias("n"), "h", F.lit(None).cast("string").alias("p"))


def _roll(nodes: DataFrame) -> DataFrame:
    digits = [f"d{i}" for i in range(DIGITS)]
    block = F.shiftright("r", 3 * DIGITS).alias("block")
    rows = nodes.select("k", "n", block, *[F.shiftright("r", 3 * i).bitwiseAND(FAN - 1).cast("int").alias(d) for i, d in enumerate(digits)], "h", "p")
    rows = rows.repartition("k", "block").withColumnRenamed("p", "kids")
    for i, digit in enumerate(digits):
        rest = ["k", "n", "block", *digits[i + 1 :]]
        rows = rows.groupBy(*rest).agg(F.array_sort(F.collect_list(F.struct(F.col(digit).alias("d"), "h", "kids"))).alias("kids"))
        joined = F.array_join(F.transform("kids", lambda x: x["h"]), "")
        rows = rows.withColumn("h", F.when(_goes_on(i), F.sha2(joined, 256)).otherwise(F.col("kids")[0]["h"]))
    return rows.select("k", "n", "block", "h", "kids")


def _goes_on(level: int) -> Column:
    """Whether a tree still has several nodes on that level of the tier, so that they become runs."""
    return F.col("n") > FAN**level


def _emit(tiers: list[DataFrame], start: list[DataFrame]) -> DataFrame:
    """h, p, path and up of every node the tree was made from.

    start: for each tier the blocks that are a tree's top, as k, block, path (from there
    upward) and up (handed down as it is).
    """
    coming = None
    for i in range(len(tiers) - 1, -1, -1):
        into = start[i] if coming is None else start[i].unionByName(coming)
        met = tiers[i].drop("h").unionByName(into, allowMissingColumns=True)
        one = lambda c: F.collect_list(c)[0].alias(c)  # noqa: E731  of the one row that has it
        met = met.groupBy("k", "block").agg(one("n"), one("kids"), one("path"), one("up"))
        nodes = F.array(F.struct("kids", "path"))
        for level in range(DIGITS - 1, -1, -1):
            nodes = _children(nodes, level)
        one_each = met.select("k", "block", "up", F.posexplode(nodes).alias("place", "x"))
        out = one_each.select("k", (F.col("block") * BLOCK + F.col("place")).alias("block"), "x.path", "up", F.col("x.h").alias("h"), F.col("x.kids").alias("p"))
        coming = out.select("k", "block", "path", "up")
    return out.drop("k", "block")


def _children(nodes: Column, level: int) -> Column:
    """Of nodes (kids, path) all children, with the run's others before the path."""

    def below(node: Column) -> Column:
        hashes = F.transform(node["kids"], lambda x: x["h"])
        side = lambda part: F.array_join(part, "")

        def child(x: Column, i: Column) -> Column:
            run = F.struct(
                side(F.slice(hashes, F.lit(1), i)).alias("left"), side(F.slice(hashes, i + 2, F.lit(FAN))).alias("right")
            )
            path = F.when(_goes_on(level), F.concat(F.array(run), node["path"])).otherwise(node["path"])
            return F.struct(x["h"].alias("h"), x["kids"].alias("kids"), path.alias("path"))

        return F.transform(node["kids"], child)

    return F.flatten(F.transform(nodes, below))
