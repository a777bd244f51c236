"""Merge into a partitioned Parquet table: update all on match, insert the rest.

The table is a plain directory, so this is not a transaction: readers may see the
moment between two partitions being swapped. A run that dies half way is healed by
running it again with the same source: every stored row with a key of the source goes,
wherever it lies, and the source's rows come in once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.session import Scratch, remove
from lakeops.sources.tables import create_partitioned, read_or_none, replace_partitions


@dataclass(frozen=True)
class UpsertResult:
    updated: int
    inserted: int


def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    null_keys: str = "reject",
) -> UpsertResult:
    """Merge ``source`` into the table at ``path`` on ``keys``.

    Only partitions that receive rows, or lose them because a matched row moves, are
    rewritten. A source without rows changes nothing and creates no table. Rows with a
    null key match nothing; they are rejected unless ``null_keys="insert"``, in which
    case every run inserts them again.
    """
    with Scratch(spark, "upsert") as scratch:
        source = scratch.store(source)
        _check_keys(source, keys, null_keys)
        rows = source.count()
        if not rows:
            return UpsertResult(0, 0)
        target = read_or_none(spark, path, source.schema)
        if target is None:
            create_partitioned(source, path, partition_cols)
            return UpsertResult(0, rows)

        # a matched row may sit in another partition than its replacement, unless the
        # partition is part of the key: then the source's own partitions bound the search
        wanted = source.select(*keys)
        fixed = set(partition_cols) <= set(keys)
        searched = _within(target, source, partition_cols) if fixed else target
        matched = scratch.store(
            searched.select(*dict.fromkeys([*keys, *partition_cols])).join(wanted, list(keys), "left_semi")
        )
        parts = source.select(*partition_cols).unionByName(matched.select(*partition_cols))
        touched = scratch.store(parts.distinct())

        affected = _within(target, touched, partition_cols).join(
            _renamed(touched, partition_cols), _same(partition_cols), "left_semi"
        )
        kept = affected.join(wanted, list(keys), "left_anti")
        staged = scratch.store(kept.unionByName(source))
        emptied = touched.join(
            _renamed(staged.select(*partition_cols).distinct(), partition_cols), _same(partition_cols), "left_anti"
        )
        # named before anything is swapped
        gone = scratch.store(_directories(affected, emptied, partition_cols))
        replace_partitions(staged, path, partition_cols)
        for row in gone.toLocalIterator():  # directory names, one at a time
            remove(spark, row["directory"])
        updated = matched.select(*keys).distinct().count()
        return UpsertResult(updated, rows - updated)


def _renamed(parts: DataFrame, cols: Sequence[str]) -> DataFrame:
    return parts.select(*[F.col(c).alias(f"_part_{c}") for c in cols])


def _same(cols: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_part_{c}")) for c in cols])


def _within(target: DataFrame, parts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The target between the least and the greatest value of each partition column.

    One row of bounds, whatever the number of partitions; as a filter on partition
    columns it prunes directories.
    """
    bounds = parts.agg(
        *[F.min(c).alias(f"low_{c}") for c in cols],
        *[F.max(c).alias(f"high_{c}") for c in cols],
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols],
    ).first()
    for c in cols:
        inside = F.lit(False)
        if bounds[f"low_{c}"] is not None:
            inside = F.col(c).between(F.lit(bounds[f"low_{c}"]), F.lit(bounds[f"high_{c}"]))
        target = target.where(inside | F.col(c).isNull() if bounds[f"nulls_{c}"] else inside)
    return target


def _directories(affected: DataFrame, emptied: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Directories of the partitions all of whose rows move away; an overwrite leaves those alone."""
    files = affected.select(*cols, F.col("_metadata.file_path").alias("file"))
    # the path is told as a URI, in which a plus sign is itself
    told = F.replace(F.regexp_replace("file", "/[^/]*$", ""), F.lit("+"), F.lit("%2B"))
    directory = F.url_decode(told).alias("directory")
    return files.join(_renamed(emptied, cols), _same(cols), "left_semi").select(directory).distinct()


def _check_keys(source: DataFrame, keys: Sequence[str], null_keys: str) -> None:
    null_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    if null_keys == "reject" and not source.where(null_key).isEmpty():
        raise ValueError(f"source has null merge keys in {list(keys)}")
    repeated = source.where(~null_key).groupBy(*keys).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"source has more than one row for a merge key {list(keys)}")
