"""Code for the executors, tables that are passed on and go, joins by checked size, components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.session import new_scratch

#: Up to so many rows of a few numbers a stored table is broadcast: about 64 MB in memory.
BROADCAST_ROWS = 1_000_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        file = Path(tempfile.mkdtemp(prefix="lakeops-py-"), "lakeops.zip")
        with zipfile.ZipFile(file, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(file))
        _shipped.add(app)
    return spark


_folder: ContextVar[str | None] = ContextVar("folder", default=None)


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder that takes what ``materialise`` stores inside; whoever opens it removes it.

    That is due as soon as what was made from its tables is stored itself.
    """
    path = f"{_folder.get()}/{label}-{uuid.uuid4().hex}" if _folder.get() else new_scratch(spark, label)
    token = _folder.set(path)
    try:
        yield path
    finally:
        _folder.reset(token)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """As ``lakeops.session.materialise``, in the open scratch folder if there is one."""
    spark = df.sparkSession
    path = f"{_folder.get()}/{label}-{uuid.uuid4().hex}" if _folder.get() else new_scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table``, marked for broadcast if a count proves it small; else it is shuffled."""
    return F.broadcast(table) if table.count() <= rows else table


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the edges (a, b).

    Alternates two star steps on stored tables: every node first points its larger
    neighbours, then its smaller ones, at the smallest it knows. The number of rounds grows
    with the logarithm of the longest path; no step gathers a node's neighbours.
    """
    now = materialise(_down(edges), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        now = materialise(_small_star(_large_star(now)), "edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _down(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node, without loops."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points at the node's smallest neighbour or itself."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    larger = edges.select(F.col("b").alias("n"), F.col("a").alias("v"))
    joined = larger.join(least, "n", "left").select(F.col("v").alias("a"), F.coalesce("m", "n").alias("b"))
    # a node without larger neighbours keeps its own edges to smaller ones
    own = edges.groupBy("a").agg(F.min("b").alias("b"))
    return _down(joined.unionByName(own))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point at the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(joined.unionByName(least.select("a", F.col("m").alias("b"))))
