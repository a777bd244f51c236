"""Which task reads and writes which dataset, and what depends on what.

An edge row is ``(src, task, dst)``. A task's inputs and outputs are rows of their own,
``(src, task, null)`` and ``(null, task, dst)``: linear in what was declared, where
pairing every input with every output would not be, and tasks that only read or only
write are covered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.session import materialise, new_scratch
from lakeops.sources.layers import batch_view


def declare(
    spark: SparkSession, jobs: Sequence[tuple[str, Sequence[str], Sequence[str]]]
) -> DataFrame:
    """``(task, reads, writes)`` declarations of jobs as rows."""
    return spark.createDataFrame(
        [(task, list(reads), list(writes)) for task, reads, writes in jobs],
        "task string, reads array<string>, writes array<string>",
    )


def lineage_edges(jobs: DataFrame) -> DataFrame:
    """Distinct edges from ``(task, reads, writes)`` rows."""
    nothing = F.lit(None).cast("string")
    reads = jobs.select(F.explode("reads").alias("src"), "task", nothing.alias("dst"))
    writes = jobs.select(nothing.alias("src"), "task", F.explode("writes").alias("dst"))
    return reads.unionByName(writes).distinct()


def lineage_impact(
    edges: DataFrame, start: str, direction: str = "downstream", max_depth: int | None = None
) -> DataFrame:
    """Datasets reachable from ``start`` with their smallest number of tasks away.

    Level by level: the datasets found last are joined to the edges, and what is already
    known is dropped, so a dataset is expanded once however many paths lead to it and
    cycles end. Levels are stored in the shared scratch area.
    """
    if direction not in ("downstream", "upstream"):
        raise ValueError(f"unknown direction {direction!r}")
    spark = edges.sparkSession
    into, out_of = ("src", "dst") if direction == "downstream" else ("dst", "src")
    edges = materialise(edges.select("src", "task", "dst"), "lineage-edges")
    consumed = edges.where(F.col(into).isNotNull()).select(F.col(into).alias("dataset"), "task")
    produced = edges.where(F.col(out_of).isNotNull()).select("task", F.col(out_of).alias("dataset"))

    path = new_scratch(spark, "lineage-levels")
    schema = "dataset string, depth int"
    first = spark.range(1).select(F.lit(start).alias("dataset"), F.lit(0).alias("depth"))
    first.write.mode("append").parquet(path)
    depth, frontier = 0, spark.read.schema(schema).parquet(path)
    while max_depth is None or depth < max_depth:
        depth += 1
        known = spark.read.schema(schema).parquet(path)
        tasks = consumed.join(frontier.select("dataset"), "dataset", "left_semi").select("task")
        reached = produced.join(tasks.distinct(), "task", "left_semi").select("dataset").distinct()
        fresh = reached.join(known.select("dataset"), "dataset", "left_anti")
        fresh = materialise(fresh.withColumn("depth", F.lit(depth)), "lineage-frontier")
        if fresh.isEmpty():
            break
        fresh.write.mode("append").parquet(path)
        frontier = fresh
    return spark.read.schema(schema).parquet(path).where("depth > 0")


def lineage_closure(edges: DataFrame, start: str, direction: str = "downstream", max_depth: int = 10) -> DataFrame:
    """``lineage_impact`` in one statement, a recursive query, for small graphs.

    The recursion has no memory of what it has seen: a dataset is expanded once for every
    path that leads to it, and only ``max_depth`` ends a cycle. Spark stops it beyond
    ``spark.sql.cteRecursionRowLimit`` rows (a million); larger graphs take
    ``lineage_impact``, which expands every dataset once.
    """
    if direction not in ("downstream", "upstream"):
        raise ValueError(f"unknown direction {direction!r}")
    into, out_of = ("src", "dst") if direction == "downstream" else ("dst", "src")
    with batch_view(edges, "edges") as view:
        return edges.sparkSession.sql(
            f"""WITH RECURSIVE hops AS (
                SELECT DISTINCT a.{into} AS x, b.{out_of} AS y FROM {view} a JOIN {view} b ON a.task = b.task
                WHERE a.{into} IS NOT NULL AND b.{out_of} IS NOT NULL),
              reach(dataset, depth) AS (
                SELECT CAST(:start AS STRING), 0
                UNION ALL SELECT y, depth + 1 FROM reach JOIN hops ON dataset = x WHERE depth < {int(max_depth)})
            SELECT dataset, MIN(depth) AS depth FROM reach WHERE depth > 0 AND dataset <> :start GROUP BY dataset""",
            {"start": start},
        )
