"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Everything that changes results or plan quality and may be set at run time.
# Sizing (executors, memory, shuffle partitions) stays with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # partition_date=2024-01-01 must read back as the string it was written as
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's settings to an existing session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def session(app: str = "lakeops", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with the library's settings."""
    # the pools of run_gold share the executors only under fair scheduling
    builder = SparkSession.builder.appName(app).config("spark.scheduler.mode", "FAIR")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if root:
        return root.rstrip("/")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="lakeops-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_scratch(spark: SparkSession, label: str) -> str:
    """A path under the shared scratch area that nobody else uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


class Scratch:
    """Intermediate tables of one job, removed at its end, also when it fails.

    Nothing that the job returns may still read them.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.n = spark, new_scratch(spark, label), 0

    def store(self, df: DataFrame) -> DataFrame:
        """As ``materialise``, below this job's folder."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.root)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch area and read it back.

    Cuts the lineage, survives the loss of any executor and, unlike an RDD
    checkpoint, keeps column pruning and size statistics for what follows.
    """
    spark = df.sparkSession
    path = new_scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
