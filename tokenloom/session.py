"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files of datasets that are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "tokenloom",
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults this library assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or one already set on the
    context). Only a local-mode session without one gets a fresh folder under
    the system temp dir, as in tests; a cluster session without a shared
    folder is an error, because a machine-local folder does not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder")
        d = tempfile.mkdtemp(prefix="tokenloom-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for written intermediate tables, inside the checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop path of a file or folder, and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sparkContext().hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


class ScratchTables:
    """Intermediate tables in the shared folder: written, read back (which cuts lineage and lets the planner
    know their size), and removed by the job that made them once they are used."""

    def __init__(self, spark: SparkSession, kind: str):
        self.spark, self.base = spark, scratch_path(spark, f"{kind}-{uuid.uuid4().hex[:12]}")
        self.made = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.base}/{name}-{self.made}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path, fs = hadoop_path(self.spark, t._path)
            fs.delete(path, True)
