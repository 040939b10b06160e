"""Batches written once: a sink of batch folders and a ledger of what they hold.

A micro-batch may run again: after a failure half-way, after a restart before
Spark had noted it as done, or after its checkpoint was lost. Each batch has its
own folder, named by the stream's id and the batch's number (both the same when
it runs again), and is part of the sink from the moment its ledger entry is
written, which is the last thing a batch does:

* a batch that failed before its entry replaces its own folder;
* a batch that has its entry writes nothing;
* a folder without an entry is never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import path_exists

DATA, LEDGER = "data", "ledger"


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """``<stream>_<number>``: the same whenever the batch runs again."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not stream:
        raise RuntimeError("a batch is written from within foreachBatch only")
    return f"{stream}_{batch_id}"


def read_ledger(spark: SparkSession, sink: str) -> DataFrame | None:
    """The entries of all batches with their ``batch``; None before the first one."""
    if not path_exists(spark, f"{sink}/{LEDGER}"):
        return None
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{sink}/{LEDGER}")


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """The rows of all batches that the ledger names, with their ``batch``. Rows of
    unfinished batches are left out."""
    ledger = read_ledger(spark, sink)
    if ledger is None:
        raise FileNotFoundError(f"no batch was written to {sink}")
    batches = ledger.select("batch").distinct()
    data = spark.read.option("basePath", f"{sink}/{DATA}").parquet(f"{sink}/{DATA}")
    return data.join(batches, "batch", "left_semi")


def write_batch(batch: DataFrame, batch_id: int, sink: str,
                rows: Callable[[DataFrame, str], tuple[DataFrame, DataFrame]]) -> None:
    """Write a batch's rows, then its entry. ``rows(batch, name)`` gives both."""
    spark, name = batch.sparkSession, batch_name(batch, batch_id)
    entry = f"{sink}/{LEDGER}/{name}"
    if path_exists(spark, f"{entry}/_SUCCESS"):
        return
    data, noted = rows(batch, name)
    data.write.mode("overwrite").parquet(f"{sink}/{DATA}/batch={name}")
    noted.withColumn("batch", F.lit(name)).write.mode("overwrite").parquet(entry)


def start(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Drain what is there with ``write`` per batch, then stop."""
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
