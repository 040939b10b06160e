"""Structured Streaming: process only what is new.

* X1 ``ingest_shards``: each new shard file is decoded exactly once into a
  Parquet sink with a ledger of the files it holds (:mod:`.ledger`), also after
  a failed batch, a restart, or with a new checkpoint;
* X2 ``token_totals``: running token totals per split as shards arrive;
* X3 ``best_loss``: best loss so far per run as log rows arrive;
  ``best_flags``: every row with its ``is_best``, as in W3.

All run with ``trigger(availableNow=True)``: drain what is there, then stop,
so a re-run picks up only new files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import file_basename
from ..operators.logs import INF, running_best
from ..session import path_exists
from ..sources.corpus import shard_id_of, split_of
from ..functions.tokens import token_count
from . import ledger as L


# The binaryFile source's fixed schema (a stream source must be given one).
BINARY_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def shard_stream(spark: SparkSession, path: str, glob: str = "data*.bin",
                 max_files_per_trigger: int | None = None, recursive: bool = False) -> DataFrame:
    """``(path, shard, shard_id, data)`` of shard files as they arrive."""
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
         .option("pathGlobFilter", glob).option("recursiveFileLookup", recursive))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(path)
    name = file_basename(F.col("path"))
    return df.select("path", name.alias("shard"), shard_id_of(name).alias("shard_id"),
                     F.col("content").alias("data"))


def ingest_files(stream: DataFrame, sink: str, checkpoint: str, file: str = "path") -> StreamingQuery:
    """Rows of new files -> the sink, every file once.

    ``file`` names the column that tells the rows' file. Files that the ledger
    has from other batches, of this or an earlier stream, are passed over, so a
    lost checkpoint writes nothing twice. The ledger has a row per file."""
    def rows(batch: DataFrame, name: str):
        done = L.read_ledger(batch.sparkSession, sink)
        if done is not None:
            batch = batch.join(done.filter(F.col("batch") != name).select(file).distinct(), file, "left_anti")
        return batch, batch.select(file).distinct()

    return L.start(stream, checkpoint, lambda batch, i: L.write_batch(batch, i, sink, rows))


def ingest_shards(spark: SparkSession, src: str, sink: str, checkpoint: str,
                  glob: str = "data*.bin", width: int = 1, recursive: bool = False,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Decode each new shard file once; rows ``(path, shard, shard_id, n_tok,
    data)``, read back with :func:`ledger.read_sink`."""
    s = shard_stream(spark, src, glob, max_files_per_trigger, recursive).withColumn("n_tok", token_count("data", width))
    return ingest_files(s, sink, checkpoint)


def token_totals(stream: DataFrame, num_train: int, num_val: int, val_start: int,
                 width: int = 1) -> DataFrame:
    """Streaming totals per split (``complete`` output mode)."""
    return (stream.withColumn("split", split_of("shard_id", num_train, num_val, val_start))
                  .groupBy("split")
                  .agg(F.sum(token_count("data", width) if "data" in stream.columns
                             else F.col("n_tok")).cast("long").alias("n_tokens"),
                       F.count(F.lit(1)).alias("n_docs")))


def best_loss(log_stream: DataFrame) -> DataFrame:
    """Best (non-NaN) loss and rows seen per run (``complete`` mode)."""
    finite = F.when(F.isnan("loss"), F.lit(None).cast("double")).otherwise(F.col("loss"))
    return log_stream.groupBy("run").agg(F.min(finite).alias("best_loss"),
                                         F.count(F.lit(1)).alias("n_rows"))


def best_flags(log_stream: DataFrame, sink: str, checkpoint: str, init_best: float = INF) -> StreamingQuery:
    """X3 per row: ``is_best`` and ``best_so_far`` of every log row as it arrives.

    Rows are ordered by step within a batch and by arrival between batches, so
    the flags equal W3's where a run's steps arrive in order. Each batch runs the
    batch operator from the best losses so far and leaves the new ones beside its
    rows, one per run; a run that holds most rows is spread over many tasks, which
    keyed streaming state would not do. Null runs are a run of their own."""
    def state(name: str) -> str:
        return f"{sink}/state/{name}"

    def rows(batch: DataFrame, name: str):
        spark = batch.sparkSession
        stream, number = name.rsplit("_", 1)
        before = state(f"{stream}_{int(number) - 1}")
        known = (spark.read.parquet(before) if path_exists(spark, before)
                 else spark.createDataFrame([], "run STRING, best DOUBLE"))
        loss = F.when(~F.isnan("loss"), F.col("loss"))
        now = batch.groupBy("run").agg(F.min(loss).alias("best"))
        (known.unionByName(now).groupBy("run").agg(F.min("best").alias("best"))
         .write.mode("overwrite").parquet(state(name)))
        known = known.select(F.col("run").alias("_run"), F.col("best").alias("_best"))
        flagged = running_best(batch, F.lit(init_best)) if number == "0" else running_best(
            batch.join(known, F.col("run").eqNullSafe(F.col("_run")), "left"),
            F.least(F.coalesce("_best", F.lit(INF)), F.lit(init_best))).drop("_run", "_best")
        return flagged, spark.range(1).select(F.lit(int(number)).alias("number"))

    return L.start(log_stream, checkpoint, lambda batch, i: L.write_batch(batch, i, sink, rows))


def run_complete(agg: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """Drain a streaming aggregate into an in-memory table (bounded: one row
    per group) and stop."""
    return (agg.writeStream.outputMode("complete").format("memory").queryName(name)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
