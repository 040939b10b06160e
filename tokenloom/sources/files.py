"""File sources and sinks: binary token shards, whole-text files, directory
listings, the partitioned token sink and tokenizer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import file_basename
from .corpus import shard_id_of
from .shard_ranges import RANGE_BYTES, ROW_BYTES, scan_ranges


def list_dir(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """``(path, file, size)`` of the files in a folder, zero-length ones
    included (an empty shard is short, not missing). No file is opened."""
    return scan_ranges(spark, path, glob, recursive, content=False).select("path", "file", "size")


def read_shard_ranges(spark: SparkSession, path: str, glob: str = "data*.bin", width: int = 1,
                      recursive: bool = False, range_bytes: int = RANGE_BYTES, row_bytes: int = ROW_BYTES,
                      required: DataFrame | None = None) -> DataFrame:
    """Token shards of any size -> ``(path, shard, shard_id, size, start,
    data)``, in pieces of at most ``row_bytes`` that end between tokens;
    ``start`` is the piece's place in its file. Many tasks read one long
    shard. With ``required`` (a ``file`` column), a required file that is
    absent fails the job."""
    df = scan_ranges(spark, path, glob, recursive, width=width, range_bytes=range_bytes, row_bytes=row_bytes)
    df = df.select("path", F.col("file").alias("shard"), shard_id_of("file").alias("shard_id"), "size", "start", "data")
    return df if required is None else df.unionByName(_missing(spark, path, glob, required, recursive), allowMissingColumns=True)


def _missing(spark: SparkSession, path: str, glob: str, required: DataFrame, recursive: bool = False) -> DataFrame:
    """A row per required file that is absent, whose reading is an error."""
    present = list_dir(spark, path, glob, recursive).select("file")
    return required.select("file").join(present, "file", "left_anti").select(
        F.raise_error(F.concat(F.lit("missing shard file: "), F.col("file"))).cast("string").alias("shard"))


def read_shards(spark: SparkSession, path: str, glob: str = "data*.bin",
                required: DataFrame | None = None) -> DataFrame:
    """Binary token shards -> ``(shard, shard_id, doc_id, data)``; the whole
    file is one document (``doc_id = 0``) of its shard. With ``required``
    (a ``file`` column), a required file that is absent fails the job.

    A file is read whole into one row (binaryFile's per-file limit applies;
    :func:`read_shard_ranges` has none); zero-length files are skipped by the
    scan (they hold no tokens).
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
          .select(file_basename(F.col("path")).alias("shard"), F.col("content").alias("data")))
    df = df.select("shard", shard_id_of(F.col("shard")).alias("shard_id"),
                   F.lit(0).cast("long").alias("doc_id"), "data")
    if required is not None:
        df = df.unionByName(_missing(spark, path, glob, required), allowMissingColumns=True)
    return df


def read_texts(spark: SparkSession, path: str, glob: str = "*.txt",
               exclude: tuple[str, ...] = (), recursive: bool = False) -> DataFrame:
    """Every matching file in a folder as one record ``(path, file, text)``,
    whole file, minus an explicit exclude list (no accidental inputs such as
    a tokenizer's own ``merges.txt``)."""
    # wholetext must be the keyword: text() resets an earlier .option("wholetext")
    df = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).text(path, wholetext=True)
          .select(F.input_file_name().alias("path"), F.col("value").alias("text")))
    df = df.select("path", file_basename(F.col("path")).alias("file"), "text")
    if exclude:
        df = df.filter(~F.col("file").isin(list(exclude)))
    return df


def write_tokens(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persist token streams once, partitioned by split (partition pruning
    on read)."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def write_blocks(blocks: DataFrame, path: str, world_size: int, mode: str = "overwrite") -> None:
    """T7 sink: packed blocks written one folder per split and data-parallel
    rank (block ``k`` -> rank ``k % world_size``), so each worker reads only
    its own folder (partition pruning)."""
    from ..operators.stream import assign_ranks
    (assign_ranks(blocks, world_size).write.mode(mode)
        .partitionBy("split", "rank").parquet(path))


def read_tokens(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(F.col("split") == split) if split else df


def save_tokenizer(model, path: str) -> None:
    """Vocabulary and merges as two Parquet tables."""
    model.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    model.merges.write.mode("overwrite").parquet(f"{path}/merges")


def load_tokenizer(spark: SparkSession, path: str):
    from ..operators.bpe import BpeModel
    return BpeModel(spark.read.parquet(f"{path}/merges"), spark.read.parquet(f"{path}/vocab"))
