"""T6 over a token stream stored by position.

The stream of a split is written once as blocks of ``block_size`` tokens in
folders of ``blocks_per_part`` consecutive blocks, sorted by block inside a
folder. A sample then opens only the folders that its windows touch, and
within them Parquet's row-group statistics of ``block``. An index of one row
per split holds the stream's length, so sampling scans nothing to learn it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.tokens import bytes_to_ids, token_count
from .stream import pack_sequences, positions, window_starts

BLOCKS, INDEX = "blocks", "index"
BLOCK_SCHEMA = "block BIGINT, data BINARY, split STRING, part BIGINT"
BLOCKS_PER_PART = 1 << 18   # 64 MB of 256-token blocks, one byte a token


def write_blocks_by_position(corpus: DataFrame, path: str, block_size: int, width: int = 1,
                             blocks_per_part: int = BLOCKS_PER_PART, mode: str = "overwrite") -> None:
    """Write the corpus' streams as ``blocks/split=../part=../`` and ``index``.

    The blocks are exchanged once, by part: all parts but a split's last hold
    equally many tokens, whatever the documents are. The last, shorter block
    of a stream is kept."""
    pos = positions(corpus, width)
    blocks = pack_sequences(pos, block_size, shift=0, width=width, keep_partial=True)
    part = F.expr(f"block div {blocks_per_part}")
    (blocks.select("split", part.alias("part"), "block", F.col("x").alias("data"))
     .repartition("split", "part").sortWithinPartitions("split", "part", "block")
     .write.mode(mode).partitionBy("split", "part").parquet(f"{path}/{BLOCKS}"))
    (corpus.groupBy("split").agg(F.sum(token_count("data", width)).cast("long").alias("n_total"))
     .select("split", "n_total", F.lit(block_size).alias("block_size"), F.lit(width).alias("width"),
             F.lit(blocks_per_part).alias("blocks_per_part"))
     .coalesce(1).write.mode(mode).parquet(f"{path}/{INDEX}"))


def touched_blocks(spark: SparkSession, path: str, starts: DataFrame, entry) -> DataFrame:
    """The stored blocks that windows of ``block_size + 1`` tokens from ``start`` touch, with the window each is for.

    There are two per window, so their folders and the windows are bounded by the
    number of windows, which is a parameter; both stay out of any shuffle."""
    B = entry["block_size"]
    want = starts.select("*", F.explode(F.array(F.expr(f"start div {B}"), F.expr(f"start div {B} + 1"))).alias("block"))
    parts = [r[0] for r in want.select(F.expr(f"block div {entry['blocks_per_part']}").alias("p")).distinct().collect()]
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/{BLOCKS}").filter((F.col("split") == entry["split"]) & F.col("part").isin(parts))
    return stored.select("block", "data").join(F.broadcast(want), "block")


def sample_stored_windows(spark: SparkSession, path: str, batch_size: int, steps: int, seed: int = 0,
                          split: str = "train", as_arrays: bool = False) -> DataFrame:
    """The windows of :func:`~.stream.sample_windows`, from the stored stream; window and block are equally long."""
    entry = spark.read.parquet(f"{path}/{INDEX}").filter(F.col("split") == split).first()
    if entry is None:
        raise ValueError(f"no stream of split {split!r} in {path}")
    B, width = entry["block_size"], entry["width"]
    starts = window_starts(spark, split, F.lit(entry["n_total"]), B, batch_size, steps, seed)
    found = touched_blocks(spark, path, starts, entry)
    # the end of the first block and the beginning of the next, up to B + 1 tokens
    first = F.col("block") == F.expr(f"start div {B}")
    at = (F.expr(f"start % {B}") * width).cast("int")
    piece = F.when(first, F.col("data").substr(at + 1, F.lit(B * width))).otherwise(F.col("data").substr(F.lit(1), at + width))
    pieces = F.array_sort(F.collect_list(F.struct("block", piece.alias("piece"))))
    buf = F.concat(F.get(pieces, F.lit(0))["piece"], F.coalesce(F.get(pieces, F.lit(1))["piece"], F.lit(b"")))
    out = found.groupBy("split", "step", "b", "start").agg(buf.alias("buf"))
    x, y = F.col("buf").substr(1, B * width), F.col("buf").substr(width + 1, B * width)
    if as_arrays:
        x, y = bytes_to_ids(x, width), bytes_to_ids(y, width)
    return out.select("split", "step", "b", "start", x.alias("x"), y.alias("y"))
