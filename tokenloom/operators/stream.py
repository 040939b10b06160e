"""Token-stream operators: counts, global positions, chunks, packing, sampling.

Input is a corpus ``(split, shard_id, doc_id, data BINARY)``. The stream of a
split is the concatenation of its documents in ``(shard_id, doc_id)`` order.
No operator materialises a per-token row or holds a whole shard in one task:
positions come from a hierarchical prefix sum, and tokens move as byte pieces
cut per (document, block).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.hashing import md5_int60
from ..functions.tokens import bytes_to_ids, token_count
from ..sources.corpus import DEFAULT_CHUNK_SIZE
from .bigram import inner_pairs
from .prefix import exclusive_prefix, ranked_prefix

_LATIN1 = "ISO-8859-1"


def shard_token_counts(corpus: DataFrame, width: int = 1) -> DataFrame:
    """A1 + W1: tokens and documents per shard, running total per split.

    Output ``(split, shard_id, shard, n_docs, n_tokens, running_tokens,
    split_tokens)``. The aggregation is partial (map-side) and the window
    runs over one row per shard.
    """
    per = (corpus.groupBy("split", "shard_id", "shard")
           .agg(F.count(F.lit(1)).alias("n_docs"),
                F.sum(token_count("data", width)).cast("long").alias("n_tokens")))
    run = Window.partitionBy("split").orderBy("shard_id").rowsBetween(
        Window.unboundedPreceding, 0)
    tot = Window.partitionBy("split")
    return (per.withColumn("running_tokens", F.sum("n_tokens").over(run).cast("long"))
               .withColumn("split_tokens", F.sum("n_tokens").over(tot).cast("long")))


def _written(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table to the shared folder and read it: its size is then known to the planner."""
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def doc_offsets(corpus: DataFrame, width: int = 1) -> DataFrame:
    """T2 on metadata: ``(split, shard_id, doc_id, th, n_tok, pos)``, one row per document row.

    The lengths are computed in one scan; the ranks of the documents, not their
    ids, give the offsets (:func:`ranked_prefix`). Null ids come first in their
    shard; rows that share an id follow each other by ``th``, a hash of the data.
    """
    meta = corpus.select("split", "shard_id", "doc_id", F.xxhash64("data").alias("th"),
                         token_count("data", width).alias("n_tok"))
    return ranked_prefix(meta, "n_tok", ["split"], ["shard_id", "doc_id", "th"], "pos")


_DOC = ("split", "shard_id", "doc_id", "th")


def _of_keys(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``df`` joined with ``keys`` (columns k0..k3) on the document key; null ids are equal."""
    same = df[_DOC[0]].eqNullSafe(keys["k0"])
    for i, c in enumerate(_DOC[1:], 1):
        same = same & df[c].eqNullSafe(keys[f"k{i}"])
    return df.join(keys, same, how)


def positions(corpus: DataFrame, width: int = 1, keep_data: bool = True) -> DataFrame:
    """Each document's start offset ``pos`` and length ``n_tok`` in its split stream.

    Offsets come from :func:`doc_offsets`; with ``keep_data`` they are written
    and joined back to the documents by id and data hash (no hot key). The
    planner knows the size of the written table and broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold``. Each row comes out once: of rows
    that are equal in all, one meets the offsets of all of them.
    """
    off = doc_offsets(corpus, width)
    if not keep_data:
        return off.drop("th")
    off = _written(off, "offsets")
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(_DOC)]
    repeated = _written(off.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "repeated")
    docs = corpus.select("split", "shard_id", "doc_id", "data", F.xxhash64("data").alias("th"))
    if not repeated.isEmpty():
        docs = _of_keys(docs, repeated, "left_anti").unionByName(
            _of_keys(docs, repeated, "left_semi").dropDuplicates(list(_DOC)))
    return _of_keys(docs, off.select(*keys, "n_tok", "pos"), "inner").select("split", "shard_id", "doc_id", "data", "n_tok", "pos")


def _assemble(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Concatenate pieces per key in position order (bounded: one window each)."""
    ordered = F.array_sort(F.collect_list(F.struct("lo", "piece")))
    joined = F.array_join(F.transform(ordered, lambda p: F.decode(p["piece"], _LATIN1)), "")
    return pieces.groupBy(*keys).agg(F.encode(joined, _LATIN1).alias("buf"))


def pack_sequences(pos_df: DataFrame, block_size: int, shift: int = 1, width: int = 1,
                   as_arrays: bool = False, keep_partial: bool = False) -> DataFrame:
    """T5: consecutive fixed-length training sequences with next-token targets.

    Block ``k`` takes tokens ``[k*B, k*B + B + shift)``; ``x`` is the first B,
    ``y`` the B starting at ``shift`` (``shift=0``: targets equal inputs). An
    incomplete tail is dropped unless ``keep_partial``. Output ``(split,
    block, x, y)`` with BINARY streams, or ARRAY<INT> when ``as_arrays``.

    A block that lies in one document is cut from it where it is read. Only the
    edges of documents, less than two blocks each, are exchanged and stitched.
    """
    B = block_size
    need = B + shift
    pos, n = F.col("pos"), F.col("n_tok")
    # blocks that a document touches, and those of them that it holds whole
    first = F.greatest(F.lit(0), F.expr(f"(pos - {need} + {B}) div {B}"))
    last = F.expr(f"(pos + n_tok - 1) div {B}")
    whole_from, whole_to = F.expr(f"(pos + {B} - 1) div {B}"), F.when(n >= need, F.expr(f"(pos + n_tok - {need}) div {B}")).otherwise(-1)

    def blocks(a, b):
        return F.when(a <= b, F.sequence(a.cast("long"), b.cast("long"))).otherwise(F.array().cast("array<bigint>"))

    docs = pos_df.filter(n > 0).select("split", "pos", "n_tok", "data", first.alias("f"), last.alias("l"),
                                       whole_from.alias("wf"), whole_to.alias("wt"))
    f, l, wf, wt = (F.col(c) for c in ("f", "l", "wf", "wt"))
    inner = docs.filter(wf <= wt).select("split", "pos", "data", F.explode(blocks(wf, wt)).alias("block"))
    at = ((F.col("block") * B - pos) * width).cast("int")
    inner = inner.select("split", "block", F.col("data").substr(at + 1, F.lit(need * width)).alias("buf"))
    touched = F.when(wf <= wt, F.concat(blocks(f, wf - 1), blocks(wt + 1, l))).otherwise(blocks(f, l))
    edges = docs.select("split", "pos", "n_tok", "data", F.explode(touched).alias("block"))
    lo = F.greatest(pos, F.col("block") * B)
    hi = F.least(pos + n, F.col("block") * B + need)
    edges = edges.select("split", "block", lo.alias("lo"), F.col("data").substr(
        ((lo - pos) * width + 1).cast("int"), ((hi - lo) * width).cast("int")).alias("piece"))
    stitched = _assemble(edges, ["split", "block"])
    if not keep_partial:
        stitched = stitched.filter(F.octet_length("buf") == need * width)
    x = F.col("buf").substr(1, B * width)
    y = F.col("buf").substr(shift * width + 1, B * width)
    out = inner.unionByName(stitched).select("split", "block", x.alias("x"), y.alias("y"))
    if as_arrays:
        out = out.select("split", "block", bytes_to_ids("x", width).alias("x"),
                         bytes_to_ids("y", width).alias("y"))
    return out


def stream_chunks(pos_df: DataFrame, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Cut each split stream into ``chunk_size``-token chunks, last one short.

    Output ``(split, chunk, n_tokens, cum_tokens)``. Only document lengths are
    read; the cumulative column uses the bucketed prefix sum.
    """
    pos, n = F.col("pos"), F.col("n_tok")
    d = (pos_df.filter(n > 0).select(
        "split", "pos", "n_tok",
        F.explode(F.sequence(F.expr(f"pos div {chunk_size}"),
                             F.expr(f"(pos + n_tok - 1) div {chunk_size}"))).alias("chunk")))
    lo = F.greatest(pos, F.col("chunk") * chunk_size)
    hi = F.least(pos + n, (F.col("chunk") + 1) * chunk_size)
    per = d.groupBy("split", "chunk").agg(F.sum(hi - lo).cast("long").alias("n_tokens"))
    out = exclusive_prefix(per, "n_tokens", group=["split"], major=[], key="chunk",
                           out="_before")
    return out.select("split", "chunk", "n_tokens",
                      (F.col("_before") + F.col("n_tokens")).alias("cum_tokens"))


def split_totals(pos_df: DataFrame) -> DataFrame:
    return pos_df.groupBy("split").agg(F.sum("n_tok").cast("long").alias("n_total"))


def window_starts(spark: SparkSession, split: str, n_total: Column, block_size: int, batch_size: int,
                  steps: int, seed: int) -> DataFrame:
    """``(split, step, b, start)``: ``batch_size`` starts per step, uniform with
    replacement in ``[0, N - B)``; an empty sample space is an error."""
    step, b = F.expr(f"id div {batch_size}"), F.expr(f"id % {batch_size}")
    start = F.when(n_total > block_size, md5_int60(F.lit(seed), F.lit(split), step, b) % (n_total - block_size)).otherwise(
        F.raise_error(F.lit("sample space is empty: N <= block_size")))
    return spark.range(steps * batch_size).select(
        F.lit(split).alias("split"), step.alias("step"), b.alias("b"), start.alias("start"))


def sample_windows(corpus: DataFrame, block_size: int, batch_size: int, steps: int,
                   seed: int = 0, split: str = "train", width: int = 1,
                   as_arrays: bool = False, bucket: int = 1 << 16) -> DataFrame:
    """``batch_size`` random windows per step, uniform with replacement.

    Start ``i`` = md5(seed:split:step:b) as a 60-bit integer modulo ``N - B``
    (``N`` from a scalar subquery); ``x = stream[i, i+B)``,
    ``y = stream[i+1, i+B+1)``. Windows are matched to documents by an
    equi-join on a coarse position bucket (a range join made equi) over
    metadata only. The windows (at most two rows per sample) and the matched
    pieces are written, so that the planner knows their sizes and broadcasts
    them only below ``spark.sql.autoBroadcastJoinThreshold``; then only the
    matched documents' bytes are read and the corpus is not shuffled.
    """
    B = block_size
    need = B + 1
    if bucket < need:
        raise ValueError("bucket must be at least block_size + 1")
    spark = corpus.sparkSession
    corpus = corpus.filter(F.col("split") == split)
    meta = positions(corpus, width, keep_data=False)
    n_total = split_totals(meta).select("n_total").scalar()
    starts = window_starts(spark, split, n_total, B, batch_size, steps, seed)
    # at most two buckets per window (bucket > B): bounded by 2 * steps * batch_size rows
    wins = _written(starts.select("*", F.explode(F.sequence(
        F.expr(f"start div {bucket}"), F.expr(f"(start + {B}) div {bucket}"))).alias("bk")), "windows")
    docs = (meta.filter(F.col("n_tok") > 0)
            .select("split", "shard_id", "doc_id", "pos", "n_tok",
                    F.explode(F.sequence(F.expr(f"pos div {bucket}"),
                                         F.expr(f"(pos + n_tok - 1) div {bucket}"))).alias("bk")))
    pos, n, st = F.col("pos"), F.col("n_tok"), F.col("start")
    lo = F.greatest(pos, st)
    hi = F.least(pos + n, st + need)
    hits = (docs.join(wins, ["split", "bk"])
            # overlapping, and counted once: in the bucket where the overlap starts
            .filter((pos < st + need) & (pos + n > st)
                    & (F.col("bk") == F.floor(lo / bucket)))
            .select("split", "step", "b", "start", "shard_id", "doc_id", "pos",
                    lo.alias("lo"), hi.alias("hi")))
    pieces = (_written(hits, "hits")
              .join(corpus.select("split", "shard_id", "doc_id", "data"),
                    ["split", "shard_id", "doc_id"])
              .select("split", "step", "b", "start", "lo",
                      F.col("data").substr(((F.col("lo") - pos) * width + 1).cast("int"),
                                           ((F.col("hi") - F.col("lo")) * width).cast("int"))
                      .alias("piece")))
    win = _assemble(pieces, ["split", "step", "b", "start"])
    out = win.select("split", "step", "b", "start",
                     F.col("buf").substr(1, B * width).alias("x"),
                     F.col("buf").substr(width + 1, B * width).alias("y"))
    if as_arrays:
        out = out.select("split", "step", "b", "start", bytes_to_ids("x", width).alias("x"),
                         bytes_to_ids("y", width).alias("y"))
    return out


def assign_ranks(blocks: DataFrame, world_size: int, batch_size: int | None = None) -> DataFrame:
    """T7 + T8: block ``k`` goes to rank ``k % world_size``; its local index is
    ``k div world_size``; with ``batch_size`` the local index is cut into
    batches (``batch``, ``row``)."""
    out = (blocks.withColumn("rank", (F.col("block") % world_size).cast("int"))
                 .withColumn("local", F.expr(f"block div {world_size}")))
    if batch_size:
        out = (out.withColumn("batch", F.expr(f"local div {batch_size}"))
                  .withColumn("row", (F.col("local") % batch_size).cast("int")))
    return out


def doc_ids(corpus: DataFrame, width: int = 1) -> DataFrame:
    """T1 per document: ``ids ARRAY<INT>``."""
    return corpus.select("split", "shard_id", "doc_id", bytes_to_ids("data", width).alias("ids"))


def explode_tokens(pos_df: DataFrame, width: int = 1) -> DataFrame:
    """One row per token ``(split, pos, tok)`` — for small inputs and tests."""
    return pos_df.select(
        "split", "pos",
        F.posexplode(bytes_to_ids("data", width)).alias("i", "tok")
    ).select("split", (F.col("pos") + F.col("i")).alias("pos"), "tok")


def _pairs_and_halves(width: int):
    """(split, data, pos, n_tok) -> counted inner pairs (k1, k2 >= 0), and the first and last token of every row."""
    names = ["split", "k1", "k2", "last", "first", "c"]

    def ends(b):
        dtype = f"<u{width}"
        data = [memoryview(d.as_buffer()) for d in b.column(1)]
        if any(len(d) % width for d in data):
            raise ValueError("a uint16 token stream has an odd number of bytes")
        first = pa.array([int(np.frombuffer(d, dtype, 1)[0]) for d in data], pa.int32())
        last = pa.array([int(np.frombuffer(d[-width:], dtype)[0]) for d in data], pa.int32())
        pos, n, none = np.asarray(b.column(2)), np.asarray(b.column(3)), pa.nulls(b.num_rows, pa.int32())
        one = pa.array(np.ones(b.num_rows, np.int64))
        for key, tokens in ((-(pos + n) - 1, (last, none)), (-pos - 1, (none, first))):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key), pa.nulls(b.num_rows, pa.int64()), *tokens, one], names=names)

    def run(batches):
        halves: list[pa.RecordBatch] = []

        def told():
            for b in batches:
                if b.num_rows:
                    halves.extend(ends(b))
                    yield b

        for p in inner_pairs(width)(told()):
            yield from halves
            halves.clear()
            none = pa.nulls(p.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([p.column(0), p.column(1).cast(pa.int64()), p.column(2).cast(pa.int64()),
                                              none, none, p.column(3)], names=names)
        yield from halves
    return run


def next_token_pairs(pos_df: DataFrame, width: int = 1) -> DataFrame:
    """Counts of (token, following token) over each split stream, in one
    pass over the documents and without a join.

    Each task counts the inner pairs of its documents in Arrow batches; of a
    document itself two boundary halves go on: its last token keyed by its end
    position and its first token keyed by its start position (keys stored
    negative so they never clash with token ids). A first aggregation adds up
    inner pairs and pairs up the halves of each boundary; a second one adds the
    completed boundary pairs to the counts.
    """
    first = (pos_df.filter(F.col("n_tok") > 0).select("split", "data", "pos", "n_tok")
             .mapInArrow(_pairs_and_halves(width), "split string, k1 long, k2 long, last int, first int, c long")
             .groupBy("split", "k1", "k2").agg(F.sum("c").alias("c"), F.max("last").alias("last"), F.max("first").alias("first")))
    inner_row = F.col("k1") >= 0
    paired = first.select(
        "split",
        F.when(inner_row, F.col("k1").cast("int")).otherwise(F.col("last")).alias("tok"),
        F.when(inner_row, F.col("k2").cast("int")).otherwise(F.col("first")).alias("next_tok"),
        F.when(inner_row, F.col("c")).otherwise(F.lit(1)).alias("c"))
    return (paired.filter(F.col("tok").isNotNull() & F.col("next_tok").isNotNull())
                  .groupBy("split", "tok", "next_tok").agg(F.sum("c").alias("n")))
