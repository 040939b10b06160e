"""Corpus loss of a validation split under an add-one bigram model of
the training split (the re-aimed ``cross_entropy`` of next-token targets).

``p(b|a) = (c(a,b) + 1) / (c(a) + V)``, loss = mean over all validation
next-token targets of ``-ln p``. Pairs are counted inside documents. Every
table here is bounded by ``V**2`` rows, so the joins are small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

COUNT_TOKENS = 1 << 20   # tokens whose pairs a task counts at once


def _runs(streams, width: int) -> Iterator[tuple[object, np.ndarray]]:
    """(split, tokens) of at most ``COUNT_TOKENS``; the last token of a run is the first of the next of the same stream."""
    for split, raw in streams:
        if raw is None or len(raw) < 2 * width:
            continue
        if len(raw) % width:
            raise ValueError("a uint16 token stream has an odd number of bytes")
        ids = np.frombuffer(raw, dtype=f"<u{width}")
        for at in range(0, len(ids) - 1, COUNT_TOKENS):
            yield split, ids[at:at + COUNT_TOKENS + 1]


def _counted(runs: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs in the runs as one number each, and how often they are there."""
    bits = 8 * width
    key = np.concatenate([(r[:-1].astype(f"<u{2 * width}") << bits) | r[1:] for r in runs])
    if width == 1:
        n = np.bincount(key, minlength=1 << 16)
        return np.flatnonzero(n), n[n > 0]
    return np.unique(key, return_counts=True)


def inner_pairs(width: int):
    """Batches that begin with (split, data) -> (split, a, b, n): the adjacent pairs inside the streams, counted for
    every ``COUNT_TOKENS`` tokens or so."""
    names = ["split", "a", "b", "n"]

    def out(held: dict) -> Iterator[pa.RecordBatch]:
        for split, runs in held.items():
            key, n = _counted(runs, width)
            a, b = key >> (8 * width), key & ((1 << (8 * width)) - 1)
            yield pa.RecordBatch.from_arrays([pa.array([split] * len(n), pa.string()), pa.array(a.astype(np.int32)),
                                              pa.array(b.astype(np.int32)), pa.array(n.astype(np.int64))], names=names)

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            streams = ((s.as_py(), memoryview(d.as_buffer()) if d.is_valid else None)
                       for s, d in zip(batch.column(0), batch.column(1)))
            for split, ids in _runs(streams, width):
                held.setdefault(split, []).append(ids)
                size += len(ids)
                if size >= COUNT_TOKENS:
                    yield from out(held)
                    held, size = {}, 0
        yield from out(held)
    return run


def bigram_counts(corpus: DataFrame, width: int = 1) -> DataFrame:
    """``(split, a, b, n)``: adjacent id pairs inside documents, counted per task in
    Arrow batches; what is exchanged is bounded by the pairs, not by the tokens."""
    pairs = corpus.select("split", "data").mapInArrow(inner_pairs(width), "split string, a int, b int, n long")
    return pairs.groupBy("split", "a", "b").agg(F.sum("n").alias("n"))


def corpus_loss(counts: DataFrame, vocab_size: int = 256, train: str = "train",
                evaluate: str = "val") -> DataFrame:
    """One pass over the pair counts: train and evaluation counts side by side
    per pair, the train row total by a window over ``a`` (the table has at
    most ``V**2`` rows), then the mean negative log-likelihood."""
    split = F.col("split")
    pv = counts.groupBy("a", "b").agg(
        F.sum(F.when(split == train, F.col("n")).otherwise(0)).alias("c_ab"),
        F.sum(F.when(split == evaluate, F.col("n")).otherwise(0)).alias("m"))
    pv = pv.withColumn("c_a", F.sum("c_ab").over(Window.partitionBy("a")))
    p = (F.col("c_ab") + 1) / (F.col("c_a") + vocab_size)
    return pv.filter(F.col("m") > 0).agg(
        F.sum("m").cast("long").alias("n_targets"),
        (F.sum(-F.log(p) * F.col("m")) / F.sum("m")).alias("loss"))
