"""Sharding by histogram sort: near-equal bytes per shard, one exchange.

Rows are ordered by (hash of the text, id). The key at which a shard ends is
found without sorting: every round counts, over all partitions, the exact
bytes below a set of probe keys, and replaces the probes around each boundary
by finer ones until the bytes below a probe are within ``TOLERANCE`` of the
boundary's target. Only then the rows are exchanged, once.

Equal texts share a hash, so probes between hashes never cut a group of
copies. Where one hash holds too many bytes for that (a hot text), a second
search by id cuts inside the group.

The same rounds place the ends of finer ranges, balanced by bytes plus rows,
so that the tasks after the exchange are many and even although there are few
shards. The slot of a row is its range's first slot plus its place in the range.

Defined results: null text has size 1 and no checksum; rows equal in text and
id cannot be told apart and stay together; null ids come first within a text;
an empty table gives an empty result; input columns that bear an output's name
are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tokenloom.llm.common import table, write_scratch

SHARDS = 16
TOLERANCE = 0.005
PROBES = 128
LOW, HIGH = -(1 << 63), (1 << 63) - 1  # the largest hash is not used as a key
NO_ID = LOW


@dataclass
class Boundary:
    """Search state: rows with key < ``key`` lie below; the answer lies in (low, high]."""

    target: float
    slack: float
    measure: int
    low: int = LOW
    below: int = 0
    high: int = HIGH
    upto: int = 0
    rows: int = 0
    key: int | None = None


def _count_below(keys: DataFrame, probes: np.ndarray):
    """Per probe the exact (bytes, weight) of the rows with key < probe; per gap its (least key, largest key, rows)."""
    bins = len(probes) + 1

    def part(batches):
        total = np.zeros((3, bins), dtype=np.int64)
        least, most = np.full(bins, HIGH), np.full(bins, LOW)
        for b in batches:
            key = b.column(0).to_numpy()
            place = np.searchsorted(probes, key, side="right")
            np.add.at(total[0], place, b.column(1).to_numpy())
            np.add.at(total[1], place, b.column(2).to_numpy())
            np.add.at(total[2], place, 1)
            np.minimum.at(least, place, key)
            np.maximum.at(most, place, key)
        used = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, *total[:, used], least[used], most[used])],
                                         names=["bin", "b", "w", "n", "least", "most"])

    rows = (keys.select("key", "size", "weight").mapInArrow(part, "bin long, b long, w long, n long, least long, most long")
            .groupBy("bin").agg(F.sum("b").alias("b"), F.sum("w").alias("w"), F.sum("n").alias("n"),
                                F.min("least").alias("least"), F.max("most").alias("most")).collect())
    total, ends = np.zeros((2, bins), dtype=np.int64), [(HIGH, LOW, 0)] * bins
    for r in rows:
        total[0][r["bin"]], total[1][r["bin"]], ends[r["bin"]] = r["b"], r["w"], (r["least"], r["most"], r["n"])
    return np.cumsum(total, axis=1)[:, :-1], ends


def find_splitters(keys: DataFrame, boundaries: list[Boundary], probes: int = PROBES) -> None:
    """Set ``key`` of each boundary. keys: (key long, size long, weight long).

    A boundary is placed at a probe when the bytes below that are within its
    slack, or beside the one key that is left between two probes.
    """
    open_ = boundaries
    while open_:
        grid = set()
        for b in open_:
            width = b.high - b.low
            grid.update(b.low + width * i // (probes + 1) for i in range(probes + 2))
        at = np.array(sorted(grid), dtype=np.int64)
        counts, ends = _count_below(keys, at)
        for b in open_:
            c = counts[b.measure]
            i = int(np.searchsorted(c, b.target, side="right")) - 1  # the last probe with no more than the target below
            b.low, b.below = int(at[i]), int(c[i])
            if i + 1 == len(at):  # all keys lie below the target
                b.key = b.low
                continue
            b.high, b.upto = int(at[i + 1]), int(c[i + 1])
            least, most, b.rows = ends[i + 1]
            if least == most:
                b.low, b.high = least, least + 1
            left, right = b.target - b.below, b.upto - b.target
            if min(left, right) <= b.slack or b.high - b.low <= 1:
                b.key = b.low if left <= right else b.high
        open_ = [b for b in open_ if b.key is None]


def _digest(text: Column) -> Column:
    return F.least(F.xxhash64(F.coalesce(text, F.lit("")), text.isNull()), F.lit(HIGH - 1))


def shard_documents(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
                    text: str = "text", doc_id: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """Add size, text_crc32, shard, slot to every row; rows come out in shard order.

    ``ranges``: tasks after the exchange (default: the session's shuffle partitions).
    """
    spark = docs.sparkSession
    ranges = ranges or max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    t, ident = F.col(text), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    size = (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long")
    narrow = write_scratch(docs.select(_digest(t).alias("key"), ident.alias("ident"), size.alias("size")), "shard-keys")
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    n_bytes, n_rows = total["b"], total["n"]
    each = max(1, n_bytes // max(1, n_rows))  # a row weighs as much as its bytes plus an average row
    keys = narrow.withColumn("weight", F.col("size") + each)
    n_weight = n_bytes + each * n_rows
    cuts = [Boundary(n_bytes * k / shards, tolerance * n_bytes / shards, 0) for k in range(1, shards)]
    fine = [Boundary(n_weight * k / ranges, 0.1 * n_weight / ranges, 1) for k in range(1, ranges)]
    splits: list[tuple[int, int, bool]] = []
    if n_rows:
        find_splitters(keys, cuts + fine)
        splits = _inside_groups(keys, cuts + fine)
    ends = sorted({(k, i) for k, i, _ in splits})
    shard_ends = sorted((k, i) for k, i, own in splits if own)
    first = np.array([e[0] for e in ends], dtype=np.int64)
    second = np.array([e[1] for e in ends], dtype=np.int64)
    # the shard of the range that begins at each end: as many shard boundaries as lie at or before it
    shard_of = [0] + [sum(s <= e for s in shard_ends) for e in ends]

    where = _range_of(first, second)
    sizes = narrow.groupBy(where(F.col("key"), F.col("ident")).alias("r")).count().collect()
    count = {r["r"]: r["count"] for r in sizes}
    begin, at = [], {}
    for i, s in enumerate(shard_of):
        begin.append((i, s, at.get(s, 0)))
        at[s] = at.get(s, 0) + count.get(i, 0)

    others = [c for c in docs.columns if c not in ("size", "text_crc32", "shard", "slot")]
    wide = docs.select(*others, size.alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
                       _digest(t).alias("__key"), ident.alias("__ident"))
    wide = wide.withColumn("__range", where(F.col("__key"), F.col("__ident")))
    info = spark.createDataFrame(begin, "__r int, shard int, __first long")  # one row per range: bounded
    order = Window.partitionBy("__range").orderBy("__key", "__ident")
    placed = wide.withColumn("__n", F.row_number().over(order))
    return (placed.join(F.broadcast(info), placed["__range"] == info["__r"])
            .select(*others, "size", "text_crc32", "shard",
                    (F.col("__first") + F.col("__n") - 1).cast("long").alias("slot")))


def _range_of(first: np.ndarray, second: np.ndarray):
    """The number of the range that holds (key, id), as an Arrow-batched function."""
    @F.pandas_udf("int")
    def where(key: pd.Series, ident: pd.Series) -> pd.Series:
        k, d = key.to_numpy(), ident.to_numpy()
        out = np.searchsorted(first, k, side="left")
        hi = np.searchsorted(first, k, side="right")
        for r in np.flatnonzero(hi > out):
            out[r] += np.searchsorted(second[out[r]:hi[r]], d[r], side="right")
        return pd.Series(out.astype(np.int32))

    return where


def _inside_groups(keys: DataFrame, found: list[Boundary]) -> list[tuple[int, int, bool]]:
    """(key, first id, is a shard's end) per boundary: the rows from there on lie above.

    A boundary that is off by more than its slack because one hash holds too
    many bytes is searched again among the ids of that hash.
    """
    out, again = [], {}
    for b in found:
        off = abs((b.below if b.key == b.low else b.upto) - b.target)
        if off <= b.slack or b.high - b.low > 1 or b.rows <= 1:
            out.append((b.key, NO_ID, b.measure == 0))
        else:
            again.setdefault(b.low, []).append(b)
    for hot, group in again.items():
        ids = keys.filter(F.col("key") == hot).select(F.col("ident").alias("key"), "size", "weight")
        ends = ids.agg(F.min("key").alias("a"), F.max("key").alias("z")).first()
        inner = [Boundary(b.target - b.below, b.slack, b.measure, low=ends["a"], high=min(ends["z"], HIGH - 1) + 1) for b in group]
        find_splitters(ids, inner)
        out += [(hot, i.key, b.measure == 0) for b, i in zip(group, inner)]
    return out


def op4_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
