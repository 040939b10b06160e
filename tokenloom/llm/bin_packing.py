"""Best-fit packing by minimum bin slack: few sequences, documents whole wherever they fit.

A bin is filled around the longest piece that is left: a subset-sum dynamic
programme over the lengths still available (one bit per reachable sum, each
length as often as it is left) finds the fullest feasible combination, and that
combination is removed. The choice depends on the lengths alone, so it is made
on their histogram, which has at most ``length`` entries at any size of the
corpus: the same combination is removed as often as all its lengths last, and
the next one is searched only then. At least one length runs short each time,
so the plan, too, is bounded by ``length`` and not by the documents.

Spark does the rest. Each task tokenises its documents, cuts those that are
longer than a sequence, and numbers its pieces of each length; the numbers of
all tasks follow from one count per task and length. A piece's number among
those of its length then names its bin and its place there. Texts are read once
and never exchanged, and no length is a key that rows are dealt by, so a length
that a third of all documents have is as good as any other.

Defined results: null or empty text is the end id alone; repeated rows are
packed each; rows without id are packed too; very long texts are cut into
full sequences and a rest; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tokenloom.llm.common import table, write_scratch
from tokenloom.llm.packing import all_token_ids, in_runs, load_tokenizer

LENGTH = 4096
CUT = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long, ids binary"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, ids binary"


def fullest(room: int, lengths: list[int], left: dict[int, int]) -> dict[int, int]:
    """The combination of available lengths with the greatest sum up to ``room``: {length: times}.

    ``lengths`` ascend and are all in ``left``, which says how many there are of
    each. Longer ones are tried first, and the search ends with the first sum
    that leaves no slack; of equal sums the one of longer lengths is taken.
    """
    sums, mask, tried = 1, (1 << (room + 1)) - 1, []
    for at in range(bisect_right(lengths, room) - 1, -1, -1):
        size = lengths[at]
        spare, share = min(left[size], room // size), 1
        while spare:  # 1, 2, 4, ... copies at once reach every number of them
            times = min(share, spare)
            tried.append((size, times, sums))
            sums |= (sums << (size * times)) & mask
            spare -= times
            share *= 2
        if sums >> room:
            break
    total, uses = sums.bit_length() - 1, {}
    for size, times, before in reversed(tried):
        if not before >> total & 1:
            uses[size] = uses.get(size, 0) + times
            total -= size * times
    return uses


def combinations(histogram: dict[int, int], length: int = LENGTH):
    """Minimum bin slack over a histogram {length: pieces}: yields ({length: times}, number of such bins)."""
    left = {size: n for size, n in histogram.items() if n}
    lengths = sorted(left)
    while lengths:
        longest = lengths[-1]
        left[longest] -= 1
        uses = fullest(length - longest, lengths if left[longest] else lengths[:-1], left)
        left[longest] += 1
        uses[longest] = uses.get(longest, 0) + 1
        bins = min(left[size] // times for size, times in uses.items())
        for size, times in uses.items():
            left[size] -= bins * times
        if not all(left[size] for size in uses):
            lengths = [size for size in lengths if left[size]]
        yield uses, bins


def plan(histogram: dict[int, int], length: int = LENGTH) -> np.ndarray:
    """Rows (length, first number, first bin, times, offset), sorted: where the pieces of a length go.

    Piece ``nth`` (from 0) of a length belongs to the last row whose first number
    is not above it, bin ``first bin + (nth - first number) // times``.
    """
    rows, used, bin_ = [], dict.fromkeys(histogram, 0), 0
    for uses, bins in combinations(histogram, length):
        offset = 0
        for size, times in uses.items():
            rows.append((size, used[size], bin_, times, offset))
            used[size] += bins * times
            offset += size * times
        bin_ += bins
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def _cutter(tokenizer: str | None, length: int, with_ids: bool):
    """(doc_id, text) -> the pieces, numbered by length within the task."""
    def run(batches):
        memo, part = load_tokenizer(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(length + 1, dtype=np.int64).tolist()
        for b in in_runs(batches, 1):
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), all_token_ids(b.column(1), memo)):
                for piece, start in enumerate(range(0, len(ids), length)):
                    raw = ids[start:start + length].tobytes()
                    size = len(raw) // 4
                    rows.append((doc, piece, start, size, zlib.crc32(raw), part, seen[size], raw if with_ids else None))
                    seen[size] += 1
            if rows:
                yield _batch(list(zip(*rows)), CUT)
    return run


def _placer(where: np.ndarray):
    """Rows of CUT, ``nth`` counted over all tasks -> rows of PLACED."""
    def run(batches):
        sizes, firsts, bins, times, offsets = where.T
        key = (sizes << 44) | firsts  # fewer than 2^44 pieces have one length
        for b in batches:
            if not b.num_rows:
                continue
            size, nth = np.asarray(b.column(3)), np.asarray(b.column(6))
            at = np.searchsorted(key, (size << 44) | nth, side="right") - 1
            ahead = nth - firsts[at]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(5)), pa.array(bins[at] + ahead // times[at]),
                 pa.array(offsets[at] + ahead % times[at] * size), b.column(7)],
                names=[f.split()[0] for f in PLACED.split(", ")])
    return run


def best_fit(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, doc_id: str = "doc_id",
             text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids).

    ``tokenizer``: path of a tokenizer file that every executor can open;
    ``ids``: the piece's uint32 ids, null unless ``with_ids``.
    """
    spark = docs.sparkSession
    cut = write_scratch(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
                        .mapInArrow(_cutter(tokenizer, length, with_ids), CUT), "fit-pieces")
    counts = write_scratch(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "fit-counts")
    histogram = {r["length"]: r["n"] for r in  # at most ``length`` rows
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = plan(histogram, length)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    ahead = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    names = [f.split()[0] for f in CUT.split(", ")]
    numbered = cut.join(ahead, ["length", "part"]).withColumn("nth", F.col("nth") + F.col("ahead")).select(*names)
    return numbered.mapInArrow(_placer(where), PLACED)


def op12_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False).drop("ids")
