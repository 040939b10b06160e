"""Helpers shared by the training-data operators: words, scratch tables."""

from __future__ import annotations

import atexit
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.session import checkpoint_dir

#: ASCII white space, [\x20\x09-\x0D]; a word is a maximal run of anything else.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Places of the filter that ``might_hold`` makes: 1 MB.
FILTER_BITS = 23

_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(text: Column) -> Column:
    """The text without white space at its ends; null becomes empty."""
    return F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(SPACE))


def words(text: Column) -> Column:
    """All words of a text, in order; none for null, empty or blank text."""
    t = trimmed(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN))


def word_count(text: Column) -> Column:
    t = trimmed(text)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE_RUN))).cast("long")


def _delete(path: str) -> None:
    jvm = SparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(SparkSession.getActiveSession()._jsparkSession.sparkContext().hadoopConfiguration()
                    if SparkSession.getActiveSession() else jvm.org.apache.hadoop.conf.Configuration()).delete(p, True)


def _remove_written() -> None:
    if SparkContext._jvm is None:
        return
    for path in _written:
        try:
            _delete(path)
        except Exception:  # the JVM or the folder is gone: nothing left to remove
            return


atexit.register(_remove_written)


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it.

    This cuts lineage like checkpoint(), survives lost executors, and lets later
    steps read single columns. The table is removed by ``drop_scratch``, else
    when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    _written.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def scratch_paths() -> list[str]:
    """The scratch tables that are there now."""
    return list(_written)


def drop_scratch(*tables: DataFrame | str) -> None:
    """Remove scratch tables (frames that write_scratch returned, or paths) that no frame still to be read needs."""
    for t in tables:
        path = t if isinstance(t, str) else t._scratch_path
        if path in _written:
            _written.remove(path)
            _delete(path)


def unused_prefix(columns: list[str]) -> str:
    """A beginning for column names that none of ``columns`` has."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def might_hold(keys: DataFrame, column: str) -> Column:
    """A filter of fixed size on a column of this name: all values in ``keys`` pass, and few others while they are few."""
    place = F.pmod(F.xxhash64(column, F.lit(99)), F.lit(1 << FILTER_BITS))
    got = (keys.select(place.alias("h")).groupBy(F.shiftright("h", 6).alias("at"))
           .agg(F.bit_or(F.expr("shiftleft(1L, CAST(h & 63 AS INT))")).alias("bits")).toPandas())  # at most 2^FILTER_BITS / 64 rows
    held = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    held[got["at"].to_numpy(dtype=np.int64)] = got["bits"].to_numpy(dtype=np.int64).view(np.uint64)

    @F.pandas_udf("boolean")
    def holds(h: pd.Series) -> pd.Series:
        x = h.to_numpy()
        return pd.Series((held[x >> 6] >> (x & 63).astype(np.uint64)) & np.uint64(1) == 1)

    return holds(place)


def per_process(name: str, make):
    """What ``make`` returns, kept in this Python worker for the tasks that follow."""
    kept = sys.__dict__.setdefault("_tokenloom_kept", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def small(batches, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, to bound what a worker holds of long texts."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


@contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Actions in it hand Python Arrow batches of about ``size`` at most, or of one row; a size that the session sets stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key, None)
    if own is None:
        spark.conf.set(key, size)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(key)


def released(batches) -> Iterator[pa.RecordBatch]:
    """The same batches; after the last, what this worker holds but no longer uses goes back to the system."""
    yield from batches
    own = pa.default_memory_pool()
    for pool in (own, pa.system_memory_pool()):
        pa.set_memory_pool(pool)  # release_unused is about the pool that is set; the system's is also numpy's
        pool.release_unused()
    pa.set_memory_pool(own)


def sorted_groups(batches, n_keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, rows) per run of equal values in the first ``n_keys`` integer columns.

    For use in mapInArrow over rows that were repartitioned and sorted by those
    columns; many small groups cost one slice each, and only the group that is
    open at the end of a batch is carried over.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else b
        keys = [np.asarray(rows.column(i)) for i in range(n_keys)]
        new = np.zeros(rows.num_rows - 1, dtype=bool)
        for k in keys:
            new |= k[1:] != k[:-1]
        ends = np.flatnonzero(new) + 1
        at = 0
        for e in ends.tolist():
            yield tuple(int(k[at]) for k in keys), rows.slice(at, e - at)
            at = e
        held = [rows.slice(at)]
    for rows in held:
        yield tuple(rows.column(i)[0].as_py() for i in range(n_keys)), rows


#: DuckDB: one row, ``t`` the 256 values of CRC-32 by byte.
CRC_TABLE_SQL = ("SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k: "
                 "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i))")


def crc32_sql(octets: str, table: str) -> str:
    """DuckDB: the unsigned CRC-32 of a list of byte values, given the table of CRC_TABLE_SQL."""
    return (f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)")
