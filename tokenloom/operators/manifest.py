"""Shard manifests: required files, archive listing, verification, extract plan.

Tables:

* required ``(file, shard_id, split, ordinal)`` — from parameters, bounded by
  ``num_train + num_val`` rows (so it may be broadcast);
* expected ``(file, size)`` — the archive manifest (parsed listing);
* existing ``(file, size)`` — what the target folder holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.numeric import round6
from ..functions.text import file_basename, percent_done
from ..sources.corpus import (DEFAULT_VAL_START, MEMBER_PREFIX, MEMBER_SUFFIX, num_val_files,
                              shard_name)

MISSING, MISMATCH, VERIFIED, NOT_IN_ARCHIVE = "missing", "size_mismatch", "verified", "not_in_archive"


def required_shards(spark: SparkSession, num_train: int, val_percent: float,
                    val_start: int = DEFAULT_VAL_START) -> DataFrame:
    """P1 + O4: train ids ``0..num_train-1`` then val ids ``val_start..``, in that order.

    ``num_val = max(1, round(num_train * val_percent / 100))`` (half to even).
    """
    if num_train > val_start:
        raise ValueError("num_train > val_start: train and validation ids would overlap")
    num_val = num_val_files(num_train, val_percent)
    train = spark.range(0, num_train).select(
        F.col("id").cast("int").alias("shard_id"), F.lit("train").alias("split"),
        (F.col("id") + 1).cast("int").alias("ordinal"))
    val = spark.range(val_start, val_start + num_val).select(
        F.col("id").cast("int").alias("shard_id"), F.lit("val").alias("split"),
        (F.col("id") - val_start + num_train + 1).cast("int").alias("ordinal"))
    return train.unionByName(val).select(shard_name("shard_id").alias("file"),
                                         "shard_id", "split", "ordinal")


def parse_listing(lines: DataFrame, prefix: str = MEMBER_PREFIX,
                  suffix: str = MEMBER_SUFFIX) -> DataFrame:
    """S3: ``tar -tvf`` lines ``(line_no, line)`` -> manifest ``(file, size)``.

    Fields split on whitespace; field 3 is the size, the last field the path.
    Only paths with ``prefix`` and ``suffix`` are kept (P4), keyed by basename
    (C9); for a duplicate basename the last line wins.
    """
    parts = F.split(F.trim(F.col("line")), r"\s+")
    parsed = lines.select(
        "line_no",
        F.try_element_at(parts, F.lit(3)).alias("size_s"),
        F.try_element_at(parts, F.lit(-1)).alias("path"))
    kept = parsed.filter(F.col("path").startswith(prefix) & F.col("path").endswith(suffix))
    return (kept.select("line_no", file_basename(F.col("path")).alias("file"),
                        F.col("size_s").cast("long").alias("size"))
                .groupBy("file").agg(F.max_by("size", "line_no").alias("size")))


def verify_archive(read_listing: Callable[[], DataFrame], archive: str = "archive",
                   attempts: int = 2) -> DataFrame:
    """A5 with its retry: the listing is read (fetched anew) and counted until
    the counts agree, ``attempts`` times at most; then it is an error. A
    listing that cannot be read counts as a failed attempt. Returns the one-row
    report of the attempt that passed, with its number."""
    last = "no attempt was made"
    for attempt in range(1, attempts + 1):
        try:
            lines = read_listing()
            report = archive_count_check(lines, archive).first()
        except PySparkException as e:
            last = str(e).split("\n")[0]
            continue
        if report["ok"]:
            return lines.sparkSession.createDataFrame(
                [(*report, attempt)], "archive STRING, n_listed BIGINT, n_members BIGINT, ok BOOLEAN, attempt INT")
        last = f"{report['n_listed']} lines, {report['n_members']} members"
    raise RuntimeError(f"{archive} is not valid after {attempts} attempts: {last}")


def archive_count_check(lines: DataFrame, archive: str = "archive") -> DataFrame:
    """A5: two independent counts of one archive listing must agree and be > 0.

    ``n_listed`` counts lines; ``n_members`` counts lines that parse as a
    member (numeric size field and a path).
    """
    parts = F.split(F.trim(F.col("line")), r"\s+")
    ok_member = (F.try_element_at(parts, F.lit(3)).try_cast("long").isNotNull()
                 & (F.size(parts) >= 4))
    return lines.agg(
        F.count(F.lit(1)).alias("n_listed"),
        F.count_if(ok_member).alias("n_members"),
    ).select(F.lit(archive).alias("archive"), "n_listed", "n_members",
             ((F.col("n_listed") == F.col("n_members")) & (F.col("n_listed") > 0)).alias("ok"))


def verify_shards(required: DataFrame, existing: DataFrame, expected: DataFrame,
                  strict: bool = False) -> DataFrame:
    """Status of every required file with both sizes.

    ``missing`` (not in the folder), ``not_in_archive`` (J3; raises when
    ``strict``), ``size_mismatch`` or ``verified``. ``required`` is bounded by
    the split parameters, so it is broadcast to cut the two listings down
    before the outer joins.
    """
    req = F.broadcast(required.select("file", "shard_id", "split", "ordinal"))
    have = existing.join(req.select("file"), "file").select(
        "file", F.col("size").alias("actual_size"))
    want = expected.join(req.select("file"), "file").select(
        "file", F.col("size").alias("expected_size"))
    out = required.join(have, "file", "left").join(want, "file", "left")
    status = (F.when(F.col("actual_size").isNull(), F.lit(MISSING))
              .when(F.col("expected_size").isNull(),
                    F.raise_error(F.concat(F.lit("not in archive: "), F.col("file")))
                    if strict else F.lit(NOT_IN_ARCHIVE))
              .when(F.col("actual_size") != F.col("expected_size"), F.lit(MISMATCH))
              .otherwise(F.lit(VERIFIED)))
    return out.select("file", "shard_id", "split", "ordinal", "expected_size",
                      "actual_size", status.alias("status"))


def shards_to_extract(verified: DataFrame, variant: str = "A") -> DataFrame:
    """Files that are not verified, with their extraction order.

    Variant ``A`` keeps the required order; ``B`` lists all missing files
    first, then the others. The input is bounded by the required list.
    """
    todo = verified.filter(F.col("status") != VERIFIED)
    if variant == "A":
        order = [F.col("ordinal")]
    elif variant == "B":
        order = [F.when(F.col("status") == MISSING, 0).otherwise(1), F.col("ordinal")]
    else:
        raise ValueError("variant must be 'A' or 'B'")
    w = Window.orderBy(*order)
    return todo.withColumn("extract_order", F.row_number().over(w).cast("int"))


def not_in_archive(required: DataFrame, expected: DataFrame, strict: bool = False) -> DataFrame:
    """Required files absent from the archive manifest."""
    out = required.join(expected.select("file"), "file", "left_anti")
    if strict:
        out = out.withColumn("_fail", F.raise_error(F.concat(F.lit("not in archive: "),
                                                             F.col("file"))))
    return out


def pending_files(wanted: DataFrame, done: DataFrame, key: str = "file") -> DataFrame:
    """Act only on what is absent — ``wanted`` anti-joined with ``done``."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def expected_bytes(files: DataFrame, expected: DataFrame) -> DataFrame:
    """A2: total expected size over a chosen subset of files."""
    return (files.select("file").join(expected, "file")
            .agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("expected_bytes"),
                 F.count(F.lit(1)).alias("n_files")))


def all_verified(verified: DataFrame) -> DataFrame:
    """A3: one boolean; true when nothing is left to do (also for no files)."""
    return verified.agg(
        F.coalesce(F.bool_and(F.col("status") == VERIFIED), F.lit(True)).alias("all_verified"))


def verify_summary(verified: DataFrame) -> DataFrame:
    """A4: number of files per status."""
    return verified.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))


def extract_progress(plan: DataFrame) -> DataFrame:
    """Before each file: i of n, bytes done so far, total, percent done.

    ``plan`` is J2's output (bounded by the required list).
    """
    w = Window.orderBy("extract_order")
    prev = w.rowsBetween(Window.unboundedPreceding, -1)
    size = F.coalesce(F.col("expected_size"), F.lit(0))
    p = (plan.withColumn("i", F.row_number().over(w).cast("int"))
             .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()).cast("int"))
             .withColumn("done_bytes", F.coalesce(F.sum(size).over(prev), F.lit(0)).cast("long"))
             .withColumn("total_bytes", F.sum(size).over(Window.partitionBy()).cast("long")))
    return p.select("file", "i", "n", "done_bytes", "total_bytes",
                    percent_done("done_bytes", "total_bytes").alias("percent"),
                    round6(F.try_divide(F.col("done_bytes") * 100.0, F.col("total_bytes"))).alias("percent_exact"))
