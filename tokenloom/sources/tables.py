"""Parquet table scans.

A file with a single row group is read by a single task, so CPU-heavy per-row
work after the scan would run on one core. A session that reads such files may
set ``spark.tokenloom.scanPartitions``: every table is then dealt out to that
many partitions right after its scan. It is unset by default, and the plan
never depends on the size of the input.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

SCAN_PARTITIONS = "spark.tokenloom.scanPartitions"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if columns:
        df = df.select(*columns)
    n = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n else df
