"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import as_col


def round6(c) -> Column:
    """Round a double to 6 decimals through DECIMAL(38,12).

    Rounding the double directly differs between engines on decimal ties
    (one rounds the shortest decimal form, another ``x * 1e6``); going
    through a fixed-scale decimal gives the same answer in Spark and DuckDB.
    """
    return F.round(as_col(c).cast("decimal(38,12)"), 6).cast("double")
