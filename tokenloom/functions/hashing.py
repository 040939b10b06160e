"""Seeded draws that both Spark and DuckDB reproduce bit for bit.

Spark's ``rand``/``xxhash64`` have no DuckDB twin; ``md5`` does. The first 15
hex digits (60 bits) of ``md5('a:b:c')`` give an integer; dividing by 2**60
gives a uniform double in [0, 1). With 60 bits the modulo bias of
``int60 % n`` is below n / 2**60.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


TWO_60 = float(2 ** 60)


def md5_key(*parts) -> Column:
    """':'-joined string of the parts; Columns are cast, Python values are literals."""
    cols = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(":", *cols)


def md5_int60(*parts) -> Column:
    """60-bit non-negative BIGINT from md5 of the ':'-joined parts."""
    return F.conv(F.substring(F.md5(md5_key(*parts)), 1, 15), 16, 10).cast("long")


def md5_unit(*parts) -> Column:
    """Uniform double in [0, 1) from md5 of the ':'-joined parts."""
    return md5_int60(*parts) / F.lit(TWO_60)
