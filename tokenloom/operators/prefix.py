"""Distributed exclusive prefix aggregates in a total order.

A running ``sum``/``min``/``lag`` over a whole partition key puts every row of
that key into one task, and one shard or run may hold a third of the data.
Instead the order key is cut into buckets of at most ``fanout`` consecutive
keys and the buckets into super-buckets of at most ``fanout`` buckets. Windows
then hold at most ``fanout`` rows per partition key; only the super-bucket
summaries (``keys / fanout**2`` rows per group) meet in the top window, and
each level's table is ``fanout`` times smaller than the one below.

Supported aggregates are associative: ``sum``, ``min``, ``max`` and ``last``
(the value of the nearest preceding row, i.e. ``lag`` — kept as the maximum
of ``struct(key, value)``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

FANOUT = 4096

_AGG = {"sum": F.sum, "min": F.min, "max": F.max, "last": F.max}


def _combine(agg: str, a: Column, b: Column) -> Column:
    if agg == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    if agg == "min":
        return F.least(a, b)
    return F.greatest(a, b)  # max, last (struct order = key order)


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys, null being equal to null: rows without a group keep each other company."""
    same = F.lit(True)
    for i, k in enumerate(keys):
        right = right.withColumnRenamed(k, f"_r{i}")
        same = same & left[k].eqNullSafe(right[f"_r{i}"])
    return left.join(right, same).drop(*[f"_r{i}" for i in range(len(keys))])


def prefix_aggregates(df: DataFrame, specs: list[tuple[str, str, Column | str]],
                      group: list[str], major: list[str], key: str,
                      fanout: int = FANOUT, materialize: bool = False) -> DataFrame:
    """Add, per ``(out, agg, value)`` in ``specs``, the aggregate of ``value``
    over rows of the same ``group`` that precede this row in ``(major..., key)``
    order. ``key`` is an integer column unique within ``group + major``.

    Empty prefixes give 0 for ``sum`` and NULL otherwise. The input feeds two
    branches (the row level and the bucket levels); with ``materialize`` it is
    first written as a reliable checkpoint so it is computed once.
    """
    g, m = list(group), list(major)
    if materialize:
        from ..session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint()
    d = (df.withColumn("_b1", F.floor(F.col(key) / fanout).cast("long"))
           .withColumn("_b2", F.floor(F.col("_b1") / fanout).cast("long")))
    vals = []
    for i, (out, agg, value) in enumerate(specs):
        v = value if isinstance(value, Column) else F.col(value)
        if agg == "last":
            v = F.struct(F.col(key).alias("k"), v.alias("v"))
        d = d.withColumn(f"_v{i}", v)
        vals.append((i, out, agg))
    before = (Window.unboundedPreceding, -1)

    w1 = Window.partitionBy(*g, *m, "_b1").orderBy(key).rowsBetween(*before)
    for i, _, agg in vals:
        d = d.withColumn(f"_e1_{i}", _AGG[agg](f"_v{i}").over(w1))

    t1 = d.groupBy(*g, *m, "_b2", "_b1").agg(
        *[_AGG[agg](f"_v{i}").alias(f"_t1_{i}") for i, _, agg in vals])
    w2 = Window.partitionBy(*g, *m, "_b2").orderBy("_b1").rowsBetween(*before)
    for i, _, agg in vals:
        t1 = t1.withColumn(f"_e2_{i}", _AGG[agg](f"_t1_{i}").over(w2))

    t2 = t1.groupBy(*g, *m, "_b2").agg(
        *[_AGG[agg](f"_t1_{i}").alias(f"_t2_{i}") for i, _, agg in vals])
    w3 = Window.partitionBy(*g).orderBy(*m, "_b2").rowsBetween(*before)
    t2 = t2.select(*g, *m, "_b2", *[_AGG[agg](f"_t2_{i}").over(w3).alias(f"_e3_{i}")
                                    for i, _, agg in vals])

    boff = _join(t1, t2, [*g, *m, "_b2"]).select(
        *g, *m, "_b1",
        *[_combine(agg, F.col(f"_e3_{i}"), F.col(f"_e2_{i}")).alias(f"_o_{i}") for i, _, agg in vals])
    out = _join(d, boff, [*g, *m, "_b1"])
    for i, name, agg in vals:
        r = _combine(agg, F.col(f"_o_{i}"), F.col(f"_e1_{i}"))
        if agg == "last":
            r = r["v"]
        elif agg == "sum":
            r = r.cast("long") if dict(out.dtypes).get(f"_v{i}") in ("int", "bigint") else r
        out = out.withColumn(name, r)
    drop = ["_b1", "_b2"] + [c for i, _, _ in vals
                             for c in (f"_v{i}", f"_e1_{i}", f"_o_{i}")]
    return out.drop(*drop)


def exclusive_prefix(df: DataFrame, value: str, group: list[str], major: list[str],
                     key: str, out: str = "offset", fanout: int = FANOUT,
                     materialize: bool = False) -> DataFrame:
    """Sum of ``value`` over the preceding rows (0 for the first row)."""
    return prefix_aggregates(df, [(out, "sum", value)], group, major, key, fanout, materialize)


def ranked_prefix(df: DataFrame, value: str, group: list[str], order: list, out: str = "offset") -> DataFrame:
    """Sum of ``value`` over the rows of the same ``group`` that come before in ``order``; no arithmetic on the keys.

    Rows are range-sorted by group and order and written once. A row's prefix is
    the sum of the ranges before its own (one row per group and range) and of the
    rows before it in its range, so no window holds more than a range, whatever
    the keys are: sparse, null, repeated, or strings. Rows equal in group and
    order are spread by a random last key; their order among each other is that of
    the written table. The result is read from that table, one row per input row.
    """
    from ..session import ScratchTables
    tables = ScratchTables(df.sparkSession, "ranked")
    keys = [*group, *order]
    placed = tables.write(
        df.withColumn("_spread", F.rand(11)).repartitionByRange(*keys, "_spread").sortWithinPartitions(*keys, "_spread")
        .withColumn("_place", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()).drop("_spread"), "placed")
    before = (Window.unboundedPreceding, -1)
    names = [f"_g{i}" for i in range(len(group))]
    spans = (placed.groupBy(*group, "_part").agg(F.sum(value).alias("_sum"))
             .withColumn("_ahead", F.sum("_sum").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(*before)))
             .select(*[F.col(g).alias(n) for g, n in zip(group, names)], F.col("_part").alias("_p"), "_ahead"))
    inside = F.sum(value).over(Window.partitionBy("_part", *group).orderBy("_place").rowsBetween(*before))
    same = placed["_part"] == spans["_p"]
    for g, n in zip(group, names):
        same = same & placed[g].eqNullSafe(spans[n])
    return (placed.withColumn("_inside", inside).join(spans, same)
            .withColumn(out, (F.coalesce("_ahead", F.lit(0)) + F.coalesce("_inside", F.lit(0))).cast("long"))
            .drop("_place", "_part", "_p", "_sum", "_ahead", "_inside", *names))
