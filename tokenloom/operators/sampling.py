"""One softmax-weighted draw per group from scored candidates.

``p = exp(s/T - max(s/T)) / Z`` per group; the draw is the first item (in
item order) whose cumulative probability exceeds ``u = md5(seed:grp)`` in
[0, 1). The cumulative sum uses the bucketed prefix sum (a huge group is
spread over many tasks) and the pick is a group aggregate: the largest item
whose preceding mass is at most ``u * Z``.

A NaN or null score has no mass; items of the greatest score, infinite ones too,
share it as equals; a group without any number is drawn from evenly. Rows
without a group are a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import md5_unit
from .prefix import _join, exclusive_prefix


def softmax_sample(cands: DataFrame, temperature: float = 1.0, seed: int = 0) -> DataFrame:
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    from ..session import checkpoint_dir
    checkpoint_dir(cands.sparkSession)
    z = F.col("score").cast("double") / F.lit(temperature)
    z = F.when(~F.isnan(z), z)
    gmax = cands.groupBy("grp").agg(F.max(z).alias("_m"))
    # the weights feed three branches (totals and two prefix levels): write once
    mass = (F.when(F.col("_m").isNull() | (z == F.col("_m")), 1.0).when(z.isNull() | F.col("_m").isin(float("inf")), 0.0)
            .otherwise(F.exp(z - F.col("_m"))))
    e = _join(cands, gmax, ["grp"]).select("grp", "item", mass.alias("_e")).checkpoint()
    tot = e.groupBy("grp").agg(F.sum("_e").alias("_z"), F.count(F.lit(1)).alias("n_items"))
    cum = exclusive_prefix(e, "_e", group=["grp"], major=[], key="item", out="_before")
    u = md5_unit(F.lit(seed), F.col("grp"))
    return (_join(cum, tot, ["grp"])
               .filter((F.col("_e") > 0) & (F.col("_before") <= u * F.col("_z")))
               .groupBy("grp", "n_items")
               .agg(F.max_by(F.struct("item", (F.col("_e") / F.col("_z")).alias("p")), "item")
                    .alias("pick"))
               .select("grp", F.col("pick.item").alias("item"), F.col("pick.p").alias("prob"),
                       "n_items"))
