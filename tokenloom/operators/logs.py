"""Training-log analytics over ``(run, step, loss, ts)``.

Per-run running values (best so far, running mean, time since the previous
row) use the bucketed prefix aggregates, so a run holding most of the log is
still spread over many tasks; per-run totals are plain partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .prefix import _join, prefix_aggregates

INF = float("inf")
# Fixed value: how the log shows a time.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _seconds_between(start, end):
    """Seconds from ``start`` to ``end``; works for TIMESTAMP and TIMESTAMP_NTZ
    without going through the session time zone."""
    return F.timestamp_diff("MICROSECOND", start, end) / 1e6


def _finite_or_null(c):
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def periodic_rows(log: DataFrame, every: int, step: str = "step") -> DataFrame:
    """Keep every ``every``-th step (``step % every == 0``)."""
    return log.filter(F.col(step) % every == 0)


def eval_loss(log: DataFrame, eval_interval: int) -> DataFrame:
    """Mean loss and number of batches per run and evaluation point
    (``eval_step = step - step % eval_interval``)."""
    return (log.withColumn("eval_step", F.col("step") - F.col("step") % eval_interval)
               .groupBy("run", "eval_step")
               .agg(F.avg("loss").alias("mean_loss"), F.count(F.lit(1)).alias("n_batches")))


def eval_losses(log: DataFrame) -> DataFrame:
    """A6 over evaluation rows: per run and step, mean loss and number of batches
    of the ``train`` and of the ``val`` split side by side, and whether the
    validation loss is the run's best so far (W3). A split without rows at a
    step has a null mean and no batches; such a step is never best."""
    split = F.col("split")
    per = log.groupBy("run", "step").agg(
        *[F.avg(F.when(split == s, F.col("loss"))).alias(f"{s}_loss") for s in ("train", "val")],
        *[F.count_if(split == s).alias(f"{s}_batches") for s in ("train", "val")])
    best = running_best(per.withColumnRenamed("val_loss", "loss"))
    return best.withColumnRenamed("loss", "val_loss").drop("best_so_far")


def best_summary(log: DataFrame) -> DataFrame:
    """Per run final step and loss, best (non-NaN) loss, wall-clock span."""
    return log.groupBy("run").agg(
        F.max("step").alias("final_step"),
        F.max_by("loss", "step").alias("final_loss"),
        F.min(_finite_or_null(F.col("loss"))).alias("best_loss"),
        F.count(F.lit(1)).alias("n_steps"),
        _seconds_between(F.min("ts"), F.max("ts")).alias("total_seconds"),
    )


def running_best(log: DataFrame, init_best: float | Column = INF) -> DataFrame:
    """``is_best = loss < best so far`` (strict: a tie is not best; NaN never
    is); best starts at ``init_best`` (+inf, or a resumed value; a column of the
    log where every run resumes from its own)."""
    d = prefix_aggregates(log,
                          [("_prev_min", "min", _finite_or_null(F.col("loss")))],
                          group=["run"], major=[], key="step", materialize=True)
    init = init_best if isinstance(init_best, Column) else F.lit(init_best)
    prev = F.least(F.coalesce(F.col("_prev_min"), F.lit(INF)), init)
    is_best = F.coalesce(F.col("loss") < prev, F.lit(False))
    return (d.withColumn("is_best", is_best)
             .withColumn("best_so_far", F.when(is_best, F.col("loss")).otherwise(prev))
             .drop("_prev_min"))


def running_avg_loss(log: DataFrame) -> DataFrame:
    """Mean of the losses from the first step to this one."""
    d = prefix_aggregates(log,
                          [("_s", "sum", F.col("loss")), ("_n", "sum", F.lit(1).cast("long"))],
                          group=["run"], major=[], key="step", materialize=True)
    return (d.withColumn("running_avg", (F.col("_s") + F.col("loss")) / (F.col("_n") + 1))
             .drop("_s", "_n"))


def step_timing(log: DataFrame, max_steps: int | None = None) -> DataFrame:
    """Seconds since the run's first row, since the previous row,
    percent of ``max_steps`` (default: the run's last step), and the time as
    text (``at``)."""
    from ..session import checkpoint_dir
    checkpoint_dir(log.sparkSession)
    log = log.checkpoint()     # read by the prefix levels and the per-run totals
    d = prefix_aggregates(log, [("_prev_ts", "last", F.col("ts"))],
                          group=["run"], major=[], key="step")
    runs = log.groupBy("run").agg(F.min("ts").alias("_t0"), F.max("step").alias("_smax"))
    total = F.lit(max_steps) if max_steps else F.col("_smax")
    return (_join(d, runs, ["run"])
             .withColumn("elapsed_s", _seconds_between(F.col("_t0"), F.col("ts")))
             .withColumn("dt_s", _seconds_between(F.col("_prev_ts"), F.col("ts")))
             .withColumn("pct_done", F.when(total > 0, F.col("step") * 100.0 / total))
             .withColumn("at", F.date_format("ts", TIME_FORMAT))
             .drop("_t0", "_smax", "_prev_ts"))


def checkpoint_pick(cands: DataFrame, order_col: str = "priority") -> DataFrame:
    """Per run, the first usable file by fixed priority (NULL if none)."""
    return (cands.groupBy("run").agg(
        F.min_by(F.when(F.col("usable"), F.col("file")), F.when(F.col("usable"), F.col(order_col))).alias("file"),
        F.min(F.when(F.col("usable"), F.col(order_col))).alias(order_col)))


# Fixed priority of checkpoint files (first usable wins).
CHECKPOINT_FILES = ["model_best.pt", "checkpoint.pt", "model.pt"]
