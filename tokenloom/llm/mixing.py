"""Mixing sources to target weights by Pareto order sampling.

Each document is to be taken ``e`` times on average: ``e = min(max_copies,
c * weight)`` with one ``c`` per source so that the source's expected words
meet its target. ``floor(e)`` copies are certain; the fraction ``p`` is drawn
by Pareto order sampling: documents are ranked by random odds over inclusion
odds, ``(u/(1-u)) / (p/(1-p))``, and the first of that order are taken until
the source's words come nearest to its target (a sample of fixed size in
words). ``u`` is a hash of id and text, so reruns agree.

The texts are read once for sizes and once for the result. The rank at which a
source's sample ends is found on the narrow (source, level, size, u) table by
counting words in 1,024 rank intervals and refining the one where the target
falls; the result is then a map-side comparison, so no source, however large,
meets in one task and no text is shuffled.

Bounds: one row per source and weight level comes to the driver
(``MAX_GROUPS``); weights are rounded to ``WEIGHT_DIGITS`` digits. The query
and the pipeline prefer longer documents (``length_odds``), in three levels.

Defined results: null text has size 0; a null source is a source of its own,
ordered last; rows equal in id and text are taken or left together; documents
of size 0 follow the same draw; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tokenloom.llm.common import table, unused_prefix, word_count, write_scratch

CYCLE = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_COPIES = 2.0
MAX_GROUPS = 200_000
WEIGHT_DIGITS = 2
LONG, LONGER = 64, 512
KEY_BITS = 50
STEP_BITS = 10


def source_targets(sizes: dict, share: float = SHARE, cap: float = MAX_COPIES,
                   cycle=CYCLE) -> dict:
    """Target words per source: by weight, none above ``cap`` times its size."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    rest, target, open_ = share * sum(sizes.values()), {}, list(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / total > cap * sizes[s]]
        if not over:
            target |= {s: rest * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = cap * sizes[s]
        rest -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in target]
    return target


def scale_for(levels: list[tuple[float, float]], target: float, cap: float) -> float:
    """``c`` such that the sum of ``min(cap, c * weight) * size`` is the target."""
    low, high = 0.0, 1.0
    words = lambda c: sum(min(cap, c * w) * n for w, n in levels)
    while words(high) < target * (1 - 1e-12) and high < 1e18:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if words(mid) < target else (low, mid)
    return high


def length_odds(text: Column) -> Column:
    """Relative weight by number of words: 1, from ``LONG`` 2, from ``LONGER`` 3."""
    n = word_count(text)
    return F.when(n >= LONGER, 3.0).when(n >= LONG, 2.0).otherwise(1.0)


def _uniform(*cols: Column) -> Column:
    """In (0, 1), from a hash of the columns."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 12).cast("double") + 0.5) / float(1 << 52)


def _rank_key(u: Column, p: Column) -> Column:
    """The Pareto rank q as q/(1+q), in integer steps of 2^-KEY_BITS."""
    return F.floor(u * (1 - p) / (u * (1 - p) + (1 - u) * p) * float(1 << KEY_BITS)).cast("long")


def _cuts(narrow: DataFrame, plan: DataFrame, need: dict) -> dict:
    """source -> last rank key taken, so that its drawn words come nearest to ``need``."""
    spark = narrow.sparkSession
    keyed = write_scratch(
        narrow.join(F.broadcast(plan), narrow["source"].eqNullSafe(plan["__s"]) & (narrow["level"] == plan["__lv"]))
        .filter((F.col("__p") > 0) & (F.col("size") > 0))
        .select("source", "size", _rank_key(F.col("u"), F.col("__p")).alias("key")), "mix-keys")
    open_ = {s: (0, KEY_BITS, 0) for s, n in need.items() if n > 0}  # lowest key, bits of the interval, words below
    cuts = {s: -1 for s in need}
    while open_:
        at = spark.createDataFrame([(s, lo, bits, below, float(need[s])) for s, (lo, bits, below) in open_.items()],
                                   "at_source string, lo long, bits int, below long, need double")
        inside = (F.col("key") >= F.col("lo")) & (F.col("key") < F.col("lo") + F.expr("shiftleft(1L, bits)"))
        counted = (keyed.join(F.broadcast(at), keyed["source"].eqNullSafe(at["at_source"])).filter(inside)
                   .groupBy("at_source", "below", "need",
                            F.expr(f"shiftright(key - lo, greatest(bits - {STEP_BITS}, 0))").alias("bin"))
                   .agg(F.sum("size").alias("words"), F.min("key").alias("first"), F.max("key").alias("last")))
        upto = F.col("below") + F.sum("words").over(Window.partitionBy("at_source").orderBy("bin"))
        reached = F.when(F.col("upto") >= F.col("need"), F.struct("bin", "upto", "words", "first", "last"))
        crossing = (counted.withColumn("upto", upto).groupBy("at_source")
                    .agg(F.min(reached).alias("x"), F.max("last").alias("end")))
        state, open_ = open_, {}
        for r in crossing.collect():
            s, x = r["at_source"], r["x"]
            lo, bits, _ = state[s]
            if x is None:  # rounding: all words together fall short of the target
                cuts[s] = r["end"]
            elif x["first"] == x["last"]:
                before = x["upto"] - x["words"]
                cuts[s] = x["first"] if x["upto"] - need[s] <= need[s] - before else x["first"] - 1
            else:
                step = max(bits - STEP_BITS, 0)
                open_[s] = (lo + (x["bin"] << step), step, x["upto"] - x["words"])
    return cuts


def mix(docs: DataFrame, targets=source_targets, text: str = "text", doc_id: str = "doc_id",
        source: str = "source", weight: str | Column | None = None, max_copies: float = MAX_COPIES,
        seed: int = 17) -> DataFrame:
    """Add size, source_size, target and copies to every document.

    ``targets`` maps {source: words} to {source: target words}. ``weight``
    is an optional column (or its name) of relative weights (null: 1); such
    documents are taken in proportion, up to ``max_copies`` each.
    """
    spark = docs.sparkSession
    given = F.lit(1.0) if weight is None else F.col(weight) if isinstance(weight, str) else weight
    w = F.round(F.coalesce(given.cast("double"), F.lit(1.0)), WEIGHT_DIGITS)
    u = _uniform(F.col(doc_id), F.col(text), F.lit(seed))
    narrow = write_scratch(docs.select(F.col(source).cast("string").alias("source"), w.alias("level"),
                                       word_count(F.col(text)).alias("size"), u.alias("u")), "mix-sizes")
    groups = narrow.groupBy("source", "level").agg(F.sum("size").alias("n")).limit(MAX_GROUPS + 1).collect()
    if len(groups) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} sources and weight levels")
    by_source: dict = {}
    for g in groups:
        by_source.setdefault(g["source"], []).append((g["level"], g["n"]))
    sizes = {s: sum(n for _, n in levels) for s, levels in by_source.items()}
    wanted = targets(sizes)
    rows, need = [], {}
    for s in sizes:
        levels = by_source[s]
        c = scale_for(levels, wanted[s], max_copies) if sizes[s] else 0.0
        taken = [(lv, min(max_copies, c * lv), n) for lv, n in levels]
        need[s] = wanted[s] - sum(math.floor(e + 1e-12) * n for _, e, n in taken)
        for lv, e, _ in taken:
            whole = math.floor(e + 1e-12)
            p = max(0.0, e - whole)
            rows.append((s, lv, whole, p if p > 1e-9 else 0.0, sizes[s], float(wanted[s])))
    schema = "__s string, __lv double, __whole int, __p double, source_size long, target double"
    plan = spark.createDataFrame(rows, schema)
    cuts = _cuts(narrow, plan, need) if rows else {}
    full = spark.createDataFrame([(*r, cuts.get(r[0], -1)) for r in rows], schema + ", __cut long")
    others = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    x = unused_prefix(docs.columns)
    full = full.select(*[F.col(c).alias(f"{x}{c.strip('_')}") for c in full.columns])
    base = docs.select(*others, word_count(F.col(text)).alias("size"), w.alias(f"{x}w"), u.alias(f"{x}u"),
                       F.col(source).cast("string").alias(f"{x}source"))
    drawn = (F.col(f"{x}p") > 0) & (_rank_key(F.col(f"{x}u"), F.col(f"{x}p")) <= F.col(f"{x}cut"))
    joined = base.join(F.broadcast(full), base[f"{x}source"].eqNullSafe(full[f"{x}s"]) & (base[f"{x}w"] == full[f"{x}lv"]))
    return joined.select(*others, "size", F.col(f"{x}source_size").alias("source_size"), F.col(f"{x}target").alias("target"),
                         (F.col(f"{x}whole") + drawn.cast("int")).cast("long").alias("copies"))


def repeat_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per copy taken, with ``columns`` only."""
    copy = unused_prefix(mixed.columns) + "copy"
    return (mixed.filter(F.col("copies") > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*columns))


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, weight=length_odds(F.col("text"))).select("doc_id", "size", "source_size", "target",
                            (F.col("copies") * F.col("size")).alias("taken"))
