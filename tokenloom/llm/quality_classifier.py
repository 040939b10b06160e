"""Quality by co-training a text classifier and a metadata classifier.

The text view sees ratios of the whole text (case, symbols, repetition, word
and line shape); the metadata view sees language, source and declared length.
Each is a logistic regression. Over ``ROUNDS`` rounds each view labels the
unlabelled documents it is most sure of and hands them to the other view's
training set. The views are then calibrated and combined by a logistic
regression of their logits on labelled rows that neither has trained on.

Fitting takes at most ``MAX_LABELLED`` labelled and ``MAX_POOL`` unlabelled
documents, chosen by a hash of their id; only their feature rows come to the
driver. Every document is scored by SQL expressions over its whole text.

Defined results: null and empty text has features of zero words; null language
or source is a value of its own; rows without id are scored, but not learned
from; without labelled rows of both classes every score is 1; an empty table
gives an empty result; columns that bear an output's name are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.llm.common import table, words
from tokenloom.llm.logistic import Logistic
from tokenloom.llm.quality_rules import STOP_WORDS

MAX_LABELLED, MAX_POOL = 20_000, 20_000
ROUNDS, PER_ROUND = 4, 500
SURE = 0.95
BUCKETS = 32
KEEP = 0.5

TEXT_VIEW = ("upper", "symbols", "bangs", "digits", "distinct", "stops", "mean_word", "log_words", "dup_lines")


def _share(text: Column, inside: str, size: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{inside}]+", "")) / size


def text_features(text: Column) -> list[Column]:
    """The columns of ``TEXT_VIEW``; expects the words in ``__w``."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    n, chars = F.greatest(F.size("__w"), F.lit(1)), F.greatest(F.length(t), F.lit(1))
    lines = F.split(t, "\n", -1)
    made = (_share(t, r"\p{Lu}", chars), _share(t, r"#*$%&|<>", chars), _share(t, "!?", chars), _share(t, "0-9", chars),
            F.size(F.array_distinct("__w")) / n, F.size(F.filter("__w", lambda w: F.lower(w).isin(STOP_WORDS))) / n,
            F.least(F.length(F.array_join("__w", "")) / n, F.lit(40.0)), F.log1p(F.size("__w").cast("double")),
            1 - F.size(F.array_distinct(lines)) / F.size(lines))
    return [m.cast("double").alias(f"__t_{name}") for name, m in zip(TEXT_VIEW, made)]


def _bucket(c: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(c.cast("string"), F.lit("\x00"))), F.lit(BUCKETS)).cast("int")


def featured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the features: __t_* of the text, __lang, __source buckets and __len of the metadata."""
    have = docs.columns
    lang = F.col("lang") if "lang" in have else F.lit(None)
    source = F.col("source") if "source" in have else F.lit(None)
    size = F.col("n_chars") if "n_chars" in have else F.lit(None)
    return docs.withColumn("__w", words(F.col(text))).select(
        *have, *text_features(F.col(text)), _bucket(lang).alias("__lang"), _bucket(source).alias("__source"),
        F.log1p(F.greatest(F.coalesce(size.cast("double"), F.lit(0.0)), F.lit(0.0))).alias("__len"))


FEATURES = [f"__t_{n}" for n in TEXT_VIEW] + ["__lang", "__source", "__len"]


def views(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text view, metadata view) of feature rows."""
    k = len(TEXT_VIEW)
    one = np.eye(BUCKETS)
    return rows[:, :k], np.hstack([one[rows[:, k].astype(int)], one[rows[:, k + 1].astype(int)], rows[:, k + 2:]])


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    both: Logistic


def co_train(x: np.ndarray, y: np.ndarray, pool: np.ndarray) -> CoTrained | None:
    """x, pool: feature rows; y: labels of x. Every fourth labelled row is kept for calibration."""
    aside = np.arange(len(y)) % 4 == 0
    if len(set(y[~aside])) < 2 or len(set(y[aside])) < 2:
        return None
    seen, free = list(views(x[~aside])), views(pool)
    label = [y[~aside], y[~aside]]
    left = np.ones(len(pool), dtype=bool)
    model = [Logistic(v, t) for v, t in zip(seen, label)]
    for _ in range(ROUNDS):
        for teacher in (0, 1):
            if not left.any():
                break
            p = model[teacher].predict(free[teacher])
            share = max(0.02, min(0.98, label[teacher].mean()))
            for value, sure, quota in ((1, p, share), (0, 1 - p, 1 - share)):
                best = np.flatnonzero(left & (sure >= SURE))
                best = best[np.argsort(-sure[best], kind="stable")][:max(1, int(PER_ROUND * quota))]
                left[best] = False
                seen[1 - teacher] = np.vstack([seen[1 - teacher], free[1 - teacher][best]])
                label[1 - teacher] = np.concatenate([label[1 - teacher], np.full(len(best), value)])
        model = [Logistic(v, t) for v, t in zip(seen, label)]
    logits = np.stack([m.logit(v) for m, v in zip(model, views(x[aside]))], axis=1)
    return CoTrained(*model, Logistic(logits, y[aside]))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> CoTrained | None:
    """Co-train on bounded samples of labelled and unlabelled documents."""
    y = (labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__y"))
         .filter(F.col("__y").isin(0, 1) & F.col("__id").isNotNull()))
    n = y.count()
    part = F.pmod(F.xxhash64("__id", F.lit(23)), F.lit(1_000_000))
    chosen = y.filter(part < int(1_000_000 * min(1.0, 0.95 * MAX_LABELLED / max(1, n))) + 1).limit(MAX_LABELLED)
    total = docs.count()
    pool_share = int(1_000_000 * min(1.0, 0.9 * (MAX_POOL + MAX_LABELLED) / max(1, total))) + 1
    named = docs.withColumn("__id", F.col(doc_id))
    picked = (named.join(F.broadcast(chosen), "__id", "left")  # at most MAX_LABELLED rows
              .filter(F.col("__y").isNotNull() | (part < pool_share)).limit(2 * MAX_LABELLED + MAX_POOL))
    rows = featured(picked, text).select("__id", "__y", *FEATURES).toPandas()
    known = rows[rows["__y"].notna()].sort_values(["__id", *FEATURES]).drop_duplicates("__id")
    order = np.argsort([hash_id(i) for i in known["__id"]], kind="stable")
    known = known.iloc[order]
    pool = rows[rows["__y"].isna()].sort_values(["__id", *FEATURES]).head(MAX_POOL)
    return co_train(known[FEATURES].to_numpy(float), known["__y"].to_numpy(float), pool[FEATURES].to_numpy(float))


def hash_id(i) -> int:
    return (int(i) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF


def _logit(m: Logistic, cols: list[Column]) -> Column:
    c, b = m.raw()
    out = F.lit(c)
    for w, col in zip(b.tolist(), cols):
        out = out + F.lit(w) * col
    return F.greatest(F.lit(-30.0), F.least(F.lit(30.0), out))


def score_quality(docs: DataFrame, model: CoTrained | None, text: str = "text") -> DataFrame:
    """Add score (of quality 1), text_score, meta_score and kept to every document."""
    others = [c for c in docs.columns if c not in ("score", "text_score", "meta_score", "kept")]
    if model is None:
        one = F.lit(1.0)
        return docs.select(*others, one.alias("score"), one.alias("text_score"), one.alias("meta_score"),
                           F.lit(True).alias("kept"))
    c, b = model.meta.raw()
    pick = lambda weights, k: F.element_at(F.array(*[F.lit(w) for w in weights.tolist()]), F.col(k) + 1)
    meta = (F.lit(c) + pick(b[:BUCKETS], "__lang") + pick(b[BUCKETS:2 * BUCKETS], "__source")
            + F.lit(float(b[-1])) * F.col("__len"))
    meta = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), meta))
    df = featured(docs, text).select(*others, _logit(model.text, [F.col(f"__t_{n}") for n in TEXT_VIEW]).alias("__lt"),
                                     meta.alias("__lm"))
    sigmoid = lambda z: 1 / (1 + F.exp(-z))
    both = _logit(model.both, [F.col("__lt"), F.col("__lm")])
    return (df.withColumn("score", sigmoid(both)).withColumn("text_score", sigmoid(F.col("__lt")))
            .withColumn("meta_score", sigmoid(F.col("__lm"))).withColumn("kept", F.col("score") >= KEEP)
            .drop("__lt", "__lm"))


def op5_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", "score", "text_score", "meta_score", "kept")
