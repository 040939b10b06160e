"""Quality rules: a threshold table compiled into one Spark projection.

``THRESHOLDS`` names a measure and its allowed range. ``measures`` adds the
counts, ``apply_rules`` compiles the table into one boolean column and one
column that names the broken rules. Everything is built from SQL functions.

Defined results: null or blank text has no words and fails; repeated rows are
judged each by itself; columns of the input that bear the name of an output
are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.llm.common import table, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = ("the of and to in is a that for it on with as are this be by at or was an not have from "
              "der die das und ist zu den von mit ein eine des dem im auf es sich "
              "le la les de et un une est que dans pour sur par du avec au "
              "el los las y en se con su lo del al").split()


@dataclass(frozen=True)
class Threshold:
    """A document passes when ``low <= measure <= high`` (None: open)."""

    measure: str
    low: float | None = None
    high: float | None = None


THRESHOLDS = (
    Threshold("mean_word_chars", 1.5, 20.0),
    Threshold("symbols_per_word", None, 0.25),
    Threshold("bangs_per_word", None, 0.5),
    Threshold("stop_word_ratio", 0.01, None),
    Threshold("dup_line_ratio", None, 0.5),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _joined(h: str, step: int, n: Column) -> Column:
    """Hash of each element with the one ``step`` places on."""
    return F.zip_with(h, F.slice(h, F.lit(step + 1), F.greatest(n, F.lit(1))), lambda a, b: F.xxhash64(a, b))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of ``COUNTS`` and the ratios of ``THRESHOLDS``.

    A window counts as repeated if its hash (64 bits, within one text) occurs
    twice. Only texts that hold a repeated window pay for finding its place.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    size = F.size("__w")
    df = docs.withColumn("__t", t).withColumn("__w", words(F.col("__t")))
    df = df.withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):  # one column each, so that none is computed twice: 2, 4, then 8 words
        df = df.withColumn("__h", _joined("__h", step, size))
    df = df.withColumn("__win", F.when(size >= WINDOW, F.slice("__h", F.lit(1), size - (WINDOW - 1))).otherwise(
        F.array().cast("array<bigint>")))
    repeated = F.size(F.array_distinct("__win")) < F.size("__win")
    by_hash = F.sort_array(F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("__s", F.when(repeated, by_hash))
    last = F.size("__s") - 1
    twice = F.zip_with(F.slice("__s", 1, last), F.slice("__s", F.lit(2), last),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(twice, lambda p: p.isNotNull()))))
    df = df.withColumn("__p", F.when(F.col("__s").isNotNull(), starts))
    covered = F.aggregate(
        F.zip_with("__p", F.slice("__p", F.lit(2), F.size("__p")),
                   lambda a, b: F.when(b.isNull(), WINDOW).otherwise(F.least(F.lit(WINDOW), b - a))),
        F.lit(0), lambda acc, x: acc + x)
    lines = F.filter(F.split("__t", "\n", -1), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    df = (df.withColumn("__l", lines)
          .withColumn("n_words", size.cast("long"))
          .withColumn("word_chars", F.length(F.array_join("__w", "")).cast("long"))
          .withColumn("n_symbols", F.length(F.regexp_replace("__t", f"[^{SYMBOLS}]+", "")).cast("long"))
          .withColumn("n_dup_lines", (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"))
          .withColumn("n_repeat_words", F.coalesce(F.when(F.col("__p").isNotNull(), covered), F.lit(0)).cast("long"))
          .withColumn("__bangs", F.length(F.regexp_replace("__t", "[^!?]+", "")))
          .withColumn("__stops", F.size(F.filter("__w", lambda w: F.lower(w).isin(STOP_WORDS)))))
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    return (df.withColumn("mean_word_chars", F.col("word_chars") / per_word)
            .withColumn("symbols_per_word", F.col("n_symbols") / per_word)
            .withColumn("bangs_per_word", F.col("__bangs") / per_word)
            .withColumn("stop_word_ratio", F.col("__stops") / per_word)
            .withColumn("dup_line_ratio", F.col("n_dup_lines") / F.greatest(F.size("__l"), F.lit(1)))
            .drop("__t", "__w", "__h", "__win", "__s", "__p", "__l", "__bangs", "__stops"))


def apply_rules(measured: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Add base_failed, broken (names of broken rules) and kept, as one projection."""
    base = ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))

    def fails(t: Threshold) -> Column:
        c = F.lit(False)
        if t.low is not None:
            c = c | (F.col(t.measure) < t.low)
        if t.high is not None:
            c = c | (F.col(t.measure) > t.high)
        return c

    broken = F.filter(F.array(F.when(base, F.lit("base")), *[F.when(fails(t), F.lit(t.measure)) for t in thresholds]),
                      lambda x: x.isNotNull())
    others = [c for c in measured.columns if c not in ("base_failed", "broken", "kept")]
    return measured.select(*others, base.alias("base_failed"), broken.alias("broken"),
                           (F.size(broken) == 0).alias("kept"))


def quality_rules(docs: DataFrame, text: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    return apply_rules(measures(docs, text), thresholds)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", *COUNTS, "base_failed", "kept")


_RATIO_SQL = {
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "bangs_per_word": "n_bangs / greatest(n_words, 1)",
    "stop_word_ratio": "n_stops / greatest(n_words, 1)",
    "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
}


def oracle() -> str:
    """The same counts in SQL, from whole windows of words instead of hashes."""
    passes = []
    for t in THRESHOLDS:
        e = f"CAST({_RATIO_SQL[t.measure].replace(' / ', ' AS DOUBLE) / ')}"
        passes += [f"{e} >= {t.low}"] if t.low is not None else []
        passes += [f"{e} <= {t.high}"] if t.high is not None else []
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
again AS (
  SELECT doc_id, i FROM win
  QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cover AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM again)
  GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(t, '[^!?]', '', 'g')) AS n_bangs,
         len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stops,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(cover.n, 0) AS n_repeat_words
  FROM d LEFT JOIN cover USING (doc_id)),
j AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(passes)} AS kept
FROM j"""
