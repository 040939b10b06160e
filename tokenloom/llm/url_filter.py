"""URL filter: host-suffix and path-prefix expressions joined to rules by hash.

Each URL is expanded into the expressions "host suffix + path prefix" that a
rule could have, a SHA-256 digest is taken of each, and an equi-join on the
digest's first 32 bits proposes rules; the full digest confirms them. Of the
confirmed rules the longest wins.

The expansion is bounded by the rules: host suffixes have no more labels than
any rule's host, path prefixes only the lengths of rule paths, so a URL makes
at most (labels x lengths) expressions however long it is, and none is lost.

Up to ``MAX_BROADCAST`` rules are broadcast: expressions are joined where they
are made, and only those that a rule confirms are exchanged. Of more rules a
filter of fixed size drops most expressions that no rule begins like; the rest
meet the rules by (prefix, salt), with ``SALT`` copies of each rule, so that a
prefix that most URLs share (``org`` and ``/``) is spread over tasks.

Defined results: a null URL or one without ``://`` has an empty host and path;
URLs that no rule fits get ``DEFAULT``; equal URLs are expanded once but every
row is returned; of rules of one length the one with the longer host wins, then
``block``; rules with a null are ignored, repeated ones count once; without
rules or pages the result is all ``DEFAULT`` or empty; columns host, path, rule
and verdict of the pages are replaced, others go along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.llm.common import might_hold, table, unused_prefix

DEFAULT = "allow"
MAX_BROADCAST = 50_000
SALT = 16

#: (verdict, host, path): fixed rules of the query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty without ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.regexp_replace(u, r"(?s)\A.*?://", "")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules as rows (prefix, rule_digest, rank, rule, verdict)."""
    named = rules.withColumn("rule", F.concat("host", "path"))
    rank = F.struct(F.length("rule").alias("n"), F.length("host").alias("h"),
                    (F.col("verdict") == "block").alias("b"), F.col("rule").alias("r"))
    return (with_digest(named, F.col("host"), F.col("path"))
            .select("prefix", F.col("digest").alias("rule_digest"), rank.alias("rank"), "rule", "verdict"))


def with_digest(df: DataFrame, host: Column, path: Column) -> DataFrame:
    """Add digest (of host, a space, path) and prefix (its first 32 bits)."""
    return (df.withColumn("digest", F.sha2(F.concat(host, F.lit(" "), path), 256))
            .withColumn("prefix", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")))


def expressions(urls: DataFrame, labels: int, lengths: list[int]) -> DataFrame:
    """(host, path) -> one row per expression a rule could match."""
    parts = F.split("host", r"\.", -1)
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(labels))),
                           lambda k: F.array_join(F.slice(F.col("__parts"), F.size("__parts") - k + 1, k), "."))
    prefixes = F.array_distinct(F.filter(
        F.array(*[F.when(F.length("path") >= k, F.substring("path", 1, k)) for k in lengths]),
        lambda p: p.isNotNull()))
    df = (urls.withColumn("__parts", parts).withColumn("__s", F.explode(suffixes))
          .withColumn("__p", F.explode(prefixes)))
    return with_digest(df, F.col("__s"), F.col("__p")).select("host", "path", "digest", "prefix")


def proposed(made: DataFrame, rules: DataFrame, few: bool) -> DataFrame:
    """Expressions with the rules of their prefix."""
    if few:
        return made.join(F.broadcast(rules), "prefix")  # at most MAX_BROADCAST rules
    salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return (made.filter(might_hold(rules, "prefix"))
            .withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALT)).cast("int"))
            .join(salted, ["prefix", "salt"]))


def url_verdicts(pages: DataFrame, rules=RULES, url: str = "url", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Add host, path, rule (null if none fits) and verdict to every page.

    ``rules``: (verdict, host, path) tuples, or a DataFrame of these columns.
    """
    spark = pages.sparkSession
    keep = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    host, path = split_url(F.col(url))
    named = pages.select(*keep, host.alias("host"), path.alias("path"))
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")
    rules = rules.select("verdict", "host", "path").dropna()
    shape = rules.agg(F.count("*").alias("n"), F.max(F.size(F.split("host", r"\.", -1))).alias("labels"),
                      F.sort_array(F.collect_set(F.length("path"))).alias("lengths")).first()
    if not shape["n"]:
        return named.select("*", F.lit(None).cast("string").alias("rule"), F.lit(DEFAULT).alias("verdict"))
    x = unused_prefix(named.columns)
    urls = named.select("host", "path").distinct()
    hit = (proposed(expressions(urls, shape["labels"], shape["lengths"]), rule_table(rules), shape["n"] <= max_broadcast)
           .filter(F.col("digest") == F.col("rule_digest"))
           .groupBy("host", "path")
           .agg(F.max(F.struct("rank", "rule", "verdict")).alias("best"))
           .select(F.col("host").alias(f"{x}h"), F.col("path").alias(f"{x}p"),
                   F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")))
    return (named.join(hit, (F.col("host") == F.col(f"{x}h")) & (F.col("path") == F.col(f"{x}p")), "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(DEFAULT))).drop(f"{x}h", f"{x}p"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


def oracle() -> str:
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return f"""
WITH r(verdict, rh, rp) AS (VALUES {values}),
u AS (
  SELECT page_id, url, CASE WHEN contains(coalesce(url, ''), '://')
         THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, url
  FROM u),
ranked AS (
  SELECT p.page_id, p.host, p.path, p.url, r.rh || r.rp AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id, p.url
                            ORDER BY length(r.rh || r.rp) DESC, length(r.rh) DESC, r.verdict DESC) AS k
  FROM p LEFT JOIN r ON (p.host = r.rh OR ends_with(p.host, '.' || r.rh)) AND starts_with(p.path, r.rp))
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict FROM ranked WHERE k = 1"""
