"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each
result as Parquet in the shared checkpoint folder and reads it as the next
stage's documents. All stages but the last return the columns they were given.

Defined results: null, empty or blank texts fail the quality rules; repeated rows
are judged alike and near-dedup keeps one of them; rows without id are judged by
their text; ties and very long texts are nothing special; an empty table gives an
empty result; extra columns go along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.llm import minhash, mixing, packing, quality_classifier, quality_rules
from tokenloom.llm.common import drop_scratch, scratch_paths, table, unused_prefix, write_scratch


def _own(docs: DataFrame) -> DataFrame:
    """The documents and, under names that no operator uses, all their columns once more."""
    p = unused_prefix(docs.columns)
    return docs.select(*[F.col(c) for c in ("doc_id", "text", "lang", "source", "n_chars") if c in docs.columns],
                       *[F.col(c).alias(f"{p}own_{i}") for i, c in enumerate(docs.columns)])


def _kept(judged: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, in one pass and with nothing written.

    The verdict goes through an expression that the optimizer takes for
    non-deterministic (it always holds): a filter on it stays above the measures,
    instead of being pushed below them with a copy of each."""
    p = unused_prefix(docs.columns)
    own = [f"{p}own_{i}" for i in range(len(docs.columns))]
    verdict = (F.col("kept").cast("int") + F.floor(F.rand(0)) > 0).alias(f"{p}kept")  # rand is below 1
    return judged.select(*own, verdict).filter(f"{p}kept").select(*own).toDF(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return _kept(quality_classifier.score_quality(_own(docs), model), docs)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule."""
    return _kept(quality_rules.quality_rules(_own(docs)), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, longer ones with greater odds."""
    return mixing.repeat_copies(mixing.mix(docs, weight=mixing.length_odds(F.col("text"))), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("quality classifier", classify_quality),
    ("quality rules", apply_quality_rules),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: The first stage is learned and the last tokenises. tests/llm checks the first against known labels, the rules and
#: near-dedup against plain Python, the mixed words of each source against its target, and the packing by a round trip.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; a stage's scratch tables and input go as soon as its output is written."""
    docs, before = table(spark, sf_dir, "documents"), set(scratch_paths())
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_scratch(*(set(scratch_paths()) - before - {docs._scratch_path}))
    return docs
