"""The shard corpus: documents grouped into ordered shards.

The corpus table is ``(shard STRING, shard_id INT, doc_id BIGINT, data BINARY)``:
a shard plays the role of a token shard file, documents inside it are in
``doc_id`` order, and ``data`` is the document's token bytes (UTF-8 bytes of
its text for byte-level tokens).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.tokens import utf8_bytes

# ---- fixed values (the shard archive layout) ---------------------------------
# Archive members kept: paths under MEMBER_PREFIX ending in MEMBER_SUFFIX.
MEMBER_PREFIX = "tok105/"
MEMBER_SUFFIX = ".bin"
# Shard file name: "data" + id zero-padded to two digits + ".bin".
SHARD_NAME_FORMAT = "data%02d.bin"
# First validation shard id.
DEFAULT_VAL_START = 45
# Tokens per conversion chunk.
DEFAULT_CHUNK_SIZE = 10_000_000
# -------------------------------------------------------------------------------


def shard_id_of(source) -> "F.Column":
    """Numeric shard id: the digits that end the name's stem (``src12`` -> 12,
    ``data07.bin`` -> 7); NULL when there are none.

    Names sort as text (``src0, src1, src10``); the numeric id is the order key.
    """
    c = F.col(source) if isinstance(source, str) else source
    return F.regexp_extract(c, r"(\d+)(\.[^./]*)?$", 1).try_cast("int")


def shard_name(shard_id) -> "F.Column":
    """Zero-padded shard file name, ``data07.bin`` (3+ digit ids keep all digits)."""
    c = F.col(shard_id) if isinstance(shard_id, str) else shard_id
    return F.format_string(SHARD_NAME_FORMAT, c)


def corpus_from_documents(docs: DataFrame, text_col: str = "text",
                          source_col: str = "source") -> DataFrame:
    """documents(doc_id, text, source, ...) -> corpus(shard, shard_id, doc_id, data).

    A source without a number (or null) has no place in the stream: an error."""
    unnumbered = F.raise_error(F.concat(F.lit("shard without a number: "),
                                        F.coalesce(F.col(source_col), F.lit("null")))).cast("int")
    return docs.select(
        F.col(source_col).alias("shard"),
        F.coalesce(shard_id_of(source_col), unnumbered).alias("shard_id"),
        F.col("doc_id"),
        utf8_bytes(F.coalesce(F.col(text_col), F.lit(""))).alias("data"),
    )


def split_of(shard_id, num_train: int, num_val: int, val_start: int) -> "F.Column":
    """P2: 'train' for ids 0..num_train-1, 'val' for val_start..val_start+num_val-1."""
    c = F.col(shard_id) if isinstance(shard_id, str) else shard_id
    return (F.when((c >= 0) & (c < num_train), F.lit("train"))
            .when((c >= val_start) & (c < val_start + num_val), F.lit("val"))
            .otherwise(F.lit("unused")))


def num_val_files(num_train: int, val_percent: float) -> int:
    """``max(1, round(num_train * val_percent / 100))`` with half-to-even rounding."""
    return max(1, round(num_train * val_percent / 100))


def write_corpus(corpus: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The corpus in one folder per shard, so that shards are left out before they are read."""
    corpus.write.mode(mode).partitionBy("shard_id").parquet(path)


def read_required(corpus: DataFrame, required: DataFrame) -> DataFrame:
    """O2: the rows of a written corpus whose shard is in ``required``
    ``(shard_id, split)``, with that split. The list is bounded by the split
    parameters: its ids become a filter on the folders (other shards are not
    even opened), and it is broadcast for the split."""
    names = required.select("shard_id", "split")
    ids = [r["shard_id"] for r in names.select("shard_id").distinct().collect()]
    return corpus.drop("split").filter(F.col("shard_id").isin(ids)).join(F.broadcast(names), "shard_id")


def with_split(corpus: DataFrame, num_train: int, val_percent: float,
               val_start: int = DEFAULT_VAL_START, keep_unused: bool = False) -> DataFrame:
    """Label each document's split from its shard id (no join, prunable)."""
    num_val = num_val_files(num_train, val_percent)
    if num_train > val_start:
        raise ValueError("train and validation shard ids would overlap")
    out = corpus.withColumn("split", split_of("shard_id", num_train, num_val, val_start))
    if not keep_unused:
        out = out.filter(F.col("split") != "unused")
    return out
