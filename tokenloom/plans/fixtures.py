"""Frames built from the driver tables.

Mapping (fixed, see FIXTURES.md):

* ``documents.source`` (``src0``..``src19``) is a token shard, document order
  inside a shard is ``doc_id``, tokens are the UTF-8 bytes of ``text``;
* 20 shards: ``num_train=18, val_percent=10, val_start=18`` -> train 0..17,
  validation 18..19;
* manifest: *expected* = bytes per shard; *existing* = expected without the
  shards with ``shard_id % 7 = 3``, and one byte short where ``shard_id % 5 = 4``;
* ``events`` is a training log: run = ``event_type``, step = ``event_id``,
  loss = ``value``; as candidates: group = ``user_id``, item = ``event_id``,
  score = ``value``;
* ``conversations``: a user turn is a prompt, the next assistant turn its
  continuation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.logs import CHECKPOINT_FILES
from ..sources.corpus import MEMBER_PREFIX, corpus_from_documents, shard_name, with_split, write_corpus
from ..sources.tables import read_table

# Fixed parameters of the registered queries.
NUM_TRAIN = 18
VAL_PERCENT = 10
VAL_START = 18
BLOCK_SIZE = 256
BATCH_SIZE = 32
SAMPLE_STEPS = 200
SEED = 1337
CHUNK_SIZE = 100_000
WORLD_SIZE = 8
VOCAB_BYTES = 105          # vocab of the pre-tokenized byte shards
EVAL_INTERVAL = 200
STOP_BYTE = 10             # newline ends a generated sequence
TEMPERATURE = 0.8
USABLE_BELOW = 1.0
BPE_MERGES = 1024         # merges of the registered tokenizer
MISSING_MOD, MISSING_REM = 7, 3
SHORT_MOD, SHORT_REM = 5, 4


def documents(spark: SparkSession, sf_dir: str, columns=("doc_id", "text", "source")) -> DataFrame:
    return read_table(spark, sf_dir, "documents", list(columns))


def corpus(spark: SparkSession, sf_dir: str, keep_unused: bool = False) -> DataFrame:
    """``(shard, shard_id, doc_id, data, split)`` for the fixed split."""
    c = corpus_from_documents(documents(spark, sf_dir))
    return with_split(c, NUM_TRAIN, VAL_PERCENT, VAL_START, keep_unused=keep_unused)


def expected_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """*expected* manifest ``(file, size)``: bytes per shard, named ``dataNN.bin``."""
    c = corpus_from_documents(documents(spark, sf_dir))
    return (c.groupBy("shard_id").agg(F.sum(F.octet_length("data")).cast("long").alias("size"))
             .select(shard_name("shard_id").alias("file"), "size"))


def existing_files(spark: SparkSession, sf_dir: str, expected: DataFrame | None = None) -> DataFrame:
    """*existing* directory listing ``(file, size)`` derived from *expected*."""
    e = expected_sizes(spark, sf_dir) if expected is None else expected
    sid = F.regexp_extract("file", r"(\d+)", 1).cast("int")
    return (e.filter(sid % MISSING_MOD != MISSING_REM)
             .select("file", F.when(sid % SHORT_MOD == SHORT_REM, F.col("size") - 1)
                     .otherwise(F.col("size")).alias("size")))


def listing_lines(spark: SparkSession, sf_dir: str, expected: DataFrame | None = None) -> DataFrame:
    """Archive listing text ``(line_no, line)`` in ``tar -tvf`` layout, made from
    *expected*, plus one directory entry and one non-shard member."""
    e = expected_sizes(spark, sf_dir) if expected is None else expected
    sid = F.regexp_extract("file", r"(\d+)", 1).cast("long")
    lines = e.select(
        (sid + 2).alias("line_no"),
        F.concat(F.lit("-rw-r--r-- user/group "), F.col("size").cast("string"),
                 F.lit(" 2024-01-01 00:00 " + MEMBER_PREFIX), F.col("file")).alias("line"))
    extra = e.groupBy().agg(F.sum("size").alias("t")).select(
        F.explode(F.array(
            F.struct(F.lit(0).cast("long").alias("line_no"),
                     F.lit("drwxr-xr-x user/group 0 2024-01-01 00:00 " + MEMBER_PREFIX).alias("line")),
            F.struct(F.lit(1).cast("long").alias("line_no"),
                     F.concat(F.lit("-rw-r--r-- user/group "), F.col("t").cast("string"),
                              F.lit(" 2024-01-01 00:00 " + MEMBER_PREFIX + "all.txt")).alias("line")))).alias("r")
    ).select("r.line_no", "r.line")
    return lines.unionByName(extra)


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run, step, loss, ts)`` from events."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    return ev.select(F.col("event_type").alias("run"), F.col("event_id").alias("step"),
                     F.col("value").alias("loss"), "ts")


def eval_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run, step, split, loss)``: evaluation rows; an event belongs to the
    evaluation at the start of its interval, every tenth user is validation."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "user_id", "value"])
    return ev.select(F.col("event_type").alias("run"),
                     (F.col("event_id") - F.col("event_id") % EVAL_INTERVAL).alias("step"),
                     F.when(F.col("user_id") % 10 == 0, "val").otherwise("train").alias("split"),
                     F.col("value").alias("loss"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(grp, item, score)`` from events."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "value"])
    return ev.select(F.col("user_id").alias("grp"), F.col("event_id").alias("item"),
                     F.col("value").alias("score"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, turn, text)``: every row of the conversations."""
    return read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, turn, prompt, text)``: text = prompt followed by the reply.

    A user turn and the assistant turn after it share the key ``(conv_id,
    user turn)``; one aggregation over that key (at most two rows per group)
    pairs them, with one scan and one shuffle instead of a self-join."""
    cv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    role = F.col("role")
    key = F.when(role == "assistant", F.col("turn") - 1).otherwise(F.col("turn"))
    g = (cv.filter(role.isin("user", "assistant"))
           .groupBy("conv_id", key.alias("turn"))
           .agg(F.max(F.when(role == "user", F.col("text"))).alias("prompt"),
                F.max(F.when(role == "assistant", F.col("text"))).alias("reply")))
    return g.filter(F.col("prompt").isNotNull() & F.col("reply").isNotNull()).select(
        "conv_id", "turn", "prompt", F.concat("prompt", "reply").alias("text"))


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run, file, priority, usable)``: per run, the three checkpoint files in
    fixed priority; a file is usable when some row of the run written to it
    (``user_id % 3`` = its priority) has a finite loss below ``USABLE_BELOW``."""
    ev = read_table(spark, sf_dir, "events", ["event_type", "user_id", "value"])
    names = F.array(*[F.lit(n) for n in CHECKPOINT_FILES])
    pr = (F.col("user_id") % 3).cast("int")
    return (ev.select(F.col("event_type").alias("run"), pr.alias("priority"),
                      (~F.isnan("value") & (F.col("value") < USABLE_BELOW)).alias("ok"))
              .groupBy("run", "priority").agg(F.bool_or("ok").alias("usable"))
              .select("run", F.get(names, F.col("priority")).alias("file"), "priority", "usable"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages", ["page_id", "url"])


def _scratch(spark: SparkSession, kind: str) -> str:
    import uuid
    from ..session import scratch_path
    return scratch_path(spark, f"{kind}-{uuid.uuid4().hex[:12]}")


def shard_text_files(spark: SparkSession, sf_dir: str, docs_per_file: int = 4096) -> str:
    """Write the corpus as raw text files, one folder per shard (``shard=srcN``),
    each file holding at most ``docs_per_file`` documents (one per line), and
    return the folder. Files are derived from ``documents`` by Spark."""
    out = _scratch(spark, "shardfiles")
    d = documents(spark, sf_dir).select(F.col("source").alias("shard"), "doc_id", "text")
    # sorted by (shard, doc_id) so the partitioned writer keeps document order
    (d.repartition("shard", F.floor(F.col("doc_id") / docs_per_file))
      .sortWithinPartitions("shard", "doc_id").select("shard", "text")
      .write.partitionBy("shard").text(out))
    return out


def corpus_files(spark: SparkSession, sf_dir: str, keep_unused: bool = False) -> str:
    """The split corpus written as Parquet partitioned by shard (stream input)."""
    out = _scratch(spark, "corpus")
    write_corpus(corpus(spark, sf_dir, keep_unused), out)
    return out


def log_files(spark: SparkSession, sf_dir: str) -> str:
    """The training log written as Parquet partitioned by run (stream input)."""
    out = _scratch(spark, "trainlog")
    train_log(spark, sf_dir).write.partitionBy("run").parquet(out)
    return out
