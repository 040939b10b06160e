"""Registered queries: one per inventory key, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (through :mod:`.fixtures`) and runs over
whole tables and whole texts. Arrays are rendered as comma-separated ids so
that results compare across engines; every computed column is aliased to the
name its DuckDB oracle uses (:mod:`.oracle`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..functions import tokens as tk
from ..functions.numeric import round6
from ..functions.tokens import (bytes_to_ids, decode_utf8, ids_csv, ids_to_bytes, out_of_range,
                                token_sum, utf8_bytes)
from ..operators import bigram, block_sink, bpe, clean, logs, manifest as M, sampling, stream
from ..sources import files as FS
from ..sources import tokenizer_files as TF
from ..sources.corpus import (MEMBER_PREFIX, MEMBER_SUFFIX, corpus_from_documents, read_required, split_of,
                              with_split)
from ..session import ScratchTables
from ..streaming import ingest as X, ledger as L
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- token stream ---------------------------------------------------------

@query
def shard_token_counts(spark, sf_dir):
    return stream.shard_token_counts(fx.corpus(spark, sf_dir))


@query
def running_token_total(spark, sf_dir):
    return (stream.shard_token_counts(fx.corpus(spark, sf_dir))
            .select("split", "shard_id", "n_tokens", "running_tokens"))


@query
def shard_scan(spark, sf_dir):
    c = fx.corpus(spark, sf_dir, keep_unused=True)
    return (c.groupBy("shard", "shard_id")
            .agg(F.sum(F.octet_length("data")).cast("long").alias("n_tokens"),
                 F.sum(token_sum("data")).cast("long").alias("token_sum")))


@query
def byte_tokens(spark, sf_dir):
    c = fx.corpus(spark, sf_dir, keep_unused=True)
    ids = bytes_to_ids("data")
    return c.select("shard_id", "doc_id",
                    F.size(ids).cast("long").alias("n_tok"),
                    F.aggregate(ids, F.lit(0).cast("long"), lambda a, x: a + x).alias("tok_sum"),
                    F.md5(ids_csv(ids)).alias("ids_md5"))


@query
def global_positions(spark, sf_dir):
    return stream.positions(fx.corpus(spark, sf_dir), keep_data=False).select(
        "split", "shard_id", "doc_id", "n_tok", "pos")


@query
def stream_chunks(spark, sf_dir):
    pos = stream.positions(fx.corpus(spark, sf_dir), keep_data=False)
    return stream.stream_chunks(pos, fx.CHUNK_SIZE)


@query
def pack_sequences(spark, sf_dir):
    pos = stream.positions(fx.corpus(spark, sf_dir))
    blocks = stream.pack_sequences(pos, fx.BLOCK_SIZE)
    # token bytes rendered as hex (native, stays in codegen)
    return blocks.select("split", "block", F.hex("x").alias("x_hex"), F.hex("y").alias("y_hex"))


@query
def sample_windows(spark, sf_dir):
    w = stream.sample_windows(fx.corpus(spark, sf_dir), fx.BLOCK_SIZE, fx.BATCH_SIZE,
                              fx.SAMPLE_STEPS, seed=fx.SEED, split="train")
    return w.select("split", "step", "b", "start", F.hex("x").alias("x_hex"),
                    F.hex("y").alias("y_hex"))


@query
def sample_windows_stored(spark, sf_dir):
    """T6 from the stream stored by position."""
    out = fx._scratch(spark, "stream")
    block_sink.write_blocks_by_position(fx.corpus(spark, sf_dir), out, fx.BLOCK_SIZE)
    w = block_sink.sample_stored_windows(spark, out, fx.BATCH_SIZE, fx.SAMPLE_STEPS, seed=fx.SEED, split="train")
    return w.select("split", "step", "b", "start", F.hex("x").alias("x_hex"), F.hex("y").alias("y_hex"))


# --- manifest ---------------------------------------------------------------

def _required(spark, num_train=fx.NUM_TRAIN, val_percent=fx.VAL_PERCENT, val_start=fx.VAL_START):
    return M.required_shards(spark, num_train, val_percent, val_start)


def _expected(spark, sf_dir):
    return M.parse_listing(fx.listing_lines(spark, sf_dir))


def _verified(spark, sf_dir):
    """The verified manifest, with one scan of the documents: sizes per shard are written (one row per shard) before
    both listings are made of them, and so is the verdict (one row per required file), which some queries read twice."""
    tables = ScratchTables(spark, "manifest")
    sizes = tables.write(fx.expected_sizes(spark, sf_dir), "sizes")
    expected = M.parse_listing(fx.listing_lines(spark, sf_dir, sizes))
    return tables.write(M.verify_shards(_required(spark), fx.existing_files(spark, sf_dir, sizes), expected), "verified")


@query
def parse_listing(spark, sf_dir):
    return _expected(spark, sf_dir)


@query
def name_filter(spark, sf_dir):
    """Members under ``tok105/`` ending in ``.bin``, minus an exclude list."""
    parts = F.split(F.trim(F.col("line")), r"\s+")
    paths = fx.listing_lines(spark, sf_dir).select("line_no", F.element_at(parts, -1).alias("path"))
    keep = (F.col("path").startswith(MEMBER_PREFIX) & F.col("path").endswith(MEMBER_SUFFIX)
            & ~T.file_basename(F.col("path")).isin("data00.bin"))
    return paths.filter(keep)


@query
def required_shards(spark, sf_dir):
    return _required(spark).join(
        _expected(spark, sf_dir).withColumnRenamed("size", "expected_size"), "file", "left")


@query
def union_required(spark, sf_dir):
    """The required files (train ++ val), and which of them the given tables' archive and folder lack (missing ++ short)."""
    v = _verified(spark, sf_dir).select("file", "status")
    return _required(spark).join(v, "file", "left").select(
        "file", "shard_id", "split", "ordinal", F.when(F.col("status") != "verified", F.col("status")).alias("to_extract"))


@query
def split_train_val(spark, sf_dir):
    c = corpus_from_documents(fx.documents(spark, sf_dir))
    num_val = max(1, round(fx.NUM_TRAIN * fx.VAL_PERCENT / 100))
    return c.select("doc_id", "shard_id",
                    split_of("shard_id", fx.NUM_TRAIN, num_val, fx.VAL_START).alias("split"))


@query
def limit_shards(spark, sf_dir):
    c = with_split(corpus_from_documents(fx.documents(spark, sf_dir)), 4, 25, fx.VAL_START)
    return c.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"),
                                  F.sum(F.octet_length("data")).cast("long").alias("n_tokens"))


@query
def limit_shards_pruned(spark, sf_dir):
    """O2 on a corpus written by shard: folders of other shards are not read."""
    path = fx.corpus_files(spark, sf_dir, keep_unused=True)
    required = M.required_shards(spark, 4, 25, fx.VAL_START)
    c = read_required(spark.read.parquet(path), required)
    return c.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"),
                                  F.sum(F.octet_length("data")).cast("long").alias("n_tokens"))


@query
def ordered_shards(spark, sf_dir):
    per = fx.corpus(spark, sf_dir).groupBy("shard", "shard_id").agg(
        F.count(F.lit(1)).alias("n_docs"))
    from pyspark.sql import Window
    return per.withColumn("order_rank", F.row_number().over(Window.orderBy("shard_id")).cast("int"))


@query
def verify_shards(spark, sf_dir):
    return _verified(spark, sf_dir)


@query
def shards_to_extract(spark, sf_dir):
    v = _verified(spark, sf_dir)
    a = M.shards_to_extract(v, "A").select("file", "status", "extract_order")
    b = M.shards_to_extract(v, "B").select("file", F.col("extract_order").alias("extract_order_b"))
    return a.join(b, "file")


@query
def not_in_archive(spark, sf_dir):
    # the reference's default layout (10 train, validation from id 45) against this archive
    return M.not_in_archive(_required(spark, 10, 10, 45), _expected(spark, sf_dir))


@query
def pending_files(spark, sf_dir):
    return M.pending_files(_required(spark), fx.existing_files(spark, sf_dir))


@query
def expected_bytes(spark, sf_dir):
    return M.expected_bytes(_required(spark), _expected(spark, sf_dir))


@query
def all_verified(spark, sf_dir):
    return M.all_verified(_verified(spark, sf_dir))


@query
def verify_summary(spark, sf_dir):
    return M.verify_summary(_verified(spark, sf_dir))


@query
def archive_count_check(spark, sf_dir):
    return M.archive_count_check(fx.listing_lines(spark, sf_dir), "tok105.tar.gz")


@query
def extract_progress(spark, sf_dir):
    return M.extract_progress(M.shards_to_extract(_verified(spark, sf_dir), "A"))


# --- text clean-up -----------------------------------------------------------

def _gen(spark, sf_dir, out):
    g = fx.generated(spark, sf_dir)
    return g.select("conv_id", "turn", out(g).alias("out"))


#: Added to every turn, so that the escape rules have something to remove.
ESCAPES = " \\342\\201\\207,\\101\\102\\103 \\12!\u0007 end "


def _turns(spark, sf_dir, out):
    c = fx.turns(spark, sf_dir).select("conv_id", "turn", F.concat("text", F.lit(ESCAPES)).alias("text"))
    return c.select("conv_id", "turn", out(F.col("text")).alias("out"))


@query
def clean_generated(spark, sf_dir):
    return _gen(spark, sf_dir, lambda g: clean.clean_generated_col(g.text, g.prompt))


@query
def strip_literal(spark, sf_dir):
    return _turns(spark, sf_dir, T.strip_literal)


@query
def strip_escapes(spark, sf_dir):
    return _turns(spark, sf_dir, T.strip_escapes)


@query
def split_prefix(spark, sf_dir):
    g = fx.generated(spark, sf_dir)
    ctx, gen = T.split_prefix(g.text, g.prompt)
    return g.select("conv_id", "turn", ctx.alias("context"), gen.alias("generated"))


@query
def drop_whitespace(spark, sf_dir):
    return _turns(spark, sf_dir, T.drop_whitespace)


@query
def space_after_punct(spark, sf_dir):
    return _turns(spark, sf_dir, T.space_after_punct)


@query
def collapse_trim(spark, sf_dir):
    return _turns(spark, sf_dir, T.collapse_trim)


@query
def strip_control(spark, sf_dir):
    return _turns(spark, sf_dir, T.strip_control)


@query
def file_basename(spark, sf_dir):
    p = fx.pages(spark, sf_dir)
    return p.select("page_id", T.file_basename(p.url).alias("basename"))


@query
def zero_pad_name(spark, sf_dir):
    c = fx.corpus(spark, sf_dir, keep_unused=True)
    return c.select("shard_id").distinct().select(
        "shard_id", T.zero_pad_name(F.col("shard_id")).alias("file"),
        T.zero_pad_name(F.col("shard_id") * 1000).alias("wide_file"))


@query
def percent_done(spark, sf_dir):
    s = stream.shard_token_counts(fx.corpus(spark, sf_dir))
    return s.select("split", "shard_id",
                    T.percent_done(F.col("running_tokens"), F.col("split_tokens")).alias("percent"))


# --- training log ------------------------------------------------------------

@query
def periodic_rows(spark, sf_dir):
    return logs.periodic_rows(fx.train_log(spark, sf_dir), fx.EVAL_INTERVAL).select(
        "run", "step", "loss")


@query
def eval_loss(spark, sf_dir):
    return logs.eval_loss(fx.train_log(spark, sf_dir), fx.EVAL_INTERVAL).select(
        "run", "eval_step", round6("mean_loss").alias("mean_loss"), "n_batches")


@query
def eval_losses(spark, sf_dir):
    """A6 over evaluation rows by split, with the best validation loss so far."""
    return logs.eval_losses(fx.eval_log(spark, sf_dir)).select(
        "run", "step", round6("train_loss").alias("train_loss"), round6("val_loss").alias("val_loss"),
        "train_batches", "val_batches", "is_best")


@query
def best_summary(spark, sf_dir):
    return logs.best_summary(fx.train_log(spark, sf_dir))


@query
def running_best(spark, sf_dir):
    return logs.running_best(fx.train_log(spark, sf_dir)).select(
        "run", "step", "is_best", "best_so_far")


@query
def running_avg_loss(spark, sf_dir):
    return logs.running_avg_loss(fx.train_log(spark, sf_dir)).select(
        "run", "step", round6("running_avg").alias("running_avg"))


@query
def step_timing(spark, sf_dir):
    return logs.step_timing(fx.train_log(spark, sf_dir)).select(
        "run", "step", "elapsed_s", "dt_s", round6("pct_done").alias("pct_done"), "at")


@query
def checkpoint_pick(spark, sf_dir):
    return logs.checkpoint_pick(fx.checkpoints(spark, sf_dir))


@query
def softmax_sample(spark, sf_dir):
    s = sampling.softmax_sample(fx.candidates(spark, sf_dir), fx.TEMPERATURE, fx.SEED)
    return s.select("grp", "item", round6("prob").alias("prob"), "n_items")


# --- token stream, continued ---------------------------------------------------

def _blocks(spark, sf_dir):
    return stream.pack_sequences(stream.positions(fx.corpus(spark, sf_dir)), fx.BLOCK_SIZE)


@query
def append_tokens(spark, sf_dir):
    """T4: append one drawn id (md5 of seed:doc_id, mod 256) to each document's
    last ``block_size - 1`` tokens."""
    from ..functions.hashing import md5_int60
    d = _doc_ids(spark, sf_dir)
    tok = (md5_int60(F.lit(fx.SEED), F.col("doc_id")) % 256).cast("int")
    return d.select("doc_id", ids_csv(tk.append_token(tk.tail_context(F.col("ids"), fx.BLOCK_SIZE - 1),
                                                      tok)).alias("ids"))


@query
def rank_shards(spark, sf_dir):
    r = stream.assign_ranks(_blocks(spark, sf_dir), fx.WORLD_SIZE)
    return r.groupBy("split", "rank").agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum("block").cast("long").alias("block_sum"),
        F.sum(F.get(bytes_to_ids(F.substring("x", 1, 1)), 0)).cast("long").alias("x_first_sum"))


@query
def batch_rows(spark, sf_dir):
    r = stream.assign_ranks(_blocks(spark, sf_dir), 1, fx.BATCH_SIZE)
    return r.groupBy("split", "batch").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.min("block").alias("first_block"),
                                           F.max("block").alias("last_block"))


def _doc_ids(spark, sf_dir):
    return stream.doc_ids(fx.corpus(spark, sf_dir, keep_unused=True))


@query
def tail_context(spark, sf_dir):
    d = _doc_ids(spark, sf_dir)
    return d.select("doc_id", ids_csv(tk.tail_context(F.col("ids"), fx.BLOCK_SIZE)).alias("ids"))


@query
def truncate_at_stop(spark, sf_dir):
    d = _doc_ids(spark, sf_dir)
    return d.select("doc_id", ids_csv(tk.truncate_at_stop(F.col("ids"), fx.STOP_BYTE)).alias("ids"))


@query
def vocab_range_check(spark, sf_dir):
    d = _doc_ids(spark, sf_dir)
    return d.groupBy("shard_id").agg(
        F.sum(out_of_range(F.col("ids"), fx.VOCAB_BYTES)).cast("long").alias("n_out_of_range"))


@query
def explode_tokens(spark, sf_dir):
    return stream.explode_tokens(stream.positions(fx.corpus(spark, sf_dir)))


@query
def next_token_pairs(spark, sf_dir):
    return stream.next_token_pairs(stream.positions(fx.corpus(spark, sf_dir)))


@query
def corpus_loss(spark, sf_dir):
    l = bigram.corpus_loss(bigram.bigram_counts(fx.corpus(spark, sf_dir)), 256)
    return l.select("n_targets", round6("loss").alias("loss"))


# --- tokenizer ------------------------------------------------------------------

BPE_VOCAB = 256 + fx.BPE_MERGES + 1


def _train_text(spark, sf_dir):
    docs = fx.documents(spark, sf_dir, ("doc_id", "text", "source"))
    c = docs.withColumn("shard_id", F.regexp_extract("source", r"(\d+)$", 1).cast("int"))
    return c.filter(F.col("shard_id") < fx.NUM_TRAIN)


@query
def pretoken_counts(spark, sf_dir):
    return bpe.pretoken_counts(_train_text(spark, sf_dir))


@query
def bpe_pair_counts(spark, sf_dir):
    return bpe.pair_counts(bpe.words_table(bpe.pretoken_counts(_train_text(spark, sf_dir))))


_SAVED: dict = {}


def _train(spark, sf_dir):
    return bpe.train_bpe(spark, bpe.pretoken_counts(_train_text(spark, sf_dir)), BPE_VOCAB)


def _model(spark, sf_dir):
    """The tokenizer of this corpus, saved once (S6) per state of the documents' files and loaded from there."""
    files = (spark.read.format("binaryFile").load(f"{sf_dir}/documents.parquet")
             .agg(F.xxhash64(F.sort_array(F.collect_list(F.struct("path", "length", "modificationTime")))).alias("h")))
    key = (spark.sparkContext.applicationId, sf_dir, BPE_VOCAB, files.first()["h"])
    if key not in _SAVED:
        out = fx._scratch(spark, "tokenizer")
        FS.save_tokenizer(_train(spark, sf_dir), out)
        _SAVED[key] = out
    return FS.load_tokenizer(spark, _SAVED[key])


def _specials(model):
    return {bytes(r["token"]).decode(): r["id"] for r in model.vocab.filter("special").collect()}


@query
def bpe_train(spark, sf_dir):
    return _train(spark, sf_dir).merges


@query
def top_pair(spark, sf_dir):
    return bpe.top_pair(bpe_pair_counts(spark, sf_dir))


@query
def special_tokens(spark, sf_dir):
    v = _model(spark, sf_dir).vocab
    return v.filter((F.col("id") < 256) | F.col("special")).select(
        "id", F.hex("token").alias("token_hex"), "special")


@query
def bpe_encode(spark, sf_dir):
    model = _model(spark, sf_dir)
    docs = fx.documents(spark, sf_dir, ("doc_id", "text"))
    e = bpe.encode_documents(docs, bpe.merges_list(model), as_arrays=False, specials=_specials(model))
    # data: uint16 little-endian ids; digest of the stream bytes
    return e.select("doc_id", (F.octet_length("data") / 2).cast("long").alias("n_ids"),
                    F.md5("data").alias("ids_md5"))


@query
def encode_corpus(spark, sf_dir):
    model = _model(spark, sf_dir)
    c = fx.corpus(spark, sf_dir)
    stream2 = c.select("split", "shard_id", F.col("shard_id").cast("string").alias("shard"), "doc_id",
                       bpe.encode_stream(decode_utf8(F.col("data")), bpe.merges_list(model),
                                         _specials(model)).alias("data"))
    stream2 = ScratchTables(spark, "encoded").write(stream2, "stream")  # read twice, encoded once
    digest = stream2.groupBy("split", "shard_id").agg(F.bit_xor(F.xxhash64("doc_id", "data")).alias("ids_hash"))
    return stream.shard_token_counts(stream2, width=2).join(digest, ["split", "shard_id"])


@query
def corpus_loss_bpe(spark, sf_dir):
    """A9 over the trained tokenizer's ids."""
    model = _model(spark, sf_dir)
    c = fx.corpus(spark, sf_dir).select(
        "split", bpe.encode_stream(decode_utf8(F.col("data")), bpe.merges_list(model), _specials(model)).alias("data"))
    l = bigram.corpus_loss(bigram.bigram_counts(c, width=2), BPE_VOCAB)
    return l.select("n_targets", round6("loss").alias("loss"))


@query
def token_to_id(spark, sf_dir):
    model = _model(spark, sf_dir)
    words = bpe.pretoken_counts(_train_text(spark, sf_dir)).select(
        "word", utf8_bytes(F.col("word")).alias("token"))
    return bpe.token_to_id(words, model.vocab).select("word", "id")


@query
def decode_tokens(spark, sf_dir):
    """Every document, with the separator after it, encoded and decoded without it."""
    model = _model(spark, sf_dir)
    docs = fx.documents(spark, sf_dir, ("doc_id", "text")).select(
        "doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(bpe.END_OF_TEXT)).alias("text"))
    e = bpe.encode_documents(docs, bpe.merges_list(model), specials=_specials(model))
    d = bpe.decode_ids(e, model.vocab)
    return d.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"),
                    F.length("text").cast("long").alias("n_chars"))


# --- file sources and sinks -----------------------------------------------------

def _shard_of_path(path_col):
    return F.regexp_extract(path_col, r"shard=([^/]+)", 1)


@query
def shard_files_scan(spark, sf_dir):
    """S1 through real files: every file under ``shard=srcN/`` read as binary, in byte ranges."""
    root = fx.shard_text_files(spark, sf_dir)
    df = (FS.read_shard_ranges(spark, root, "*.txt", recursive=True)
          .select(_shard_of_path(F.col("path")).alias("shard"), "data"))
    return df.groupBy("shard").agg(F.sum(F.octet_length("data")).cast("long").alias("n_tokens"),
                                   F.sum(token_sum("data")).cast("long").alias("token_sum"))


@query
def text_scan(spark, sf_dir):
    """Whole-file text records."""
    root = fx.shard_text_files(spark, sf_dir)
    df = (FS.read_texts(spark, root, recursive=True)
          .select(_shard_of_path(F.col("path")).alias("shard"), "text"))
    return df.groupBy("shard").agg(F.sum(F.length("text")).cast("long").alias("n_chars"))


@query
def list_dir(spark, sf_dir):
    """Listing with sizes, no file opened."""
    root = fx.shard_text_files(spark, sf_dir)
    df = (FS.list_dir(spark, root, "*.txt", recursive=True)
          .select(_shard_of_path(F.col("path")).alias("shard"), F.col("size").alias("length")))
    return df.groupBy("shard").agg(F.sum("length").cast("long").alias("size"))


@query
def token_sink(spark, sf_dir):
    """Persist each split once, read back with partition pruning."""
    out = fx._scratch(spark, "tokens")
    FS.write_tokens(fx.corpus(spark, sf_dir).select("split", "shard_id", "doc_id", "data"), out)
    back = FS.read_tokens(spark, out)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"),
                                     F.sum(F.octet_length("data")).cast("long").alias("n_tokens"))


@query
def tokenizer_tables(spark, sf_dir):
    """Save and load vocabulary and merges."""
    out = fx._scratch(spark, "tokenizer")
    FS.save_tokenizer(_model(spark, sf_dir), out)
    m = FS.load_tokenizer(spark, out)
    return m.vocab.join(m.merges.select("id", "rank", "l", "r"), "id", "left").select(
        "id", F.hex("token").alias("token_hex"), "special", "rank", "l", "r")


@query
def tokenizer_files(spark, sf_dir):
    """The tokenizer through ``vocab.json`` and ``merges.txt``."""
    out = fx._scratch(spark, "tokenizer-files")
    TF.save_tokenizer_files(spark, _model(spark, sf_dir), out)
    m = TF.load_tokenizer_files(spark, out)
    return m.vocab.join(m.merges.select("id", "rank", "l", "r"), "id", "left").select(
        "id", F.hex("token").alias("token_hex"), "special", "rank", "l", "r")


# --- streaming --------------------------------------------------------------------

def _stream_name(kind):
    import uuid
    return f"{kind}_{uuid.uuid4().hex[:10]}"


@query
def stream_ingest_shards(spark, sf_dir):
    """Documents of each new file of a written corpus once, by the ledger; the second run finds nothing new."""
    src = fx.corpus_files(spark, sf_dir)
    sink, ck = fx._scratch(spark, "ingested"), fx._scratch(spark, "ingest-ck")
    schema = spark.read.parquet(src).schema
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(src)
         .select("*", F.octet_length("data").cast("long").alias("n_tok"), F.col("_metadata.file_path").alias("path")))
    for _ in range(2):
        X.ingest_files(s, sink, ck).awaitTermination()
    return (L.read_sink(spark, sink).groupBy("shard_id")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tok").cast("long").alias("n_tokens")))


@query
def stream_ingest_files(spark, sf_dir):
    """X1 through real files: each shard file decoded once, in several batches; then, as if the checkpoint were
    lost, a new stream over the same files, which writes nothing."""
    src = fx.shard_text_files(spark, sf_dir)
    sink = fx._scratch(spark, "ingested")
    for _ in range(2):
        X.ingest_shards(spark, src, sink, fx._scratch(spark, "ingest-ck"), "*.txt", recursive=True,
                        max_files_per_trigger=64).awaitTermination()
    return (L.read_sink(spark, sink).groupBy(_shard_of_path(F.col("path")).alias("shard"))
            .agg(F.sum("n_tok").cast("long").alias("n_tokens"),
                 F.sum(token_sum("data")).cast("long").alias("token_sum")))


@query
def stream_token_totals(spark, sf_dir):
    """Token totals per split as shard files arrive (complete mode)."""
    src = fx.corpus_files(spark, sf_dir)
    schema = spark.read.parquet(src).schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(src)
    num_val = max(1, round(fx.NUM_TRAIN * fx.VAL_PERCENT / 100))
    agg = X.token_totals(s.drop("split"), fx.NUM_TRAIN, num_val, fx.VAL_START)
    name = _stream_name("token_totals")
    X.run_complete(agg, name, fx._scratch(spark, "totals-ck")).awaitTermination()
    return spark.table(name)


@query
def stream_best_loss(spark, sf_dir):
    """Best loss per run as log files arrive (complete mode)."""
    src = fx.log_files(spark, sf_dir)
    schema = spark.read.parquet(src).schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(src)
    name = _stream_name("best_loss")
    X.run_complete(X.best_loss(s), name, fx._scratch(spark, "best-ck")).awaitTermination()
    return spark.table(name)


@query
def stream_best_flags(spark, sf_dir):
    """X3 per row: the log arrives in four parts, steps in order; every row's flag as in W3."""
    src, sink, ck = fx._scratch(spark, "trainlog"), fx._scratch(spark, "flags"), fx._scratch(spark, "flags-ck")
    log = fx.train_log(spark, sf_dir).select("run", "step", "loss")
    last = log.agg(F.max("step")).first()[0]
    part = F.floor(F.col("step") * 4 / ((last or 0) + 1))
    for i in range(4):
        log.filter(part == i).write.mode("append").parquet(src)
        X.best_flags(spark.readStream.schema(log.schema).parquet(src), sink, ck).awaitTermination()
    return L.read_sink(spark, sink).select("run", "step", "is_best", "best_so_far")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
