import os
import re

import pytest
from pyspark.sql import functions as F

from tokenloom.sources import files as FS
from tokenloom.streaming import ingest as X, ledger as L


def write_shards(folder, contents):
    os.makedirs(folder, exist_ok=True)
    for name, data in contents.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)


SHARDS = {"data00.bin": bytes([1, 2, 3]), "data01.bin": bytes(range(200)), "data45.bin": b"", "notes.txt": b"x"}


def test_read_shards_and_list_dir(spark, tmp_path):
    d = str(tmp_path / "tok")
    write_shards(d, SHARDS)
    # Spark's own file scan skips zero-length files (data45.bin): no tokens
    got = {r.shard: (r.shard_id, bytes(r.data)) for r in FS.read_shards(spark, d).collect()}
    assert got == {n: (int(n[4:6]), b) for n, b in SHARDS.items() if n.endswith(".bin") and b}
    ls = {r.file: r.size for r in FS.list_dir(spark, d).collect()}
    assert ls == {n: len(b) for n, b in SHARDS.items()}
    req = spark.createDataFrame([("data00.bin",), ("data02.bin",)], "file STRING")
    with pytest.raises(Exception):
        FS.read_shards(spark, d, required=req).collect()
    ok = spark.createDataFrame([("data00.bin",)], "file STRING")
    assert FS.read_shards(spark, d, required=ok).count() == 2


def test_shard_ranges_split_long_files_and_list_empty_ones(spark, tmp_path):
    d = str(tmp_path / "tok")
    big = bytes(i * 7 % 251 for i in range(10_001))
    write_shards(d, {**SHARDS, "data02.bin": big, "_tmp.bin": b"no", "data03.bin": b""})
    df = FS.read_shard_ranges(spark, d, range_bytes=1000, row_bytes=300)
    assert df.rdd.getNumPartitions() >= 10
    rows = df.collect()
    assert max(len(r.data) for r in rows) <= 300
    got = {}
    for r in sorted(rows, key=lambda r: (r.shard, r.start)):
        assert r.start == len(got.setdefault(r.shard, b"")) and r.shard_id == int(r.shard[4:6])
        got[r.shard] += bytes(r.data)
        assert r.size >= len(got[r.shard])
    want = {n: b for n, b in SHARDS.items() if n.startswith("data")}
    assert got == {**want, "data02.bin": big, "data03.bin": b""}
    # two-byte tokens are never cut
    even = FS.read_shard_ranges(spark, d, "data02.bin", width=2, range_bytes=1001, row_bytes=301).collect()
    assert all(r.start % 2 == 0 for r in even) and sum(len(r.data) for r in even) == len(big)
    req = spark.createDataFrame([("data03.bin",), ("data09.bin",)], "file STRING")
    with pytest.raises(Exception, match="missing shard file: data09.bin"):
        FS.read_shard_ranges(spark, d, required=req).collect()
    assert FS.read_shard_ranges(spark, d, required=req.limit(1)).count() == 5
    empty = tmp_path / "empty"
    empty.mkdir()
    assert FS.list_dir(spark, str(empty)).count() == 0 == FS.read_shard_ranges(spark, f"file://{empty}").count()
    with pytest.raises(Exception):
        FS.list_dir(spark, str(tmp_path / "nowhere")).collect()


def test_an_empty_shard_is_short_not_missing(spark, tmp_path):
    from tokenloom.operators import manifest as M
    d = str(tmp_path / "tok")
    write_shards(d, {"data00.bin": b"abc", "data01.bin": b""})
    expected = spark.createDataFrame([("data00.bin", 3), ("data01.bin", 5), ("data02.bin", 2)], "file STRING, size BIGINT")
    required = expected.selectExpr("file", "0 AS shard_id", "'train' AS split", "0 AS ordinal")
    v = M.verify_shards(required, FS.list_dir(spark, d).select("file", "size"), expected)
    got = {r.file: r.status for r in v.collect()}
    assert got == {"data00.bin": "verified", "data01.bin": "size_mismatch", "data02.bin": "missing"}


def test_read_texts_whole_files_with_exclude(spark, tmp_path):
    d = tmp_path / "txt"
    d.mkdir()
    (d / "a.txt").write_text("line one\nline two\n")
    (d / "merges.txt").write_text("should be excluded")
    (d / "b.md").write_text("not matched")
    got = {r.file: r.text for r in FS.read_texts(spark, str(d), exclude=("merges.txt",)).collect()}
    assert got == {"a.txt": "line one\nline two\n"}


def test_token_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("train", 0, 1, bytearray(b"ab")), ("val", 45, 2, bytearray(b"c"))],
                               "split STRING, shard_id INT, doc_id BIGINT, data BINARY")
    FS.write_tokens(df, str(tmp_path / "s"))
    back = FS.read_tokens(spark, str(tmp_path / "s"), "val").collect()
    assert [(r.doc_id, bytes(r.data)) for r in back] == [(2, b"c")]


def ingested(spark, sink):
    return sorted((r.shard, r.n_tok, bytes(r.data)) for r in L.read_sink(spark, sink).collect())


def test_ingest_each_shard_exactly_once(spark, tmp_path):
    src, sink, ck = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ck")
    write_shards(src, {"data00.bin": b"abc", "data01.bin": b"de"})
    X.ingest_shards(spark, src, sink, ck, max_files_per_trigger=1).awaitTermination()
    assert L.read_ledger(spark, sink).select("batch").distinct().count() == 2
    X.ingest_shards(spark, src, sink, ck).awaitTermination()
    write_shards(src, {"data02.bin": b"fghi"})
    X.ingest_shards(spark, src, sink, ck).awaitTermination()
    want = [("data00.bin", 3, b"abc"), ("data01.bin", 2, b"de"), ("data02.bin", 4, b"fghi")]
    assert ingested(spark, sink) == want
    # the checkpoint is lost: a new stream sees all files again and writes the new one only
    write_shards(src, {"data03.bin": b"j"})
    X.ingest_shards(spark, src, sink, str(tmp_path / "ck-new")).awaitTermination()
    assert ingested(spark, sink) == [*want, ("data03.bin", 1, b"j")]


@pytest.mark.parametrize("entry_written", [False, True])
def test_ingest_after_a_failed_batch_writes_nothing_twice(spark, tmp_path, monkeypatch, entry_written):
    src, sink, ck = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ck")
    write_shards(src, {"data00.bin": b"abc"})
    X.ingest_shards(spark, src, sink, ck).awaitTermination()
    write_shards(src, {"data01.bin": b"de", "data02.bin": b"fghi"})
    write = L.write_batch

    def failing(batch, batch_id, sink, rows):
        def half(batch, name):
            data, noted = rows(batch, name)
            # the rows are written, the entry fails in its job
            return data, noted.withColumn("boom", F.raise_error(F.lit("lost")))
        write(batch, batch_id, sink, rows if entry_written else half)
        raise RuntimeError("lost before the batch was noted as done")

    monkeypatch.setattr(L, "write_batch", failing)
    with pytest.raises(Exception, match="lost"):
        X.ingest_shards(spark, src, sink, ck).awaitTermination()
    # rows of an unfinished batch are not read, those of a finished one are
    assert len(ingested(spark, sink)) == (3 if entry_written else 1)
    monkeypatch.setattr(L, "write_batch", write)
    X.ingest_shards(spark, src, sink, ck).awaitTermination()
    assert ingested(spark, sink) == [("data00.bin", 3, b"abc"), ("data01.bin", 2, b"de"), ("data02.bin", 4, b"fghi")]


def test_best_flags_over_several_batches_equal_batch(spark, tmp_path):
    import random
    from tokenloom.operators.logs import running_best
    rnd = random.Random(3)
    rows = [(run, step, rnd.choice([float("nan"), 1.0, 5.0, rnd.uniform(0, 9), float("inf")]))
            for run in ("a", "b", None) for step in range(40)] + [("late", 35, 2.0)]
    schema = "run STRING, step BIGINT, loss DOUBLE"
    log, src, sink, ck = spark.createDataFrame(rows, schema), *(str(tmp_path / n) for n in ("src", "sink", "ck"))
    for part in range(4):
        log.filter(F.floor(F.col("step") / 10) == part).coalesce(1).write.mode("append").parquet(src)
        X.best_flags(spark.readStream.schema(schema).parquet(src), sink, ck).awaitTermination()

    def flags(df):
        return sorted(((r.run or "", r.step, r.is_best, r.best_so_far) for r in df.collect()))

    assert flags(L.read_sink(spark, sink)) == flags(running_best(log))
    assert L.read_sink(spark, sink).select("batch").distinct().count() == 4


def test_stream_totals_and_best_loss_equal_batch(spark, tmp_path):
    src = str(tmp_path / "src2")
    write_shards(src, {"data00.bin": b"abc", "data01.bin": b"de", "data45.bin": b"xyz!"})
    s = X.shard_stream(spark, src, max_files_per_trigger=1)
    X.run_complete(X.token_totals(s, 2, 1, 45), "tt_test", str(tmp_path / "ck2")).awaitTermination()
    got = {r.split: (r.n_tokens, r.n_docs) for r in spark.table("tt_test").collect()}
    assert got == {"train": (5, 2), "val": (4, 1)}

    logdir = str(tmp_path / "log")
    rows = [("a", 1, 3.0), ("a", 2, float("nan")), ("a", 3, 1.5), ("b", 1, 7.0)]
    spark.createDataFrame(rows, "run STRING, step BIGINT, loss DOUBLE").write.partitionBy("run").parquet(logdir)
    sch = spark.read.parquet(logdir).schema
    ls = spark.readStream.schema(sch).option("maxFilesPerTrigger", 1).parquet(logdir)
    X.run_complete(X.best_loss(ls), "bl_test", str(tmp_path / "ck3")).awaitTermination()
    got = {r.run: (r.best_loss, r.n_rows) for r in spark.table("bl_test").collect()}
    assert got == {"a": (1.5, 3), "b": (7.0, 1)}


def test_read_table_is_dealt_out_only_on_request(spark, tmp_path):
    from tokenloom.sources import tables
    d = str(tmp_path / "t")
    spark.range(1000).coalesce(1).write.parquet(f"{d}/x.parquet")
    asked = spark.conf.get(tables.SCAN_PARTITIONS, None)
    try:
        spark.conf.unset(tables.SCAN_PARTITIONS)
        assert "Exchange" not in tables.read_table(spark, d, "x")._jdf.queryExecution().executedPlan().toString()
        spark.conf.set(tables.SCAN_PARTITIONS, "5")
        dealt = tables.read_table(spark, d, "x")
        assert dealt.rdd.getNumPartitions() == 5 and dealt.count() == 1000
    finally:
        spark.conf.unset(tables.SCAN_PARTITIONS) if asked is None else spark.conf.set(tables.SCAN_PARTITIONS, asked)


def test_shard_without_a_number_is_an_error(spark):
    from tokenloom.sources.corpus import corpus_from_documents
    for source in ("nodigits", None):
        df = spark.createDataFrame([(1, "a", "src0"), (2, "b", source)], "doc_id BIGINT, text STRING, source STRING")
        with pytest.raises(Exception, match="shard without a number"):
            corpus_from_documents(df).collect()


def test_write_blocks_one_folder_per_rank(spark, tmp_path):
    blocks = spark.createDataFrame([("train", k, bytearray([k])) for k in range(10)],
                                   "split STRING, block BIGINT, x BINARY")
    out = str(tmp_path / "blocks")
    FS.write_blocks(blocks, out, 4)
    assert sorted(os.listdir(os.path.join(out, "split=train"))) == [f"rank={r}" for r in range(4)]
    r1 = spark.read.parquet(out).filter("rank = 1").collect()
    assert sorted(r.block for r in r1) == [1, 5, 9] and all(r.local == r.block // 4 for r in r1)


def test_required_shards_prune_folders(spark, tmp_path):
    from tests.helpers import tiny_corpus
    from tokenloom.sources.corpus import read_required, write_corpus
    path = str(tmp_path / "corpus")
    write_corpus(tiny_corpus(spark), path)
    required = spark.createDataFrame([(0, "train"), (3, "val"), (77, "val")], "shard_id INT, split STRING")
    df = read_required(spark.read.parquet(path), required)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*shard_id#\d+ IN ", plan)
    assert {(r.split, r.doc_id) for r in df.collect()} == {("train", 0), ("train", 1), ("train", 2), ("val", 7), ("val", 8)}
    # a folder whose files are not readable is not touched
    for f in os.listdir(os.path.join(path, "shard_id=1")):
        if f.endswith(".parquet"):
            with open(os.path.join(path, "shard_id=1", f), "wb") as out:
                out.write(b"broken")
    assert read_required(spark.read.schema(df.drop("split").schema.add("split", "string")).parquet(path), required).count() == 5
