import glob
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import stream
from tokenloom.operators.prefix import prefix_aggregates
from tokenloom.functions.tokens import bytes_to_ids
from tokenloom.sources.corpus import corpus_from_documents, with_split

from helpers import brute_streams, tiny_corpus


def test_positions_match_cumsum(spark):
    pos = stream.positions(tiny_corpus(spark), keep_data=False)
    got = {(r.split, r.shard_id, r.doc_id): (r.pos, r.n_tok) for r in pos.collect()}
    for split in ("train", "val"):
        keys = sorted(k for k in got if k[0] == split)
        acc = 0
        for k in keys:
            assert got[k][0] == acc
            acc += got[k][1]


@pytest.mark.parametrize("fanout", [2, 3, 4096])
def test_prefix_aggregates_all_levels(spark, fanout):
    rnd = random.Random(7)
    rows = [(g, k, rnd.choice([None, float(rnd.randint(-50, 50))]) if k % 5 else float("nan"))
            for g in ("a", "b") for k in rnd.sample(range(0, 200), 60)]
    df = spark.createDataFrame(rows, "g STRING, k BIGINT, v DOUBLE")
    finite = F.when(F.isnan("v"), None).otherwise(F.col("v"))
    out = prefix_aggregates(df, [("s", "sum", F.coalesce(finite, F.lit(0.0))),
                                 ("mn", "min", finite), ("mx", "max", finite),
                                 ("lst", "last", F.col("k"))],
                            group=["g"], major=[], key="k", fanout=fanout).collect()
    got = {(r.g, r.k): r for r in out}
    for g in ("a", "b"):
        ks = sorted(k for (gg, k) in got if gg == g)
        vals = {k: v for (gg, k, v) in rows if gg == g}
        for i, k in enumerate(ks):
            prev = [vals[j] for j in ks[:i]]
            fin = [x for x in prev if x is not None and x == x]
            r = got[(g, k)]
            assert r.s == pytest.approx(sum(fin))
            assert r.mn == (min(fin) if fin else None)
            assert r.mx == (max(fin) if fin else None)
            assert r.lst == (ks[i - 1] if i else None)


@pytest.mark.parametrize("B,shift", [(4, 1), (7, 1), (16, 1), (5, 0)])
def test_pack_sequences_equal_brute_force(spark, B, shift):
    pos = stream.positions(tiny_corpus(spark))
    got = {(r.split, r.block): (bytes(r.x), bytes(r.y))
           for r in stream.pack_sequences(pos, B, shift=shift).collect()}
    want = {}
    for split, s in brute_streams().items():
        k = 0
        while (k + 1) * B + shift <= len(s):
            w = bytes(s[k * B:k * B + B + shift])
            want[(split, k)] = (w[:B], w[shift:shift + B])
            k += 1
    assert got == want


def test_pack_as_arrays_and_concatenation(spark):
    pos = stream.positions(tiny_corpus(spark))
    rows = stream.pack_sequences(pos, 8, as_arrays=True).filter("split = 'train'").orderBy("block").collect()
    flat = [t for r in rows for t in r.x]
    assert flat == brute_streams()["train"][:len(flat)]


def test_pack_invariant_to_partitioning(spark):
    base = sorted(stream.pack_sequences(stream.positions(tiny_corpus(spark)), 6).collect())
    for n in ("1", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            c = tiny_corpus(spark).repartition(int(n) if n != "200" else 3)
            assert sorted(stream.pack_sequences(stream.positions(c), 6).collect()) == base
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_sample_windows_equal_stream_slices(spark):
    B, bs, steps, seed = 8, 4, 3, 5
    out = stream.sample_windows(tiny_corpus(spark), B, bs, steps, seed=seed).collect()
    s = brute_streams()["train"]
    assert len(out) == bs * steps
    for r in out:
        h = int(hashlib.md5(f"{seed}:train:{r.step}:{r.b}".encode()).hexdigest()[:15], 16)
        assert r.start == h % (len(s) - B)
        assert bytes(r.x) == bytes(s[r.start:r.start + B])
        assert bytes(r.y) == bytes(s[r.start + 1:r.start + B + 1])


def test_sample_windows_empty_space_raises(spark):
    with pytest.raises(Exception):
        stream.sample_windows(tiny_corpus(spark), 10_000, 2, 1).collect()


def test_stream_chunks(spark):
    pos = stream.positions(tiny_corpus(spark), keep_data=False)
    got = {(r.split, r.chunk): (r.n_tokens, r.cum_tokens) for r in stream.stream_chunks(pos, 9).collect()}
    want = {}
    for split, s in brute_streams().items():
        for c in range((len(s) + 8) // 9):
            n = min(9, len(s) - 9 * c)
            want[(split, c)] = (n, 9 * c + n)
    assert got == want


def test_next_token_pairs(spark):
    pos = stream.positions(tiny_corpus(spark))
    got = {(r.split, r.tok, r.next_tok): r.n for r in stream.next_token_pairs(pos).collect()}
    want = {}
    for split, s in brute_streams().items():
        for (a, b), n in Counter(zip(s, s[1:])).items():
            want[(split, a, b)] = n
    assert got == want


def test_explode_tokens(spark):
    pos = stream.positions(tiny_corpus(spark))
    rows = stream.explode_tokens(pos).collect()
    for split, s in brute_streams().items():
        got = sorted((r.pos, r.tok) for r in rows if r.split == split)
        assert got == list(enumerate(s))


def test_shard_token_counts(spark):
    rows = stream.shard_token_counts(tiny_corpus(spark)).orderBy("split", "shard_id").collect()
    train = [r for r in rows if r.split == "train"]
    assert [r.n_tokens for r in train] == [6, 103 + len("emoji \U0001F600 and nbsp\u00a0here".encode()),
                                           len(("h\u00e9llo w\u00f6rld " * 5).encode())]
    assert train[-1].running_tokens == sum(r.n_tokens for r in train) == train[0].split_tokens


def test_assign_ranks_and_batches(spark):
    blocks = spark.range(0, 20).withColumnRenamed("id", "block")
    r = stream.assign_ranks(blocks, 4, batch_size=2).collect()
    for x in r:
        assert x.rank == x.block % 4 and x.local == x.block // 4
        assert x.batch == x.local // 2 and x.row == x.local % 2


@pytest.mark.parametrize("fanout", [2, 5])
def test_exclusive_prefix_with_major_level(spark, fanout):
    from tokenloom.operators.prefix import exclusive_prefix
    rnd = random.Random(fanout)
    rows = [("s", sh, d, rnd.randint(0, 9)) for sh in (3, 1, 2) for d in rnd.sample(range(100), 25)]
    df = spark.createDataFrame(rows, "g STRING, sh INT, d BIGINT, v BIGINT")
    got = {(r.sh, r.d): r.off for r in
           exclusive_prefix(df, "v", group=["g"], major=["sh"], key="d", out="off", fanout=fanout).collect()}
    acc = 0
    for _, sh, d, v in sorted(rows, key=lambda r: (r[1], r[2])):
        assert got[(sh, d)] == acc
        acc += v


def test_pack_u16_stream(spark):
    ids = {0: [1, 300, 65535, 7], 1: [], 2: [9, 8, 7, 6, 5, 4, 3]}
    data = [("train", 0, k, bytearray(b"".join(i.to_bytes(2, "little") for i in v))) for k, v in ids.items()]
    c = spark.createDataFrame(data, "split STRING, shard_id INT, doc_id BIGINT, data BINARY")
    pos = stream.positions(c, width=2)
    got = {r.block: (r.x, r.y) for r in stream.pack_sequences(pos, 3, width=2, as_arrays=True).collect()}
    s = [t for k in sorted(ids) for t in ids[k]]
    want = {k: (s[3 * k:3 * k + 3], s[3 * k + 1:3 * k + 4]) for k in range((len(s) - 1) // 3)}
    assert got == want


def test_pack_random_corpora_equal_brute_force(spark):
    rnd = random.Random(2024)
    for trial in range(6):
        rows, doc_id = [], 0
        for shard in rnd.sample(range(0, 6), rnd.randint(1, 4)):
            for _ in range(rnd.randint(1, 6)):
                n = rnd.choice([0, 1, 2, rnd.randint(3, 40), rnd.randint(40, 120)])
                rows.append(("train", shard, doc_id, bytearray(rnd.randrange(256) for _ in range(n))))
                doc_id += rnd.randint(1, 3)
        c = spark.createDataFrame(rows, "split STRING, shard_id INT, doc_id BIGINT, data BINARY")
        s = b"".join(bytes(d) for _, _, _, d in sorted(rows, key=lambda r: (r[1], r[2])))
        B, shift = rnd.randint(1, 17), rnd.choice([0, 1])
        got = {r.block: (bytes(r.x), bytes(r.y))
               for r in stream.pack_sequences(stream.positions(c), B, shift=shift).collect()}
        want = {k: (s[k * B:k * B + B], s[k * B + shift:k * B + shift + B])
                for k in range((len(s) - shift) // B) if k * B + B + shift <= len(s)}
        assert got == want, (trial, B, shift)


def test_sample_windows_random_corpora(spark):
    rnd = random.Random(77)
    for trial in range(4):
        rows = [("train", rnd.randint(0, 3), d, bytearray(rnd.randrange(256) for _ in range(rnd.randint(0, 50))))
                for d in range(rnd.randint(3, 15))]
        s = b"".join(bytes(r[3]) for r in sorted(rows, key=lambda r: (r[1], r[2])))
        B = rnd.randint(1, 12)
        if len(s) <= B:
            continue
        c = spark.createDataFrame(rows, "split STRING, shard_id INT, doc_id BIGINT, data BINARY")
        seed = rnd.randint(0, 999)
        for r in stream.sample_windows(c, B, 3, 2, seed=seed, bucket=B + 1 + rnd.randint(0, 20)).collect():
            h = int(hashlib.md5(f"{seed}:train:{r.step}:{r.b}".encode()).hexdigest()[:15], 16)
            assert r.start == h % (len(s) - B)
            assert bytes(r.x) == s[r.start:r.start + B] and bytes(r.y) == s[r.start + 1:r.start + B + 1]


def test_corpus_loss_equals_brute_force(spark):
    import math
    from tokenloom.operators import bigram
    rnd = random.Random(5)
    rows = [(rnd.choice(["train", "train", "val"]), 0, d,
             bytearray(rnd.choice(b"abcde") for _ in range(rnd.randint(0, 30)))) for d in range(40)]
    c = spark.createDataFrame(rows, "split STRING, shard_id INT, doc_id BIGINT, data BINARY")
    got = bigram.corpus_loss(bigram.bigram_counts(c), 256).first()
    tr, ev = Counter(), Counter()
    for split, _, _, d in rows:
        (tr if split == "train" else ev).update(zip(d, d[1:]))
    row = Counter()
    for (a, _), n in tr.items():
        row[a] += n
    m = sum(ev.values())
    nll = sum(n * -math.log((tr[(a, b)] + 1) / (row[a] + 256)) for (a, b), n in ev.items())
    assert got.n_targets == m and got.loss == pytest.approx(nll / m)


def test_next_token_pairs_random_with_empty_documents(spark):
    rnd = random.Random(21)
    rows = [(rnd.choice(["train", "val"]), rnd.randint(0, 3), d,
             bytearray(rnd.randrange(6) for _ in range(rnd.choice([0, 0, 1, rnd.randint(2, 9)]))))
            for d in range(60)]
    c = spark.createDataFrame(rows, "split STRING, shard_id INT, doc_id BIGINT, data BINARY")
    got = {(r.split, r.tok, r.next_tok): r.n
           for r in stream.next_token_pairs(stream.positions(c)).collect()}
    want = Counter()
    for split in ("train", "val"):
        s = b"".join(bytes(r[3]) for r in sorted((r for r in rows if r[0] == split),
                                                 key=lambda r: (r[1], r[2])))
        for a, b in zip(s, s[1:]):
            want[(split, a, b)] += 1
    assert got == dict(want)


def test_stream_chunks_random(spark):
    rnd = random.Random(12)
    rows = [("train", rnd.randint(0, 4), d, bytearray(rnd.randint(0, 40))) for d in range(50)]
    c = spark.createDataFrame(rows, "split STRING, shard_id INT, doc_id BIGINT, data BINARY")
    pos = stream.positions(c, keep_data=False)
    total = sum(len(r[3]) for r in rows)
    for size in (1, 7, 64, total, total + 5):
        got = {r.chunk: (r.n_tokens, r.cum_tokens) for r in stream.stream_chunks(pos, size).collect()}
        want = {k: (min(size, total - k * size), min((k + 1) * size, total))
                for k in range((total + size - 1) // size)}
        assert got == want, size


def test_positions_by_rank_with_sparse_null_and_repeated_ids(spark):
    """Random 63-bit ids, null ids and repeated rows: each row once, offsets as in a sorted list."""
    import random
    rnd = random.Random(31)
    rows = [(rnd.randrange(-2 ** 62, 2 ** 62), "t" * rnd.randrange(0, 9), f"src{rnd.randrange(3)}") for _ in range(2000)]
    rows += [(None, "no id " * i, "src1") for i in range(6)] + [(None, "same", "src0")] * 5
    rows += [(7, "seven", "src2")] * 4 + [(7, "other seven", "src2")]
    c = with_split(corpus_from_documents(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")), 3, 34, 3)
    for keep in (False, True):
        got = stream.positions(c, keep_data=keep).collect()
        assert len(got) == len(rows)
        at = 0
        order = sorted(got, key=lambda r: (r.pos, r.n_tok))
        for r in order:
            assert r.pos == at
            at += r.n_tok
        full = [r for r in order if r.n_tok]
        keys = [(r.shard_id, r.doc_id is not None, r.doc_id or 0) for r in full]
        assert keys == sorted(keys)
    assert sorted(((r.doc_id is None, r.doc_id or 0, bytes(r.data).decode()) for r in got)) == sorted(
        (d is None, d or 0, t) for d, t, _ in rows)


def test_rank_ranges_are_even(spark):
    import random
    from tokenloom.operators.prefix import ranked_prefix
    rnd = random.Random(1)
    rows = [("a", rnd.getrandbits(62), 1) for _ in range(20_000)] + [("a", None, 1)] * 10_000  # a third without id
    out = ranked_prefix(spark.createDataFrame(rows, "g STRING, k BIGINT, v BIGINT"), "v", ["g"], ["k"], "at")
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sorted(r["at"] for r in out.collect()) == list(range(30_000))
    assert out.filter("k IS NULL AND at >= 10000").isEmpty()
    files = out.inputFiles()
    per_range = [spark.read.parquet(f).count() for f in files]
    assert max(per_range) <= 2 * sum(per_range) / len(per_range), (per_range, sizes)


def test_packing_moves_only_edges(spark):
    """Whole inner blocks are cut where documents are read: the exchange carries edges only."""
    import random
    rnd = random.Random(4)
    rows = [(i, "".join(rnd.choice("abc de") for _ in range(rnd.choice([0, 1, 5, 900, 3000]))), f"src{i % 3}") for i in range(60)]
    c = with_split(corpus_from_documents(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")), 3, 34, 3)
    data = "".join(t for _, t, _ in sorted(rows, key=lambda r: (int(r[2][3:]), r[0]))).encode()
    for block, shift in ((16, 1), (64, 0), (256, 1), (5000, 1)):
        got = {r.block: (bytes(r.x), bytes(r.y)) for r in stream.pack_sequences(stream.positions(c), block, shift=shift).collect()}
        want = {k: (data[k * block:(k + 1) * block], data[k * block + shift:(k + 1) * block + shift])
                for k in range(len(data) // block + 1) if len(data[k * block:(k + 1) * block + shift]) == block + shift}
        assert got == want


@pytest.mark.parametrize("width", [1, 2])
def test_stored_windows_equal_sampled_ones_and_open_few_files(spark, tmp_path, width):
    from tokenloom.operators import block_sink
    c = tiny_corpus(spark).withColumn("data", F.concat("data", "data"))   # even lengths
    path = str(tmp_path / "stream")
    block_sink.write_blocks_by_position(c, path, 6, width=width, blocks_per_part=2)

    def rows(df):
        return sorted((r.step, r.b, r.start, bytes(r.x), bytes(r.y)) for r in df.collect())

    for split in ("train", "val"):
        got = rows(block_sink.sample_stored_windows(spark, path, 4, 30, seed=5, split=split))
        assert got == rows(stream.sample_windows(c, 6, 4, 30, seed=5, split=split, width=width)) and len(got) == 120
    # files of folders that no window touches are not opened
    few = rows(block_sink.sample_stored_windows(spark, path, 2, 1, split="train"))
    touched = {k // 2 for _, _, start, _, _ in few for k in (start // 6, start // 6 + 1)}
    others = [f for f in glob.glob(f"{path}/blocks/split=train/part=*/*.parquet") if int(f.split("part=")[1].split("/")[0]) not in touched]
    assert len(others) > 10 and len(touched) <= 4
    for f in others:
        with open(f, "wb") as out:
            out.write(b"broken")
    assert rows(block_sink.sample_stored_windows(spark, path, 2, 1, split="train")) == few
    arrays = block_sink.sample_stored_windows(spark, path, 1, 1, split="val", as_arrays=True).first()
    assert len(arrays.x) == 6 and arrays.y[:-1] == arrays.x[1:]
    with pytest.raises(ValueError, match="no stream"):
        block_sink.sample_stored_windows(spark, path, 1, 1, split="other")


def test_stored_windows_of_a_short_stream_are_an_error(spark, tmp_path):
    from tokenloom.operators import block_sink
    path = str(tmp_path / "stream")
    block_sink.write_blocks_by_position(tiny_corpus(spark, [(1, "abcd", "src0"), (2, "efghi", "src3")]), path, 4)
    with pytest.raises(Exception, match="sample space is empty"):
        block_sink.sample_stored_windows(spark, path, 1, 1, split="train").collect()
    r = block_sink.sample_stored_windows(spark, path, 1, 1, split="val").first()
    assert (bytes(r.x), bytes(r.y)) == (b"efgh", b"fghi")


def test_pairs_are_counted_in_the_tasks_and_the_exchange_has_no_row_per_token(spark):
    """A stream longer than what is counted at once, for both widths, against plain Python; no generator of a row per token."""
    rnd = random.Random(4)
    from tokenloom.operators import bigram
    docs = [bytes(rnd.randrange(6) for _ in range(n)) for n in (0, 2, 4, (1 << 21) + 6, 10, (1 << 20) + 2)]
    rows = [("train", 0, d, bytearray(b)) for d, b in enumerate(docs)]
    c = spark.createDataFrame(rows, "split STRING, shard_id INT, doc_id BIGINT, data BINARY").repartition(1)
    for width in (1, 2):
        ids = [[int.from_bytes(b[i:i + width], "little") for i in range(0, len(b), width)] for b in docs]
        inner = Counter(p for a in ids for p in zip(a, a[1:]))
        assert {(r.a, r.b): r.n for r in bigram.bigram_counts(c, width).collect()} == inner
        whole = [t for a in ids for t in a]
        pairs = stream.next_token_pairs(stream.positions(c, width), width)
        assert {(r.tok, r.next_tok): r.n for r in pairs.collect()} == Counter(zip(whole, whole[1:]))
        assert "Generate" not in pairs._jdf.queryExecution().executedPlan().toString()
