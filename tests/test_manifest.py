import pytest
from pyspark.sql import functions as F

from tokenloom.operators import manifest as M
from tokenloom.functions.text import file_basename, zero_pad_name, percent_done


def lines(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "line_no BIGINT, line STRING")


LISTING = [
    "drwxr-xr-x u/g 0 2024-01-01 00:00 tok105/",
    "-rw-r--r-- u/g 10 2024-01-01 00:00 tok105/data00.bin",
    "-rw-r--r-- u/g 11 2024-01-01 00:00 tok105/data01.bin",
    "-rw-r--r-- u/g 99 2024-01-01 00:00 other/data02.bin",
    "-rw-r--r-- u/g 12 2024-01-01 00:00 tok105/data02.txt",
    "-rw-r--r-- u/g 13 2024-01-01 00:00 tok105/data01.bin",
    "-rw-r--r-- u/g 45 2024-01-01 00:00 tok105/data45.bin",
]


def test_parse_listing_last_duplicate_wins(spark):
    got = {r.file: r.size for r in M.parse_listing(lines(spark, LISTING)).collect()}
    assert got == {"data00.bin": 10, "data01.bin": 13, "data45.bin": 45}


@pytest.mark.parametrize("n,p,count,val", [
    (0, 10, 1, ["data45.bin"]),
    (3, 0, 4, ["data45.bin"]),
    (3, 50, 5, ["data45.bin", "data46.bin"]),              # 1.5 rounds to even
    (5, 10, 6, ["data45.bin"]),                            # 0.5 rounds to 0, but one at least
    (5, 50, 7, ["data45.bin", "data46.bin"]),              # 2.5 rounds to even
    (15, 10, 17, ["data45.bin", "data46.bin"]),            # 1.5 rounds to even
    (45, 10, 49, ["data45.bin", "data46.bin", "data47.bin", "data48.bin"]),
    (10, 100, 20, ["data45.bin", "data46.bin", "data47.bin", "data48.bin", "data49.bin",
                   "data50.bin", "data51.bin", "data52.bin", "data53.bin", "data54.bin"]),
])
def test_required_shards_rounding(spark, n, p, count, val):
    files = [r.file for r in M.required_shards(spark, n, p).orderBy("ordinal").collect()]
    assert len(files) == count and files[n:] == val
    assert files[:n] == sorted(files[:n]) and (n < 3 or files[:3] == ["data00.bin", "data01.bin", "data02.bin"])


def test_required_overlap_raises(spark):
    with pytest.raises(ValueError):
        M.required_shards(spark, 46, 10)


def _verify(spark, strict=False):
    req = M.required_shards(spark, 3, 50, 45)          # data00-02, data45-46
    expected = M.parse_listing(lines(spark, LISTING))
    existing = spark.createDataFrame([("data00.bin", 10), ("data01.bin", 11), ("data46.bin", 1)],
                                     "file STRING, size BIGINT")
    return M.verify_shards(req, existing, expected, strict=strict)


def test_verify_statuses(spark):
    got = {r.file: r.status for r in _verify(spark).collect()}
    assert got == {"data00.bin": "verified", "data01.bin": "size_mismatch", "data02.bin": "missing",
                   "data45.bin": "missing", "data46.bin": "not_in_archive"}
    with pytest.raises(Exception):
        _verify(spark, strict=True).collect()


def test_extract_plans_and_summaries(spark):
    v = _verify(spark)
    a = [r.file for r in M.shards_to_extract(v, "A").orderBy("extract_order").collect()]
    b = [r.file for r in M.shards_to_extract(v, "B").orderBy("extract_order").collect()]
    assert a == ["data01.bin", "data02.bin", "data45.bin", "data46.bin"]
    assert b == ["data02.bin", "data45.bin", "data01.bin", "data46.bin"]
    assert M.all_verified(v).first().all_verified is False
    assert M.all_verified(v.filter("false")).first().all_verified is True
    assert {r.status: r.n_files for r in M.verify_summary(v).collect()} == {
        "verified": 1, "size_mismatch": 1, "missing": 2, "not_in_archive": 1}
    prog = M.extract_progress(M.shards_to_extract(v, "A")).orderBy("i").collect()
    assert [(r.i, r.n, r.done_bytes, r.total_bytes) for r in prog] == [
        (1, 4, 0, 13 + 45), (2, 4, 13, 58), (3, 4, 13, 58), (4, 4, 58, 58)]
    assert [r.percent for r in prog] == [0, 22, 22, 100]


def test_not_in_archive_and_pending(spark):
    req = M.required_shards(spark, 2, 100, 45)   # data00, data01, data45, data46
    expected = M.parse_listing(lines(spark, LISTING))
    assert [r.file for r in M.not_in_archive(req, expected).collect()] == ["data46.bin"]
    with pytest.raises(Exception):
        M.not_in_archive(req, expected, strict=True).collect()
    done = spark.createDataFrame([("data00.bin",)], "file STRING")
    assert sorted(r.file for r in M.pending_files(req, done).collect()) == ["data01.bin", "data45.bin",
                                                                            "data46.bin"]
    eb = M.expected_bytes(req, expected).first()
    assert (eb.expected_bytes, eb.n_files) == (10 + 13 + 45, 3)


def test_archive_count_check(spark):
    assert M.archive_count_check(lines(spark, LISTING)).first().ok is True
    assert M.archive_count_check(lines(spark, [])).first().ok is False
    assert M.archive_count_check(lines(spark, ["garbage"])).first().ok is False


def test_name_functions(spark):
    df = spark.createDataFrame([("a/b/c.bin", 7, 5, 20), ("c.bin", 123, 0, 0), ("a/b/", 1, 1, 3)],
                               "p STRING, i INT, d BIGINT, t BIGINT")
    got = df.select(file_basename(F.col("p")).alias("b"), zero_pad_name(F.col("i")).alias("z"),
                    percent_done("d", "t").alias("pc")).collect()
    assert [(r.b, r.z, r.pc) for r in got] == [("c.bin", "data07.bin", 25), ("c.bin", "data123.bin", None),
                                                ("", "data01.bin", 33)]


def test_split_labels_and_overlap_guard(spark):
    from tokenloom.sources.corpus import corpus_from_documents, num_val_files, with_split
    docs = spark.createDataFrame([(i, "t", f"src{i}") for i in range(50)],
                                 "doc_id BIGINT, text STRING, source STRING")
    c = with_split(corpus_from_documents(docs), 10, 10, keep_unused=True)
    got = {r.shard_id: r.split for r in c.collect()}
    assert num_val_files(10, 10) == 1
    assert [s for s in range(50) if got[s] == "train"] == list(range(10))
    assert [s for s in range(50) if got[s] == "val"] == [45]
    with pytest.raises(ValueError):
        with_split(corpus_from_documents(docs), 46, 10)


def test_listing_and_verify_random_against_python(spark):
    import random
    rnd = random.Random(8)
    names = [f"data{i:02d}.bin" for i in range(12)]
    listing = []
    for _ in range(40):
        pre = rnd.choice(["tok105/", "tok105/", "other/"])
        suf = rnd.choice([".bin", ".bin", ".txt"])
        name = rnd.choice(names).replace(".bin", suf)
        listing.append(f"-rw-r--r-- u/g {rnd.randint(1, 99)} 2024-01-01 00:00 {pre}{name}")
    expected = {}
    for line in listing:                                   # last duplicate wins
        parts = line.split()
        if parts[-1].startswith("tok105/") and parts[-1].endswith(".bin"):
            expected[parts[-1].split("/")[-1]] = int(parts[2])
    existing = {n: rnd.choice([expected.get(n, 5), expected.get(n, 5) + 1])
                for n in names if rnd.random() < 0.7}
    got_exp = {r.file: r.size for r in M.parse_listing(lines(spark, listing)).collect()}
    assert got_exp == expected
    req = M.required_shards(spark, 5, 20, 8)              # data00-04, data08
    ex = spark.createDataFrame(list(existing.items()), "file STRING, size BIGINT")
    got = {r.file: r.status for r in M.verify_shards(req, ex, M.parse_listing(lines(spark, listing))).collect()}
    for f in [f"data{i:02d}.bin" for i in (0, 1, 2, 3, 4, 8)]:
        if f not in existing:
            assert got[f] == "missing"
        elif f not in expected:
            assert got[f] == "not_in_archive"
        else:
            assert got[f] == ("verified" if existing[f] == expected[f] else "size_mismatch")


def test_archive_is_read_again_once_then_an_error(spark):
    good = ["-rw-r--r-- u/g 5 2024-01-01 00:00 tok105/data00.bin"]
    listings, read = [], []

    def fetch():
        read.append(len(read))
        return spark.createDataFrame([(x,) for x in listings[len(read) - 1]], "line STRING")

    listings[:] = [["cut off"], good]
    assert tuple(M.verify_archive(fetch, "a").first()) == ("a", 1, 1, True, 2)
    read.clear()
    listings[:] = [[], ["cut off"], good]   # a count of 0 fails too
    with pytest.raises(RuntimeError, match="not valid after 2 attempts: 1 lines, 0 members"):
        M.verify_archive(fetch, "a")

    def unreadable():
        return spark.read.text("/nonexistent/listing")
    with pytest.raises(RuntimeError, match="not valid"):
        M.verify_archive(unreadable)
