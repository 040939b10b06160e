"""Small frames and brute-force references shared by the tests."""

from tokenloom.sources.corpus import corpus_from_documents, with_split

# Edge rows: empty text, 1 byte, shorter than a block, many blocks, emoji, U+00A0.
TINY_DOCS = [
    (0, "", "src0"),
    (1, "a", "src0"),
    (2, "short", "src0"),
    (3, "x" * 70 + "y" * 33, "src1"),
    (4, "emoji \U0001F600 and nbsp\u00a0here", "src1"),
    (5, "h\u00e9llo w\u00f6rld " * 5, "src2"),
    (10, "", "src2"),
    (7, "tail of val", "src3"),
    (8, "second val doc \u00e9\u00e9", "src3"),
    (9, "unused shard", "src9"),
]


def tiny_docs(spark, rows=TINY_DOCS):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")


def tiny_corpus(spark, rows=TINY_DOCS):
    # train shards 0..2, validation shard 3 (num_val = round(3 * 34 / 100) = 1)
    return with_split(corpus_from_documents(tiny_docs(spark, rows)), 3, 34, 3)


def brute_streams(rows=TINY_DOCS, num_train=3, val_start=3, num_val=1):
    """split -> list of byte values, documents in (shard_id, doc_id) order."""
    out = {"train": [], "val": []}
    for doc_id, text, src in sorted(rows, key=lambda r: (int(r[2][3:]), r[0])):
        sid = int(src[3:])
        split = "train" if sid < num_train else ("val" if val_start <= sid < val_start + num_val else None)
        if split:
            out[split].extend(text.encode("utf-8"))
    return out


def csv(b: bytes) -> str:
    return ",".join(str(x) for x in b)
