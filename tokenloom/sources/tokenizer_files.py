"""A tokenizer as the two files that byte-level BPE tools exchange.

``vocab.json`` maps each token to its id, ``merges.txt`` lists the merged pairs
in order, after a version line. Tokens are bytes, shown as printable characters:
a printable Latin-1 byte is its own character, the others are the characters
from U+0100 on, in order. Both files are bounded by the vocabulary.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..operators.bpe import BpeModel
from ..session import hadoop_path

# The bytes shown as themselves, and the files' names and first line.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
VOCAB_FILE, MERGES_FILE = "vocab.json", "merges.txt"
VERSION = "#version: 0.2"

CHAR_OF = {b: chr(b) for b in PRINTABLE}
CHAR_OF |= {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in CHAR_OF)}
BYTE_OF = {c: b for b, c in CHAR_OF.items()}


def printable(token: bytes) -> str:
    return "".join(map(CHAR_OF.__getitem__, token))


def token_bytes(shown: str) -> bytes:
    """The bytes of a token; one that holds other characters is none of the byte-level tokens."""
    try:
        return bytes(map(BYTE_OF.__getitem__, shown))
    except KeyError as e:
        raise ValueError(f"{shown!r} holds a character that shows no byte") from e


def _write(spark: SparkSession, path: str, text: str) -> None:
    p, fs = hadoop_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path, wholetext=True).first()
    if row is None:
        raise ValueError(f"{path} is empty")
    return row["value"]


def save_tokenizer_files(spark: SparkSession, model: BpeModel, folder: str) -> None:
    """Write ``vocab.json`` and ``merges.txt``. Where two merges make the same
    token, ``vocab.json`` holds the id of the first, as the format has one id
    per token."""
    vocab = model.vocab.orderBy("id").collect()
    shown = {r["id"]: bytes(r["token"]).decode() if r["special"] else printable(bytes(r["token"])) for r in vocab}
    ids: dict[str, int] = {}
    for i, token in shown.items():
        ids.setdefault(token, i)
    pairs = [f"{shown[m['l']]} {shown[m['r']]}" for m in model.merges.orderBy("rank").collect()]
    _write(spark, f"{folder}/{VOCAB_FILE}", json.dumps(ids, ensure_ascii=False))
    _write(spark, f"{folder}/{MERGES_FILE}", "\n".join([VERSION, *pairs]) + "\n")


def load_tokenizer_files(spark: SparkSession, folder: str) -> BpeModel:
    """Read both files, whatever order the ids are in. A token that is neither a
    byte nor made by a merge is special; how often a merge occurred is not
    known (null). A merge of, or into, a token without an id is an error."""
    ids: dict[str, int] = json.loads(_read(spark, f"{folder}/{VOCAB_FILE}"))
    lines = _read(spark, f"{folder}/{MERGES_FILE}").split("\n")
    pairs = [tuple(x.split(" ")) for x in lines if x.strip() and not x.startswith("#version")]
    merges = []
    for rank, pair in enumerate(pairs):
        if len(pair) != 2 or (absent := [t for t in (*pair, "".join(pair)) if t not in ids]):
            raise ValueError(f"merge {rank} {pair}: " + ("not two tokens" if len(pair) != 2 else f"no id for {absent}"))
        merges.append((rank, ids[pair[0]], ids[pair[1]], ids["".join(pair)], None))
    plain = {"".join(p) for p in pairs} | set(BYTE_OF)
    vocab = [(i, token_bytes(t) if t in plain else t.encode(), t not in plain) for t, i in ids.items()]
    return BpeModel(spark.createDataFrame(merges, "rank INT, l INT, r INT, id INT, freq BIGINT"),
                    spark.createDataFrame(sorted(vocab), "id INT, token BINARY, special BOOLEAN"))
