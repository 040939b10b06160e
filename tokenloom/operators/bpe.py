"""Byte-level BPE as Spark jobs: pre-token counts, pair counts, training,
encoding and decoding.

Id layout: bytes 0-255, then one id per merge in rank order, special tokens
last (``n_merges = vocab_size - 256 - n_special``).

Token sequences are strings with one code point per token: a byte is its
ISO-8859-1 character (U+0000-00FF) and merge ``k`` is U+0100+k, i.e. the
code point equals the token id. A merge of ``(l, r)`` into ``n`` is then the
literal, left-to-right, non-overlapping ``replace(chr(l)+chr(r), chr(n))`` —
exactly BPE's merge rule. Pair counts of a fresh word table are made of these
strings in the JVM. Merging a word (in training and encoding) and decoding are
Arrow-batched functions: :func:`merge_word` does it in ``n log n`` steps, where
SQL functions need one pass per merge.

Training makes many merges per Spark job and stays exact: see :func:`train_bpe`.
"""

from __future__ import annotations

import heapq
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import WS_CLASS
from ..functions.tokens import bytes_to_ids, utf8_bytes
from ..session import ScratchTables

# ---- fixed values -----------------------------------------------------------
# Pre-token pattern: the published GPT-2 pattern
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# with \s spelled out as the explicit whitespace class (so it means the same
# in every engine).
_WS = WS_CLASS[1:-1]
PRETOKEN_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
                    rf"| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
END_OF_TEXT = "<|endoftext|>"
MIN_FREQUENCY = 2
# -----------------------------------------------------------------------------

_LATIN1 = "ISO-8859-1"
MAX_ID = 0xD7FF          # training: ids must be BMP code points below the surrogates
MAX_STREAM_ID = 0xFFFF   # uint16 streams
MEMO_WORDS = 1 << 18     # distinct words an encoding task remembers; beyond it the memory starts anew
HEAD_WORDS = 1 << 18     # parts of words on which the driver makes a round's merges
HEAD_TOKENS = 1 << 22    # and their tokens
HEAD_PAIRS = 1 << 18     # the best pairs, of which it knows the counts
FIRST_DEPTH = 16         # the best pair's count by the least one of the first round
_END_OF_ROW = 0xFFFF     # no id of training


def pretokens(text) -> Column:
    """Array of pre-tokens of a text (whole text, in order)."""
    t = text if isinstance(text, Column) else F.col(text)
    return F.regexp_extract_all(t, F.lit(PRETOKEN_PATTERN), 0)


def pretoken_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)`` word frequencies; map-side partial aggregation keeps
    frequent words from concentrating before the shuffle."""
    return (docs.select(F.explode(pretokens(text)).alias("word"))
                .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def byte_chars(text) -> Column:
    """A string's UTF-8 bytes as one ISO-8859-1 character each (token = byte)."""
    t = text if isinstance(text, Column) else F.col(text)
    return F.decode(utf8_bytes(t), _LATIN1)


def words_table(counts: DataFrame) -> DataFrame:
    """``(word, n, s)`` with ``s`` the word's byte tokens."""
    return counts.select("word", "n", byte_chars(F.col("word")).alias("s"))


def pair_counts(words: DataFrame, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """K1: adjacent-pair frequency weighted by word count, ``n >= min_frequency``.

    Pairs are formed with native ``split``/``arrays_zip`` on the token string
    and grouped on one BIGINT key ``l * 65536 + r`` (map-side combined)."""
    ch = F.split(F.col("s"), "")
    n = F.size("c")
    p = (words.select("n", ch.alias("c"))
              .select("n", F.explode(F.arrays_zip(F.slice("c", 1, n - 1).alias("a"),
                                                  F.slice("c", 2, n - 1).alias("b"))).alias("p"))
              .select("n", (F.ascii("p.a").cast("long") * 65536 + F.ascii("p.b")).alias("k"))
              .groupBy("k").agg(F.sum("n").cast("long").alias("n")))
    return p.filter(F.col("n") >= min_frequency).select(
        F.expr("k div 65536").cast("int").alias("l"), (F.col("k") % 65536).cast("int").alias("r"), "n")


def top_pair(pairs: DataFrame) -> DataFrame:
    """O3: the best pair — count desc, then left id, then right id."""
    return pairs.orderBy(F.desc("n"), "l", "r").limit(1)


@dataclass
class BpeModel:
    merges: DataFrame      # (rank INT, l INT, r INT, id INT, freq BIGINT)
    vocab: DataFrame       # (id INT, token BINARY, special BOOLEAN)


def merge_word(ids: list[int], ranks: dict[tuple[int, int], int], changes=None) -> list[int]:
    """BPE of one word: the pair of the lowest new id is merged, leftmost first, until none is left.

    ``ranks``: pair -> new id, rising in the order of the merges. The word is a
    linked list and its mergeable pairs a heap of (new id, place), so a merge
    touches its neighbours only: ``n log n`` steps for ``n`` bytes.
    ``changes(step, pair, by)`` is told how every merge changes the pair counts.
    """
    heap = [(new, i) for i, pair in enumerate(zip(ids, ids[1:])) if (new := ranks.get(pair)) is not None]
    if not heap:
        return ids
    heapq.heapify(heap)
    ids, n = list(ids), len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        new, i = heapq.heappop(heap)
        j = after[i]
        if ids[i] < 0 or j >= n or ranks.get((ids[i], ids[j])) != new:
            continue  # an earlier merge took one of the two
        h, k = before[i], after[j]
        if changes:
            changes(new, (ids[i], ids[j]), -1)
            if h >= 0:
                changes(new, (ids[h], ids[i]), -1)
                changes(new, (ids[h], new), 1)
            if k < n:
                changes(new, (ids[j], ids[k]), -1)
                changes(new, (new, ids[k]), 1)
        ids[i], ids[j], after[i] = new, -1, k
        if k < n:
            before[k] = i
            if (more := ranks.get((new, ids[k]))) is not None:
                heapq.heappush(heap, (more, i))
        if h >= 0 and (more := ranks.get((ids[h], new))) is not None:
            heapq.heappush(heap, (more, h))
    return [t for t in ids if t >= 0]


def merge_ranks(merges) -> dict[tuple[int, int], int]:
    """(l, r, id) in order -> {pair: id}; the first merge of a pair counts."""
    ranks: dict = {}
    for l, r, new in merges:
        ranks.setdefault((l, r), new)
    return ranks


class Segments:
    """One-by-one BPE over weighted segments, with an index from pairs to the segments that hold them: a merge
    touches only these and changes counts by difference."""

    def __init__(self, segments: list[tuple[int, list[int]]]):
        self.n = [n for n, _ in segments]
        self.ids = [ids for _, ids in segments]
        self.counts: dict = defaultdict(int)
        self.held: dict = defaultdict(set)
        for w, ids in enumerate(self.ids):
            for pair in zip(ids, ids[1:]):
                self.counts[pair] += self.n[w]
                self.held[pair].add(w)
        self.heap: list = []
        self._push(self.counts)

    def _push(self, pairs) -> None:
        for pair in pairs:
            if self.counts[pair] > 0:
                heapq.heappush(self.heap, (-self.counts[pair], *pair))

    def next_merges(self, first_id: int, most: int, least: int) -> list[tuple[int, int, int, int]]:
        """(l, r, id, count) of the next merges, at most ``most``, while the best pair's count is ``least`` or more."""
        out = []
        while len(out) < most and self.heap:
            n, l, r = heapq.heappop(self.heap)
            if self.counts[l, r] != -n:
                continue  # changed since; its present count is in the heap too
            if -n < least:
                break
            new, changed = first_id + len(out), set()
            for w in list(self.held.pop((l, r), ())):

                def change(_step, pair, by):
                    self.counts[pair] += by * self.n[w]  # noqa: B023 (called before the loop goes on)
                    changed.add(pair)
                    if by > 0:
                        self.held[pair].add(w)  # noqa: B023

                self.ids[w] = merge_word(self.ids[w], {(l, r): new}, change)
            self.counts[l, r] = 0
            self._push(changed)
            out.append((l, r, new, -n))
        return out


def _flat(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Binary uint16 rows -> all tokens, with ``_END_OF_ROW`` after each row, and the lengths of the rows."""
    ids = ids.cast(pa.binary())
    ends = np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset:ids.offset + len(ids) + 1]
    size = np.diff(ends) // 2
    flat = np.full(int(size.sum()) + len(size), _END_OF_ROW, dtype=np.uint16)
    tokens = np.ones(len(flat), dtype=bool)
    tokens[np.cumsum(size + 1) - 1] = False
    if size.any():
        flat[tokens] = np.frombuffer(memoryview(ids.buffers()[2])[ends[0]:ends[-1]], dtype="<u2")
    return flat, size


def _binary(tokens: np.ndarray, size: np.ndarray) -> pa.Array:
    """The tokens as binary rows of ``size`` tokens each."""
    ends = np.concatenate([[0], np.cumsum(size * 2)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(tokens.astype("<u2"))])


def _byte_rows(batches):
    """(n, bytes) -> (n, ids): a byte's id is the byte."""
    for b in batches:
        raw = b.column(1).cast(pa.binary())
        ends = np.frombuffer(raw.buffers()[1], dtype=np.int32)[raw.offset:raw.offset + len(raw) + 1]
        tokens = np.frombuffer(memoryview(raw.buffers()[2] or b"")[ends[0]:ends[-1]], dtype=np.uint8)
        yield pa.RecordBatch.from_arrays([b.column(0), _binary(tokens, np.diff(ends))], names=["n", "ids"])


def _joints(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each place between two neighbours of ``flat``: the pair as one number, and whether both are of one row."""
    return ((flat[:-1].astype(np.int64) << 16) | flat[1:], (flat[:-1] != _END_OF_ROW) & (flat[1:] != _END_OF_ROW))


def _merge(merges: list[tuple[int, int, int]]):
    """(n, ids) -> the rows after the merges, in their order; rows of one token have no pair left and go."""
    def run(batches):
        for b in batches:
            flat, _ = _flat(b.column(1))
            for l, r, new in merges:
                at = np.flatnonzero((flat[:-1] == l) & (flat[1:] == r))
                if l == r and len(at) > 1:  # of a run of one token, every second place
                    i = np.arange(len(at))
                    begin = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, i, 0))
                    at = at[(i - begin) % 2 == 0]
                if len(at):
                    flat[at] = new
                    flat = np.delete(flat, at + 1)
            size = np.diff(np.flatnonzero(flat == _END_OF_ROW), prepend=-1) - 1
            left = size > 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0).filter(pa.array(left)), _binary(flat[np.repeat(left, size + 1) & (flat != _END_OF_ROW)], size[left])],
                names=["n", "ids"])
    return run


def _pairs_of_rows(batches):
    """(n, ids) -> (pair, n), summed per batch."""
    for b in batches:
        flat, size = _flat(b.column(1))
        pair, inside = _joints(flat)
        n = np.repeat(np.asarray(b.column(0)), size + 1)[:-1][inside]
        pair = pair[inside]
        order = np.argsort(pair, kind="stable")
        pair, n = pair[order], n[order]
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        n = np.add.reduceat(n, first) if len(first) else n
        yield pa.RecordBatch.from_arrays([pa.array(pair[first]), pa.array(n, pa.int64())], names=["k", "n"])


def _cut(frequent: np.ndarray):
    """(n, ids) -> the longest parts of each row in which all pairs are in ``frequent`` (sorted)."""
    def run(batches):
        for b in batches:
            flat, size = _flat(b.column(1))
            pair, inside = _joints(flat)
            at = np.minimum(np.searchsorted(frequent, pair), len(frequent) - 1)
            held = np.concatenate([[False], inside & (frequent[at] == pair), [False]])  # the joint before each token
            begin, end = np.flatnonzero(held[1:] & ~held[:-1]), np.flatnonzero(held[:-1] & ~held[1:]) + 1
            row = np.repeat(np.arange(len(size)), size + 1)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row[begin])),
                                              _binary(flat[held[1:] | held[:-1]], end - begin)], names=["n", "ids"])
    return run


def train_bpe(spark: SparkSession, counts: DataFrame, vocab_size: int,
              min_frequency: int = MIN_FREQUENCY, specials=(END_OF_TEXT,),
              batch: int = 1024, head_words: int = HEAD_WORDS) -> BpeModel:
    """K2: repeat (best pair -> merge everywhere) until the vocabulary is full
    or no pair reaches ``min_frequency``. The merges are exactly those that are
    made one by one from the counts of all words; each round of Spark jobs makes up
    to ``batch`` of them:

    1. the pairs of all distinct words are counted, and a frequency ``least`` is set
       below the best pair's;
    2. every word is cut at its pairs rarer than that, and equal parts are added up:
       few are left, as most pairs of rare words are rare;
    3. the driver makes the merges on these parts, one by one, while the best pair
       has ``least`` or more;
    4. Spark makes the same merges in all words.

    Step 3 is exact: a merge joins two tokens across a joint, and all joints that one
    pair joins later belong to one pair now. So no pair that is or will be as frequent
    as ``least`` has a joint that was cut, and the counts of all such pairs come from
    the parts alone. ``least`` rises until at most ``head_words`` parts, of
    ``HEAD_TOKENS`` tokens, are left for the driver; where there are more even among
    the best pairs, the round makes the best pair's merge only.

    Words and parts stay in tables in the shared folder, which cuts lineage.
    """
    n_merges = vocab_size - 256 - len(specials)
    if n_merges < 0:
        raise ValueError("vocab_size too small for bytes and special tokens")
    if vocab_size - 1 > MAX_ID:
        raise ValueError(f"vocab_size above {MAX_ID + 1} is not supported")
    tables = ScratchTables(spark, "bpe")
    # one file per task that can run: later rounds read each by one task
    words = tables.write(
        counts.select("n", utf8_bytes("word").alias("raw")).filter(F.octet_length("raw") > 1)
        .repartition(spark.sparkContext.defaultParallelism).mapInArrow(_byte_rows, "n long, ids binary"), "words")
    merges: list[tuple[int, int, int]] = []
    freqs: list[int] = []
    depth = FIRST_DEPTH
    while len(merges) < n_merges:
        pairs = words.mapInArrow(_pairs_of_rows, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
        best = top_pairs(pairs.filter(F.col("n") >= min_frequency), HEAD_PAIRS + 1)
        if not best:
            break
        made, depth = _merges_on_parts(tables, words, best, depth, 256 + len(merges),
                                       min(batch, n_merges - len(merges)), min_frequency, head_words)
        merges += [m[:3] for m in made]
        freqs += [m[3] for m in made]
        if len(merges) < n_merges:
            merged = tables.write(words.mapInArrow(_merge([m[:3] for m in made]), "n long, ids binary"), "words")
            tables.drop(words)
            words = merged
    tables.drop(words)
    tokens = {i: bytes([i]) for i in range(256)}
    for l, r, new in merges:
        tokens[new] = tokens[l] + tokens[r]
    n_done = len(merges)
    for i, sp in enumerate(specials):
        tokens[256 + n_done + i] = sp.encode("utf-8")
    # Both tables are bounded by vocab_size (a parameter), not by the data.
    mdf = spark.createDataFrame([(k, *m, f) for k, (m, f) in enumerate(zip(merges, freqs))],
                                "rank INT, l INT, r INT, id INT, freq BIGINT")
    vdf = spark.createDataFrame(
        [(i, tokens[i], i >= 256 + n_done) for i in sorted(tokens)],
        "id INT, token BINARY, special BOOLEAN")
    return BpeModel(mdf, vdf)


def top_pairs(pairs: DataFrame, most: int) -> list[tuple[int, int]]:
    """The best pairs (pair, n), in order; ``most`` bounds what the driver gets."""
    return [(r["k"], r["n"]) for r in pairs.orderBy(F.desc("n"), "k").limit(most).collect()]


def _merges_on_parts(tables: ScratchTables, words: DataFrame, best: list[tuple[int, int]], depth: int, first_id: int,
                     most: int, min_frequency: int, head_words: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Steps 2 and 3 of a round: (l, r, id, count) of its merges, and how deep below the best pair the next round begins."""
    top = best[0][1]
    rarest = max(min_frequency, best[HEAD_PAIRS][1] + 1 if len(best) > HEAD_PAIRS else 1)  # rarer ones may be missing in ``best``
    rows, held = words, []
    while (least := max(rarest, top // depth)) <= top:
        frequent = np.sort(np.array([k for k, n in best if n >= least], dtype=np.int64))
        rows = tables.write(rows.mapInArrow(_cut(frequent), "n long, ids binary").groupBy("ids")
                            .agg(F.sum("n").alias("n")).select("n", "ids"), "parts")
        held.append(rows)
        size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("ids") / 2).alias("tokens")).first()
        if size["n"] <= head_words and size["tokens"] <= HEAD_TOKENS:
            parts = [(r["n"], np.frombuffer(r["ids"], dtype="<u2").tolist()) for r in rows.collect()]
            tables.drop(*held)
            return Segments(parts).next_merges(first_id, most, least), depth * 2 if size["n"] * 4 <= head_words else depth
        if least == top:
            break
        depth = max(1, min(depth, top // least) // 2)
    tables.drop(*held)
    k, n = best[0]
    return [(k >> 16, k & 0xFFFF, first_id, n)], 2


def merges_list(model: BpeModel) -> list[tuple[int, int, int]]:
    """The ordered merge list (bounded by the vocabulary size)."""
    return [(r["l"], r["r"], r["id"]) for r in model.merges.orderBy("rank").collect()]


def encoder_tables(model: BpeModel) -> tuple[list[tuple[int, int, int]], dict[int, int]]:
    """What encodes with a tokenizer whose ids are in any order: merges over ids
    that are bytes or 256 + rank, and the tokenizer's id of each of these.

    Where several merges make one token, a merge of that token counts for each."""
    known = {r["id"]: bytes(r["token"]) for r in model.vocab.filter(~F.col("special")).collect()}
    own: dict[int, list[int]] = {i: [t[0]] for i, t in known.items() if len(t) == 1}
    ids = {b[0]: i for i, b in own.items()}
    if absent := sorted(set(range(256)) - set(ids)):
        raise ValueError(f"the vocabulary lacks {len(absent)} bytes, first {absent[0]}")
    merges = []
    for new, (l, r, made) in enumerate(merges_list(model), 256):
        merges += [(a, b, new) for a in own[l] for b in own[r]]
        own.setdefault(made, []).append(new)
        ids[new] = made
    return merges, ids


def _word_pieces(text, specials: dict[str, int]) -> Column:
    """Pre-tokens of a text; a special token's string is a piece of its own.

    One pattern cuts both: a special token, or the pre-tokens of what lies
    before the next one. No character is set apart as a separator, so every text
    keeps all its characters."""
    if not specials:
        return pretokens(text)
    t = text if isinstance(text, Column) else F.col(text)
    names = list(specials)
    special = reduce(or_, [t.contains(n) for n in names])  # few texts hold one
    either = "|".join(r"\Q" + n + r"\E" for n in sorted(names, key=len, reverse=True))
    parts = F.regexp_extract_all(t, F.lit(rf"(?s)(?:{either})|.+?(?={either}|\z)"), 0)
    cut = F.flatten(F.transform(parts, lambda p: F.when(p.isin(names), F.array(p)).otherwise(pretokens(p))))
    return F.when(special, cut).otherwise(pretokens(t))


def encode_stream(text, merges: list[tuple[int, int, int]], specials: dict[str, int] | None = None,
                  ids_of_file: dict[int, int] | None = None) -> Column:
    """K3 as one column: text -> BINARY little-endian uint16 ids; null stays null.

    Pre-tokens are cut in the JVM. The words arrive in Arrow batches, and each
    distinct word is merged once per task, so the time hardly grows with the
    number of merges and nothing is shuffled. The merges and ``specials``
    (string -> id) are bounded by the vocabulary. ``ids_of_file`` renames the
    merges' ids (:func:`encoder_tables`).
    """
    top = max([*(ids_of_file or {}).values(), *(specials or {}).values()], default=0)
    if top > MAX_STREAM_ID:
        raise ValueError(f"id {top} does not fit a uint16 stream")
    ranks, fixed = merge_ranks(merges), {k: struct.pack("<H", v) for k, v in (specials or {}).items()}

    @F.arrow_udf("binary")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = dict(fixed)

        def ids_of(word: str) -> bytes:
            got = memo.get(word)
            if got is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                    memo.update(fixed)
                ids = merge_word(list(word.encode("utf-8")), ranks)
                if ids_of_file:
                    ids = [ids_of_file[i] for i in ids]
                got = memo[word] = struct.pack(f"<{len(ids)}H", *ids)
            return got

        for texts in batches:
            words = texts.flatten().dictionary_encode()  # the batch's words, in order
            ids = pa.array(map(ids_of, words.dictionary.to_pylist()), pa.binary()).take(words.indices)
            ends = np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset:ids.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int32)
            count = np.asarray(pc.fill_null(pc.list_value_length(texts), 0))
            rows = ends[np.concatenate([[0], np.cumsum(count)])]
            none = texts.is_null()
            yield pa.Array.from_buffers(
                pa.binary(), len(texts), [pc.invert(none).buffers()[1], pa.py_buffer(rows.astype(np.int32)), ids.buffers()[2]],
                null_count=texts.null_count)

    return encoded(_word_pieces(text, specials or {}))


def encode_documents(docs: DataFrame, merges: list[tuple[int, int, int]], key: str = "doc_id",
                     text: str = "text", as_arrays: bool = True,
                     specials: dict[str, int] | None = None,
                     ids_of_file: dict[int, int] | None = None) -> DataFrame:
    """K3: text -> ids per document, row by row (no shuffle).

    ``as_arrays`` gives ``ids ARRAY<INT>``; otherwise ``data`` is the uint16
    little-endian stream (the format a training loader reads)."""
    enc = encode_stream(F.col(text), merges, specials, ids_of_file)
    if as_arrays:
        return docs.select(key, enc.alias("data")).select(key, bytes_to_ids("data", 2).alias("ids"))
    return docs.select(key, enc.alias("data"))


def token_to_id(tokens: DataFrame, vocab: DataFrame, token: str = "token") -> DataFrame:
    """Token bytes -> id by an equi-join with the (bounded) vocabulary; null for an unknown token."""
    return tokens.join(F.broadcast(vocab.select(F.col("token").alias(token), "id")), token, "left")


def decode_ids(seqs: DataFrame, vocab: DataFrame, key: str = "doc_id", ids: str = "ids",
               skip_special: bool = True) -> DataFrame:
    """Ids -> text in order, row by row (no explode, no shuffle).

    The vocabulary (bounded by its size) is collected once. Special tokens are
    left out unless ``skip_special`` is false; ids outside the vocabulary have
    no text. A cut multi-byte character becomes U+FFFD.
    """
    known = {r["id"]: bytes(r["token"]) for r in vocab.collect() if not (skip_special and r["special"])}

    @F.pandas_udf("binary")
    def joined(seq: pd.Series) -> pd.Series:
        return seq.map(lambda s: b"" if s is None else b"".join(known.get(i, b"") for i in s))

    return seqs.select(key, F.make_valid_utf8(joined(F.col(ids)).cast("string")).alias("text"))
