"""Packing along a Hilbert curve: neighbouring documents share sequences.

A document's tokens are hashed into a vector that is projected to ``DIMS``
dimensions (each token id has a fixed random direction; their sum over the root
of the count is the projection). The coordinates, cut into equal shares by
quantiles of a bounded sample, give the document's Hilbert key. Documents are
range-partitioned by that key and sorted in each range; the running token count
over all ranges is a document's place on the curve, and a sequence is every
2,048 tokens of it. So only the last sequence is padded, pieces are cut where a
sequence ends, and each token id lies in one piece.

Texts are tokenised once and exchanged once, as token ids. There is a range for
every ``RANGE_BYTES`` of text (and one per shuffle partition at least), so what
a task sorts does not grow with the corpus. Range bounds come from a sample of
at most ``SAMPLE`` documents or ``SAMPLE_PER_RANGE`` a range (by hash of id and
text); they only decide how even the tasks are. Copies share a Hilbert key, so
the key is followed by a hash of the id: a hot text is spread over ranges.

Defined results: null or empty text is the end id alone; repeated rows are
packed each; rows without id are packed too; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import codecs
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers.pre_tokenizers import WhitespaceSplit

from tokenloom.llm.common import batches_of, per_process, released, small, table, write_scratch

TOKENIZER = "word_bpe_49k.json"
LENGTH = 2048
END_ID = 1
DIMS, BITS = 4, 8
SAMPLE, SAMPLE_PER_RANGE = 5_000, 10
RANGE_BYTES = 128 << 20
MEMO = 1 << 15
SEEN_BYTES = 64
AT_ONCE = 1 << 13
TEXT_BYTES = 2 << 20
BATCH = "4m"
SEED = 77
_END = np.array([END_ID], dtype="<u4").tobytes()


#: Words of one or more letters, ASCII in lower case or Latin-1, composed.
_LETTERS = r"^[a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+$"


def _by_byte(spelt: dict[int, str]) -> str | None:
    """What each UTF-8 byte of words of letters becomes, in lower case, if the model sees bytes; else None."""
    if {len(s) for s in spelt.values()} != {2} or len({s[0] for s in spelt.values()}) > 1:
        return None
    to = [chr(b) if b < 0x80 else "\ufffe" for b in range(0x100)]  # U+FFFE: an error
    for c, s in spelt.items():
        to[0xC3], to[c - 0x40] = s  # U+00C0 to U+00FF are 0xC3 and the last six bits with 0x80
        if c > 0xDF and c != 0xFF:  # the upper-case letter stands 0x20 before
            to[c - 0x60] = s[1]
    return "".join(to)


class WordIds(dict):
    """uint32 ids, as bytes, of each distinct white-space word; at most 2 x MEMO are remembered, and 2 x MEMO in ``seen``.

    The tokenizer's pre-tokenizer splits at white space, and between a letter
    and the punctuation after it, and its normalizer changes no character
    across these; so a text's ids are those of its parts one after another (a
    test compares whole texts). ``of`` takes the words of many texts at once, as
    columns; those it has seen are kept as columns too (``seen``), the model takes
    up to AT_ONCE new words of letters in a call, and only other new words are
    looked up one by one. Words are keyed with A-Z in lower case, as the normalizer
    would make them. The tokenizer's added strings are cut out of the text before
    (``added``), in their own spelling only; a word that becomes one of them in
    lower case is ordinary text, so words are encoded by ``ordinary``.
    """

    # punctuation other than the apostrophe, and the end of a word before it that is cut there: a letter (ASCII or Latin-1)
    _marks = b".,;:!?#$%&*|)"
    _letter = re.compile(rb"[a-z]|\xc3[\xa0-\xb6\xb8-\xbf]")

    # a word of ASCII and Latin-1 letters, composed: one piece, which only has to be put in lower case
    _latin = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.old, self._ordinary = tokenizer, tokenizer.model, {}, None
        added = {t.content.encode(): i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.added = {t: np.array([i], dtype="<u4").tobytes() for t, i in added.items()}
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, sorted(added, key=len, reverse=True))) + b")") if added else None
        letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
        self.spelt = {ord(c): tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}  # as the model sees it
        self.spelling = _by_byte(self.spelt)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.letters = type(tokenizer)(self.model)  # shares the model: words of letters, as the model sees them, with spaces between
        self.letters.pre_tokenizer = WhitespaceSplit()
        mark = self.model.end_of_word_suffix
        names = map(tokenizer.id_to_token, range(tokenizer.get_vocab_size()))
        self.last = np.array([bool(mark) and (t or "").endswith(mark) for t in names])  # ids that end a word
        self.seen = pa.array([], pa.string())  # words of the texts before, with their uses, number of ids and ids
        self.seen_uses, self.seen_sizes = np.zeros(0, dtype=np.float32), np.zeros(0, dtype=np.int64)
        self.seen_ids = np.zeros(0, dtype="<u4")

    def ordinary(self):
        """A second tokenizer, made when first asked for, to which the added strings are ordinary text."""
        if self._ordinary is None:
            self._ordinary = type(self.tokenizer).from_str(self.tokenizer.to_str())
            self._ordinary.encode_special_tokens = True
        return self._ordinary

    def __missing__(self, word: bytes) -> bytes:
        if word[-1] in self._marks:  # not remembered itself: its two parts are
            stem = word.rstrip(self._marks)
            if 97 <= (stem[-1] if stem else 0) <= 122 or self._letter.fullmatch(stem[-2:]):
                return self[stem] + self[word[len(stem):]]
        ids = self.old.get(word)
        if ids is not None:
            return self._remember(word, ids)
        if word.isalpha():  # of ASCII letters: neither normalizer nor pre-tokenizer has anything to do
            raw = [t.id for t in self.model.tokenize(word.decode())]
        elif self._latin.fullmatch(word):
            raw = [t.id for t in self.model.tokenize(word.decode().lower().translate(self.spelt))]
        else:
            tokenizer = self.ordinary() if any(t in word for t in self.added) else self.tokenizer
            raw = tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids
        return self._remember(word, np.array(raw, dtype="<u4").tobytes())

    def _remember(self, word: bytes, ids: bytes) -> bytes:
        if len(self) >= MEMO:  # the words of this generation stay at hand during the next
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def of(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each word among some distinct ones, and the ids of these: all, and how many each has.

        The distinct words are those in ``seen``, then the new ones. Arrow finds them, and no word of letters is an
        object of Python."""
        had = len(self.seen)
        coded = pa.concat_arrays([self.seen, words]).dictionary_encode()
        which, distinct = np.asarray(coded.indices)[had:], coded.dictionary
        ids, sizes = self.seen_ids, self.seen_sizes
        if len(distinct) > had:
            new_ids, new_sizes = self._new(distinct.slice(had))
            ids, sizes = np.concatenate([ids, new_ids]), np.concatenate([sizes, new_sizes])
            uses = np.bincount(which, minlength=len(distinct)).astype(np.float32)
            uses[:had] += self.seen_uses / 2
            self._see(distinct, ids, sizes, uses, min(2 * MEMO, len(words)))
        return which, ids, sizes

    def _see(self, words: pa.StringArray, ids: np.ndarray, sizes: np.ndarray, uses: np.ndarray, most: int) -> None:
        """Keep the most used of these words, older uses counting less; long words are not kept.

        They are no more than the words of a run, so that going through them costs less than the run."""
        keep = np.flatnonzero(np.asarray(pc.binary_length(words)) <= SEEN_BYTES)
        if len(keep) > most:
            keep = np.sort(keep[np.argpartition(uses[keep], len(keep) - most)[len(keep) - most:]])
        self.seen, self.seen_uses, self.seen_sizes = words.take(pa.array(keep)), uses[keep], sizes[keep]
        self.seen_ids = ids[_spans((np.cumsum(sizes) - sizes)[keep], self.seen_sizes)]

    def _new(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, one word after another, and how many each has; the empty word has none."""
        plain = np.array(pc.match_substring_regex(words, _LETTERS).to_numpy(zero_copy_only=False))
        found, sizes = np.zeros(0, dtype="<u4"), np.zeros(len(words), dtype=np.int64)
        if plain.any():
            letters = words.filter(pa.array(plain))
            found = np.concatenate([self._letters(letters.slice(at, AT_ONCE)) for at in range(0, len(letters), AT_ONCE)])
            ends = np.flatnonzero(self.last[found]) + 1
            if len(ends) == np.count_nonzero(plain):
                sizes[plain] = np.diff(ends, prepend=0)
            else:  # a model that doesn't mark the ends of words
                plain[:], found = False, found[:0]
        if plain.all():
            return found, sizes
        others = [self[w] if w else b"" for w in _joined(words.filter(pa.array(~plain))).split(b" ")]
        sizes[~plain] = np.fromiter(map(len, others), np.int64, len(others)) >> 2
        ids, of_letters = np.empty(sizes.sum(), dtype="<u4"), np.repeat(plain, sizes)
        ids[of_letters] = found
        ids[~of_letters] = np.frombuffer(b"".join(others), dtype="<u4")
        return ids, sizes

    def _letters(self, words: pa.StringArray) -> np.ndarray:
        """The ids of words of letters, one word after another, in one call."""
        words = _joined(words)  # next, as the model sees them
        spelt = codecs.charmap_decode(words, "strict", self.spelling)[0] if self.spelling else words.decode().lower().translate(self.spelt)
        return np.array(self.letters.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, dtype="<u4")


def _joined(words: pa.Array) -> bytes:
    """Words with spaces between."""
    words = words.view(pa.binary())
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(whole, b" ")[0].as_py()


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each start and the places after it, as many as its size."""
    upto = np.cumsum(sizes)
    places = np.repeat(starts - (upto - sizes), sizes)
    places += np.arange(len(places))
    return places


def load_tokenizer(path: str | None = None) -> WordIds:
    """The tokenizer at ``path`` and the ids of words it has seen."""
    from tokenizers import Tokenizer
    path = path or public_tokenizers.path(TOKENIZER)

    return per_process(f"word ids of {path}", lambda: WordIds(Tokenizer.from_file(path)))


def token_ids(text: bytes | None, memo: WordIds) -> np.ndarray:
    """Ids of a text and the end id."""
    text, ids = text or b"", []
    parts = memo.cut.split(text) if memo.cut and any(t in text for t in memo.added) else [text]
    for i, part in enumerate(parts):
        if i % 2:
            ids.append(memo.added[part])
        else:
            ids.extend(map(memo.__getitem__, part.lower().split()))
    return np.frombuffer(b"".join([*ids, _END]), dtype="<u4")


#: A letter or digit and the marks after it that end the word: the pre-tokenizer cuts between them.
_MARKED = r"([0-9a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}])([.,;:!?#$%&*|)]+)([\x20\x09-\x0D]|$)"


def _runs(texts: pa.Array):
    """(from, to) of even runs of these texts: of TEXT_BYTES, and the rest of the text that ends there, at most."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    size = int(upto[-1]) if len(upto) else 0
    n = -(-size // TEXT_BYTES)
    ends = np.searchsorted(upto, size * np.arange(1, n) / n) + 1 if n else []
    ends = np.unique(np.append(ends, len(upto)).astype(np.int64)).tolist()
    return ((at, end) for at, end in zip([0, *ends], ends) if at < end)


def in_runs(batches, column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about TEXT_BYTES of the texts in this column, or fewer."""
    for b in batches:
        for at, end in _runs(b.column(column)):
            yield b.slice(at, end - at)


def all_token_ids(texts: pa.Array, memo: WordIds) -> list[np.ndarray]:
    """``token_ids`` of each binary text: Arrow finds the distinct words, which are looked up once for many texts."""
    out: list[np.ndarray] = []
    for at, end in _runs(texts):
        run = pc.fill_null(texts.slice(at, end - at), b"")
        odd = np.zeros(len(run), dtype=bool)  # with added strings
        for t in memo.added:
            odd |= pc.match_substring(run, t.decode()).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), b"", run) if odd.any() else run
        parts = pc.ascii_split_whitespace(pc.replace_substring_regex(
            pc.ascii_lower(plain.view(pa.string())), _MARKED, r"\1 \2\3"))
        which, ids, sizes = memo.of(parts.values)
        times = sizes[which]  # ids of each word of the texts
        ends = np.concatenate([[0], np.cumsum(times)])[np.asarray(parts.offsets)]
        ended = np.insert(ids[_spans((np.cumsum(sizes) - sizes)[which], times)], ends[1:], END_ID).astype("<u4", copy=False)
        ends += np.arange(len(ends))
        got = [ended[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        for i in np.flatnonzero(odd).tolist():
            got[i] = token_ids(run[i].as_py(), memo)
        out += got
    return out


def directions(buckets: int = 1 << 16) -> np.ndarray:
    """DIMS rows: the random direction of each hashed token id, by dimension."""
    return np.random.default_rng(SEED).standard_normal((DIMS, buckets)).astype(np.float32)


def project(ids: np.ndarray, dirs: np.ndarray) -> list[float]:
    """Few-dimensional projection of the hashed bag of token ids."""
    at = (ids & (dirs.shape[1] - 1)).astype(np.int64)
    return [float(d.take(at).sum()) / len(ids) ** 0.5 for d in dirs]


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert key of integer cells (n x dims), each below 2**bits."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # from coordinates to the transposed key
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def cell(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Number of the quantile interval of each coordinate."""
    return np.stack([np.searchsorted(cuts[d], points[:, d]) for d in range(points.shape[1])], axis=1)


def _ids_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(doc_id), F.col(text)).alias("h"), F.col(text).cast("binary").alias("t"))


def _projector(path: str | None):
    """(doc_id, h, t) -> (h, coordinates): for the sample."""
    def run(batches):
        memo, dirs = load_tokenizer(path), directions()
        for b in in_runs(batches, 2):
            pts = np.array([project(ids, dirs) for ids in all_token_ids(b.column(2), memo)], dtype=np.float32).reshape(-1, DIMS)
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array(pts[:, d]) for d in range(DIMS))],
                                             names=["h", *(f"x{d}" for d in range(DIMS))])
    return run


def _keyer(path: str | None, cuts: np.ndarray, ends: np.ndarray):
    """(doc_id, h, t) -> (range, key, doc_id, n, ids as uint16 or uint32 bytes)."""
    def run(batches):
        memo, dirs = load_tokenizer(path), directions()
        for b in in_runs(batches, 2):
            ids = all_token_ids(b.column(2), memo)
            pts = np.array([project(i, dirs) for i in ids], dtype=np.float32).reshape(-1, DIMS)
            key = (hilbert(cell(pts, cuts)) << 31) | (np.asarray(b.column(1)) & 0x7FFFFFFF)
            where = np.searchsorted(ends, key, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(where), pa.array(key), b.column(0), pa.array([len(i) for i in ids], pa.int64()),
                 pa.array([_pack(i) for i in ids], pa.binary())], names=["range", "key", "doc_id", "n", "ids"])
    return lambda batches: released(run(batches))


def _pack(ids: np.ndarray) -> bytes:
    """uint16 where all ids fit, else uint32; the length tells which."""
    return (ids.astype("<u2") if ids.max() < 1 << 16 else ids.astype("<u4")).tobytes()


def _unpack(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n else "<u4").astype("<u4")


def _pieces(length: int, with_ids: bool):
    """(doc_id, n, place on the curve, ids) -> one row per piece."""
    def run(batches):
        for b in small(batches):
            out: list[list] = [[] for _ in range(8)]
            for doc, n, at, raw in zip(*(c.to_pylist() for c in b.columns)):
                ids, start = _unpack(raw, n), 0
                while start < n:
                    offset = (at + start) % length
                    size = min(n - start, length - offset)
                    piece = ids[start:start + size].tobytes()
                    for o, v in zip(out, (doc, start, size, zlib.crc32(piece), n, (at + start) // length, offset,
                                          piece if with_ids else None)):
                        o.append(v)
                    start += size
            yield pa.RecordBatch.from_arrays([*(pa.array(o, pa.int64()) for o in out[:7]), pa.array(out[7], pa.binary())],
                                             names=[c.split()[0] for c in PIECES.split(", ")])
    return lambda batches: released(run(batches))


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, doc_id: str = "doc_id",
         text: str = "text", ranges: int | None = None, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document in a sequence; ``ids``: its uint32 ids, if asked for.

    ``tokenizer``: path of a tokenizer file that every executor can open.
    """
    spark = docs.sparkSession
    rows = _ids_of(docs, doc_id, text)
    whole = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)).alias("size")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or max(partitions, -(-whole["size"] // RANGE_BYTES))
    most = max(SAMPLE, ranges * SAMPLE_PER_RANGE)
    share = min(1.0, 0.9 * most / max(whole["n"], 1))
    near = "h long, " + ", ".join(f"x{d} float" for d in range(DIMS))
    pick = F.xxhash64("h", F.lit(SEED))
    sample = (rows.filter(F.pmod(pick, F.lit(1 << 40)) < int(share * (1 << 40)) + 1)
              .mapInArrow(_projector(tokenizer), near).orderBy(pick, "h").limit(most).toPandas())
    points = sample[[f"x{d}" for d in range(DIMS)]].to_numpy(dtype=np.float32).reshape(-1, DIMS)
    shares = np.arange(1, 1 << BITS) / (1 << BITS)
    cuts = np.quantile(points, shares, axis=0).T if len(points) else np.zeros((DIMS, len(shares)))
    keys = np.sort((hilbert(cell(points, cuts)) << 31) | (sample["h"].to_numpy(dtype=np.int64) & 0x7FFFFFFF))
    ends = keys[np.arange(1, ranges) * len(keys) // ranges] if len(keys) else np.zeros(0, dtype=np.int64)
    keyed = rows.mapInArrow(_keyer(tokenizer, cuts, ends), "range int, key long, doc_id long, n long, ids binary")
    if ranges > partitions:
        keyed = keyed.repartition(ranges, "range")
    order = Window.partitionBy("range").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    with batches_of(spark, BATCH):
        placed = write_scratch(keyed.withColumn("upto", F.sum("n").over(order)), "pack-ids")
    before, at = [], 0
    for r in placed.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():
        before.append((r["range"], at))
        at += r["n"]
    base = spark.createDataFrame(before, "r int, first long")  # one row per range: bounded by ``ranges``
    located = placed.join(F.broadcast(base), placed["range"] == base["r"]).select(
        "doc_id", "n", (F.col("first") + F.col("upto") - F.col("n")).alias("at"), "ids")
    out = located.mapInArrow(_pieces(length, with_ids), PIECES)
    return out if with_ids else out.drop("ids")


def op3_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)
