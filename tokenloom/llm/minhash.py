"""MinHash near-dedup: universal hash minima, banding, verification, components.

Texts with equal shingle sets are folded into one representative first, so a
group of copies costs one signature row. Each representative gets 128 minima
of universal hash functions over its shingle hashes, cut into 32 bands of 4. At
similarity 0.75 a pair shares no band with probability 5.3e-6, and its estimate
falls below ``SURE`` (fewer than 71 of 128 equal minima) with probability 4.8e-7:
together at most 5.8e-6, and less for more similar pairs.

Candidates are verified in two passes and never emitted as all pairs of a
bucket:

1. every member of a bucket against the bucket's least id (linear in the
   members), by signature and then on full shingle sets; the links found are
   joined into components;
2. in buckets whose members still lie in different components, members are
   compared by signature in tiles of two blocks of ``BLOCK``; tiles that hold a
   pair of different components whose estimate leaves 0.75 possible get the
   texts of its members, decide such pairs on full sets and return stars. A
   pair is compared in the first band it shares only.

A pair inside one component need not be verified: it cannot change the result.

Defined results: null, empty or blank text has no shingles and links with
nothing; fewer than five words make one shingle of the whole sequence; equal
texts are linked; repeated rows are returned each; a row without id takes the
component of equal texts that have one, else null, and is then kept. Rows that
share an id are one node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.llm.common import drop_scratch, might_hold, small, sorted_groups, table, unused_prefix, write_scratch
from tokenloom.llm.components import connected_components

WORDS = 5
PERCENT = 75
MINIMA, ROWS = 128, 4
BANDS = MINIMA // ROWS
SURE = 0.55  # pairs with a lower estimate are not compared on full sets (its loss: see above)
BLOCK = 512
CHUNK = 1 << 15

_rng = np.random.default_rng(20240601)
MULT = _rng.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
ADD = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
POSITION = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    w = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not w:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))
    k = min(WORDS, len(w))
    n = len(w) - k + 1
    s = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        s += h[i:i + n] * POSITION[i]
    s = np.sort(_mix(s))
    return s[np.concatenate(([True], s[1:] != s[:-1]))]


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures (len(sets) x MINIMA, uint32) of non-empty sets."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), MINIMA), dtype=np.uint32)
    buf = np.empty_like(x)
    for i in range(MINIMA):
        np.multiply(x, MULT[i], out=buf)
        np.add(buf, ADD[i], out=buf)
        out[:, i] = np.minimum.reduceat(buf, starts)
    return out


def _sign(batches):
    """(id, th, text binary) -> (id, th, n, fp, sig)."""
    for b in small(batches):
        ids, th = b.column(0), b.column(1)
        n, fp, sig = [], [], []
        waiting: list[np.ndarray] = []
        size = 0

        def flush():
            nonlocal size
            if waiting:
                sig.extend(r.tobytes() for r in minima(waiting))
                waiting.clear()
                size = 0

        for t in b.column(2):
            s = shingle_hashes(t.as_py() or b"")
            n.append(len(s))
            if not len(s):
                flush()
                fp.append(None)
                sig.append(None)
                continue
            fp.append(hashlib.md5(s.tobytes()).digest())
            waiting.append(s)
            size += len(s)
            if size >= CHUNK:
                flush()
        flush()
        yield pa.RecordBatch.from_arrays(
            [ids, th, pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sig, pa.binary())],
            names=["id", "th", "n", "fp", "sig"])


def _bands(batches):
    """(id, sig) -> one row per band: (band hash, band number, id)."""
    for b in batches:
        ids = np.asarray(b.column(0))
        s = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint32).reshape(len(ids), BANDS, ROWS)
        h = np.zeros((len(ids), BANDS), dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
        for r in range(ROWS):
            h = _mix(h + (s[:, :, r].astype(np.uint64) + np.uint64(1)) * POSITION[r])
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64).ravel()), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(ids))),
             pa.array(np.repeat(ids, BANDS))], names=["band", "k", "id"])


def text_key(text: Column) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, th, n, fp, sig): set size, fingerprint of the set and minima, per row."""
    return (docs.select(F.col(doc_id).cast("long").alias("id"), text_key(F.col(text)).alias("th"),
                        F.col(text).cast("binary").alias("t"))
            .mapInArrow(_sign, "id long, th long, n long, fp binary, sig binary"))


def _shingles(t: bytes | None) -> set:
    w = (t or b"").lower().split()
    return set(zip(*(w[i:] for i in range(WORDS)))) if len(w) >= WORDS else {tuple(w)} if w else set()


def _linked(x: set, y: set) -> bool:
    both = len(x & y)
    return bool(x and y) and 100 * both >= PERCENT * (len(x) + len(y) - both)


def _similar(batches):
    """(a, b, ta, tb) -> (u, v) where the full shingle sets are similar enough."""
    last: dict = {}

    def shingles(key, t):
        if key not in last:
            if len(last) >= 16:
                last.clear()
            last[key] = _shingles(t)
        return last[key]

    for batch in small(batches):
        out = [(a, b) for a, b, ha, hb, ta, tb in zip(*(c.to_pylist() for c in batch.columns))
               if _linked(shingles((a, ha), ta), shingles((b, hb), tb))]
        yield _edges(out)


def _edges(pairs: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
                                      names=["u", "v"])


def texts_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts (id, th, t) of some ids; most others are dropped before the shuffle."""
    need = ids.select("id").distinct()
    return write_scratch(texts.filter(might_hold(need, "id")).join(need, "id", "left_semi"), "mh-texts")


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full texts are similar, as written (u, v). texts: (id, th, t binary)."""
    held = texts_of(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))), texts)
    left = held.select(F.col("id").alias("a"), F.col("th").alias("ha"), F.col("t").alias("ta"))
    right = held.select(F.col("id").alias("b"), F.col("th").alias("hb"), F.col("t").alias("tb"))
    links = write_scratch(pairs.join(right, "b").join(left, "a").select("a", "b", "ha", "hb", "ta", "tb")
                          .mapInArrow(_similar, "u long, v long"), "mh-verified")
    drop_scratch(held)
    return links


def _possible(n1: Column, n2: Column) -> Column:
    return 100 * F.least(n1, n2) >= PERCENT * F.greatest(n1, n2)


def _agree(batches):
    """(a, b, sa, sb) -> pairs whose signatures leave the similarity possible."""
    for batch in batches:
        a = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint32).reshape(-1, MINIMA)
        b = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint32).reshape(-1, MINIMA)
        ok = pa.array((a == b).mean(axis=1) >= SURE)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])


def _candidates(k: int, i: int, j: int, rows: pa.RecordBatch):
    """Per member of block i the members of block j that may be similar, lie in another component and share no earlier band."""
    ids, label, n, blk, lead = (np.asarray(rows.column(c)) for c in ("id", "label", "n", "blk", "lead"))
    sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), dtype=np.uint32).reshape(len(ids), MINIMA)
    right = np.flatnonzero((blk == j) & (ids != lead))  # the first pass compared the least id with all
    for r in np.flatnonzero((blk == i) & (ids != lead)):
        c = right[(label[right] != label[r])
                  & (100 * np.minimum(n[right], n[r]) >= PERCENT * np.maximum(n[right], n[r]))]
        if i == j:
            c = c[ids[c] > ids[r]]
        if len(c):
            same = sig[c] == sig[r]
            sure = same.mean(axis=1) >= SURE
            first = same[sure].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
            c = c[sure][first == k]
        if len(c):
            yield int(r), c.tolist()


def _busy(batches):
    """The members of a tile that have a candidate there."""
    for (_, k, i, j), rows in sorted_groups(batches, 4):
        used = sorted({x for r, c in _candidates(k, i, j, rows) for x in (r, *c)})
        if used:
            yield rows.take(pa.array(used))


def _tile_links(batches):
    """Stars (u, v) of the linked members of a tile, decided on full shingle sets."""
    for (_, k, i, j), rows in sorted_groups(batches, 4):
        ids, text = rows.column("id").to_pylist(), rows.column("t")
        hashed: dict = {}
        root = list(range(len(ids)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def hashes(x: int) -> np.ndarray:
            if x not in hashed:
                hashed[x] = shingle_hashes(text[x].as_py() or b"")
            return hashed[x]

        for r, near in _candidates(k, i, j, rows):
            for c in near:
                if find(r) == find(c):
                    continue
                x, y = hashes(r), hashes(c)
                both = len(x) + len(y) - len(np.union1d(x, y))
                if (100 * both >= PERCENT * (len(x) + len(y) - both)
                        and _linked(_shingles(text[r].as_py()), _shingles(text[c].as_py()))):
                    a, b = sorted((find(r), find(c)), key=lambda x: ids[x])
                    root[b] = a
        yield _edges([(ids[x], ids[find(x)]) for x in range(len(ids)) if find(x) != x])


def _mixed_links(bands: DataFrame, buckets: DataFrame, reps: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Second pass: links between components that meet in a bucket (of two, the first pass compared all)."""
    named = (bands.join(buckets.filter(F.col("size") > 2), "band").join(labels, "id", "left")
             .withColumn("label", F.coalesce("component", "id")).drop("component"))
    mixed = (named.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y"))
             .filter(F.col("x") != F.col("y")).select("band"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    member = (named.join(mixed, "band", "left_semi").join(reps.select("id", "n", "sig"), "id")
              .withColumn("blk", F.pmod(F.xxhash64("id"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other")))
    keys = ("band", "k", "i", "j")
    columns = "band long, k int, i int, j int, id long, label long, n long, blk int, lead long, sig binary"
    busy = write_scratch(member.select(*keys, "id", "label", "n", "blk", "lead", "sig").repartition(*keys)
                         .sortWithinPartitions(*keys).mapInArrow(_busy, columns), "mh-busy")
    held = texts_of(busy, texts)
    links = write_scratch(busy.join(held.select("id", "t"), "id").select(*busy.columns, "t")
                          .repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_tile_links, "u long, v long"), "mh-links")
    drop_scratch(busy, held)
    return links


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, th, n_shingles, component_id, kept), one row per input row."""
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), text_key(F.col(text)).alias("th"),
                        F.col(text).cast("binary").alias("t"))
    full = write_scratch(signatures(docs, doc_id, text), "mh-full")
    reps = write_scratch(full.filter((F.col("n") > 0) & F.col("id").isNotNull())
                         .groupBy("fp", "n", "sig").agg(F.min("id").alias("id")), "mh-reps")
    signed = write_scratch(full.drop("sig"), "mh-signed")
    drop_scratch(full)
    bands = write_scratch(reps.select("id", "sig").mapInArrow(_bands, "band long, k int, id long"), "mh-bands")
    buckets = write_scratch(bands.groupBy("band").agg(F.min("id").alias("lead"), F.max("id").alias("end"),
                                                      F.count("*").alias("size"))
                            .filter(F.col("lead") != F.col("end")).drop("end"), "mh-buckets")
    starred = (bands.join(buckets, "band").filter(F.col("id") != F.col("lead"))
               .select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct())
    one = reps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    two = reps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    likely = write_scratch(starred.join(two, "b").join(one, "a").filter(_possible(F.col("na"), F.col("nb")))
                           .select("a", "b", "sa", "sb").mapInArrow(_agree, "a long, b long"), "mh-likely")
    similar = verify(likely, texts)
    first = connected_components(similar).select("id", "component")
    drop_scratch(likely, similar)
    more = _mixed_links(bands, buckets, reps, first, texts)
    drop_scratch(bands, buckets)
    label = first.select(F.col("id").alias("x"), "component")
    links = (more.join(label, more["u"] == label["x"], "left").select(F.coalesce("component", "u").alias("u"), "v")
             .join(label, F.col("v") == label["x"], "left").select("u", F.coalesce("component", "v").alias("v")))
    second = connected_components(links).select(F.col("id").alias("y"), F.col("component").alias("lower"))
    placed = (reps.select("fp", F.col("id").alias("rep"))
              .join(label, F.col("rep") == F.col("x"), "left")
              .withColumn("mid", F.coalesce("component", "rep"))
              .join(second, F.col("mid") == F.col("y"), "left")
              .select("fp", F.coalesce("lower", "mid").alias("component_id")))
    out = signed.select("id", "th", "n", "fp").join(placed, "fp", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias("doc_id"), "th", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      (component.isNull() | F.coalesce(F.col("id") == component, F.lit(False))).alias("kept"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of which one per group of near duplicates stays; repeated rows once.

    Whole texts are shuffled once, to meet the keys that stay. Only rows whose
    key (id and text) repeats are shuffled again, to leave one of each.
    """
    p = unused_prefix(docs.columns)
    verdicts = write_scratch(near_duplicates(docs, doc_id, text).filter("kept").groupBy("doc_id", "th")
                             .agg((F.count("*") > 1).alias("many")), "mh-verdicts")
    keyed = docs.withColumn(f"{p}id", F.col(doc_id).cast("long")).withColumn(f"{p}th", text_key(F.col(text)))

    def having(keys: DataFrame) -> DataFrame:
        return keyed.join(keys, keyed[f"{p}id"].eqNullSafe(keys[f"{p}k"]) & (keyed[f"{p}th"] == keys[f"{p}t"]), "left_semi")

    keys = verdicts.select(F.col("doc_id").alias(f"{p}k"), F.col("th").alias(f"{p}t"), F.col("many").alias(f"{p}many"))
    repeated = keys.filter(f"{p}many")
    if repeated.isEmpty():
        return having(keys).select(*docs.columns)
    once = having(keys.filter(~F.col(f"{p}many")))
    twice = having(repeated).dropDuplicates([f"{p}id", f"{p}th"])
    return once.unionByName(twice).select(*docs.columns)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
