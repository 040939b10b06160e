"""Embedding near-dedup by product quantisation over coarse inverted lists.

Equal vectors are folded into one representative with a count. A coarse
quantiser (k-means on a bounded sample) gives every representative a home list;
its residual is coded in ``SUBSPACES`` subspaces of 256 words.

Which lists are compared follows from a bound, not from a count: a vector at
home in ``h`` can only link with one at home in ``c`` if the plane half-way
between the two centres lies within the link radius of it, as the other one is
beyond that plane: ``d(q,c)^2 - d(q,h)^2 <= 2 d(h,c) radius``. So no link is
lost, whatever the number of lists. Neighbouring lists form blocks of at most
``TILE_VALUES`` numbers (a larger list is cut by a hash of the id), and a tile
of two blocks gets those vectors of each that reach a list of the other.

In a tile, asymmetric table lookups give the distance to the decoded vector,
which is exact up to the coding error stored with it; the filter ``distance <=
radius + error`` loses no pair, and the pairs it lets through are decided by
exact cosine in double precision. Pairs are not emitted: a tile returns, per
vector, its number of links and the least id it is connected with there; these
stars give the components.

The result equals brute force (tests/llm). The price is paid where the bound
excludes little: on vectors without clusters nearly all blocks meet, and the
work and the copies of the vectors grow with the square of the table and with
the number of blocks. ``SAMPLE_ROWS``/``SAMPLE_BYTES`` bound the fitting and
``MAX_LISTS`` the lists.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component links with nothing, as do rows without id; vectors of
different lengths do not link; repeated rows count as links of each other; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.llm.common import sorted_groups, table, write_scratch
from tokenloom.llm.components import connected_components

COSINE = 0.9
RADIUS = np.sqrt(2 - 2 * COSINE)
LIST = 256
MAX_LISTS = 4096
SUBSPACES = 8
WORDS = 256
TILE_VALUES = 1 << 19
MAX_TILE = 8192
CHUNK = 256
SAMPLE_ROWS = 16_384
SAMPLE_BYTES = 64 << 20
SEED = 5


def _parse(batches):
    """(id, embedding) -> (id, dim, ekey, vec): dim 0 and nulls for vectors that cannot link."""
    for b in batches:
        col = b.column(1)
        kind = "<f4" if pa.types.is_float32(col.type.value_type) else "<f8"
        values = np.asarray(col.values.cast(pa.float64())).astype(kind)
        offsets, absent = np.asarray(col.offsets), np.asarray(col.is_null())
        dims, keys, vecs = [], [], []
        for i in range(len(col)):
            v = values[offsets[i]:offsets[i + 1]]
            if absent[i] or not len(v) or not np.isfinite(v).all() or not v.any():
                dims.append(0)
                keys.append(None)
                vecs.append(None)
                continue
            raw = v.tobytes()
            dims.append(len(v))
            vecs.append(raw)
            keys.append(hashlib.md5(raw).digest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()),
                                          pa.array(vecs, pa.binary())], names=["id", "dim", "ekey", "vec"])


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors in double precision."""
    kind = "<f4" if raw and len(raw[0]) == 4 * dim else "<f8"
    v = np.frombuffer(b"".join(raw), dtype=kind).reshape(-1, dim).astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _nearness(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return x @ centres.T - (centres * centres).sum(axis=1) / 2


def kmeans(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearness(x, centres).argmax(axis=1)
        n = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def fit(sample: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(coarse centres, words of the residual codes per subspace) for ``n`` vectors."""
    rng = np.random.default_rng(SEED)
    centres = kmeans(sample, max(1, min(MAX_LISTS, n // LIST)), 8, rng)
    residual = sample - centres[_nearness(sample, centres).argmax(axis=1)]
    k = min(WORDS, max(1, len(sample) // 4))
    return centres, [kmeans(residual[:, a:z], k, 6, rng) for a, z in subspaces(sample.shape[1])]


def subspaces(dim: int) -> list[tuple[int, int]]:
    return [(int(a[0]), int(a[-1]) + 1) for a in np.array_split(np.arange(dim), min(SUBSPACES, dim))]


class Index:
    """Coarse centres and, per subspace, the words of the residual codes."""

    def __init__(self, centres: np.ndarray, words: list[np.ndarray]):
        self.centres, self.words, self.dim = centres, words, centres.shape[1]
        self.cuts = subspaces(self.dim)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to all centres."""
        return (x * x).sum(axis=1, keepdims=True) - 2 * _nearness(x, self.centres)

    def reach(self, x: np.ndarray, home: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        """Whether a vector within the radius may be at home in a list; ``gaps``: distances between the centres."""
        d = self.distances(x)
        return d - d[np.arange(len(x)), home][:, None] <= 2 * RADIUS * gaps[home] + 1e-9

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, length of the coding error) of vectors in their home lists."""
        r = x - self.centres[home]
        codes = np.stack([_nearness(r[:, a:z], w).argmax(axis=1) for (a, z), w in zip(self.cuts, self.words)], axis=1)
        left = np.concatenate([r[:, a:z] - w[codes[:, s]] for s, ((a, z), w) in enumerate(zip(self.cuts, self.words))], axis=1)
        return codes.astype(np.uint8), np.sqrt((left * left).sum(axis=1))

    def offsets(self, home: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What a decoded member adds to its squared distance from any vector, besides that of its centre."""
        add = np.zeros(len(codes))
        for s, ((a, z), w) in enumerate(zip(self.cuts, self.words)):
            got = w[codes[:, s]]
            add += (got * (got + 2 * self.centres[home, a:z])).sum(axis=1)
        return add

    def lookup(self, x: np.ndarray, home: np.ndarray, codes: np.ndarray, add: np.ndarray) -> np.ndarray:
        """Squared distances (members x vectors) of vectors to decoded members, by table lookups."""
        d = np.ascontiguousarray(self.distances(x).T, dtype=np.float32)[home]
        d += add.astype(np.float32)[:, None]
        for s, ((a, z), w) in enumerate(zip(self.cuts, self.words)):
            d += (-2 * (w @ x[:, a:z].T)).astype(np.float32)[codes[:, s]]
        return d


def _gaps(centres: np.ndarray) -> np.ndarray:
    square = (centres * centres).sum(axis=1)
    return np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * centres @ centres.T, 0))


def blocks(sizes: np.ndarray, gaps: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell of each list, first block of each cell, blocks of each cell): lists near each other share a cell."""
    cell, first, count = np.zeros(len(sizes), dtype=np.int64), [], []
    open_, at, held = np.ones(len(sizes), dtype=bool), 0, 0
    for _ in range(len(sizes)):
        open_[at] = False
        if not first or held + sizes[at] > tile:
            first.append(first[-1] + count[-1] if first else 0)
            count.append(1)
            held = 0
        held += sizes[at]
        count[-1] = max(1, -(-int(held) // tile))
        cell[at] = len(first) - 1
        at = int(np.where(open_, gaps[at], np.inf).argmin())
    return cell, np.array(first), np.array(count)


def _assign(index):
    """(id, w, vec) -> with home list, codes and coding error."""
    def run(batches):
        ix = Index(*index.value)
        for b in batches:
            x = unit(b.column(2).to_pylist(), ix.dim)
            home = _nearness(x, ix.centres).argmax(axis=1)
            codes, err = ix.encode(x, home)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(home.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()),
                                              pa.array(err)], names=["id", "w", "vec", "home", "code", "err"])
    return run


def _deal(index, cell, first, count):
    """(id, w, vec, home, code, err, part) -> one row per tile (i, j), i <= j, of the vector's block and one it reaches."""
    order = np.argsort(cell, kind="stable")
    starts = np.flatnonzero(np.diff(cell[order], prepend=-1))
    cell_of = np.repeat(np.arange(len(count)), count)  # of each block

    def run(batches):
        ix = Index(*index.value)
        gaps = _gaps(ix.centres)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                b = batch.slice(at, CHUNK)
                home, part = np.asarray(b.column(3)), np.asarray(b.column(6))
                reach = ix.reach(unit(b.column(2).to_pylist(), ix.dim), home, gaps)
                met = np.logical_or.reduceat(reach[:, order], starts, axis=1)
                own = first[cell[home]] + part % count[cell[home]]
                row, other = np.nonzero(met[:, cell_of])
                i, j = np.minimum(own[row], other), np.maximum(own[row], other)
                rows = b.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array((own[row] != i).astype(np.int32)), *rows.columns[:6]],
                                                 names=["i", "j", "side", "id", "w", "vec", "home", "code", "err"])
    return run


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (least node of each component) after nodes ``a`` and ``b`` are linked."""
    a, b = label[a], label[b]
    at = np.arange(len(label))
    while True:
        new = at.copy()
        np.minimum.at(new, a, at[b])
        np.minimum.at(new, b, new[a])
        new = new[new]
        if (new == at).all():
            return new[label]
        at = new


def _compare(index):
    """Tiles (i, j | side, id, w, vec, home, code, err) -> (id, links, comp)."""
    def run(batches):
        ix = Index(*index.value)
        for (i, j), rows in sorted_groups(batches, 2):
            rows = rows.take(pa.array(np.argsort(np.asarray(rows.column("id")), kind="stable")))
            side, ids, w, home, err = (np.asarray(rows.column(c)) for c in ("side", "id", "w", "home", "err"))
            q, m = (np.arange(len(ids)),) * 2 if i == j else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
            if not len(q) or not len(m):
                continue
            x = unit(rows.column("vec").to_pylist(), ix.dim)
            codes = np.frombuffer(b"".join(rows.column("code").take(pa.array(m)).to_pylist()), dtype=np.uint8).reshape(len(m), -1)
            add, far = ix.offsets(home[m], codes), ((RADIUS + err[m]) ** 2 + 1e-4).astype(np.float32)
            links, label = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
            for s in range(0, len(q), CHUNK):
                part = q[s:s + CHUNK]
                near = ix.lookup(x[part], home[m], codes, add) <= far[:, None]
                near &= (ids[m][:, None] > ids[part]) if i == j else (ids[m][:, None] != ids[part])
                some = np.flatnonzero(near.any(axis=1))
                if not len(some):
                    continue
                mm, near = m[some], near[some]
                cos = x[mm] @ x[part].T
                ok = near & (cos >= COSINE)
                r, c = np.nonzero(near & (np.abs(cos - COSINE) < 1e-12))  # the same sum, whatever the tile
                ok[r, c] = (x[mm[r]] * x[part[c]]).sum(axis=1) >= COSINE
                links[part] += w[mm] @ ok
                links[mm] += ok @ w[part]
                r, c = np.nonzero(ok & (label[mm][:, None] != label[part]))
                if len(r):
                    label = _joined(label, mm[r], part[c])
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(links[hit]), pa.array(ids[label[hit]])],
                                             names=["id", "links", "comp"])
    return run


def _links(reps: DataFrame, dim: int, n: int) -> DataFrame:
    """(id, links, comp) of the representatives of one length."""
    spark = reps.sparkSession
    want = max(WORDS, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    share = int(1_000_000 * min(1.0, 0.9 * want / n)) + 1
    raw = [r["vec"] for r in reps.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share).select("vec").limit(want).collect()]
    if not raw:
        raw = [r["vec"] for r in reps.select("vec").limit(want).collect()]
    index = spark.sparkContext.broadcast(fit(unit([bytes(r) for r in raw], dim), n))  # at most MAX_LISTS centres
    base = write_scratch(reps.select("id", "w", "vec").mapInArrow(
        _assign(index), "id long, w long, vec binary, home int, code binary, err double"), "pq-coded")
    centres = index.value[0]
    sizes = np.zeros(len(centres), dtype=np.int64)
    for r in base.groupBy("home").count().collect():  # at most MAX_LISTS rows
        sizes[r["home"]] = r["count"]
    dealt = blocks(sizes, _gaps(centres), max(CHUNK, min(MAX_TILE, TILE_VALUES // dim)))
    own = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30))
    return (base.withColumn("part", own)
            .mapInArrow(_deal(index, *dealt), "i long, j long, side int, id long, w long, vec binary, home int, code binary, err double")
            .repartition("i", "j").sortWithinPartitions("i", "j")
            .mapInArrow(_compare(index), "id long, links long, comp long"))


def embedding_links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row."""
    parsed = write_scratch(vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("e"))
                           .mapInArrow(_parse, "id long, dim int, ekey binary, vec binary"), "pq-parsed")
    reps = write_scratch(parsed.filter((F.col("dim") > 0) & F.col("id").isNotNull())
                         .groupBy("dim", "ekey", "vec").agg(F.min("id").alias("id"), F.count("*").alias("w")), "pq-reps")
    found = None
    for r in reps.groupBy("dim").count().collect():  # one index per vector length
        links = _links(reps.filter(F.col("dim") == r["dim"]), r["dim"], r["count"])
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "id long, links long, comp long")
    tiles = write_scratch(found, "pq-links")
    comps = connected_components(tiles.select(F.col("id").alias("u"), F.col("comp").alias("v")))
    total = tiles.groupBy("id").agg(F.sum("links").alias("links"))
    placed = (reps.select("ekey", "dim", "id", "w").join(total, "id", "left").join(comps, "id", "left")
              .select(F.col("ekey"), F.col("dim"), (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
                      F.coalesce("component", "id").alias("c")))
    out = parsed.select("id", "dim", "ekey").join(placed, ["dim", "ekey"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("c", "id"))
    return out.select(F.col("id").alias("vec_id"), F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op1_embedding_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
