"""Minimum bin slack: against one bin at a time, and as an exact round trip."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tokenloom.llm import bin_packing as B

SCHEMA = "doc_id long, text string, piece string, length string, sequence_id string, part string"


def test_fullest_equals_all_subsets():
    rng = random.Random(3)
    for _ in range(300):
        room = rng.randrange(0, 40)
        left = {s: rng.randrange(1, 4) for s in rng.sample(range(1, 30), rng.randrange(0, 6))}
        pool = [s for s, n in left.items() for _ in range(n)]
        best = max(s for r in range(len(pool) + 1) for c in itertools.combinations(pool, r) if (s := sum(c)) <= room)
        uses = B.fullest(room, sorted(left), left)
        assert sum(s * n for s, n in uses.items()) == best
        assert all(0 < n <= left[s] for s, n in uses.items())


def one_bin_at_a_time(sizes, length):
    """Each bin: the longest item left and the fullest combination of the others, found by plain enumeration of sums."""
    left, fills = Counter(sizes), []
    while left:
        longest = max(left)
        left -= Counter([longest])
        reach = {0: ()}
        for s in sorted(left.elements(), reverse=True):
            for t in [t for t in reach if t + s <= length - longest and t + s not in reach]:
                reach[t + s] = reach[t] + (s,)
        most = max(reach)
        left -= Counter(reach[most])
        fills.append(longest + most)
    return fills


def test_plan_places_every_piece_once():
    rng = random.Random(5)
    for length, n in ((10, 60), (37, 200), (64, 400)):
        sizes = [min(length, 1 + int(rng.expovariate(0.08))) for _ in range(n)] + [7] * n
        hist = Counter(sizes)
        rows = B.plan(hist, length)
        bins = defaultdict(list)
        for size, count in hist.items():
            mine = rows[rows[:, 0] == size]
            for nth in range(count):
                _, first, bin_, times, offset = mine[np.searchsorted(mine[:, 1], nth, side="right") - 1].tolist()
                bins[bin_ + (nth - first) // times].append((offset + (nth - first) % times * size, size))
        fills = []
        for held in bins.values():
            at = 0
            for offset, size in sorted(held):
                assert offset == at
                at += size
            assert at <= length
            fills.append(at)
        assert sorted(bins) == list(range(len(bins)))
        # as many bins as when they are made one at a time (equal sums may be made of other lengths)
        assert abs(len(one_bin_at_a_time(sizes, length)) - len(fills)) <= 1


def test_round_trip(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta,", "don't", "Größe", "x1"]) for _ in range(rng.randrange(0, 90))))
            for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "word " * 3000), (None, "no id"), (1004, "a <|endoftext|> b")]
    rows += [(1005, "the same row")] * 40
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(5)
    got = B.best_fit(docs, length=256).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for doc, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 256)):
            raw = np.array(ids[at:at + 256], dtype="<u4").tobytes()
            want[(doc, piece, at, len(raw) // 4, zlib.crc32(raw), raw)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= 256
    assert len(bins) == -(-sum(r.length for r in got) // 256)  # no fewer are possible


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    out = B.best_fit(none)
    assert out.collect() == [] and out.columns == [f.split()[0] for f in B.PLACED.split(", ")]


def test_whole_table_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = B.op12_min_bin_slack(spark, sf).collect()
    total = sum(r.length for r in rows)
    assert len({r.doc_id for r in rows}) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len({r.sequence_id for r in rows}) <= -(-total // 4096) + 1
