"""The prefix trie against plain Python dictionaries."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tokenloom.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth string, ends string, shard string, a string"


def brute(rows):
    by_conv = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            by_conv[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in by_conv.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        built[c] = turns.get(first, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in kids
            saved[n[:d]] += (len(who) - 1) * words
    return Counter(
        (min(who), len(n), min(members[n[:-1]]) if n else None, len(who), kids[n], leaves[n], saved[n],
         hashlib.sha256(",".join(str(c) for c in sorted(who) if len(built[c]) == len(n)).encode()).hexdigest())
        for n, who in members.items())


def rows_of(df):
    return Counter(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256").collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = []
    for c in [*range(-25, 90), 10 ** 15 + 3, 2 ** 62]:
        for turn in range(rng.randrange(1, 7)):
            out.append((c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(["yes", "no no", "  ", "a b c"])))
    for c in range(200, 330):  # a third of all conversations begin alike
        out += [(c, t, "user", f"hot turn {t}") for t in range(rng.randrange(1, 4))]
    out += [(400, None, "user", "null turn"), (400, 0, None, None), (400, 0, "user", "tie"), (400, 0, "user", "tie"),
            (400, 0, "assistant", "tie"), (401, 5, "user", "")]
    out += [(402, t, "user", "long " * 300) for t in range(400)]  # over bands; so is its double
    out += [(403, t, "user", "long " * 300) for t in range(390)]
    out += [(None, 0, "user", "no conversation")] * 3
    return [(*r, "x", "y", "z", "w") for r in out]


def trie(conversations):
    return P.prefix_trie(*P.rebuilt(P.write_scratch(P.ordered_turns(conversations), "trie-ordered")))


def test_equals_brute_force(spark, rows, monkeypatch):
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert rows_of(trie(df)) == want
    monkeypatch.setattr(P, "SHARD", 16)
    monkeypatch.setattr(P, "BAND", 8)
    # smaller shards and bands: other bitsets, same trie
    assert rows_of(trie(df)) == want


def test_random_small(spark):
    rng = random.Random(21)
    rows = [(c, t, rng.choice("ua"), rng.choice("xyz"), None, None, None, None)
            for c in rng.sample(range(-200, 200), 120) for t in range(rng.randrange(1, 6))]
    assert rows_of(trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table(spark):
    out = trie(spark.createDataFrame([], SCHEMA))
    assert out.collect() == []


def test_query_reads_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(P.op13_prefix_trie(spark, sf)) == brute(rows)
