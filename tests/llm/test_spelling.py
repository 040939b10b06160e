"""Spelling variants against comparison of all words with all."""

import random
import re
import zlib
from collections import Counter

import pytest

from tokenloom.llm import spelling as S

SCHEMA = "doc_id long, text string, word string, n string, form string"


def near(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    x, y = sorted((x, y), key=len)
    return any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def brute(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    partners = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, ps in partners.items():
        best = min(ps, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return Counter((w, form[w], root(w), n[w], len(partners[w]), n[form[w]] if form[w] else None) for w in n)


def edited(rng, w, letters="abcé÷"):
    i = rng.randrange(len(w) + 1)
    return rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:]])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randrange(5, 11))) for _ in range(40)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "x" * 300, "x" * 299, "x" * 150 + "y" + "x" * 149]
    words = base + [edited(rng, w) for w in base for _ in range(4)]
    words += ["Prefix" + "".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]  # a hot beginning
    out = []
    for i in range(400):
        out.append((i, rng.choice([" ", "-", "1"]).join(
            (w.upper() if rng.random() < 0.1 else w) for w in rng.choices(words, k=40))))
    out += [(1000, None), (1001, ""), (1002, "1 2 3 -"), (None, "aaaaa ababab " * 5), (1003, "z" * 40000 + " again")]
    out += [(1004, "same row words")] * 50
    out += [(1005 + i, "z" * 40000 + " " + "z" * 39999) for i in range(3)]  # very long, one edit apart
    return out


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return Counter(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(6)


def test_equals_all_pairs(spark, rows):
    want = brute(rows)
    assert sum(1 for w in want if w[1]) > 50 and any(w[1] != w[2] and w[1] for w in want)
    assert rows_of(S.spelling_variants(frame(spark, rows))) == want


def test_partitions_cut_again(spark, rows, monkeypatch):
    monkeypatch.setattr(S, "GROUP_CHARS", 40)  # nearly every partition is halved, many down to one place
    monkeypatch.setattr(S, "GROUP_WIDTH", 4)
    short = [r for r in rows if len(r[1] or "") < 30000]
    assert rows_of(S.spelling_variants(frame(spark, short))) == brute(short)


def test_pairs_of_one_acceptor():
    rng = random.Random(6)
    for _ in range(200):
        width = rng.randrange(1, 6)
        words = sorted({"".join(rng.choice("ab") for _ in range(width + rng.randrange(2))) for _ in range(rng.randrange(1, 14))})
        got = Counter(frozenset(p) for p in S.near_pairs(words, width, width + 1))
        want = {frozenset((x, y)) for x in words for y in words if near(x, y) and min(len(x), len(y)) == width}
        assert got == Counter(want)
    states, start = S.minimised(["abcx", "abdx", "bbcx", "bbdx"])
    assert len(states) == 5  # minimal: the four words share their middles and ends
    assert states[start][2] == {4}


def test_empty_table(spark):
    assert rows_of(S.spelling_variants(spark.createDataFrame([], SCHEMA))) == Counter()
