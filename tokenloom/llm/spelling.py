"""Spelling variants: the vocabulary composed with a one-edit transducer and itself.

Two words are near if one inserted, deleted or replaced code point turns one
into the other. The minimised acceptor of the vocabulary, composed with the
transducer that copies all code points but one edit, and with the acceptor
again, accepts exactly these pairs. Before the edit both acceptors read the same
code points, so they stand in one state p; at the edit they take the arcs c and
d (replacement) or only one of them moves on (insertion); then both must read
the same rest, which is the intersection of two right languages, kept per pair
of states: minimised acceptors have few.

The composition is cut into partitions by its initial states. For each length m
of the shorter word, the place of the edit lies in one of two windows, the first
or the second half; the words that agree outside the window (equal beginnings and
equal ends) form one partition, an acceptor of their middles. A pair is
enumerated in the window that holds the end of its longest common prefix, so
exactly once. Partitions of more than ``GROUP_CHARS`` code points, or of middles
longer than ``GROUP_WIDTH``, are cut again by halving their window: rows of such
partitions double, and a window of one place holds at most as many words as the
alphabet has code points (and pairs of them). So no partition grows with the
vocabulary, no pairs of a whole group are tried, and nothing is dropped.

A partition returns one row per word: how many near words it found and the best
of them. Words are numbered in code-point order, so forms and roots are found on
numbers; roots follow by pointer doubling.

Defined results: null or empty text has no words; a row without id hashes the
run after an empty id; repeated rows count again; very long runs are words like
others; an empty table gives no word; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.llm.common import CRC_TABLE_SQL, crc32_sql, small, sorted_groups, table, write_scratch

LEAST_LENGTH, LEAST_COUNT, TWICE = 5, 3, 2
GARBLED = 97
GROUP_CHARS, GROUP_WIDTH = 1 << 14, 128
HELD_WORDS = 1 << 17
MAX_ROUNDS = 64
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)  # a maximal run: shorter ones give no word


def _runs(batches):
    """(doc_id as text, text) -> (word, n): a task's words, flushed when it holds many."""
    held: Counter = Counter()

    def flush():
        words = list(held)
        batch = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())],
                                           names=["word", "n"])
        held.clear()
        return batch

    for b in small(batches):
        for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
            if not text.is_valid:
                continue
            base = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            low = text.as_py().lower().decode("utf-8", "replace")  # bytes: A-Z only
            for word, n in Counter(_RUN.findall(low)).items():
                h = zlib.crc32(word.encode(), base)
                if h % GARBLED == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
                    if len(word) < LEAST_LENGTH:
                        continue
                held[word] += n
            if len(held) >= HELD_WORDS:
                yield flush()
    if held:
        yield flush()


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(wid, word, n): words frequent enough, numbered in code-point order."""
    counted = (docs.select(F.col(doc_id).cast("string"), F.col(text).cast("binary"))
               .mapInArrow(_runs, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
               .filter(F.col("n") >= LEAST_COUNT))
    return write_scratch(write_scratch(counted, "spell-counts").orderBy("word").select(
        F.monotonically_increasing_id().alias("wid"), "word", "n"), "spell-words")


def minimised(words: list[str]) -> tuple[list, int]:
    """The minimal acceptor of sorted, distinct words: its states and the initial one.

    A state is (final, {code point: state}, lengths of its rests)."""
    states, known = [], {}
    path = [[False, []]]  # states of the last word that may still get arcs
    last = ""

    def close(node) -> int:
        key = (node[0], tuple(node[1]))
        at = known.get(key)
        if at is None:
            at = known[key] = len(states)
            rests = {1 + r for _, s in node[1] for r in states[s][2]}
            states.append((node[0], dict(node[1]), frozenset(rests | {0} if node[0] else rests)))
        return at

    def shrink(depth: int):
        while len(path) - 1 > depth:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], close(node)))

    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        shrink(same)
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        last = word
    shrink(0)
    return states, close(path[0])


def near_pairs(words: list[str], width: int, places: int):
    """Pairs of the words, one edit apart, whose common prefix is shorter than ``places``.

    ``words``: sorted and distinct, of ``width`` or ``width + 1`` code points; a
    pair has at least one word of ``width``, and comes once.
    """
    states, initial = minimised(words)
    shared: dict = {}

    def rests(p: int, q: int, length: int) -> list[str]:
        """What both states accept, of one length."""
        if length not in states[p][2] or length not in states[q][2]:
            return []
        if length == 0:
            return [""]
        got = shared.get((p, q, length))
        if got is None:
            arcs, others = states[p][1], states[q][1]
            got = shared[p, q, length] = [c + rest for c, to in arcs.items() if c in others
                                          for rest in rests(to, others[c], length - 1)]
        return got

    waiting = [("", initial)]
    while waiting:
        read, p = waiting.pop()
        arcs, left = states[p][1], width - len(read)
        if len(read) < places:
            for c, d in combinations(arcs, 2):
                for rest in rests(arcs[c], arcs[d], left - 1):
                    yield read + c + rest, read + d + rest
            for d, to in arcs.items():
                for rest in rests(p, to, left):
                    if not rest.startswith(d):
                        yield read + rest, read + d + rest
        waiting.extend((read + c, to) for c, to in arcs.items())


def _enumerate(batches):
    """Partitions (m, a, b, k1, k2; middle, wid, n) -> (wid, n_near, form_n, form): best near word and how many."""
    for (m, a, b, _, _), rows in sorted_groups(batches, 5):
        if rows.num_rows < 2:
            continue
        of = dict(zip(rows.column(5).to_pylist(), zip(rows.column(6).to_pylist(), rows.column(7).to_pylist())))
        found: dict = {}
        for x, y in near_pairs(sorted(of), min(b, m) - a, b - a):
            for (wid, _), (other, n) in ((of[x], of[y]), (of[y], of[x])):
                had = found.get(wid)
                if had is None:
                    found[wid] = [1, n, other]
                else:
                    had[0] += 1
                    if n > had[1] or n == had[1] and other < had[2]:
                        had[1:] = n, other
        if found:
            cols = [list(found), *zip(*found.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["wid", "n_near", "form_n", "form"])


_KEYS = ("m", "a", "b", "k1", "k2")


def _partitions(words: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows (m, a, b) of words -> with the hash of what lies outside the window and the middle inside."""
    size = F.length("word")
    after = F.greatest(F.col("m") - F.col("b"), F.lit(0))
    head, tail = F.col("word").substr(F.lit(1), F.col("a")), F.right(F.col("word"), after)
    return windows.select("m", "a", "b", F.xxhash64(head, tail).alias("k1"), F.xxhash64(F.lit(5), tail, F.lit(3), head).alias("k2"),
                          F.col("word").substr(F.col("a") + 1, size - F.col("a") - after).alias("middle"), "wid", "n", "word")


def _halves(rows: DataFrame) -> DataFrame:
    """Each window (a, b) cut in two."""
    mid = F.expr("(a + b) div 2").cast("int")
    cuts = F.array(F.struct(F.col("a").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b").alias("b")))
    return rows.select("m", "wid", "n", "word", F.explode(cuts).alias("w")).select("m", "w.a", "w.b", "wid", "n", "word")


def near_words(words: DataFrame) -> DataFrame:
    """(wid, n_near, form_n, form) for every word that has a near one; ``words``: (wid, word, n)."""
    size = F.length("word")
    whole = words.select(F.explode(F.filter(F.array(size, size - 1), lambda m: m >= LEAST_LENGTH)).alias("m"),
                         F.lit(0).alias("a"), "wid", "n", "word").withColumn("b", F.col("m") + 1)
    rows = _partitions(words, _halves(whole))
    found = []
    for _ in range(MAX_ROUNDS):
        sizes = rows.groupBy(*_KEYS).agg(F.count("*").alias("size"), F.sum(F.length("middle")).alias("chars"))
        big = write_scratch(sizes.filter((F.col("size") > 1) & (F.col("b") - F.col("a") > 1) &
                                         ((F.col("chars") > GROUP_CHARS) | (F.col("b") - F.col("a") > GROUP_WIDTH)))
                            .select(*_KEYS), "spell-big")
        more = not big.isEmpty()
        fit = rows.join(big, list(_KEYS), "left_anti") if more else rows
        found.append(fit.select(*_KEYS, "middle", "wid", "n").repartition(*_KEYS).sortWithinPartitions(*_KEYS)
                     .mapInArrow(_enumerate, "wid long, n_near long, form_n long, form long"))
        if not more:
            break
        cut = rows.join(big, list(_KEYS), "left_semi")
        rows = write_scratch(_partitions(words, _halves(cut)), "spell-cut")
    else:
        raise RuntimeError("windows did not become small")
    parts = found[0]
    for f in found[1:]:
        parts = parts.unionByName(f)
    best = F.max(F.struct("form_n", (-F.col("form")).alias("less")))  # most frequent, then first in code-point order
    return write_scratch(parts.groupBy("wid").agg(F.sum("n_near").alias("n_near"), best.alias("x"))
                         .select("wid", "n_near", F.col("x.form_n").alias("form_n"), (-F.col("x.less")).alias("form")), "spell-near")


def roots(links: DataFrame) -> DataFrame:
    """(wid, form) -> (wid, root): forms followed to the last; the counts rise along them, so there is a last."""
    state = write_scratch(links.select("wid", F.col("form").alias("root")), "spell-roots")
    for _ in range(MAX_ROUNDS):
        ahead = state.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        moved = state.join(ahead, "root", "left")
        if moved.filter(F.col("next").isNotNull()).isEmpty():
            return state
        state = write_scratch(moved.select("wid", F.coalesce("next", "root").alias("root")), "spell-roots")
    raise RuntimeError("forms run in a circle")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word of the vocabulary."""
    words = vocabulary(docs, doc_id, text)
    near = near_words(words)
    fits = near.join(words.select("wid", "n"), "wid").filter(F.col("form_n") >= TWICE * F.col("n"))
    links = write_scratch(fits.select("wid", "form", "form_n"), "spell-links")
    spelt = lambda name: words.select(F.col("wid").alias(f"{name}_id"), F.col("word").alias(name))
    formed = (links.withColumnRenamed("form", "form_id").join(roots(links).withColumnRenamed("root", "root_id"), "wid")
              .join(spelt("form"), "form_id").join(spelt("root"), "root_id").select("wid", "form", "root", "form_n"))
    return (words.join(near.select("wid", "n_near"), "wid", "left").join(formed, "wid", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def oracle() -> str:
    """The same result in DuckDB SQL: near words are found by what is left when one code point goes."""
    octets = (r"flatten(list_transform(string_split(s, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] "
              r"ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))")
    return rf"""
WITH RECURSIVE crc AS ({CRC_TABLE_SQL}),
runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT w, c, {crc32_sql(octets, "t")} AS h
  FROM (SELECT w, c, concat(doc_id, ':', w) AS s FROM runs WHERE length(w) >= {LEAST_LENGTH}), crc),
word AS (
  SELECT CASE WHEN h % {GARBLED} = 0 THEN concat(left(w, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS word,
    sum(c)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {LEAST_LENGTH} AND sum(c) >= {LEAST_COUNT}),
gone AS (
  SELECT word, n, i, concat(left(word, i - 1), substr(word, i + 1)) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
pair AS (
  SELECT x.word, y.word AS other, y.n AS m FROM gone x JOIN gone y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM gone x JOIN word y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM gone x JOIN word y ON x.rest = y.word),
near AS (
  SELECT word, count(*) AS n_near, max(m) AS m, min(other) FILTER (WHERE m = top) AS other
  FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM pair) GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {TWICE} * n THEN other END AS form,
    CASE WHEN m >= {TWICE} * n THEN m END AS form_n FROM word w LEFT JOIN near USING (word)),
walk AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL SELECT k.word, k.next, f.form FROM walk k JOIN formed f ON k.next = f.word)
SELECT f.word, form, k.at AS root, n, n_near, form_n
FROM formed f JOIN walk k ON f.word = k.word AND k.next IS NULL
"""
