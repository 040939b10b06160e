"""Conversation prefix trie from vertical bitmaps.

Conversations that begin with the same turns share nodes of a trie. They are
numbered in the order of their ids and cut into shards of ``SHARD``
consecutive ones, and their turns into bands of ``BAND`` positions. One group of
rows is one band of one shard: at most ``SHARD * BAND`` narrow rows (hashes, no
texts), whatever one conversation or one first turn may hold. In a group

* an index maps (position, turn) to the bitset of the shard's conversations
  that have that turn there;
* a depth-first walk intersects a parent's bitset with the postings of the next
  position: the lowest conversation not yet covered names the posting, the
  intersection is the child, and its bits are covered. So there are as many
  intersections as children;
* a child's popcount, its lowest conversation and the bitset of those that end
  there are its row; a band starts from the nodes that its conversations stand
  on, known by the sum of their turn hashes before it.

The shards' rows of a node meet in one grouped sum that combines before it is
shuffled. A node's end list is the shards' lists in order of the shards; its
digest is fed by one row per shard, so no list is ever held whole. Sums over a
subtree double their reach each round (a node's partial sum also goes to the
ancestor at distance 1, 2, 4, ...), so rounds grow with the logarithm of the
depth.

Turns are known by 128 bits of hash, and nodes by two sums, modulo 2^62, of
hashes of (position, turn): that any two of 10^10 nodes collide has a
probability below 10^-16.

Turns are numbered without a window over a conversation: rows are range-sorted
by conversation and turn, and a row's number follows from its place in its
range and the counts of the ranges before it. So one conversation may hold most
of all turns; only rows that share conversation and turn number meet in a task.

Defined results: turns are ordered by turn number, null first, then by role and
text; null role or text is empty; equal rows are turns each; rows without
conversation id belong to no conversation and are left out; an empty table gives
no node; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tokenloom.llm.common import CRC_TABLE_SQL, crc32_sql, sorted_groups, table, word_count, write_scratch

SHARD = 1024
BAND = 128
FAMILY = 20
MAX_DEPTH_BITS = 40
EMPTY = hashlib.sha256(b"").hexdigest()
_PARTS = ("shard long, depth long, a long, b long, up_a long, up_b long, conv_id long, n_convs long, words long, "
          "ends array<long>")


def head_length(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 4).cast("long")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, nth, a, b, words): turns numbered from 0, known by two hashes."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    placed = write_scratch(
        narrow.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
        .select("conv_id", F.monotonically_increasing_id().alias("place"), F.spark_partition_id().alias("part"),
                F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(7), "text", F.lit(11), "role").alias("b"),
                word_count(F.col("text")).alias("words")), "trie-placed")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    spans = (placed.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
             .select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")))
    return placed.join(spans, ["conv_id", "part"]).select(
        "conv_id", (F.col("place") + F.col("shift")).alias("nth"), "a", "b", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from their family's first one.

    (conv_id, len) per conversation, and (conv_id, at, a, b, words) per rebuilt turn.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    own = own.withColumn("first", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", head_length(F.col("conv_id")))
    held = own.select(F.col("conv_id").alias("first"), F.col("own").alias("lent"))
    convs = write_scratch(
        own.join(held, "first", "left").withColumn("taken", F.least("h", F.coalesce("lent", F.lit(0))))
        .select("conv_id", "first", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len")),
        "trie-convs")
    heads = turns.filter(F.col("nth") < 3).withColumnRenamed("conv_id", "first")
    taken = (convs.filter("taken > 0").select("conv_id", "first", "taken").join(heads, "first")  # 3 turns, 39 takers at most
             .filter(F.col("nth") < F.col("taken")).select("conv_id", F.col("nth").alias("at"), "a", "b", "words"))
    kept = (turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter(F.col("nth") >= F.col("h"))
            .select("conv_id", (F.col("nth") - F.col("h") + F.col("taken")).alias("at"), "a", "b", "words"))
    return convs.select("conv_id", "len"), taken.unionByName(kept)


def _step(at: Column, h: Column, salt: int) -> Column:
    """63 bits of a turn at its place; their sum, modulo 2^62, is a node's name."""
    return F.shiftrightunsigned(F.xxhash64(h, at, F.lit(salt)), 1)


def _wrapped(x: Column) -> Column:
    """A decimal sum of such parts, modulo 2^62."""
    return F.pmod(x, F.lit(1 << 62).cast("decimal(38,0)")).cast("long")


def _walk(batches):
    """Rows of one (shard, band), sorted -> the band's nodes in that shard.

    In: shard, band, at (-1: the conversation itself), local, conv_id, len, entry
    names (a, b), the turn's hashes, the turn's part of the names, words.
    """
    for (shard, band), rows in sorted_groups(batches, 2):
        at, local, conv, length, ea, eb, ta, tb, sa, sb, words = (np.asarray(rows.column(i)).tolist() for i in range(2, 13))
        conv_of, len_of = {}, {}
        postings: dict = defaultdict(int)          # (position, turn) -> bitset of conversations
        turn_at: dict = defaultdict(dict)          # position -> conversation -> row
        entering: dict = defaultdict(int)          # name of the node a band starts from -> bitset
        longer: dict = defaultdict(int)            # length -> bitset of those that end there
        for r in range(len(at)):
            bit = 1 << local[r]
            if local[r] not in conv_of:
                conv_of[local[r]], len_of[local[r]] = conv[r], length[r]
                longer[length[r]] |= bit
                entering[ea[r], eb[r]] |= bit
            if at[r] >= 0:
                postings[at[r], ta[r], tb[r]] |= bit
                turn_at[at[r]][local[r]] = r

        def ends(bits: int, depth: int) -> list[int]:
            bits, out = bits & longer[depth], []
            while bits:
                low = bits & -bits
                out.append(conv_of[low.bit_length() - 1])
                bits ^= low
            return out

        def first(bits: int) -> int:
            return (bits & -bits).bit_length() - 1

        start, out = band * BAND, []
        stack = []
        for (a, b), bits in entering.items():
            stack.append((bits, start, a, b))
            if band == 0:
                out.append((shard, 0, a, b, None, None, conv_of[first(bits)], bits.bit_count(), 0, ends(bits, 0)))
        while stack:
            bits, depth, a, b = stack.pop()
            if depth == start + BAND:
                continue
            rest = bits & ~longer[depth]
            while rest:
                r = turn_at[depth][first(rest)]
                child = bits & postings[depth, ta[r], tb[r]]
                rest &= ~child
                name = (a + sa[r]) & ((1 << 62) - 1), (b + sb[r]) & ((1 << 62) - 1)
                out.append((shard, depth + 1, *name, a, b, conv_of[first(child)], child.bit_count(), words[r],
                            ends(child, depth + 1)))
                stack.append((child, depth + 1, *name))
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in cols[:9]), pa.array(cols[9], pa.list_(pa.int64()))],
                names=[f.split()[0] for f in _PARTS.split(", ")])


def _digests(batches):
    """(depth, a, b, shard, ends) in this order -> the digest of each node's whole end list."""
    node, state = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in node] + [pa.array([state.hexdigest()])],
                                          names=["depth", "a", "b", "sha"])

    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
        for key, ids in zip(keys, batch.column(4)):
            if key != node:
                if node is not None:
                    yield done()
                node, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(",".join(map(str, ids.as_py())).encode())
    if node is not None:
        yield done()


def shard_nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of each shard, walked band by band."""
    numbered = write_scratch(convs.orderBy("conv_id").withColumn("__at", F.monotonically_increasing_id())
                             .select("conv_id", "len", F.expr(f"`__at` div {SHARD}").alias("shard"),
                                     (F.col("__at") % SHARD).alias("local")), "trie-shards")
    parts = write_scratch(turns.select("conv_id", "at", "a", "b", "words", F.expr(f"at div {BAND}").alias("band"),
                                       _step(F.col("at"), F.col("a"), 1).alias("sa"),
                                       _step(F.col("at"), F.col("b"), 2).alias("sb")), "trie-turns")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    entry = (parts.groupBy("conv_id", "band").agg(wide("sa").alias("x"), wide("sb").alias("y"))
             .select("conv_id", "band", *[F.coalesce(_wrapped(F.sum(c).over(before)), F.lit(0)).alias(f"e{c}") for c in "xy"]))
    zero = F.lit(0).cast("long")
    walked = (parts.join(entry, ["conv_id", "band"]).join(numbered, "conv_id")
              .select("shard", "band", "at", "local", "conv_id", "len", "ex", "ey", "a", "b", "sa", "sb", "words"))
    heads = numbered.select("shard", zero.alias("band"), F.lit(-1).cast("long").alias("at"), "local", "conv_id", "len",
                            *[zero.alias(c) for c in ("ex", "ey", "a", "b", "sa", "sb", "words")])
    return (walked.unionByName(heads).repartition("shard", "band").sortWithinPartitions("shard", "band")
            .mapInArrow(_walk, _PARTS))


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """(depth, a, b, n_leaves, saved) summed over each node and all below it."""
    key = ["depth", "a", "b"]
    state = write_scratch(nodes.select(
        *key, (F.col("depth") - 1).alias("up_depth"), "up_a", "up_b", F.col("leaf").alias("n_leaves"), "saved"), "trie-sums")
    for _ in range(MAX_DEPTH_BITS):
        linked = state.filter(F.col("up_a").isNotNull())
        if linked.isEmpty():
            return state.select(*key, "n_leaves", "saved")
        given = (linked.groupBy(F.col("up_depth").alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"))
                 .agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        above = state.filter(F.col("up_a").isNotNull()).select(
            F.col("depth").alias("up_depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
            F.col("up_depth").alias("d2"), F.col("up_a").alias("a2"), F.col("up_b").alias("b2"))
        state = write_scratch(
            state.join(given, key, "left").join(above, ["up_depth", "up_a", "up_b"], "left")
            .select(*key, F.col("d2").alias("up_depth"), F.col("a2").alias("up_a"), F.col("b2").alias("up_b"),
                    (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                    (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "trie-sums")
    raise RuntimeError(f"conversations of more than 2^{MAX_DEPTH_BITS} turns")


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations.

    ``convs``: (conv_id, len); ``turns``: (conv_id, at, a, b, words) with ``at`` from 0 to len - 1.
    """
    key = ["depth", "a", "b"]
    parts = write_scratch(shard_nodes(convs, turns), "trie-parts")
    nodes = write_scratch(parts.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("words").alias("words"),
        F.first("up_a").alias("up_a"), F.first("up_b").alias("up_b")), "trie-nodes")
    children = (nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"))
                .agg(F.count("*").alias("n_children")))
    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
                          F.col("conv_id").alias("parent_conv_id"))
    full = write_scratch(
        nodes.join(children, key, "left").join(parent, ["depth", "up_a", "up_b"], "left")
        .select(*key, "up_a", "up_b", "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
                ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie-full")
    sums = _subtree_sums(full)
    shas = (parts.filter(F.size("ends") > 0).select(*key, "shard", "ends").repartition(*key)
            .sortWithinPartitions(*key, "shard").mapInArrow(_digests, "depth long, a long, b long, sha string"))
    return (full.drop("saved").join(sums, key).join(shas, key, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = write_scratch(ordered_turns(table(spark, sf_dir, "conversations")), "trie-ordered")
    return prefix_trie(*rebuilt(turns))


def oracle() -> str:
    """The same result in DuckDB SQL, where a node is the string of its turns' digests."""
    return rf"""
WITH crc AS ({CRC_TABLE_SQL}),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS nth,
    md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS m,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, n, conv_id - conv_id % {FAMILY} AS first,
    {crc32_sql("list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)", "t")} % 4 AS h
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id), crc),
convs AS (
  SELECT o.conv_id, o.first, o.h, least(o.h, coalesce(f.n, 0)) AS taken,
    least(o.h, coalesce(f.n, 0)) + greatest(o.n - o.h, 0) AS len
  FROM own o LEFT JOIN own f ON o.first = f.conv_id),
seq AS (
  SELECT c.conv_id, t.nth AS pos, m, words FROM convs c JOIN turns t ON c.first = t.conv_id AND t.nth < c.taken
  UNION ALL
  SELECT c.conv_id, t.nth - c.h + c.taken, m, words FROM convs c JOIN turns t ON c.conv_id = t.conv_id AND t.nth >= c.h),
member AS (
  SELECT conv_id, 0 AS depth, '' AS p, 0 AS words, len FROM convs
  UNION ALL
  SELECT conv_id, pos + 1, string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY pos), words, len FROM seq JOIN convs USING (conv_id)),
node AS (
  SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len = depth) AS ends
  FROM member GROUP BY depth, p),
kids AS (SELECT depth - 1 AS depth, p[:32 * (depth - 1)] AS p, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
fam AS (SELECT node.*, n_children FROM node LEFT JOIN kids ON node.depth = kids.depth AND node.p = kids.p),
sums AS (
  SELECT g AS depth, p[:32 * g] AS p, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves,
    sum((n_convs - 1) * words) AS saved
  FROM (SELECT fam.*, unnest(range(depth + 1)) AS g FROM fam) GROUP BY 1, 2)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n.n_children, 0) AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM fam n JOIN sums s ON n.depth = s.depth AND n.p = s.p
LEFT JOIN node u ON n.depth > 0 AND u.depth = n.depth - 1 AND u.p = n.p[:32 * (n.depth - 1)]
"""
