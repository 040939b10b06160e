"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on narrow (u, v) rows; after each
the edges are written to the shared folder, so lineage stays short and no
component or edge list comes to the driver. A node with very many edges is one
key of a join whose other side has one row per node, which adaptive execution
splits; the grouped minima combine before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tokenloom.llm.common import drop_scratch, write_scratch

MAX_ROUNDS = 100


def _distinct(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v, each once."""
    return (edges.filter(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to the least of its neighbourhood."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
    return e.join(least, e["v"] == least["x"]).select("u", F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the least of these."""
    least = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m")
    lower = e.join(least, e["u"] == least["x"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v")))


def _state(e: DataFrame):
    return e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u long, v long) -> (id, component): the least id reachable, for every id in an edge."""
    e = write_scratch(_distinct(edges), "cc")
    state = _state(e)
    for _ in range(MAX_ROUNDS):
        if not state["n"]:
            break
        large = write_scratch(_distinct(_large_star(e)), "cc-large")
        last, e = e, write_scratch(_distinct(_small_star(large)), "cc")
        drop_scratch(last, large)
        before, state = state, _state(e)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
