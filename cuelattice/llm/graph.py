"""Connected components by star contraction on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelattice.llm.common import materialise

#: More rounds than any chain needs: each at least halves the longest.
ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    r = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x"), F.coalesce(F.sum(F.xxhash64("v", "u") % 1_000_003), F.lit(0)).alias("s")).first()
    return tuple(r)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("m")), "least")
    # both sides are dealt for the join alone, so that the rows of a hub can be split
    return both.where("v > u").join(least, F.col("u") == F.col("node")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them."""
    least = materialise(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")), "least")
    across = edges.join(least, F.col("u") == F.col("node")).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return across.union(least.select(F.col("node").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of the edges (u, v); loops are ignored.

    Each round is written to the shared folder, so lineage stays short. Nodes with
    very many neighbours meet map-side minima and joins that adaptive execution
    splits, never one task.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = materialise(ordered, "edges")
    state = _state(now)
    for _ in range(ROUNDS):
        if not state[0]:
            break
        now = materialise(_small_star(materialise(_large_star(now), "edges")), "edges")
        last, state = state, _state(now)
        if state == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
