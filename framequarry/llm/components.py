"""Connected components of a graph given by its edges, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "to")), F.sum(F.xxhash64("to", "node") % 1000003)).first())


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component): the smallest node that can be reached, for each node that has an edge to another.

    Alternates two steps until nothing changes: every node's larger neighbours are tied to its smallest neighbour, then
    its smaller ones. The number of rounds grows with the logarithm of the longest path, no step brings the neighbours
    of a node together (a minimum per node is aggregated and joined back), and each round is a written table, so a
    lost executor costs one task. Null ends and loops are no edges. No edges: no rows.
    """
    a, b = F.col(src), F.col(dst)
    edges = stage(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("to")).distinct(),
        "edges",
    )
    before = None
    state = _state(edges)
    while state != before and state[0]:
        both = edges.unionByName(edges.select(F.col("to").alias("node"), F.col("node").alias("to")))
        lowest = both.groupBy("node").agg(F.min("to").alias("low")).select("node", F.least("node", "low").alias("low"))
        larger = both.join(lowest, "node").where(F.col("to") > F.col("node"))
        tied = larger.select(F.col("to").alias("node"), F.col("low").alias("to")).distinct()
        low = tied.groupBy("node").agg(F.min("to").alias("low"))
        smaller = tied.join(low, "node").select(F.explode(F.array(
            F.struct(F.col("node"), F.col("low").alias("to")), F.struct(F.col("to").alias("node"), F.col("low").alias("to")),
        )).alias("e")).select("e.*").where(F.col("node") != F.col("to")).distinct()
        edges, before = stage(smaller, "edges"), state
        state = _state(edges)
    roots = edges.select(F.col("to").alias("node")).distinct()
    return edges.select("node", F.col("to").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
