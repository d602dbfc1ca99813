"""Connected components by star contraction: shuffles of edges only, nothing gathered by node. What is few edges, or has become
few, is settled on the driver, as every round costs some ten rounds of tasks however little they hold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import settled

#: Edges (16 bytes each) that the driver may hold.
DRIVER_EDGES = 250_000


def components_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted nodes of the edges (a, b), and for each the smallest node that edges reach."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends.reshape(2, -1)
    root = np.arange(len(nodes))
    while (open_ := root[x] != root[y]).any():
        x, y = x[open_], y[open_]
        np.minimum.at(root, np.maximum(root[x], root[y]), np.minimum(root[x], root[y]))  # a root under the smallest root beside it
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def connected_components(edges: DataFrame, rounds: int = 60, driver_edges: int = DRIVER_EDGES) -> DataFrame:
    """(node, component) of edges (a, b) of longs; the component is the smallest node that links reach.

    Each round points larger neighbours of a node, then the node and its smaller neighbours, at the smallest of them.
    Rows and their hash sum stop changing when every node points at its component. Node minima are map-side combined, and
    the joins that bring them back are plain equi-joins, which adaptive execution splits where a node is hot. Each round
    is checkpointed, so a lost executor costs one round at most. At most ``driver_edges`` edges reach the driver. Empty
    input gives no rows.
    """
    spark = edges.sparkSession
    state = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(rounds):
        n, h = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, h) == mark or not n:
            break
        if n <= driver_edges:
            told = state.select("a", "b").toArrow()
            nodes, found = components_of(told["a"].to_numpy(), told["b"].to_numpy())
            return spark.createDataFrame(pa.table({"node": nodes, "component": found}))
        mark = (n, h)
        # larger neighbours of each node go to the smallest one around it
        both = state.unionAll(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        wide = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # a node and its smaller neighbours go to the smallest of those
        low = wide.groupBy("a").agg(F.min("b").alias("m"))
        near = wide.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        state = settled(near.where("a <> b").distinct())
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(state.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
