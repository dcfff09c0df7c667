"""Connected components of a graph given as an edge table.

Plan. Rounds of contraction. In a round every node moves to the smallest of itself and its neighbours, edges are rewritten to where
their ends moved, and those that became loops or repetitions are dropped, so an edge that says nothing new is joined once and never
again. Rounds after the first compare nodes by salted bits, so that a chain shrinks by a constant part whatever the order of its ids.
As soon as at most ``finish`` edges are left, a number that does not grow with the graph, one task finds their components.
The moves are then composed from the last round back; each round's table is smaller than the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

FINISH = 1 << 17  # edges that one task takes: 2 MB


def components_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node reachable from each) of the edges (a, b)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for ends in (x, y, label[x], label[y]):
            np.minimum.at(new, ends, low)
        while (up := new[new]).tobytes() != new.tobytes():
            new = up
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        nodes, low = components_of(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(low)], names=["node", "comp"])


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def connected_components(edges: DataFrame, finish: int = FINISH) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b; long) that has another node as neighbour: comp is the smallest node reachable.

    Loops and repeated edges are fine; an edge with a null end is no edge; an empty table gives no rows. Joins are merge joins over
    exchanges that Spark can split when one node has very many edges; minima have partial aggregation. Each round's tables are checkpointed.
    """
    left, moves = saved(edges.select(*_ordered(F.col("a"), F.col("b"))).where("a < b").distinct()), []
    while left.count() > finish:
        salt = F.lit(0).cast("long") if not moves else F.xxhash64(F.lit(len(moves)))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = F.least(F.min(F.col("b").bitwiseXOR(salt)), F.first("a").bitwiseXOR(salt)).bitwiseXOR(salt)
        move = saved(both.groupBy(F.col("a").alias("node")).agg(low.alias("to")))
        for end in ("a", "b"):
            left = left.join(move.withColumnsRenamed({"node": end, "to": f"_{end}"}).hint("merge"), end).withColumn(end, F.col(f"_{end}")).drop(f"_{end}")
        left = saved(left.select(*_ordered(F.col("a"), F.col("b"))).where("a < b").distinct())
        moves.append(move)
    out = left.repartition(1).mapInArrow(_finished, "node long, comp long")
    for move in reversed(moves):
        ends = saved(out).select(F.col("node").alias("to"), "comp")
        out = move.join(ends.hint("merge"), "to", "left").select("node", F.coalesce("comp", "to").alias("comp"))
    out = saved(out)
    if len(moves) > 1:  # a salted round may have moved a component's smallest node
        low = saved(out.groupBy("comp").agg(F.min("node").alias("_low")))
        out = saved(out.join(low.hint("merge"), "comp").select("node", F.col("_low").alias("comp")))
    return out
