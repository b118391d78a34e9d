"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Scratch

#: Edges that one task joins in memory (16 bytes each); more are first contracted by stars.
FEW = 1 << 17


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all edges of a task, by halving paths to the least node."""
    table = pa.Table.from_batches(list(batches), pa.schema([("u", pa.int64()), ("v", pa.int64())]))
    u, v = table.column("u").to_numpy(), table.column("v").to_numpy()
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    up = np.arange(len(nodes))
    while True:
        low = np.minimum(up[a], up[b])
        new = up.copy()
        for side in (a, b):  # the roots of both ends go under the lower one
            np.minimum.at(new, up[side], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, up):
            break
        up = new
    yield pa.RecordBatch.from_pydict({"node": nodes.astype(np.int64), "component": nodes[up].astype(np.int64)})


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``edges`` (u, v).

    Each round is written to the shared folder, so lineage stays short. Groups
    are only ever reduced by ``min`` (partial sums before the shuffle) and
    joined (Spark splits skewed joins), so a hub of any degree is no problem. Up to
    FEW edges, a bounded amount, are joined by one task. Self-loops, nulls and repeated edges are allowed; an empty table gives an empty one.
    """
    edges = edges.where("u is not null and v is not null and u <> v").distinct()
    edges = scratch.store(edges, "edges")
    if edges.count() <= FEW:
        return edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).coalesce(1).mapInArrow(_joined, "node long, component long")
    before = None
    while True:
        after = scratch.store(_small_star(_large_star(edges)).where("u <> v").distinct(), "edges")
        scratch.drop(edges)
        edges = after
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            break
        before = mark
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
