"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import discard, written

#: Edges that one task ties at once (16 bytes each); a larger graph takes rounds over the whole table.
FEW = 500_000


def _tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, component`` of all edges ``u, v`` that a task has."""
    ends = [np.column_stack((b.column(0).to_numpy(), b.column(1).to_numpy())) for b in batches]
    ids, ends = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *ends]), return_inverse=True)
    u, v = ends.reshape(-1, 2).T
    root = np.arange(len(ids))
    while len(u):  # the larger root of an edge hangs on the smaller one, until all edges lie within a tree
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while np.any(root[root] != root):
            root = root[root]
        u, v = root[u], root[v]
        u, v = u[u != v], v[u != v]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root])], ["id", "component"])


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every end of an edge (``a``, ``b``): the smallest id that can be reached.

    In turn, each node's larger neighbours, then its smaller ones, are tied to its smallest neighbour,
    which keeps the number of edges and halves paths, so that few rounds are needed. Nothing about a
    node is gathered but its minimum. Each round's edges are a written table. Up to ``FEW`` edges are tied in one task.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v")
    known = both.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    known = written(known, "edges")
    before = _state(known)
    if before[0] <= FEW:
        return known.coalesce(1).mapInArrow(_tied, "id long, component long")
    while True:
        # large star: every neighbour above u hangs on the smallest of u and its neighbours
        ways = known.unionAll(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ways.join(least, "u").filter("v > u").select(F.col("m").alias("u"), "v").filter("u <> v").distinct()
        # small star: u and its neighbours below hang on the smallest of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        small = small.select(F.col("m").alias("u"), F.col("u").alias("v")).unionAll(small.select(F.col("m").alias("u"), "v"))
        old, known = known, written(small.filter("u <> v").distinct(), "edges")
        discard(old)
        state = _state(known)
        if state == before:
            break
        before = state
    roots = known.select(F.col("v").alias("id"), F.col("u").alias("component"))
    return roots.unionAll(known.select(F.col("u").alias("id"), F.col("u").alias("component"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """What tells whether a round has changed the edges."""
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
