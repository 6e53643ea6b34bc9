"""Connected components of an edge list by alternating star steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.store import written

_SCHEMA = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _star(emit):
    """A step over rows sorted by (u, v): ``emit(u, v, m)`` with m the least neighbour of u
    (or u). One run of equal u is never held whole."""

    def run(batches):
        at = least = None
        for b in batches:
            if not b.num_rows:
                continue
            u, v = b.column(0).to_numpy(), b.column(1).to_numpy()
            new = np.ones(len(u), bool)
            new[1:] = u[1:] != u[:-1]
            again = np.zeros(len(u), bool)
            again[1:] = ~new[1:] & (v[1:] == v[:-1])
            new[0] = u[0] != at
            heads = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            best = np.minimum(u[heads], v[heads])
            m = np.where(group >= 0, best[np.maximum(group, 0)], least) if len(heads) else np.full(len(u), least)
            at, least = int(u[-1]), int(m[-1])
            keep = ~again
            a, z = emit(u[keep], v[keep], m[keep])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(z)], schema=_SCHEMA)

    return run


def _large(u, v, m):
    far = v > u
    return v[far], m[far]


def _small(u, v, m):
    return np.where(v == m, u, v), m


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node it reaches.

    Large-star and small-star steps, one shuffle each; every round is a written
    table. It ends when each node has one parent and no parent has one.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    while True:
        both = now.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        large = (both.repartition("u").sortWithinPartitions("u", "v").mapInArrow(_star(_large), "u long, v long"))
        small = (large.repartition("u").sortWithinPartitions("u", "v").mapInArrow(_star(_small), "u long, v long"))
        now = written(small, "components")
        ends = now.select(F.inline(F.array(
            F.struct(F.col("u").alias("node"), F.col("v").alias("parent")),
            F.struct(F.col("v").alias("node"), F.lit(None).cast("long").alias("parent")))))
        ends = ends.groupBy("node").agg(F.min("parent").alias("low"), F.max("parent").alias("high"),
                                        F.bool_or(F.col("parent").isNull()).alias("above"))
        if not ends.filter("low <> high or (above and low is not null)").limit(1).count():
            return ends.select("node", F.coalesce("low", "node").alias("component"))
