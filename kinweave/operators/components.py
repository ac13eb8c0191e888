"""Connected components over an edge table, by contraction.

Each round every node hooks to its smallest neighbour, parents are followed twice, and
the edges are rewritten between the parents. What is left is the graph of the contracted
groups, at most half as many nodes; once it has at most ``FINISH`` edges, a task joins the rest. All steps are partial
aggregations and equi-joins; no neighbour list is ever gathered, and the joins on a parent or on an end of the edges deal a
hub's rows over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators.skew import spread_join
from kinweave.runtime import discard, materialize, staged

#: Edges that a single task joins.
FINISH = 1 << 14


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(a, p)``: every node of few edges with the smallest it reaches."""
    held = list(batches)
    if not held:
        return
    edges = pa.Table.from_batches(held)
    ends = [edges.column(c).to_numpy() for c in ("a", "b")]
    nodes, code = np.unique(np.concatenate(ends), return_inverse=True)
    x, y = code[: len(edges)], code[len(edges) :]
    root = np.arange(len(nodes))
    while len(x):
        rx, ry = root[x], root[y]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while not np.array_equal(root[root], root):
            root = root[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    kind = edges.schema.field("a").type
    yield pa.record_batch([pa.array(nodes, kind), pa.array(nodes[root], kind)], ["a", "p"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node of an undirected edge table.

    ``component`` is the smallest node reachable. Edges may repeat, point either way and
    be loops (a loop alone yields its node); edges with a null end are ignored; no edges
    give no rows.
    """
    clean = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    left = materialize(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    label, n = None, left.count()
    while label is None or n:
        if last := n <= FINISH:
            kind = left.schema["a"].dataType.simpleString()
            hook = materialize(left.coalesce(1).mapInArrow(_join, f"a {kind}, p {kind}"), "parents")
        else:
            both = left.union(left.select("b", "a"))
            hook = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p")), "hooks")
            for _ in range(2):
                up = hook.select(F.col("a").alias("p"), F.col("p").alias("pp"))
                done, hook = hook, materialize(spread_join(hook, up, ["p"], ["a"]).select("a", F.col("pp").alias("p")), "parents")
                discard(done)
        done, label = label, hook if label is None else materialize(
            spread_join(label, hook.select(F.col("a").alias("p"), F.col("p").alias("q")), ["p"], ["a"], "left")
            .select("a", F.coalesce("q", "p").alias("p")), "labels")
        discard(done)
        spent = [left] if hook is label else [left, hook]  # what the rest of the round still reads
        if last:
            discard(*spent)
            break
        to_a = hook.select("a", F.col("p").alias("pa"))
        to_b = hook.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        ends = spread_join(left, to_b, ["b"], ["a"]).select("a", "b", "pb")
        left = materialize(
            spread_join(ends, to_a, ["a"], ["b"], counted=left).where("pa <> pb")
            .select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct(), "edges")
        discard(*spent)
        n = left.count()
    return staged(label.select(F.col("a").alias("node"), F.col("p").alias("component")), label._stage)
