"""Connected components of an edge table, by alternating large and small stars.

A star is one join on a node's smallest neighbour, which is pre-aggregated; adaptive
execution may split its shuffles. Before a star's edges are written, each task replaces its
own by a spanning forest of them (to the smallest node it connects), so those that a star
repeats go without a shuffle of their own and few rounds are left. They end as soon as no node has two
neighbours of which one is smaller; an edge table that is written so takes none. Stars are
written to the shared folder, the last one in place of the one before; the number of
rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow, stage, unstage

#: Edges that a task holds at once.
HELD = 1 << 20


def joined(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position that each of ``n`` positions is connected to by the links ``i, j``."""
    label = np.arange(n)
    while len(i):
        x, y = label[i], label[j]
        open_ = x != y
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            short = label[label]
            if (short == label).all():
                break
            label = short
    return label


def _forests(batches, held: int = HELD):
    """Edges (node, smallest node) that connect what a task's edges connect."""
    rows, n = [], 0

    def forest():
        a, b = (np.concatenate([r[k] for r in rows]) for k in range(2))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = joined(len(nodes), at[:len(a)], at[len(a):])
        on = np.flatnonzero(label != np.arange(len(nodes)))
        return nodes[on], nodes[label[on]]

    def out(edges):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in edges], names=["a", "b"])

    for batch in batches:
        rows.append([batch.column(k).to_numpy() for k in range(2)])
        n += batch.num_rows
        if n >= held:
            edges = forest()
            rows, n = [edges], len(edges[0])
            if 2 * n > held:
                yield out(edges)
                rows, n = [], 0
    if n:
        yield out(forest())


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    # the edge to the smallest neighbour stays, the other neighbours get one to it
    return edges.join(least, "a").select(F.when(F.expr("b <> m"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b"))


def _tangled(edges: DataFrame) -> DataFrame:
    """The nodes that are neither the smallest of a star nor linked with it alone."""
    return _both(edges).groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")).where("low < u AND low <> high")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of every node of ``edges`` (a, b long).

    Loops, repeated edges and nulls are ignored; an empty table gives no rows.
    """
    def written(edges):  # a > b from here on
        return stage(map_arrow(edges, _forests, "a long, b long"), "edges")

    # the shuffle also parts the tasks from those of Python that find edges: with both, a task holds two workers
    now = written(edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct())
    while not _tangled(now).isEmpty():
        for star in (_large_star, _small_star):
            last, now = now, written(star(now))
            unstage(last)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b"), F.col("b"))).distinct()
