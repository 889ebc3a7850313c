"""Connected components: random graphs against a plain search, and the tasks that they take."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spendlens.llm import graph
from spendlens.llm.graph import components


def plain(edges):
    label = {x: x for e in edges for x in e}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {x: root(x) for x in label}


def found(df):
    got = df.collect()
    assert len(got) == len({r.node for r in got})
    return {r.node: r.component for r in got}


def test_random_graphs(spark):
    for seed, (n, m) in enumerate([(400, 150), (300, 290), (200, 600)]):
        r = random.Random(seed)
        edges = [(r.randrange(-n, n), r.randrange(-n, n)) for _ in range(m)]
        edges += [(5000 + k, 5001 + k) for k in r.sample(range(120), 120)]  # a path in any order
        edges += [(9000, k) for k in r.sample(range(8000, 8100), 60)] * 2  # the hub is the largest
        df = spark.createDataFrame(edges, "a long, b long").repartition(16)
        assert found(components(df)) == plain([e for e in edges if e[0] != e[1]])


def test_forests_of_a_task_are_bounded():
    r = np.random.default_rng(3)
    a, b = r.integers(0, 900, (2, 4000))
    on = a != b
    batches = [pa.RecordBatch.from_arrays([pa.array(a[on][k:k + 50]), pa.array(b[on][k:k + 50])], names=["a", "b"]) for k in range(0, int(on.sum()), 50)]
    for held in (100, 1000, 1 << 20):
        out = list(graph._forests(iter(batches), held))
        assert max(x.num_rows for x in out) < held + 50
        edges = [tuple(e.values()) for x in out for e in x.to_pylist()]
        assert all(x > y for x, y in edges)
        assert plain(edges) == plain(list(zip(a[on].tolist(), b[on].tolist(), strict=True)))
    assert list(graph._forests(iter([]))) == []


def tasks(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return out, sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))


def test_rounds_take_few_tasks(spark, monkeypatch):
    """Small tasks weigh, too: with many partitions a round's logs and files outgrew its rows."""
    monkeypatch.setattr(graph, "stage", lambda df, name, f=graph.stage: staged.append(name) or f(df, name))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hub = spark.range(1, 400, 1, 8).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
        staged = []
        got, n = tasks(spark, "hub", lambda: components(hub).collect())
        assert len(got) == 400 and {r.component for r in got} == {0}
        assert staged == ["edges"] and n < 120  # stars need no round
        groups = [(100 * g + r.randrange(40), 100 * g + r.randrange(40)) for g in range(30) for r in [random.Random(g)] for _ in range(300)]
        many = spark.createDataFrame(groups, "a long, b long").repartition(16)
        staged = []
        got, n = tasks(spark, "many", lambda: found(components(many)))
        assert got == plain([e for e in groups if e[0] != e[1]])
        assert len(staged) <= 7 and n < 430
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_edges_from_python_have_tasks_of_their_own(spark, monkeypatch):
    """Two Python steps in one task would keep two workers for each core."""
    from conftest import plan_text
    plans = []
    monkeypatch.setattr(graph, "stage", lambda df, name, f=graph.stage: plans.append(plan_text(df)) or f(df, name))
    edges = spark.range(20).selectExpr("id AS a", "id + 1 AS b").mapInArrow(lambda batches: batches, "a long, b long")
    assert {r.component for r in components(edges).collect()} == {0}
    first = plans[0].splitlines()
    python = [k for k, line in enumerate(first) if "MapInArrow" in line]
    assert len(python) == 2 and any("Exchange" in line for line in first[python[0]:python[1]])
