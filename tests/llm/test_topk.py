import math
import random

import duckdb
import numpy as np
import pytest

from spendlens.llm import queries, topk

SF = "/root/testdata/sf0.001"


def brute(rows, k=5, every=50):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {i: v for i, v in sorted(good, key=lambda r: r[0])}.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in good if c != q and len(w) == len(v))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows],
                               "vec_id long, embedding array<float>, score string, salt string")
    return sorted(map(tuple, topk.op2_top_k(df, **options).collect()))


def test_random_vectors_ties_and_bad_rows(spark):
    r = random.Random(1)
    rows = [(i, [r.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(8)]) for i in range(150)]
    rows += [(300, None), (301, []), (350, [float("nan")] * 8), (302, [None] + [1.0] * 7), (303, [float("inf")] * 8),
             (None, [9.0] * 8), (400, [1.0, 2.0]), (7, rows[7][1]), (8, rows[8][1])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, k=2, every=3) == brute(rows, 2, 3)


def test_many_equal_vectors_and_several_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    r = random.Random(2)
    rows = [(i, [0.5] * 16 if i % 3 else [r.uniform(-1, 1) for _ in range(16)]) for i in range(200)]
    assert run(spark, rows, every=10) == brute(rows, every=10)


def test_bounds_hold():
    r = np.random.default_rng(0)
    x = np.floor(256 * r.normal(size=(60, 30)))
    for s in (1, 4, 7, 16, 64):
        f = topk.features(x, s)
        assert (f @ f.T + 1e-6 >= x @ x.T).all()


def test_few_rows_and_empty_table(spark):
    assert run(spark, [(50, [1.0])]) == []
    assert run(spark, [(50, [1.0]), (1, [2.0])]) == [(50, 1, 1, 256 * 512)]
    assert run(spark, []) == []


@pytest.mark.parametrize("name, tables", [("op2_topk", ["embeddings"]), ("op3_chat", ["conversations"]),
                                          ("op4_minhash", ["documents"]), ("op6_line_dedup", ["documents"])])
def test_registered_queries_equal_their_sql(spark, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in res.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(res.fetchall())
