import random
import re
import string

import numpy as np

from docs import EDGE, frame, prose
from spendlens.llm import neardup
from spendlens.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    parent = {i: i for i, *_ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t, *_ in rows]
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return [(i, len(x), None if i is None else find(i)) for i, x in sets]


def check(spark, rows):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in neardup.op4_near_duplicates(frame(spark, rows)).collect()]
    want = brute(rows)
    key = lambda t: (t[0] is None, t[0] or 0, t[1], t[2] or 0)
    known = lambda x: [t for t in sorted(x, key=key) if t[0] is not None]
    assert known(got) == known(want)
    return got


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(f"w{r.random()}" if r.random() < share else w for w in text.split())


def test_edge_documents(spark):
    rows = EDGE + [(20, "A b C d"), (21, "a B c D"), (22, "a b c d e"), (23, "A  b\nc D\te")]
    got = check(spark, rows)
    kept = {r.doc_id: r.kept for r in neardup.op4_near_duplicates(frame(spark, rows)).collect() if r.doc_id is not None}
    assert kept[4] and not kept[5] and kept[9] and not kept[10] and kept[1] and kept[2] and kept[3] and not kept[21]
    assert len(got) == len(rows)


def test_groups_of_near_copies_around_the_threshold(spark):
    rows, n = [], 0
    for g in range(12):
        base = prose(g, 200, [f"{g}x{k}" for k in range(400)])
        for k in range(12):
            rows.append((n * 3 % 997, edited(base, [0, 0.005, 0.01, 0.015, 0.02, 0.03][k % 6], 100 * g + k)))
            n += 1
    check(spark, rows)


def test_large_group_is_compared_in_blocks(spark, monkeypatch):
    base = prose(5, 80, [f"z{k}" for k in range(300)])
    rows = [(k, edited(base, 0.02, k)) for k in range(150)]
    want = {i: c for i, _, c in brute(rows)}
    sets = [np.unique(np.array([hash(s) for s in shingles(t)], np.int64).view(np.uint64)) for _, t in rows]
    ids, links = np.arange(150), []
    for blocks in (4, 1):  # every block with every other one finds what one block finds
        links = []
        for i in range(blocks):
            for j in range(i, blocks):
                on = np.flatnonzero((ids % blocks == i) | (ids % blocks == j))
                links += neardup.confirm(ids[on], ids[on] % blocks, [sets[k] for k in on])
        got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert {k: got.get(k, k) for k in range(150)} == want
    check(spark, rows)


def test_bucket_edges_over_batches():
    import pyarrow as pa
    rows = [(1, 5, None), (1, 7, None), (1, 9, None), (2, 3, None), (3, 4, 2), (4, 6, None), (4, 8, None)]
    for cut in range(len(rows) + 1):
        batches = [pa.RecordBatch.from_pylist([dict(zip("kab", r)) for r in part], pa.schema([(c, pa.int64()) for c in "kab"]))
                   for part in (rows[:cut], rows[cut:])]
        got = [(r["a"], r["b"]) for b in neardup._bucket_edges(batches) for r in b.to_pylist()]
        assert sorted(got) == [(4, 2), (7, 5), (8, 6), (9, 5)]


def test_signature_distance_is_covered_by_the_chunks():
    r = np.random.default_rng(0)
    a = r.integers(0, 1 << 16, (200, neardup.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[r.choice(neardup.SYMBOLS, neardup.DISTANCE, replace=False)] ^= 1
    assert (neardup.chunk_keys(a) == neardup.chunk_keys(b)).any(axis=1).all()


def test_layout_of_other_thresholds():
    assert neardup.layout(85) == (neardup.SYMBOLS, neardup.DISTANCE, neardup.CHUNKS) == (64, 22, 12)
    symbols, distance, chunks = neardup.layout(80)
    r = np.random.default_rng(1)
    assert (r.binomial(symbols, 0.2, 100_000) > distance).sum() < 20  # 3 are expected at most
    a = r.integers(0, 1 << 16, (200, symbols)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[r.choice(symbols, distance, replace=False)] ^= 1
    assert (neardup.chunk_keys(a, chunks) == neardup.chunk_keys(b, chunks)).any(axis=1).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 9), (9, 8), (8, 7), (7, 6), (5, 5), (None, 4), (3, 2)] + [(100, k) for k in range(101, 140)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in (1, 2, 3)}, **{k: 6 for k in range(6, 11)}, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_repeated_and_null_ids(spark):
    a, b, c = (prose(k, 60) for k in (41, 42, 43))
    rows = [(3, a), (5, a), (5, b), (7, b), (7, b), (9, c), (9, ""), (9, None), (12, c + " end"), (None, c), (None, prose(44, 50)), (None, prose(44, 50) + " more"),
            (20, prose(45, 40)), (20, prose(46, 40)), (21, prose(46, 40)), (30, "one"), (30, "two"), (31, "two")]
    check(spark, rows)
    got = neardup.op4_near_duplicates(frame(spark, rows)).collect()
    assert {r.component_id for r in got if r.doc_id in (3, 5, 7)} == {3}
    assert {r.component_id for r in got if r.doc_id in (20, 21)} == {20} and {r.component_id for r in got if r.doc_id == 31} == {30}
    nulls = sorted((r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None)
    assert nulls == [(46, None, True), (47, None, True), (56, 9, False)]
    assert len({r.node for r in got if r.doc_id is None and r.component_id is None}) == 1


def test_documents_of_one_template_are_no_links(spark):
    template = prose(70, 100).split()
    r = random.Random(7)
    rows = []
    for k in range(300):  # half of the words are the document's own, in runs
        words = list(template)
        for at in range(0, 100, 20):
            words[at:at + 7] = [f"w{r.random()}" for _ in range(7)]
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, rows[k][1] + " end") for k in range(0, 300, 60)]
    docs = frame(spark, rows)
    signed = neardup.sign(docs).collect()
    sig = {s.doc_id: np.frombuffer(s.signature, "<u2") for s in signed}
    classes = spark.createDataFrame([(s.doc_id, s.signature) for s in signed], "class_id long, signature binary")
    blobs = components(neardup.candidate_edges(classes))
    assert blobs.count() > 100  # buckets of the template's symbols hold documents that are far apart
    for tile in (2048, 16):
        edges = neardup.near_edges(classes, blobs, tile=tile)
        got = {frozenset((e.a, e.b)) for e in edges.collect()}
        assert got == {frozenset((k, 1000 + k)) for k in range(0, 300, 60)}
        assert all((sig[x] != sig[y]).sum() <= neardup.DISTANCE for x, y in map(tuple, got))


def test_tiles_give_all_near_pairs():
    r = np.random.default_rng(3)
    a = r.integers(0, 3, (150, 64)).astype(np.uint16)
    b = np.concatenate([a[:70] ^ (r.random((70, 64)) < 0.3), r.integers(0, 9, (40, 64))]).astype(np.uint16)
    i, j = neardup.near(a, b, 22)
    assert set(zip(i.tolist(), j.tolist())) == {(x, y) for x in range(150) for y in range(110) if (a[x] != b[y]).sum() <= 22}


def test_empty_table(spark):
    assert neardup.op4_near_duplicates(frame(spark, [])).collect() == []
