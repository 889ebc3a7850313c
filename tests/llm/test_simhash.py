import random
import re
import string

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from docs import EDGE, frame, prose
from spendlens.llm import simhash

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(doc_id, fingerprint, component) by comparing every pair of rows."""
    prints = [fingerprint(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(rows[i][0], f"{prints[i]:016x}", least.get(find(i))) for i in range(len(rows))]


def check(spark, rows, **options):
    got = [tuple(r) for r in simhash.op11_near_duplicates(frame(spark, rows), **options).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_edge_documents(spark):
    check(spark, EDGE + [(5, "another text of number five"), (30, "Another TEXT of\tnumber  five"), (31, "two words"), (32, "Two  Words\n")])


def test_ids_that_are_all_null_and_an_empty_table(spark):
    check(spark, [(None, "same text here"), (None, "same text here")])
    check(spark, [])


def test_groups_of_near_copies_over_many_tiles(spark):
    r, rows = random.Random(3), []
    for g in range(12):
        words = prose(g, 400).split()
        for _ in range(r.randint(1, 30)):
            w = list(words)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = f"x{r.randrange(9)}"
            rows.append((len(rows), " ".join(w)))
    r.shuffle(rows)
    for tile in (4096, 40, 4):
        check(spark, rows, tile=tile)


@pytest.mark.parametrize("parts", [1, 2, 4, 8, 16])
def test_no_tile_layout_loses_a_pair(spark, parts, monkeypatch):
    r = random.Random(parts)
    base = [r.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    fps = {b ^ sum({1 << r.randrange(64) for _ in range(r.randint(0, 3))}) for b in base for _ in range(6)}
    monkeypatch.setattr(simhash, "parts_for", lambda n, tile: parts)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), tile=8).collect()
    label = {f: f for f in fps}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for e in edges:
        label[find(e.a % (1 << 64))] = find(e.b % (1 << 64))
    got = {frozenset(g for g in fps if find(g) == find(f)) for f in fps}
    want = {f: f for f in fps}

    def top(x):
        while want[x] != x:
            x = want[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 2:
                want[top(a)] = top(b)
    assert got == {frozenset(g for g in fps if top(g) == top(f)) for f in fps}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té中", max_size=60), max_size=5))
def test_fingerprints_equal_the_definition(texts):
    assert simhash.fingerprints_of(texts).tolist() == [fingerprint(t) for t in texts]


def test_a_long_text_in_pieces(monkeypatch):
    text = prose(1, 3000)
    whole = simhash.fingerprints_of([text, "a b", text])
    monkeypatch.setattr(simhash, "PIECE", 64)
    monkeypatch.setattr(simhash, "HASHES", 50)
    assert (simhash.fingerprints_of([text, "a b", text]) == whole).all()
    assert whole[0] == np.uint64(fingerprint(text))
