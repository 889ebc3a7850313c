import math
import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from spendlens.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, pos string, k1 string, said string"


def brute(rows):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said[c].append(((turn is not None, turn or 0), role or "", text or ""))
    said = {c: [(role, text) for _, role, text in sorted(turns)] for c, turns in said.items()}
    made = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        made[c] = tuple(said.get(base, [])[:h] + said[c][h:])
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        saved[node] = sum(saved[k] for k in kids[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return {(min(m), len(node)): (min(members[node[:-1]]) if node else None, len(m), len(kids[node]), leaves[node], saved[node],
                                  sha256(",".join(str(c) for c in sorted(m) if made[c] == node).encode()).hexdigest())
            for node, m in members.items()}


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA)
    got = trie.op13_prefix_trie(df, **options).collect()
    assert len({(r.conv_id, r.depth) for r in got}) == len(got)
    assert {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got} == brute(rows)


def talk(r, conv, turns, words=("a", "b")):
    return [(conv, t, r.choice(["user", "assistant"]) if t else "user", r.choice(words)) for t in range(turns)]


def test_cases_of_rows(spark):
    rows = [(1, 0, "user", "hé"), (1, 1, None, None), (2, 0, "user", "hé"), (2, None, "b", "null turn"), (2, None, "a", "null turn"), (2, 3, "", ""),
            (None, 0, "user", "nobody"), (None, None, None, None), (3, 0, "user", "x"), (3, 0, "user", "x"), (3, 0, "ser", "ux"),
            (-7, 0, "user", "hé"), (-107, 5, "user", "hé"), (-100, 0, "user", "first"), (-100, 1, "assistant", "é中"),
            (100, 0, "user", "base"), (100, 1, "assistant", "of the hundred"), (101, 0, "user", "base"), (150, 0, "user", "gone"), (205, 0, "user", "turnless or not")]
    rows += [(c, 0, "user", "one turn") for c in range(300, 340)]
    rows += [(c, t, "user", "z" * 70_000) for c in (400, 401) for t in range(2)]
    check(spark, rows)


def test_empty_tables(spark):
    check(spark, [])
    check(spark, [(None, 1, "user", "x")])


@pytest.mark.parametrize("short", [1 << 20, 50, 1])
def test_random_conversations(spark, short):
    r = random.Random(short)
    rows = [row for c in range(-30, 260) for row in talk(r, c, r.randint(1, 9))]
    r.shuffle(rows)
    check(spark, rows, short=short)


def test_a_common_turn_a_common_conversation_and_a_long_one(spark):
    r, rows = random.Random(9), []
    for c in range(1000, 2200):
        if c % 3 == 0:
            rows += [(c, t, "user", f"same {t}") for t in range(7)]
        else:
            rows += [(c, 0, "user", "hello")] + [(c, t, "user", f"{c} {r.randrange(5)}") for t in range(1, r.randint(2, 9))]
    check(spark, rows)


def test_a_long_conversation_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 16)
    monkeypatch.setattr(trie, "BUCKETS", 3)
    r = random.Random(2)
    rows = [(c, t, "user", r.choice("ab") if t > 200 else "a") for c in (100, 101, 102, 103) for t in range(260)]
    rows += [(c, t, "user", f"{c}") for c in range(500, 540) for t in range(7)]
    check(spark, rows)


def test_prefix_sums_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "DIGIT", 2)
    df = spark.createDataFrame([(p, p * p % 7) for p in range(100)], "pos long, v long")
    got = {x.pos: x.v for x in trie.running(df, ("v",)).collect()}
    assert got == {p: sum(q * q % 7 for q in range(p + 1)) for p in range(100)}
