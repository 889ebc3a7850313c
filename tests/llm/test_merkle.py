import random
import zlib
from hashlib import sha256

from docs import EDGE, frame, prose
from spendlens.llm import merkle

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, n_chars):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, "s", lang, n_chars, text)))


def tree(nodes):
    """All levels of a tree over ``nodes``."""
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
        levels.append(nodes)
    return levels


def steps(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = i // 8 * 8
        out.append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 8])))
        i //= 8
    return out


def brute(rows):
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "en") for r in rows]
    made = [(d, g, leaf(d, t, g, len(t or "")), leaf(d, (t or "").translate(LOW) if t is not None else None, g, len(t or ""))
             if d is not None and zlib.crc32(str(d).encode()) % 3 == 0 else None) for d, t, g in rows]
    langs = sorted({g for _, g, _, _ in made}, key=lambda g: (g is not None, (g or "").encode()))
    groups = {g: sorted((r for r in made if r[1] == g), key=lambda r: (r[0] is not None, r[0] or 0, r[2])) for g in langs}
    trees = {g: tree([r[2] for r in groups[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs]) if langs else []
    out = []
    for k, g in enumerate(langs):
        for i, (d, _, own, changed) in enumerate(groups[g]):
            path = steps(trees[g], i) + steps(top, k)
            digest = changed or own
            for left, right in path:
                digest = h(left, digest, right)
            root = top[-1][0]
            out.append((d, own, trees[g][-1][0], root, h(*(a + b for a, b in path)), digest, digest == root))
    return out


def check(spark, rows):
    got = [tuple(r) for r in merkle.op12_manifest(frame(spark, rows)).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    return got


def test_edge_documents(spark):
    check(spark, EDGE + [(5, "Another TEXT of five"), (5, "another text of five"), (40, "Upper", None), (41, "ÄÖ", "é"), (42, "x", "")])


def test_no_rows_and_one_row(spark):
    assert check(spark, []) == []
    (row,) = check(spark, [(7, "A single document", None)])
    assert row[1] == row[2] == row[3] and row[4] == sha256(b"").hexdigest()


def test_several_passes_sparse_ids_and_many_languages(spark):
    r, rows = random.Random(5), []
    ids = list(range(-40, 4200)) + [r.getrandbits(64) - (1 << 63) for _ in range(300)] + [-(1 << 63), (1 << 63) - 1]
    for d in ids:
        rows.append((d, f"Text {d}", "en" if r.random() < 0.97 else f"l{r.randrange(80)}"))
    r.shuffle(rows)
    check(spark, rows)


def test_repeated_ids_and_rows(spark):
    r, rows = random.Random(6), []
    for _ in range(3000):  # one id holds most rows: equal ones and others
        rows.append((9, r.choice(["same Text", f"Other {r.randrange(400)}"]), "en"))
    rows += [(d, prose(d, 5), r.choice(["en", "de"])) for d in range(100)]
    rows += [(None, f"null {k % 7}", "en") for k in range(30)] + [(12, "same Text", "en")] * 9
    r.shuffle(rows)
    check(spark, rows)


def test_a_tampered_text_fails_and_an_equal_one_does_not(spark):
    ids = [d for d in range(60) if zlib.crc32(str(d).encode()) % 3 == 0][:6]
    rows = [(d, ("UPPER" if k % 2 else "lower") + f" {d}") for k, d in enumerate(ids)] + [(None, "UPPER")]
    assert {r[0]: r[6] for r in check(spark, rows)} == {**{d: k % 2 == 0 for k, d in enumerate(ids)}, None: True}
