import random

import public_tokenizers
from tokenizers import Tokenizer

from docs import EDGE, frame, prose
from spendlens.llm import bpe, counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def apply(text, edits):
    for a, b, new in reversed(edits):
        text = text[:a] + new + text[b:]
    return text


def test_random_edits_equal_a_full_count():
    library, e, r = Tokenizer.from_file(PATH), bpe.encoder(PATH, {}), random.Random(5)
    pool = list("ab  \n\t.,'12é中") + ["'s", " the", " tion", "<|endoftext|>", "　", "!!"]
    for _ in range(300):
        text = "".join(r.choice(pool) for _ in range(r.choice([0, 1, 50, 600, 2000])))
        edits = [{"start": (a := r.randint(-3, len(text) + 3)), "stop": a + r.choice([0, 1, 5, 40, 700, -1]),
                  "text": r.choice([None, "", "x", " ", "<email>", "\n\n  a", "中"])} for _ in range(r.randint(0, 8))]
        use = counts.usable_edits(edits, len(text))
        raw = text.encode()
        tree = counts.SegmentTree(raw, e)
        assert tree.total == len(library.encode(text, add_special_tokens=False).ids)
        for a, b, new in reversed(use):
            tree.replace(len(text[:a].encode()), len(text[:b].encode()), new.encode())
        new = apply(text, use)
        assert b"".join(tree.parts) == new.encode()
        assert tree.total == len(library.encode(new, add_special_tokens=False).ids)
        kept = tree.leaves()
        assert 0 not in kept[0] and sum(kept[0]) == len(new.encode()) and sum(kept[1]) == tree.total
        again = counts.SegmentTree(new.encode(), e, kept)
        assert again.total == tree.total and again.encoded == 0


def test_only_regions_near_edits_are_encoded_anew(spark):
    text = prose(1, 20_000)
    docs = frame(spark, [(1, text + " write to a.b@mail.example.com now " + text)])
    r = counts.op8_counts(docs, PATH).first()
    assert r.n_edits == 1 and 0 < r.bytes_encoded < 2_000 < r.bytes_before / 50
    library = Tokenizer.from_file(PATH)
    assert r.tokens_after == len(library.encode(text + " write to <email> now " + text, add_special_tokens=False).ids)


def test_edge_documents_and_edits(spark):
    library = Tokenizer.from_file(PATH)
    docs = counts.redactions(frame(spark, EDGE + [(60, "call +1 (706) 555-3138, 10.0.0.1 or 4644348398010899")])).collect()
    assert [(e.start, e.text) for e in next(d for d in docs if d.doc_id == 60).edits] == [(24, "<address>"), (36, "<card>"), (5, "<phone>")]
    odd = [(1, "some text here", [(0, 4, "any"), (2, 6, "lost"), (None, 3, "x"), (5, 2, "x"), (100, 200, " end"), (9, 9, None)]),
           (2, None, [(0, 0, "new")]), (3, "plain", None), (3, "plain", [None])]
    rows = spark.createDataFrame([(d.doc_id, d.text, d.edits) for d in docs] + odd, f"doc_id long, text string, edits {counts.EDITS}")
    got = counts.count_edited(rows, PATH).collect()
    want = []
    for r in rows.collect():
        text = r.text or ""
        use = counts.usable_edits(r.edits, len(text))
        want.append((r.doc_id, len(library.encode(text, add_special_tokens=False).ids), len(use),
                     len(library.encode(apply(text, use), add_special_tokens=False).ids)))
    key = lambda t: str(t)
    assert sorted(((r.doc_id, r.tokens_before, r.n_edits, r.tokens_after) for r in got), key=key) == sorted(want, key=key)


def test_kept_trees_take_edit_after_edit_and_only_touched_regions_are_encoded(spark, tmp_path):
    library, r = Tokenizer.from_file(PATH), random.Random(9)
    texts = {i: prose(i, 30_000) for i in range(4)} | {4: "", 5: "short 中文 text"}
    counts.segment_trees(frame(spark, list(texts.items())), PATH).write.parquet(str(tmp_path / "0"))
    for turn in range(3):
        edits = {i: [(a := r.randint(0, len(t)), a + r.choice([0, 5, 60]), r.choice(["", " a new word", "中" * 9, prose(50 + turn, 3000)]))]
                 for i, t in texts.items()}
        rows = spark.createDataFrame(list(edits.items()), f"doc_id long, edits {counts.EDITS}")
        trees = spark.read.parquet(str(tmp_path / str(turn))).select("doc_id", "text", "sizes", "counts")
        counts.edit_trees(trees.join(rows, "doc_id"), PATH).write.parquet(str(tmp_path / str(turn + 1)))
        for row in spark.read.parquet(str(tmp_path / str(turn + 1))).collect():
            old, use = texts[row.doc_id], counts.usable_edits([{"start": a, "stop": b, "text": t} for a, b, t in edits[row.doc_id]], len(texts[row.doc_id]))
            texts[row.doc_id] = apply(old, use)
            assert row.text == texts[row.doc_id]
            assert row.tokens_before == len(library.encode(old, add_special_tokens=False).ids)
            assert row.tokens_after == sum(row.counts) == len(library.encode(row.text, add_special_tokens=False).ids)
            assert row.bytes_encoded < 2 * sum(len(t.encode()) for _, _, t in use) + 4 * counts.SEGMENT


def test_trees_that_do_not_fit_are_built_anew_and_other_columns_come_along(spark):
    text = prose(3, 2000)
    rows = spark.createDataFrame([(1, text, None, None, None), (2, text, [5], [1], None), (3, text, [len(text.encode()) + 1, -1], [1, 1], None),
                                  (4, text, [len(text.encode())], None, None), (5, None, [], [], [(0, 0, "new")])],
                                 f"doc_id long, text string, {counts.TREE}, edits {counts.EDITS}")
    want = len(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids)
    got = {r.doc_id: r for r in counts.edit_trees(rows, PATH).collect()}
    assert all(got[i].tokens_after == want and got[i].bytes_encoded == len(text.encode()) for i in (1, 2, 3, 4))
    assert (got[5].text, got[5].tokens_before, got[5].tokens_after, got[5].bytes_encoded) == ("new", 0, 1, 3)
    more = counts.segment_trees(frame(spark, [(1, "a b"), (None, None)]).selectExpr("*", "'x' AS `odd name`"), PATH, ("odd name",))
    assert more.columns == ["doc_id", "text", "sizes", "counts", "odd name"] and {r["odd name"] for r in more.collect()} == {"x"}


def test_empty_table(spark):
    assert counts.op8_counts(frame(spark, []), PATH).collect() == []
