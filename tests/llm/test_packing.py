import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from docs import EDGE, frame, prose
from spendlens.llm import packing
from spendlens.llm.word_tokens import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def pack(spark, rows, **options):
    return packing.op7_pack(frame(spark, rows), PATH, **options).collect()


def check(rows, got, capacity=4096):
    library = Tokenizer.from_file(PATH)
    ids = [(i, np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for i, t, *_ in rows]
    places = {}
    for r in got:
        assert 0 < r.length <= capacity
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    want = {}
    for i, x in ids:
        want.setdefault((i, len(x)), []).append(x)
    left = sorted((r.doc_id is None, r.doc_id or 0, r.doc_tokens, r.start, r.length, r.ids_crc32) for r in got)
    need = sorted((i is None, i or 0, len(x), r.start, r.length, zlib.crc32(x[r.start:r.start + r.length].tobytes()))
                  for i, x in ids for r in {(r.start, r.length): r for r in got if r.doc_id == i and r.doc_tokens == len(x)}.values())
    assert sum(r.length for r in got) == sum(len(x) for _, x in ids)
    assert left == need
    return sum(len(x) for _, x in ids) / (capacity * len(places))


def test_edge_documents(spark):
    rows = EDGE + [(100 + k, prose(k, 5 * k)) for k in range(1, 60)]
    check(rows, pack(spark, rows))


def test_little_padding(spark):
    r = random.Random(1)
    rows = [(k, prose(k, r.randint(1, 2500))) for k in range(150)]
    assert check(rows, pack(spark, rows)) > 0.97


def test_lengths_that_fit_badly_are_cut_again(spark):
    rows = [(k, "a " * 2999) for k in range(40)]  # 3000 ids each
    assert check(rows, pack(spark, rows)) > 0.95


def test_equal_lengths_and_empty_table(spark):
    rows = [(k % 3, "x y z") for k in range(500)]
    assert check(rows, pack(spark, rows)) > 0.4  # one sequence
    assert pack(spark, []) == []


def test_column_generation_is_feasible_and_near_the_bound():
    r = np.random.default_rng(0)
    for h in ({}, {512: 3}, {1: 5}, {300: 7}, {c: int(n) for c, n in zip(range(1, 513), r.integers(0, 50, 512))},
              {c: int(n) for c, n in zip(r.integers(1, 200, 60).tolist(), r.integers(1, 10**6, 60))}):
        plan = packing.solve(h)
        filled = {}
        for n, p in zip(plan.uses, plan.patterns):
            assert sum(c * a for c, a in p.items()) <= 512 and n > 0
            for c, a in p.items():
                filled[c] = filled.get(c, 0) + n * a
        assert all(filled.get(c, 0) >= n for c, n in h.items()) and set(filled) <= {c for c, n in h.items() if n}
        assert sum(filled.values()) == sum(h.values())
        # pieces longer than half a sequence cannot share one
        least = max(sum(c * n for c, n in h.items()) / 512, sum(n for c, n in h.items() if c > 256))
        assert sum(plan.uses) <= 1.02 * least + len(h) + 1
    assert sum(packing.solve({256: 1000, 128: 1000, 64: 2000}).uses) == 1000


def test_knapsack_prices_the_best_pattern():
    values = np.zeros(11)
    values[[3, 4, 7]] = 0.31, 0.45, 0.7
    worth, pattern = packing.price(values, 10)
    assert abs(worth - 1.07) < 1e-12 and pattern[3] == 2 and pattern[4] == 1


def test_word_ids_equal_the_library_on_random_text():
    library, e = Tokenizer.from_file(PATH), encoder(PATH)
    r = random.Random(2)
    pool = [chr(c) for c in range(1, 0x250)] + list("中文😀́Σς 　​٠İſK\x00")
    words = "the 's don't I'LL <|endoftext|> <|startoftext|> a<|endoftext|>b naïve ÀÉ".split()
    texts = ["".join(r.choice(pool) if r.random() < 0.4 else r.choice([*words, " ", "\n", "er", "ing"]) for _ in range(r.randint(0, 25)))
             for _ in range(3000)]
    got = e.encode([t.encode() for t in texts])
    assert got == [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]
