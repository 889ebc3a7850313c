import collections
import math
import random

import numpy as np

from docs import EDGE, frame, prose
from spendlens.llm import quality_lm as lm


def labelled(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, quality int, toxic int, lang string")


def symbols(text):
    return bytes(0x20 if b in (9, 10, 11, 12, 13, 32) else 0x30 if 0x30 <= b < 0x3A else b for b in (text or "").encode())


class Reference:
    """The model by its definition, over dictionaries."""

    def __init__(self, texts):
        top = collections.Counter()
        for t in texts:
            s = b"   " + symbols(t)
            top.update(s[i - 3:i + 1] for i in range(3, len(s)))
        self.c = {4: top}
        for k in (3, 2, 1):
            self.c[k] = collections.Counter(g[-k:] for g in self.c[k + 1])
        self.d, self.total, self.taken = {}, {}, {}
        for k, c in self.c.items():
            n = collections.Counter(c.values())
            self.d[k] = lm.modified_discounts([n[i] for i in range(1, 5)])
            self.total[k], self.taken[k] = collections.Counter(), collections.Counter()
            for g, v in c.items():
                self.total[k][g[:-1]] += v
                self.taken[k][g[:-1]] += self.d[k][min(v, 3) - 1]

    def p(self, g):
        out = 1 / 256
        for k in range(1, 5):
            own, h = g[-k:], g[-k:-1]
            if self.total[k][h]:
                c = self.c[k][own]
                less = self.d[k][min(c, 3) - 1] if c else 0
                out = (c - less + self.taken[k][h] * out) / self.total[k][h]
        return out

    def log_prob(self, text):
        s = b"   " + symbols(text)
        return sum(math.log(self.p(s[i - 3:i + 1])) for i in range(3, len(s)))


def test_probabilities_equal_the_definition(spark):
    train = [prose(k, 80) + f" {k}!" for k in range(15)]
    rows = [(k, t) for k, t in enumerate(train)] + [(100 + i, t) for i, (_, t, *_) in enumerate(EDGE) if len(t or "") < 5000]
    rows += rows[:3]
    ref = Reference(train)
    model = lm.KneserNey(lm.ngram_counts(frame(spark, rows[:15])))
    want = {i: (len(symbols(t)), ref.log_prob(t)) for i, t in rows}
    for bits in (6, lm.HEAD_BITS):  # most n-grams through the join, or all in the head
        got = lm.log_probabilities(frame(spark, rows), model, bits).collect()
        assert len(got) == len(rows)
        for r in got:
            n, lp = want[r.doc_id]
            assert r.n_symbols == n and math.isclose(r.log_prob, lp, rel_tol=1e-9, abs_tol=1e-9)


def test_probabilities_of_a_context_sum_to_one(spark):
    ref = Reference([prose(k, 50) for k in range(10)])
    for h in (b"the", b"   ", b"qqq"):
        assert abs(sum(ref.p(h + bytes([b])) for b in range(256)) - 1) < 1e-9


def test_clean_documents_stay_and_junk_goes(spark):
    r = random.Random(1)
    good = [(k, prose(k, 120), "en" if k % 2 else "fr") for k in range(200)]
    junk = [(1000 + k, "".join(r.choice("#$%&*QXZ") for _ in range(600)), "en") for k in range(20)]
    labels = labelled(spark, [(i, 1, 0) for i, *_ in good[:150]] + [(i, 0, 0) for i, *_ in junk[:5]] + [(None, 1, 0), (7, None, None), (150, 1, 1)])
    got = {r.doc_id: r for r in lm.op9_quality(frame(spark, good + junk + [(2000, None), (2001, ""), (2002, prose(1, 50), None), (2003, prose(2, 50), "new")]), labels).collect()}
    assert all(got[i].kept for i, *_ in good) and not any(got[i].kept for i, *_ in junk)
    assert not got[2000].kept and got[2001].perplexity is None and got[2002].kept and got[2003].kept
    assert got[2002].limit == got[2003].limit is not None


def test_limits_drawing_and_verdicts_equal_brute_force(spark):
    r = random.Random(4)
    docs = [(k, prose(k, r.choice([3, 20, 90])) + "#$" * r.choice([0, 0, 0, 30]), r.choice(["en", "fr", None])) for k in range(160)]
    docs += [docs[3], (500, None, "en"), (501, "", "fr"), (502, prose(5, 9), "new"), (None, prose(6, 9), "en")]
    labels = [(i, int(r.random() < 0.7), int(r.random() < 0.05)) for i in range(0, 160, 2)] + [(0, 1, 0), (500, 1, 0), (None, 1, 0), (9999, 1, 0)]
    got = lm.op9_quality(frame(spark, docs), labelled(spark, labels), quantile=0.9, margin=0.05, prior=50).collect()
    assert len(got) == len(docs)

    trusted = {i for i, q, t in labels if i is not None and q == 1 and not t}
    ref = Reference([t for i, t, _ in docs if i in trusted and t])
    scored = [(i, len(symbols(t)), ref.log_prob(t), lang if i is not None else None) for i, t, lang in docs]
    limit, mean = {}, {}
    for lang in ("en", "fr", "new", "*"):
        own = [(n, lp) for i, n, lp, x in scored if i in trusted and n and (lang == "*" or x == lang)]
        if own:
            mean[lang] = -sum(lp for _, lp in own) / sum(n for n, _ in own)
            steps = sorted(math.floor((-lp + 50 * mean[lang]) / (n + 50) * 500) for n, lp in own)
            limit[lang] = (steps[math.ceil(0.9 * len(steps) - 1e-9) - 1] + 1) / 500 + 0.05
    want = []
    for i, n, lp, lang in scored:
        lang = lang if lang in limit else "*"
        drawn = (-lp + 50 * mean[lang]) / (n + 50)
        want.append((i if i is not None else -1, n, math.exp(-lp / n) if n else 0.0, math.exp(limit[lang]), math.exp(drawn), n > 0 and drawn <= limit[lang]))
    rows = sorted((r.doc_id if r.doc_id is not None else -1, r.n_symbols, r.perplexity or 0.0, r.limit, r.drawn_perplexity, r.kept) for r in got)
    assert {r[-1] for r in rows[:161]} == {True, False}
    for a, b in zip(rows, sorted(want), strict=True):
        assert a[:2] == b[:2] and np.allclose(a[2:5], b[2:5], rtol=1e-7) and a[5] == b[5]


def test_edge_documents_without_labels_and_empty_table(spark):
    got = lm.op9_quality(frame(spark, EDGE), labelled(spark, [])).collect()
    assert len(got) == len(EDGE) and all(r.kept == (r.n_symbols > 0) for r in got)
    assert lm.op9_quality(frame(spark, []), labelled(spark, [(1, 1, 0)])).collect() == []


def test_discounts():
    d = lm.modified_discounts([100, 40, 20, 10])
    y = 100 / 180
    assert np.allclose(d, [1 - 2 * y * 0.4, 2 - 3 * y * 0.5, 3 - 4 * y * 0.5])
    assert lm.modified_discounts([0, 0, 0, 0]) == [0.5, 0.75, 0.75]


def test_the_model_counts_every_trusted_text(spark, monkeypatch):
    docs = spark.range(20_050).selectExpr("id AS doc_id", "'abcdefgh ' AS text", "'en' AS lang")
    counted = []

    class Model(lm.KneserNey):
        def __init__(self, counts):
            super().__init__(counts)
            counted.extend(r.c for r in self.tables[lm.ORDER].collect())

    monkeypatch.setattr(lm, "KneserNey", Model)
    out = lm.op9_quality(docs, docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic"))
    assert set(counted) == {20_050} and out.where("kept").count() == 20_050


def test_ids_that_may_be_in_a_set_hold_all_that_are(spark):
    docs = spark.range(-500, 1500).selectExpr("id AS doc_id", "'t' AS text").unionByName(spark.sql("SELECT NULL AS doc_id, 't' AS text"))
    ids = spark.range(-400, 1500, 7).selectExpr("id AS doc_id")
    want = {r.doc_id for r in ids.collect()}
    for bits in (5, 12, 25):
        got = [r.doc_id for r in lm._may_be_in(docs, ids, bits).collect()]
        assert want <= set(got) and len(got) == len(set(got))
    assert set(got) - {None} == want
    assert lm._may_be_in(docs, ids.limit(0)).count() == 0
