import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from spendlens.llm import text_arrays as ta

texts = st.lists(st.text(alphabet="ab \n\t\x0bé中.", max_size=30), max_size=6)


def arrays(items):
    raw = [t.encode() for t in items]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


@settings(max_examples=200, deadline=None)
@given(texts)
def test_words_and_lines_are_those_of_each_text(items):
    data, offsets = arrays(items)
    raw = data.tobytes()
    s, e, t = ta.word_spans(data, offsets)
    want = [(i, w.encode()) for i, x in enumerate(items) for w in re.findall(r"[^\x20\x09-\x0D]+", x)]
    assert [(int(i), raw[a:b]) for a, b, i in zip(s, e, t)] == want
    s, e, t = ta.line_spans(data, offsets)
    want = [(i, w.encode()) for i, x in enumerate(items) for w in x.split("\n")]
    assert sorted((int(i), raw[a:b]) for a, b, i in zip(s, e, t)) == sorted(want)


@settings(max_examples=100, deadline=None)
@given(texts)
def test_equal_words_have_equal_hashes_and_others_do_not(items):
    data, offsets = arrays(items)
    s, e, _ = ta.word_spans(data, offsets)
    h = ta.range_hashes(data, s, e).tolist()
    words = [data[a:b].tobytes() for a, b in zip(s, e)]
    assert len(set(h)) == len(set(words)) == len(set(zip(h, words)))


def test_hashes_do_not_depend_on_where_a_long_run_is_cut(monkeypatch):
    data, offsets = arrays(["abc de " * 500, "x" * 3000, "abc de"])
    s, e, _ = ta.word_spans(data, offsets)
    want = ta.range_hashes(data, s, e)
    monkeypatch.setattr(ta, "_STEP", 16)
    assert (ta.range_hashes(data, s, e) == want).all()


def test_windows_repeats_and_counts():
    h = np.array([1, 2, 3, 1, 2, 3], np.uint64)
    at, w = ta.windows(h, np.zeros(6, int), 3)
    assert at.tolist() == [0, 1, 2, 3] and w[0] == w[3] != w[1]
    assert ta.windows(h, np.array([0, 0, 0, 1, 1, 1]), 4)[0].tolist() == []
    assert ta.repeated(h).all() and ta.seen_before(h).tolist() == [False] * 3 + [True] * 3
