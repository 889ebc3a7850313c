import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import plan_text
from spendlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, id string, tree string, parent string, score string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t, r or "", x or ""))
    out = []
    for c, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out.append((c, len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss)))
    return out


def test_edge_conversations_are_read_back_exactly(spark):
    hostile = ["\\### Assistant: </turn> ok", "####", "</turn>\n</turn>", "\\\\", "#\\#", "<\\/turn>", "\\", "é中" * 50,
               "### user: x</turn>\n", "", None, "x" * 300_000, "/turn>"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(hostile)]
    rows += [(2, 0, "user", "tie"), (2, 0, "assistant", "tie"), (2, 0, "user", "tie"), (3, 5, None, "no role"),
             (3, -1, "a: b</turn>", "odd role"), (4, None, "user", "no turn"), (4, 1, "assistant", "last"), (None, 0, "user", "no id")]
    got = chat.op3_chat(conversations(spark, rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(brute(rows), key=key)


def test_long_conversation_and_empty_table(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(150)] + [(2, 0, "user", "short")]
    got = sorted(tuple(r)[:5] for r in chat.op3_chat(conversations(spark, rows)).collect())
    assert got == sorted(brute(rows))
    assert chat.op3_chat(conversations(spark, [])).collect() == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="#\\</turn>\nab: ", max_size=20), min_size=1, max_size=6))
def test_escaping_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape("t").alias("e"))
    for r in df.select("t", "e", chat.unescape("e").alias("u")).collect():
        assert r.u == r.t and "</turn>" not in r.e and "###" not in r.e


def test_paths_of_a_tree_are_ranked_by_score(spark):
    rows = [(1, "t", 1, None, "user", "q", 1.0), (1, "t", 2, 1, "assistant", "a", 0.5), (1, "t", 3, 1, "assistant", "b", 2.0),
            (1, "t", 4, 3, "user", "c", 0.0), (1, "t", 5, 3, "user", "d", 0.0), (1, "t", 6, 99, "user", "orphan", 0.1),
            (1, "t", 7, 8, "user", "cycle", 9.0), (1, "t", 8, 7, "user", "cycle", 9.0), (1, "t", 9, 8, "user", "below a cycle", 9.0),
            (1, "t", 5, 3, "user", "d", 0.0), (2, "u", 1, None, "user", "alone", None)]
    m = spark.createDataFrame(rows, "conv_id long, tree string, id long, parent long, role string, text string, score double")
    out = {(r.conv_id, r.path): [t.text for t in r.turns] for r in chat.read_back(chat.format_paths(m, best=9)).collect()}
    assert out == {(1, 1): ["q", "b", "c"], (1, 2): ["q", "b", "d"], (1, 3): ["q", "a"], (1, 4): ["orphan"], (2, 1): ["alone"]}
    assert chat.format_paths(m, best=1).count() == 2


def test_only_dataframe_operations(spark):
    plan = plan_text(chat.op3_chat(conversations(spark, [(1, 0, "user", "x")])))
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
