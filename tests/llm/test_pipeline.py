import re
import subprocess
import sys
import time
from pathlib import Path

import public_tokenizers
import pytest

import corpus_pipeline
from docs import prose
from spendlens.llm.shared import stage
from test_langid import LANGS

ROOT = Path(__file__).resolve().parents[2]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_in():
    junk = " ".join(["#$%&*"] * 200)
    rows = []
    for k in range(90):
        lang = list(LANGS)[k % 3]
        own = prose(k, 120, LANGS[lang])
        note = prose(7, 12, LANGS["xx"])
        rows.append((k, f"{own}\n{note}\n{prose(900 + k, 40, LANGS[lang])}" if k % 4 == 0 else own, lang))
    rows += [(200 + k, rows[k][1], rows[k][2]) for k in range(6)]          # exact copies
    rows += [(300, rows[7][1] + " ka", rows[7][2])]                        # a near copy
    rows += [(400 + k, junk, "xx") for k in range(3)] + [(500, None, "xx"), (501, "", "yy"), (502, "1234 5678", "zz"), (None, prose(3, 90, LANGS["xx"]), "xx")]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, t, lang, "src", len(t or "")) for i, t, lang in rows_in()]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(90)] + [(400, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_in_turn(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, folder), name)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
    assert list(kept) == ["quality", "language", "lines", "near_duplicates"]
    clean = set(range(90))
    assert clean <= set(kept["quality"]) and not {400, 401, 402, 500, 501} & set(kept["quality"])
    assert clean | {None} <= set(kept["language"]) and 502 not in kept["language"]
    texts, note = {i: t for i, t, _ in rows_in()}, prose(7, 12, LANGS["xx"])
    for i, r in kept["lines"].items():
        if i in clean and i % 4 == 0:
            assert note not in r.text and r.n_chars == len(r.text) and r.text in texts[i].replace(note + "\n", "")
        elif i in clean:
            assert r.text == texts[i]
    assert clean <= set(kept["near_duplicates"]) and not {*range(200, 206), 300} & set(kept["near_duplicates"])


def test_recurring_lines_go_from_short_documents(spark):
    passage = [prose(70, 25), prose(71, 30)]
    rows = [(k, "\n".join([prose(k, 20), *passage])) for k in range(3)]  # 73 % of the words
    copy = [prose(600 + k, 20) for k in range(12)]
    rows += [(10, "\n".join(copy)), (11, "\n".join([*copy, prose(700, 5)])), (12, "\n".join([passage[0], *copy]))]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.lines(spark, docs, "").collect()}
    # one of the documents that consist mostly of the passage keeps it
    own = {0: rows[0][1], 1: prose(1, 20), 2: prose(2, 20), 10: rows[3][1], 11: rows[4][1], 12: "\n".join(copy)}
    assert got == {i: (t, len(t)) for i, t in own.items()}


def test_near_copies_between_80_and_85_go(spark):
    rows = []
    for k in range(10):
        words = prose(800 + k, 204, [f"{k}v{j}" for j in range(400)]).split()
        edit = [f"e{j}" if j in (40, 80, 120, 160) else w for j, w in enumerate(words)]  # 180 of 220 shingles
        rows += [(k, " ".join(words)), (100 + k, " ".join(edit))]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows], SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == set(range(10))


def test_run_packs_what_the_stages_keep(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    assert set(range(90)) <= {r.doc_id for r in got}
    fill = {}
    for r in got:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in fill.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(spans), sorted(spans)[1:]))
        assert sum(n for _, n in spans) <= 4096
    assert {r.doc_id for r in got} & {*range(200, 206), 300, 400, 401, 402, 500, 501, 502} == set()


def test_one_row_of_each_group_stays(spark):
    a, b, c = (prose(k, 60) for k in (31, 32, 33))
    rows = [(1, a), (1, a), (2, a), (None, a), (None, a), (None, b), (None, b), (None, b), (5, c), (5, c + " end"), (6, c), (7, None), (7, None), (8, " "), (None, ""), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", len(t or "")) for k, (i, t) in enumerate(rows)], SCHEMA)
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got.collect())
    kept_c = [t for _, i, t in ids if i == 5]
    assert len(kept_c) == 1 and kept_c[0].startswith(c)
    assert [(n, i) for n, i, _ in ids] == [(False, 1), (False, 5), (False, 7), (False, 8), (True, 0), (True, 0)]
    assert [t for n, _, t in ids if n] == sorted(["", b])


def test_documents_left_blank_go(spark):
    note = prose(40, 30)
    rows = [(1, note + "\n" + prose(50, 5)), (2, note), (3, " \n" + note + "\n "), (4, prose(41, 40)), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {1: note + "\n" + prose(50, 5), 4: prose(41, 40), 5: None, 6: ""} or got[1].startswith(note)
    assert 4 in got and got[5] is None and got[6] == "" and all(t is None or t.strip() or i == 6 for i, t in got.items())


def test_staged_tables_go_with_the_application(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from spendlens.session import local_session
from spendlens.llm.graph import components
spark = local_session(2, 2, extra={{"spark.checkpoint.dir": {str(tmp_path)!r}}})
out = components(spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long"))
assert {{r.component for r in out.collect()}} == {{0}}
import os
assert len([n for n in os.listdir({str(tmp_path)!r}) if n.startswith("llm-")]) == 1  # earlier rounds are gone already
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    for _ in range(60):  # the JVM ends a little after the driver's Python
        if not list(tmp_path.glob("llm-*")):
            return
        time.sleep(0.5)
    raise AssertionError(f"left: {list(tmp_path.glob('llm-*'))}")


def test_every_operator_has_a_query():
    from spendlens.llm.queries import QUERIES
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert public_tokenizers.path("word_bpe_49k.json")


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
