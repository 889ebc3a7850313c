import threading
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixtures import platform_tables
from spendlens.plans import run_report
from spendlens.sinks import ensure_schema, replace_table, republish, versions_of
from spendlens.spec import ExternalTarget, FieldSpec, ReportSpec
from test_reports import PLATFORM


def _db():
    return "t_" + uuid.uuid4().hex[:8]


def test_replace_table_declares_types_and_comments_and_overwrites(spark):
    db = _db()
    ensure_schema(spark, db, "home of reports", "Reports", "EU")
    spec = ReportSpec(target=f"{db}.t", dimensions=(FieldSpec("k", "STRING", "k"),),
                      metrics=(FieldSpec("v", "NUMERIC", "sum(v)"),))
    df = spark.createDataFrame([("a", 1)], "k string, v bigint")
    replace_table(df, spec.target, spec)
    replace_table(spark.createDataFrame([("b", 2), ("c", 3)], "k string, v bigint"),
                  spec.target, spec)
    back = spark.table(spec.target)
    assert rows(back) == [("b", 2), ("c", 3)]
    assert back.schema["v"].dataType.simpleString() == "decimal(38,9)"
    assert back.schema["v"].metadata.get("comment") == "[db_field_name = v]"
    props = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {db}").collect()}
    assert props.get("Comment") == "home of reports"
    assert "friendly_name" in str(props.get("Properties"))


def test_overwrite_a_table_read_by_its_own_query_via_staging(spark):
    db = _db()
    ensure_schema(spark, db)
    spark.createDataFrame([(1,)], "x bigint").write.saveAsTable(f"{db}.src")
    src = spark.table(f"{db}.src")
    replace_table(src.selectExpr("x + 1 AS x"), f"{db}.src", via_staging=True)
    assert rows(spark.table(f"{db}.src")) == [(2,)]
    # without the flag the refused overwrite is detected and routed through staging too
    replace_table(spark.table(f"{db}.src").selectExpr("x * 10 AS x"), f"{db}.src")
    assert rows(spark.table(f"{db}.src")) == [(20,)]
    # the plain table became the first version
    assert [rows(spark.table(v)) for v in versions_of(spark, f"{db}.src")] == [[(1,)], [(2,)], [(20,)]]


def test_run_report_then_republish_copies_the_stored_table(spark):
    home, ext = _db(), _db()
    ensure_schema(spark, home)
    spec = ReportSpec(**{**PLATFORM.__dict__, "target": f"{home}.platform",
                         "external": ExternalTarget(True, ext, "EU", "copy", "Copy")})
    res = run_report(spark, "platform", spec, tables=platform_tables(spark))
    assert res == {"target": f"{home}.platform", "external": f"{ext}.platform"}
    assert rows(spark.table(f"{ext}.platform")) == rows(spark.table(f"{home}.platform"))
    assert spark.table(f"{ext}.platform").count() == 7
    # an inactive report republishes an empty typed table
    off = ReportSpec(**{**spec.__dict__, "table_active": False})
    run_report(spark, "platform", off)
    assert spark.table(f"{ext}.platform").count() == 0
    assert spark.table(f"{home}.platform").count() == 0
    assert republish(spark, ReportSpec(**{**spec.__dict__, "external": ExternalTarget()})) is None


def test_replace_table_over_files_left_by_an_earlier_session(spark):
    db = _db()
    ensure_schema(spark, db)
    loc = [r[1] for r in spark.sql(f"DESCRIBE DATABASE {db}").collect() if r[0] == "Location"][0]
    # files at the managed location that the (in-memory) catalog does not know about
    spark.createDataFrame([(9,)], "x bigint").write.parquet(loc.rstrip("/") + "/t")
    replace_table(spark.createDataFrame([(1,), (2,)], "x bigint"), f"{db}.t")
    assert rows(spark.table(f"{db}.t")) == [(1,), (2,)]
    replace_table(spark.createDataFrame([(3,)], "x bigint"), f"{db}.t")
    assert rows(spark.table(f"{db}.t")) == [(3,)]


def test_a_failing_report_leaves_the_old_table(spark):
    db = _db()
    ensure_schema(spark, db)
    replace_table(spark.createDataFrame([(1,)], "x bigint"), f"{db}.t")
    bad = spark.range(3).select(F.raise_error(F.lit("report failed")).cast("bigint").alias("x"))
    with pytest.raises(Exception, match="report failed"):
        replace_table(bad, f"{db}.t")
    assert rows(spark.table(f"{db}.t")) == [(1,)]
    assert len(versions_of(spark, f"{db}.t")) == 1  # none of the failed run
    replace_table(spark.table(f"{db}.t").selectExpr("x + 1 AS x"), f"{db}.t", keep_seconds=0)
    assert rows(spark.table(f"{db}.t")) == [(2,)]
    assert sorted(t.tableType for t in spark.catalog.listTables(db)) == ["MANAGED", "VIEW"]


def test_a_reader_never_misses_the_table_while_it_is_replaced(spark):
    db = _db()
    ensure_schema(spark, db)
    name, seen, wrong, done = f"{db}.t", set(), [], threading.Event()
    replace_table(spark.range(5).selectExpr("id", "0L AS run"), name)

    def read():
        while not done.is_set():
            try:
                got = spark.table(name).groupBy("run").count().collect()
                assert len(got) == 1 and got[0]["count"] == 5  # one version, whole
                seen.add(got[0].run)
            except Exception as e:  # noqa: BLE001 - every failure of the reader is one
                wrong.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for run in range(1, 9):
            replace_table(spark.range(5).selectExpr("id", f"{run}L AS run"), name)
            if run == 4:
                with pytest.raises(Exception, match="report failed"):
                    replace_table(spark.range(3).select(F.raise_error(F.lit("report failed")).cast("bigint").alias("run")), name)
    finally:
        done.set()
        reader.join()
    assert not wrong and len(seen) > 1
    assert len(versions_of(spark, name)) == 9
    replace_table(spark.range(5).selectExpr("id", "9L AS run"), name, keep_seconds=0)
    assert versions_of(spark, name) == versions_of(spark, name)[-1:]
    assert {r.run for r in spark.table(name).collect()} == {9}


def test_versions_of_tables_with_like_names_are_kept_apart(spark):
    db = _db()
    ensure_schema(spark, db)
    for name in ("t", "t__v", "tt"):
        for x in (1, 2):
            replace_table(spark.createDataFrame([(x,)], "x bigint"), f"{db}.{name}", keep_seconds=0)
    for name in ("t", "t__v", "tt"):
        assert rows(spark.table(f"{db}.{name}")) == [(2,)]
        assert len(versions_of(spark, f"{db}.{name}")) == 1
