"""Every registered query against its DuckDB oracle (the driver's check, at sf0.001).

Set SPENDLENS_ORACLE_SF=/root/testdata/sf0.01 to run the driver's own scale.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from spendlens.catalog.oracle import ORACLE_SQL  # noqa: E402
from spendlens.catalog.queries import QUERIES  # noqa: E402
from oracle_check import TABLES, digest, types_of  # noqa: E402

SF = os.environ.get("SPENDLENS_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    spark_types, duck_types = types_of(df.schema, res.description)
    assert spark_types == duck_types
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(ocols, want)[0]


def test_entry_runs_the_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["date", "platform", "campaign_name", "account_name"]


def test_every_query_matches_on_the_sort_merge_path(spark, duck):
    """With broadcasts off (dimensions too big to broadcast, as on a large cluster) every
    query still equals its oracle."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    bad = []
    try:
        for name, fn in sorted(QUERIES.items()):
            df = fn(spark, SF)
            res = duck.execute(ORACLE_SQL[name])
            ocols = [d[0] for d in res.description]
            if digest(df.columns, [tuple(r) for r in df.collect()])[0] != \
                    digest(ocols, res.fetchall())[0]:
                bad.append(name)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert bad == []
