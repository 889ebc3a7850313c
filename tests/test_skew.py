"""A key holding a third of all rows: results stay whole and equal when Spark splits it."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from fixtures import platform_tables
from spendlens.catalog.queries import star_join
from spendlens.operators import latest_by, pivot_metrics
from spendlens.plans import platform_report
from spendlens.sources import loader
from spendlens.spec import FieldSpec, ReportSpec

N = 60_000

FORCED_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def forced_skew(spark):
    old = {k: spark.conf.get(k, None) for k in FORCED_SKEW}
    yield lambda: [spark.conf.set(k, v) for k, v in FORCED_SKEW.items()]
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_tables(spark):
    t = platform_tables(spark)
    t["platform_report"] = spark.range(N).selectExpr(
        "DATE'2024-01-01' + CAST(id % 30 AS INT) AS date",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS ad_id",          # ad 1: a third of rows
        "CASE WHEN id % 3 = 0 THEN 'facebook' ELSE 'instagram' END AS publisher_platform",
        "CAST(id % 100 AS DOUBLE) AS spend", "CAST(1 AS BIGINT) AS clicks",
        "CAST(2 AS BIGINT) AS impressions")
    # every ad points at one of two ad sets: the dimension chain's join key is hot too
    t["ad_history"] = spark.range(N).selectExpr(
        "CAST(id AS STRING) AS id", "concat('ad ', id) AS name",
        "CAST(10 + id % 2 AS STRING) AS ad_set_id", "true AS is_current")
    return t


SPEC = ReportSpec(target="db.skew", dimensions=(FieldSpec("date", "DATE", "date"),
                                                FieldSpec("ad_set_name", "STRING", "ad_set_name")),
                  metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)"),
                           FieldSpec("n", "INT64", "count(*)"),
                           FieldSpec("clicks", "INT64", "sum(clicks)")))


def test_report_with_a_hot_key_is_whole_and_unchanged_by_skew_splits(spark, forced_skew):
    t = _hot_tables(spark)
    base = sorted(platform_report(SPEC, loader(spark, "", t)).collect())
    assert sum(r.clicks for r in base) == N              # no row dropped or sampled
    forced_skew()
    df = platform_report(SPEC, loader(spark, "", t))
    assert sorted(df.collect()) == base
    plan = plan_text(df)                                  # the final adaptive plan
    assert "SortMergeJoin(skew=true)" in plan             # AQE did split the hot partition


def test_latest_by_and_pivot_with_a_hot_key(spark, forced_skew):
    forced_skew()
    hist = spark.range(N).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k",
                                     "id AS t", "CAST(id % 5 AS STRING) AS e", "id AS v")
    top = {r.k: r.t for r in latest_by(hist, ["k"], "t").collect()}
    assert top[0] == max(i for i in range(N) if i % 3 == 0)
    assert len(top) == 1 + sum(1 for i in range(N) if i % 3)
    piv = pivot_metrics(hist, ["k"], "e", [("0", "zero"), ("1", "one")], {"s": F.col("v")})
    hot = piv.where("k = 0").first()
    assert hot.s_zero == sum(i for i in range(N) if i % 3 == 0 and i % 5 == 0)


@pytest.mark.parametrize("big", ["orders", "part", "supplier"])
def test_null_links_of_the_star_join_are_dealt_over_all_partitions(spark, tmp_path, big):
    dims = {"orders": ("o_orderkey", "o_orderpriority", 5), "part": ("p_partkey", "p_name", 7), "supplier": ("s_suppkey", "s_name", 3)}
    # every link is NULL (multiples of 5, 7 and 3); one dimension is too big to be broadcast
    spark.range(4000).selectExpr("id * 105 AS l_orderkey", "id * 105 AS l_partkey", "id * 105 AS l_suppkey",
                                 "1.5D AS l_extendedprice").write.parquet(f"{tmp_path}/lineitem.parquet")
    for table, (key, name, _) in dims.items():
        spark.range(20_000 if table == big else 1).selectExpr(f"id AS {key}", f"sha2(CAST(id AS STRING), 256) AS {name}").write.parquet(f"{tmp_path}/{table}.parquet")
    forced = {"spark.sql.autoBroadcastJoinThreshold": "100k", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in forced}
    try:
        for k, v in forced.items():
            spark.conf.set(k, v)
        df = star_join(spark, str(tmp_path))
        assert plan_text(df).count("SortMergeJoin") == 1
        got = df.withColumn("at", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(r[:7] for r in got) == [(k * 105, k * 105, k * 105, 1.5, None, None, None) for k in range(4000)]
    rows = [r.at for r in got]
    assert len(set(rows)) > 1 and max(map(rows.count, set(rows))) < 2000
