"""The plan summariser behind PLANS.md reads shuffles, joins, scans and subqueries."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import plan_text  # noqa: E402
from plan_summary import summarise  # noqa: E402


def test_summarise_reads_a_real_plan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id % 7 AS k", "id AS v").write.parquet(path)
    df = spark.read.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        agg = df.where("v > 10").groupBy("k").sum("v")
        joined = agg.join(df.groupBy("k").count(), "k", "left")
        s = summarise(plan_text(joined))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert any(x.startswith("hashpartitioning(k, ") for x in s["shuffles"])
    assert any(j.startswith("SortMergeJoin") and j.endswith("LeftOuter") for j in s["joins"])
    assert any("GreaterThan(v,10)" in filters for _, filters in s["scans"])
    assert s["subqueries"] == 0
