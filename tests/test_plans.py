"""Physical plan checks: shuffles, window limits, pruned scans.

Broadcast joins are switched off here so the plans look like plans over large inputs.
"""

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from fixtures import platform_tables, star_tables
from spendlens.operators import latest_by, pivot_metrics, rollup, stitch_facts
from spendlens.plans import ad_group_report, platform_report
from spendlens.sources import loader
from spendlens.spec import ConversionSpec, FieldSpec, ReportSpec
from test_reports import PLATFORM, STAR


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "-1")
    spark.conf.set(keys[2], "false")  # static plan: shuffles are exactly what is planned
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _plan(df):
    return plan_text(df)


def _shuffles(plan):
    return len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition", plan))


def test_pivot_is_one_shuffle(no_broadcast):
    spark = no_broadcast
    df = spark.range(100).selectExpr("id % 7 AS k", "CAST(id % 3 AS STRING) AS e", "id AS v")
    out = pivot_metrics(df, ["k"], "e", [("0", "a"), ("1", "b")], {"s": F.col("v")})
    assert _shuffles(_plan(out)) == 1
    native = df.groupBy("k").pivot("e", ["0", "1"]).sum("v")
    assert _shuffles(_plan(native)) == 2  # what the conditional sums avoid


def test_latest_by_limits_before_the_shuffle(no_broadcast):
    spark = no_broadcast
    df = spark.range(1000).selectExpr("id % 10 AS k", "id AS t")
    plan = _plan(latest_by(df, ["k"], "t"))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.index("Partial") > plan.index("Exchange")  # partial limit sits below it


def test_grain_safe_stitch_reuses_one_partitioning(no_broadcast):
    spark = no_broadcast
    base = spark.range(200).selectExpr("CAST(DATE'2024-01-01' + CAST(id % 3 AS INT) AS DATE) AS d",
                                       "id % 11 AS ad_id", "CAST(id % 5 AS STRING) AS g", "id AS v")
    facts = [rollup(base, {"date": "d", "ad_id": "ad_id", "_gn_id": "g"}, {f"m{i}": F.sum("v")})
             for i in range(4)]
    for mode in ("grain_safe", "chained"):
        out = stitch_facts(facts[0], None,
                           [(f, [f"m{i}"]) for i, f in enumerate(facts[1:], 1)], mode=mode)
        assert _shuffles(_plan(out)) == 4  # one per roll-up, none for the three joins


def test_pivot_join_back_adds_no_shuffle(no_broadcast):
    spark = no_broadcast
    t = star_tables(spark)
    lines = _plan(ad_group_report(STAR, loader(spark, "", t))).split("\n")
    # the pivot is joined on the roll-up's grain: the join's subtree holds just the two
    # aggregates' own shuffles, none added to co-partition them for the join
    i = next(i for i, line in enumerate(lines) if "SortMergeJoin [date#" in line)
    depth = lines[i].index("+-")
    sub = []
    for line in lines[i + 1:]:
        m = re.search(r"[:+]- ", line)
        if m is None or m.start() <= depth:
            break
        sub.append(line)
    assert sum("Exchange hashpartitioning" in line for line in sub) == 2, sub


def test_unused_freshness_is_not_computed(spark):
    t = platform_tables(spark)
    spec = ReportSpec(target="db.p", dimensions=(FieldSpec("date", "DATE", "date"),),
                      metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)"),))
    plan = _plan(platform_report(spec, loader(spark, "", t)))
    assert "Subquery" not in plan and "NestedLoopJoin" not in plan
    used = ReportSpec(**{**spec.__dict__, "metrics": (
        FieldSpec("d", "DATE", "max(last_data_date)"), FieldSpec("s", "DATETIME",
                                                                   "max(last_synced_at)"))})
    plan = _plan(platform_report(used, loader(spark, "", t)))
    # attached as a scalar subquery (one small job), never as a join
    assert "Subquery" in plan and "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # both values come from one merged subquery that runs once (the other use is reused);
    # shown on the static plan, since adaptive execution applies the reuse while running
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        static = _plan(platform_report(used, loader(spark, "", t)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(set(re.findall(r"Subquery (?:scalar-)?subquery#(\d+)", static))) == 1
    assert "ReusedSubquery" in static


def test_scans_read_only_used_columns(spark, tmp_path):
    t = platform_tables(spark)
    path = str(tmp_path / "platform_report")
    t["platform_report"].withColumn("unused_wide", F.lit("x" * 50)).write.parquet(path)
    t["platform_report"] = spark.read.parquet(path)
    spec = ReportSpec(target="db.p", dimensions=(FieldSpec("date", "DATE", "date"),),
                      metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)"),))
    plan = _plan(platform_report(spec, loader(spark, "", t)))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    fact_scans = [s for s in scans if "spend" in s]
    assert fact_scans and all("unused_wide" not in s and "clicks" not in s for s in fact_scans)


def test_allow_list_prunes_the_fact_with_a_runtime_bloom_filter(spark, tmp_path):
    """With a big fact (threshold lowered here) and no broadcast, the filtered account
    dimension feeds a bloom filter that prunes the fact side before its shuffle."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1b"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        for name, df in star_tables(spark).items():
            df.write.parquet(str(tmp_path / name))
        spec = ReportSpec(**{**STAR.__dict__, "account_ids": (100,)})
        df = ad_group_report(spec, loader(spark, str(tmp_path)))
        plan = plan_text(df, "extended")
        assert "might_contain" in plan and "bloom_filter_agg" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_latest_by_reads_only_the_columns_of_the_report(spark, tmp_path):
    wide = spark.range(20).selectExpr("id", "id % 3 AS k", "id AS t", "concat('n', id) AS name",
                                      *[f"id AS w{i}" for i in range(10)])
    wide.write.parquet(str(tmp_path / "hist"))
    load = loader(spark, str(tmp_path))
    out = latest_by(load("hist", ["k", "name", "t"]), ["k"], "t")
    schema = re.findall(r"ReadSchema: (\S+)", plan_text(out, "formatted"))
    assert schema == ["struct<k:bigint,t:bigint,name:string>"]


def test_platform_chain_shuffles_the_ads_at_most_twice(no_broadcast):
    spark = no_broadcast
    spec = ReportSpec(**{**PLATFORM.__dict__, "account_ids": (), "actions": False, "action_values": False,
                         "metrics": (FieldSpec("cost", "FLOAT64", "sum(cost)"),)})
    spec = ReportSpec(**{**spec.__dict__, "dimensions": tuple(
        f for f in spec.dimensions) + (FieldSpec("ad_label", "STRING", "ad_name"),)})
    lines = _plan(platform_report(spec, loader(spark, "", platform_tables(spark)))).split("\n")
    # exchanges that carry the ad's own columns before it meets the fact
    ads = [line for line in lines if "Exchange hashpartitioning(" in line
           and re.search(r"hashpartitioning\((ad_set_id|id|__ad_key|__ad_set_link)#", line)]
    assert 0 < len(ads) <= 4, ads  # ads by link and by key, ad sets by link and by key
