"""Freshness out of the roll-up's own exchange: one scan of the fact, the same values."""

import re
from dataclasses import replace

import pytest
from conftest import plan_text, rows
from fixtures import platform_tables
from pyspark.sql import functions as F
from spendlens.catalog.specs import REPORT_SPECS
from spendlens.catalog.standins import spark_sources
from spendlens.operators.facts import rollup
from spendlens.operators.sync import rollup_with_sync, sync_info
from spendlens.plans import BUILDERS
from spendlens.sources import loader
from spendlens.spec import FieldSpec

SF = "/root/testdata/sf0.001"
FACTS = {"platform": "platform_report", "campaign": "ad_analytics_by_campaign", "ad_group": "ad_performance_report",
         "keyword": "keyword_performance_report", "multi_fact": "ads_basic_data_metrics_by_day_report"}


def unfiltered(kind, **more):
    metrics = [m for m in REPORT_SPECS[kind].metrics if m.name not in ("last_synced_at", "last_data_date")]
    fresh = (FieldSpec("last_synced_at", "DATE", "max(last_synced_at)"), FieldSpec("last_data_date", "DATE", "max(last_data_date)"))
    return replace(REPORT_SPECS[kind], selection="all", metrics=(*metrics, *fresh), account_ids=(), regex_filters=(), **more)


@pytest.mark.parametrize("kind", list(FACTS))
def test_one_scan_of_the_fact_and_a_reused_exchange(spark, kind, tmp_path):
    tables = spark_sources(spark, SF, kind)
    # the fact in a file of its own, so that its scans can be told apart
    tables[FACTS[kind]].write.parquet(str(tmp_path / "the_fact.parquet"))
    tables[FACTS[kind]] = spark.read.parquet(str(tmp_path / "the_fact.parquet"))
    out = BUILDERS[kind](unfiltered(kind), loader(spark, "", tables))
    got = out.collect()
    final = plan_text(out).split("== Initial Plan ==")
    executed = final[0] + "".join(p.split("== Final Plan ==")[1] for p in final[1:] if "== Final Plan ==" in p)
    assert "ReusedExchange" in executed
    assert len(re.findall(r"FileScan parquet[^\n]*the_fact\.parquet", executed)) - executed.count("ReusedExchange") <= 1
    # the value is that of the fact's rows
    day = {"campaign": "day", "multi_fact": "stat_time_day"}.get(kind, "date")
    latest = tables[FACTS[kind]].agg(F.max(F.to_date(day)).alias("d")).first().d
    assert {r.last_data_date for r in got} == {latest}
    assert len({(r.last_synced_at, r.last_data_date) for r in got}) == 1


def test_the_same_row_as_over_the_rows(spark):
    import datetime as dt
    data = [(dt.date(2024, 1, d) if d else None, a, dt.datetime(2024, 2, s) if s else None, 1) for d, a, s in
            [(1, 1, 3), (1, 1, 5), (2, 2, None), (0, 1, 9), (0, None, None)]]
    fact = spark.createDataFrame(data, "date date, ad_id long, stamp timestamp_ntz, spend long")
    for part in (fact, fact.where("ad_id = 2"), fact.where("spend > 5")):
        grouped = rollup(part, ["date", "ad_id"], {"cost": F.sum("spend"), "s": F.max("stamp")})
        kept, sync = rollup_with_sync(grouped, "s")
        assert rows(sync) == rows(sync_info(part, F.col("stamp"), F.col("date")))
        assert rows(kept) == rows(grouped.drop("s"))
        const = F.lit("2024-05-01").cast("date")
        assert rows(rollup_with_sync(grouped, const)[1]) == rows(sync_info(part, const, F.col("date")))


def test_filters_keep_a_narrow_scan_of_their_own(spark):
    spec = replace(REPORT_SPECS["platform"], account_ids=())
    plan = plan_text(BUILDERS["platform"](spec, loader(spark, "", spark_sources(spark, SF, "platform"))), "extended")
    assert "% 2) < 2)" not in plan
    # a report that does not read freshness has neither
    bare = replace(unfiltered("platform"), metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)"),))
    plan = plan_text(BUILDERS["platform"](bare, loader(spark, "", platform_tables(spark))), "extended")
    assert "% 2) < 2)" not in plan and "scalar-subquery" not in plan.split("Optimized")[1]
