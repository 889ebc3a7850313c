"""Left joins that nobody reads are left out, and only where that changes no row."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from conftest import plan_text, rows
from spendlens.catalog.specs import REPORT_SPECS
from spendlens.catalog.standins import spark_sources
from spendlens.plans import BUILDERS, reports
from spendlens.plans.links import Link, needed_links
from spendlens.sources import loader
from spendlens.spec import FieldSpec

SF = "/root/testdata/sf0.001"
#: A field of each dimension of each report, and the tables behind its joins.
FIELDS = {
    "platform": {"ad_name": "ad_history", "ad_set_name": "ad_set_history", "campaign_name": "campaign_history", "account_name": "account_history"},
    "campaign": {"campaign_name": "campaign_history", "campaign_group_name": "campaign_group_history", "account_name": "account_history"},
    "ad_group": {"campaign_name": "campaign_history", "ad_group_name": "ad_group_history", "account_name": "account_history"},
    "keyword": {"campaign_name": "campaign_history", "ad_group_name": "ad_group_history", "account_name": "account_history", "keyword_text": "keyword_history"},
}


def report(spark, kind, fields, **more):
    spec = replace(REPORT_SPECS[kind], selection="all", account_ids=(), regex_filters=(),
                   dimensions=(FieldSpec("date", "DATE", "date"), *(FieldSpec(f, "STRING", f) for f in fields)),
                   metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)"), FieldSpec("n", "INT64", "count(*)")), **{"unique_ids": (), **more})
    return BUILDERS[kind](spec, loader(spark, "", spark_sources(spark, SF, kind)))


def joins(df):
    return plan_text(df, "extended").split("Optimized Logical Plan")[1].split("Physical Plan")[0].count("Join ")


@pytest.mark.parametrize("kind,kept", [("platform", ["campaign_name"]), ("platform", ["ad_name"]), ("platform", []), ("campaign", ["campaign_group_name"]),
                                       ("campaign", []), ("ad_group", ["ad_group_name"]), ("keyword", ["keyword_text"]), ("keyword", [])])
def test_reports_are_equal_with_fewer_joins(spark, kind, kept):
    lean = report(spark, kind, kept, unique_ids=tuple(FIELDS[kind].values()))
    # the relation with all joins
    api = getattr(reports, f"{kind}_api")(replace(REPORT_SPECS[kind], account_ids=()), loader(spark, "", spark_sources(spark, SF, kind)))
    full = api.groupBy("date", *kept).agg(F.sum("cost").cast("double").alias("cost"), F.count(F.lit(1)).alias("n"))
    assert rows(lean) == rows(full)
    assert joins(lean) < joins(full)
    if kind != "campaign":  # there newest versions are unique by construction
        assert joins(report(spark, kind, kept)) == joins(full)


def test_the_keyword_report_leaves_out_two_dimension_joins(spark):
    spec = REPORT_SPECS["keyword"]
    load = loader(spark, "", spark_sources(spark, SF, "keyword"))
    lean, full = BUILDERS["keyword"](spec, load), BUILDERS["keyword"](replace(spec, unique_ids=()), load)
    assert joins(full) - joins(lean) == 2 and rows(lean) == rows(full)
    plan = plan_text(lean, "formatted")
    assert "supplier.parquet" not in plan and "part.parquet" not in plan


def test_a_declared_dimension_that_repeats_ids_raises(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "id bigint, name string")
    link = Link(dim, [("key", "id")], {"name_": "name"}, declared="dimension_x")
    assert needed_links([link], frozenset({"name_"})) == [link]  # read: joined, not checked
    assert needed_links([link], None) == [link]
    with pytest.raises(ValueError, match="dimension_x is not unique"):
        needed_links([link], frozenset())
    once = Link(dim.where("name <> 'b'"), [("key", "id")], {"name_": "name"}, declared="dimension_x")
    assert needed_links([once], frozenset()) == []


def test_links_that_others_need_or_that_filter_stay(spark):
    dim = spark.createDataFrame([(1, 2)], "id bigint, up bigint")
    far = Link(dim, [("link", "id")], {"far": "up"}, unique=True)
    near = Link(dim, [("key", "id")], {"link": "up"}, unique=True)
    assert needed_links([near, far], frozenset({"far"})) == [near, far]
    assert needed_links([near, far], frozenset({"link"})) == [near]
    assert needed_links([near, far], frozenset()) == []
    inner = replace(near, how="inner")
    assert needed_links([inner, far], frozenset()) == [inner]
    assert needed_links([replace(near, unique=False), far], frozenset()) == [replace(near, unique=False)]
