"""Registered queries: each operator of the engine exercised on the driver's tables.

Every callable takes ``(spark, sf_dir)``, reads whole test tables (or stand-ins Spark
derives from them) and returns a lazy DataFrame. Money is cast to ``decimal(18,2)``
before it is summed (exact, independent of addition order) and leaves as ``double`` (the
exact sum's nearest double, the same in every engine); every output column has a fixed
type.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import local_datetime, platform_label
from ..operators.enrich import chain, left_join, stitch_facts
from ..operators.facts import constant_sum, product_sum, rollup
from ..operators.filters import account_allow_list, allow_list_predicate, regex_filters
from ..operators.history import current_only, latest_by
from ..operators.pivot import pivot_metrics
from ..operators.shape import build_report
from ..operators.sync import attach_sync, run_time_literal, sync_info
from ..plans.compact import store_facts
from ..plans.reports import BUILDERS, multi_fact_api
from ..plans.runner import build
from ..sinks.tables import ensure_schema, replace_table, republish
from ..sources.tables import loader
from ..spec import (SELECT_DEFAULT_THEN_ACTIVE, ConversionSpec, ExternalTarget, FieldSpec,
                    RegexFilter, ReportSpec)
from .specs import REPORT_SPECS, RUN_TS, TZ
from .standins import base_table, catalog_sources, spark_sources

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return base_table(spark, sf_dir, name)


def _money(c: str) -> F.Column:
    return F.col(c).cast("decimal(18,2)")


def _ind(event: str) -> F.Column:
    return F.when(F.col("event_type") == event, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


# ---- roll-ups (A1-A13) --------------------------------------------------------------
def daily_rollup(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    out = rollup(li, {"date": F.to_date("l_shipdate"), "l_orderkey": "l_orderkey",
                      "l_linestatus": "l_linestatus"},
                 {"cost": F.sum(_money("l_extendedprice")),
                  "clicks": F.sum(F.col("l_quantity").cast("bigint")),
                  "impressions": F.sum("l_linenumber"),
                  "frequency": constant_sum(0)})
    return out.withColumn("cost", F.col("cost").cast("double"))


def wide_rollup(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    measures = {f"{e}s": F.sum(_ind(e)) for e in ("signup", "purchase", "error", "view", "click")}
    measures["purchase_value"] = F.sum(F.when(F.col("event_type") == "purchase",
                                              _money("value")))
    measures["total_value"] = F.sum(_money("value"))
    measures["events"] = F.sum(F.lit(1).cast("bigint"))
    out = rollup(ev, {"date": F.to_date("ts"), "user_id": "user_id"}, measures)
    return (out.withColumn("purchase_value", F.col("purchase_value").cast("double"))
               .withColumn("total_value", F.col("total_value").cast("double")))


def product_sum_query(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    disc_or_null = F.when(F.col("l_returnflag") != "N", _money("l_discount"))
    out = rollup(li, {"date": F.to_date("l_shipdate")},
                 {"revenue": product_sum(_money("l_extendedprice"), _money("l_discount")),
                  "revenue_skip_null": product_sum(_money("l_extendedprice"), disc_or_null)})
    return (out.withColumn("revenue", F.col("revenue").cast("double"))
               .withColumn("revenue_skip_null", F.col("revenue_skip_null").cast("double")))


def constant_measures(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    out = rollup(li, ["l_returnflag"],
                 {"frequency": constant_sum(0), "row_count": F.sum(F.lit(1).cast("bigint"))},
                 constants={"conversions": F.lit(0).cast("bigint"),
                            "promotion_type": F.lit(""),
                            "run_schedule_start": F.lit(None).cast("timestamp_ntz"),
                            "has_actions": F.lit(True)})
    return out


# ---- dimension versions (F1-F4, W1-W3) ----------------------------------------------
def current_only_query(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    flagged = orders.withColumn(
        "is_current", F.when(F.col("o_orderstatus") == "F", F.lit(True))
                       .when(F.col("o_orderstatus") == "O", F.lit(False)))
    return current_only(flagged, "is_current")


def latest_by_query(spark, sf_dir):
    return latest_by(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])


# ---- joins (J1-J27) ------------------------------------------------------------------
def _order_fact(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return rollup(li, ["l_orderkey"], {"cost": F.sum(_money("l_extendedprice")),
                                       "qty": F.sum(F.col("l_quantity").cast("bigint"))})


def _string_dims(spark, sf_dir):
    """orders -> customer -> nation -> region with string ids (dimension side).

    Whole tables; NULL links (every fifth order's, poor customers') make the join misses.
    """
    orders = _t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).cast("string").alias("customer_id"),
        "o_orderpriority")
    customer = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), "c_name",
        F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).cast("string").alias("nation_id"))
    nation = _t(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"), "n_name",
        F.col("n_regionkey").cast("string").alias("region_id"))
    region = _t(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("id"), "r_name")
    return orders, customer, nation, region


def _snowflake(spark, sf_dir, ids=(), cast=None):
    fact = _order_fact(spark, sf_dir)
    orders, customer, nation, region = _string_dims(spark, sf_dir)
    how = "left"
    if ids:
        how = "inner"
        region = region.where(allow_list_predicate(region, "id", ids, cast))
    base = orders.select(F.col("id").alias("__order_key"), "o_orderpriority",
                         F.col("customer_id").alias("__cust_link"))
    dims = chain(base, [
        (customer, [("__cust_link", "id")], {"c_name": "c_name", "__nation_link": "nation_id"},
         how),
        (nation, [("__nation_link", "id")], {"n_name": "n_name", "__region_link": "region_id"},
         how),
        (region, [("__region_link", "id")], {"region_id": "id", "r_name": "r_name"}, how),
    ], normalise=True)
    cols = ["o_orderpriority", "c_name", "n_name", "region_id", "r_name"]
    out = left_join(fact, dims, [("l_orderkey", "__order_key")], {c: c for c in cols},
                    how=how, normalise=True)
    out = out.select("l_orderkey", F.col("cost").cast("double").alias("cost"), "qty",
                     *cols)
    return account_allow_list(out, "region_id", ids, cast)


def snowflake_chain(spark, sf_dir):
    return _snowflake(spark, sf_dir)


def account_allow_list_query(spark, sf_dir):
    return _snowflake(spark, sf_dir, ids=(1, 2))


def account_allow_list_cast(spark, sf_dir):
    return _snowflake(spark, sf_dir, ids=(1, 2), cast="INT64")


def snowflake_branch(spark, sf_dir):
    fact = _order_fact(spark, sf_dir)
    orders = _t(spark, sf_dir, "orders")
    customer = _t(spark, sf_dir, "customer")
    newest = latest_by(orders, ["o_orderpriority"], "o_orderdate", ["o_orderkey"])
    base = orders.select(F.col("o_orderkey").alias("__order_key"),
                         F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("__cust_link"),
                         F.col("o_orderpriority").alias("__prio_link"))
    dims = chain(base, [
        (customer, [("__cust_link", "c_custkey")], {"c_name": "c_name"}, "left"),
        (newest, [("__prio_link", "o_orderpriority")],
         {"newest_in_priority": "o_orderkey"}, "left"),
    ])
    out = left_join(fact, dims, [("l_orderkey", "__order_key")],
                    {"c_name": "c_name", "newest_in_priority": "newest_in_priority"})
    return out.select("l_orderkey", F.col("cost").cast("double").alias("cost"),
                      "c_name", "newest_in_priority")


def star_join(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    fact = rollup(li, ["l_orderkey", "l_partkey", "l_suppkey"],
                  {"cost": F.sum(_money("l_extendedprice"))})
    # whole dimensions; NULL links make the join misses
    for k, n in (("order", 5), ("part", 7), ("supp", 3)):
        fact = fact.withColumn(f"__{k}_link", F.when(F.col(f"l_{k}key") % n != 0, F.col(f"l_{k}key")))
    orders, part, supplier = (_t(spark, sf_dir, t) for t in ("orders", "part", "supplier"))
    out = left_join(fact, orders, [("__order_link", "o_orderkey")],
                    {"o_orderpriority": "o_orderpriority"}, spread_nulls=True)
    out = left_join(out, part, [("__part_link", "p_partkey")], {"p_name": "p_name"}, spread_nulls=True)
    out = left_join(out, supplier, [("__supp_link", "s_suppkey")], {"s_name": "s_name"}, spread_nulls=True)
    return out.select("l_orderkey", "l_partkey", "l_suppkey",
                      F.col("cost").cast("double").alias("cost"),
                      "o_orderpriority", "p_name", "s_name")


# ---- pivots (A14-A17, X7, X15) -------------------------------------------------------
def _events_by_user_day(spark, sf_dir):
    return _t(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))


def pivot_single(spark, sf_dir):
    ev = _events_by_user_day(spark, sf_dir)
    out = pivot_metrics(ev, ["user_id", "date"], "event_type",
                        [ConversionSpec("view", "views"), ConversionSpec("click", "clicks")],
                        {"actions": _money("value")})
    return out.select("user_id", "date",
                      *[F.col(c).cast("double").alias(c)
                        for c in ("actions_views", "actions_clicks")])


PIVOT_MULTI_VALUES = [ConversionSpec("purchase", "purchase"), ConversionSpec("signup", "signup")]


def _pivot_multi(spark, sf_dir, prune=False):
    ev = _events_by_user_day(spark, sf_dir).select(
        "user_id", "date", "event_type",
        F.col("value").cast("string").alias("amount_txt"),
        F.col("props").alias("props_txt"),
        F.when(F.col("event_id") % 7 == 0, F.lit("n/a"))
         .otherwise((F.col("event_id") % 5).cast("string")).alias("qty_txt"))
    out = pivot_metrics(ev, ["user_id", "date"], "event_type", PIVOT_MULTI_VALUES,
                        {"amount": F.col("amount_txt").try_cast("double"),
                         "props": F.col("props_txt").try_cast("double"),
                         "qty": F.col("qty_txt").try_cast("double")},
                        prune_unlisted=prune)
    return out


def _pivot_multi_cols():
    cols = []
    for m, t in (("amount", "cents"), ("props", "double"), ("qty", "double")):
        for v in PIVOT_MULTI_VALUES:
            cols.append((f"{m}_{v.output_name}", t))
    return cols


def _typed(c: str, t: str) -> F.Column:
    """Output cast; ``cents``: a sum of two-decimal doubles rounded to exact cents first."""
    col = F.col(c).cast("decimal(38,2)") if t == "cents" else F.col(c)
    return col.cast("double").alias(c)


def pivot_multi(spark, sf_dir):
    out = _pivot_multi(spark, sf_dir)
    return out.select("user_id", "date", *[_typed(c, t) for c, t in _pivot_multi_cols()])


def pivot_join_back(spark, sf_dir):
    ev = _events_by_user_day(spark, sf_dir)
    spine = rollup(ev, ["user_id", "date"], {"n_events": F.count(F.lit(1)),
                                             "value": F.sum(_money("value"))})
    wide = _pivot_multi(spark, sf_dir, prune=True)
    cols = [c for c, _ in _pivot_multi_cols()]
    out = left_join(spine, wide, [("user_id", "user_id"), ("date", "date")], {c: c for c in cols})
    return out.select("user_id", "date", "n_events",
                      F.col("value").cast("double").alias("value"),
                      *[_typed(c, t) for c, t in _pivot_multi_cols()])


# ---- freshness (A13, J27, X2-X5) ------------------------------------------------------
def sync_info_cross(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    spine = rollup(ev, {"date": F.to_date("ts"), "event_type": "event_type"},
                   {"n_events": F.count(F.lit(1))})
    ts_type = ev.schema["ts"].dataType
    sync = sync_info(ev, local_datetime("ts", TZ, ts_type), F.to_date("ts"))
    runs = ev.agg(F.max(run_time_literal(RUN_TS)).alias("run_at"))
    return attach_sync(spine, sync).withColumn("run_at", runs.scalar())


# ---- filters and scalars (F7-F9, X10-X12) --------------------------------------------
def regex_filters_query(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    out = regex_filters(part, [RegexFilter("p_name", "^small", True),
                               RegexFilter("p_brand", "#1$", False)])
    return out.select("p_partkey", "p_name", "p_brand", "p_size")


RAW_PLATFORM = ("CASE c_mktsegment WHEN 'BUILDING' THEN 'facebook' "
                "WHEN 'AUTOMOBILE' THEN 'audience_network' WHEN 'MACHINERY' THEN 'unknown' "
                "ELSE concat(lower(c_mktsegment), '_', lower(c_name)) END")


def platform_label_query(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer").select("c_custkey", F.expr(RAW_PLATFORM).alias("raw"))
    return cust.select("c_custkey", "raw", platform_label("raw").alias("platform"))


def star_except(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").drop("o_totalprice", "o_orderpriority")
    return orders.select(F.col("o_orderkey").alias("order_id"),
                         F.col("o_custkey").alias("customer_id"),
                         F.col("o_orderstatus").alias("status"),
                         F.col("o_orderdate").alias("order_date"))


FIELD_SELECTION_SPEC = ReportSpec(
    target="spendlens_home.order_bands",
    selection=SELECT_DEFAULT_THEN_ACTIVE,
    dimensions=(FieldSpec("status", "STRING", "o_orderstatus", default=True, active=True),
                FieldSpec("priority", "STRING", "o_orderpriority", active=True),
                FieldSpec("price_band", "INT64", "o_totalprice / 100000", active=True),
                FieldSpec("custkey", "INT64", "o_custkey")),
    metrics=(FieldSpec("orders", "INT64", "count(*)", default=True),
             FieldSpec("total", "FLOAT64", "sum(CAST(o_totalprice AS DECIMAL(18,2)))",
                       default=True),
             FieldSpec("max_price", "INT64", "max(o_totalprice)", active=True),
             FieldSpec("min_price", "FLOAT64", "min(o_totalprice)")),
)


def field_selection(spark, sf_dir):
    return build_report(_t(spark, sf_dir, "orders"), FIELD_SELECTION_SPEC)


# ---- multi-fact stitching (J19-J26) ---------------------------------------------------
STITCH_COLS = ("date", "ad_id", "_gn_id", "cost", "revenue", "cta_purchase", "likes",
               "purchase", "video_views_p100")


def _stitch(spark, sf_dir, mode):
    spec = ReportSpec(target="spendlens_home.stitch", dimensions=(
        FieldSpec("date", "DATE", "date"),), stitch=mode)
    api = multi_fact_api(spec, loader(spark, "", spark_sources(spark, sf_dir, "multi_fact")))
    return api.select(*STITCH_COLS).withColumn("cost", F.col("cost").cast("double")) \
              .withColumn("revenue", F.col("revenue").cast("double"))


def multi_fact_stitch(spark, sf_dir):
    return _stitch(spark, sf_dir, "as_written")


def multi_fact_grain_safe(spark, sf_dir):
    return _stitch(spark, sf_dir, "grain_safe")


def multi_fact_chained(spark, sf_dir):
    return _stitch(spark, sf_dir, "chained")


def _week_stitch(spark, sf_dir, mode):
    """Two facts whose ``_gn_id`` stands for a user's week, so a group spans days."""
    ev = _t(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), F.col("user_id").alias("ad_id"), "event_type", "value",
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.to_date(F.date_trunc("week", "ts")).cast("string")).alias("_gn_id"))
    keys = ["date", "ad_id", "_gn_id"]
    spine = rollup(ev, keys, {"cost": F.sum(_money("value")), "events": F.count(F.lit(1))})
    sales = rollup(ev.where(F.col("event_type").isin("purchase", "signup")), keys,
                   {"purchases": F.sum(_ind("purchase")), "sale_value": F.sum(_money("value"))})
    out = stitch_facts(spine, None, [(sales, ["purchases", "sale_value"])], mode=mode)
    return out.withColumn("cost", F.col("cost").cast("double")) \
              .withColumn("sale_value", F.col("sale_value").cast("double"))


def multi_fact_week(spark, sf_dir):
    return _week_stitch(spark, sf_dir, "as_written")


def multi_fact_week_chained(spark, sf_dir):
    return _week_stitch(spark, sf_dir, "chained")


def history_fan_out(spark, sf_dir, latest: bool = False):
    ev = _events_by_user_day(spark, sf_dir)
    spine = rollup(ev, ["date", "user_id"], {"n_events": F.count(F.lit(1))})
    ads = _t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ad_id"),
        F.concat(F.lit("ad "), F.col("o_orderkey").cast("string")).alias("ad_name"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("campaign_id"),
        "o_orderdate", "o_orderkey")
    if latest:  # the opt-in: newest version per ad instead of every version
        ads = latest_by(ads, ["ad_id"], "o_orderdate", ["o_orderkey"])
    campaigns = _t(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("campaign_id"),
        F.col("n_name").alias("campaign_name"),
        F.col("n_regionkey").cast("bigint").alias("advertiser_id"))
    accounts = _t(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("advertiser_id"), F.col("r_name").alias("name"))
    base = ads.select(F.col("ad_id").alias("__ad_key"), "ad_name",
                      F.col("campaign_id").alias("__camp_link"))
    dims = chain(base, [
        (campaigns, [("__camp_link", "campaign_id")],
         {"campaign_name": "campaign_name", "__adv_link": "advertiser_id"}, "left"),
        (accounts, [("__adv_link", "advertiser_id")], {"advertiser_name": "name"}, "left"),
    ])
    cols = ["ad_name", "campaign_name", "advertiser_name"]
    out = left_join(spine, dims, [("user_id", "__ad_key")], {c: c for c in cols})
    return out.select("date", "user_id", "n_events", *cols)


def history_latest(spark, sf_dir):
    return history_fan_out(spark, sf_dir, latest=True)


# ---- sinks (K1-K6, S28) ---------------------------------------------------------------
PUBLISH_SPEC = ReportSpec(
    target="spendlens_home.star_join",
    dimensions=(FieldSpec("l_orderkey", "INT64", "l_orderkey"),
                FieldSpec("l_partkey", "INT64", "l_partkey"),
                FieldSpec("l_suppkey", "INT64", "l_suppkey"),
                FieldSpec("o_orderpriority", "STRING", "o_orderpriority"),
                FieldSpec("p_name", "STRING", "p_name"),
                FieldSpec("s_name", "STRING", "s_name")),
    metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)"),),
    external=ExternalTarget(active=True, database="spendlens_external", location="EU",
                            description="republished reports", friendly_name="Reports"),
)


def publish_round_trip(spark, sf_dir):
    """Write the star join as a typed, commented table, republish it, read the copy.

    Each run has table names of its own, so runs that share a warehouse do not meet.
    """
    spec = replace(PUBLISH_SPEC, target=f"{PUBLISH_SPEC.target}_{uuid.uuid4().hex[:12]}")
    ensure_schema(spark, "spendlens_home", "report outputs")
    replace_table(star_join(spark, sf_dir), spec.target, spec)
    dst = republish(spark, spec)
    return spark.table(dst)


def published_schema(spark, sf_dir):
    """What the catalog shows of the published copy: its columns with types and comments, and
    its schema's comment and properties, each with the number of rows published."""
    run = uuid.uuid4().hex[:12]
    spec = replace(PUBLISH_SPEC, target=f"{PUBLISH_SPEC.target}_{run}",
                   external=replace(PUBLISH_SPEC.external, database=f"spendlens_external_{run}"))
    ensure_schema(spark, "spendlens_home", "report outputs")
    replace_table(star_join(spark, sf_dir), spec.target, spec)
    dst = republish(spark, spec)
    columns = spark.sql(f"DESCRIBE TABLE {dst}").select(
        F.lit("column").alias("kind"), F.col("col_name").alias("name"), F.concat_ws(" ", "data_type", "comment").alias("value"))
    schema = spark.sql(f"DESCRIBE DATABASE EXTENDED {spec.external.database}").select("info_name", "info_value")
    props = schema.where("info_name = 'Properties'").select(
        F.explode(F.expr("regexp_extract_all(info_value, '[(]([^(),]+,[^()]*)[)]', 1)")).alias("p"))
    schema = schema.where("info_name = 'Comment'").select(F.lit("schema").alias("kind"), F.lit("comment").alias("name"), F.col("info_value").alias("value")).union(
        props.select(F.lit("schema"), F.substring_index("p", ",", 1), F.expr("substring(p, instr(p, ',') + 1)")))
    return columns.union(schema).withColumn("published_rows", spark.table(dst).agg(F.count(F.lit(1))).scalar())


# ---- sources through the catalog (C8) ---------------------------------------------------
def report_campaign_catalog(spark, sf_dir):
    """The campaign report whose sources are tables of a catalog schema (here views over the files)."""
    schema = f"spendlens_sources_{uuid.uuid4().hex[:12]}"
    ensure_schema(spark, schema, "source tables of the campaign report")
    catalog_sources(spark, sf_dir, "campaign", schema)
    spec = replace(REPORT_SPECS["campaign"], source=schema)
    return build(spark, "campaign", spec)


def report_multi_fact_bucketed(spark, sf_dir):
    """The multi-fact report over its facts stored at their grain, bucketed by ad."""
    schema = f"spendlens_facts_{uuid.uuid4().hex[:12]}"
    ensure_schema(spark, schema, "daily facts of the multi-fact report")
    sources = spark_sources(spark, sf_dir, "multi_fact_week")
    names = store_facts(spark, loader(spark, "", sources), schema, 8, timezone=REPORT_SPECS["multi_fact_week"].timezone)
    stored = {name.split(".")[-1].strip("`"): spark.table(name) for name in names}
    return BUILDERS["multi_fact"](REPORT_SPECS["multi_fact_week"], loader(spark, "", {**sources, **stored}))


# ---- whole reports (R1-R5) -----------------------------------------------------------
def _report(kind: str) -> Query:
    def run(spark, sf_dir):
        spec = REPORT_SPECS[kind]
        return BUILDERS[kind.removesuffix("_week")](spec, loader(spark, "", spark_sources(spark, sf_dir, kind)))
    run.__name__ = f"report_{kind}"
    return run


QUERIES: dict[str, Query] = {
    "daily_rollup": daily_rollup,
    "wide_rollup": wide_rollup,
    "product_sum": product_sum_query,
    "constant_measures": constant_measures,
    "current_only": current_only_query,
    "latest_by": latest_by_query,
    "snowflake_chain": snowflake_chain,
    "snowflake_branch": snowflake_branch,
    "star_join": star_join,
    "pivot_single": pivot_single,
    "pivot_multi": pivot_multi,
    "pivot_join_back": pivot_join_back,
    "sync_info_cross": sync_info_cross,
    "account_allow_list": account_allow_list_query,
    "account_allow_list_cast": account_allow_list_cast,
    "regex_filters": regex_filters_query,
    "platform_label": platform_label_query,
    "star_except": star_except,
    "field_selection": field_selection,
    "multi_fact_stitch": multi_fact_stitch,
    "multi_fact_grain_safe": multi_fact_grain_safe,
    "multi_fact_chained": multi_fact_chained,
    "multi_fact_week": multi_fact_week,
    "multi_fact_week_chained": multi_fact_week_chained,
    "history_fan_out": history_fan_out,
    "history_latest": history_latest,
    "publish_round_trip": publish_round_trip,
    "published_schema": published_schema,
    "report_campaign_catalog": report_campaign_catalog,
    "report_multi_fact_bucketed": report_multi_fact_bucketed,
    "report_platform": _report("platform"),
    "report_campaign": _report("campaign"),
    "report_ad_group": _report("ad_group"),
    "report_keyword": _report("keyword"),
    "report_multi_fact": _report("multi_fact"),
    "report_multi_fact_week": _report("multi_fact_week"),
}
