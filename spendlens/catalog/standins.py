"""Stand-in source tables built from the driver's TPC-H-like test tables.

The test tables hold no advertising data, so each report's sources are derived from them
with plain projections (e.g. lineitem -> daily ad stats, orders -> ad versions). Every
stand-in is one SELECT over whole test tables, written in the SQL subset Spark and
DuckDB share, so the registered Spark queries and their DuckDB oracles start from
identical inputs; ``{ts_ntz}`` is the one type name the two spell differently.

Spark runs the text with ``spark.sql(text, table=DataFrame)``: no temp views, nothing
collected, the result is an ordinary lazy DataFrame whose work grows with the tables.

The ``WHERE event_type IN (...)`` clauses of the multi-fact stand-ins give each daily fact
table its kind of event (attribution rows are sign-ups and purchases, video rows are
views, ...), and ``% n`` expressions map ids onto a few campaigns and advertisers; every
event row still lands in the spine and in at least one fact. Nothing is sampled, capped
or cut to make a check cheaper.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..plans.reports import ATTRIBUTION, ENGAGEMENT, IN_APP_EVENT, PAGE_EVENT, VIDEO_PLAY

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events")

PLATFORM = ("CASE l_linenumber WHEN 1 THEN 'facebook' WHEN 2 THEN 'instagram' "
            "WHEN 3 THEN 'messenger' WHEN 4 THEN 'audience_network' WHEN 5 THEN 'unknown' "
            "WHEN 6 THEN 'threads_feed-beta' END")
BIG1 = "CAST(1 AS BIGINT)"
BIG0 = "CAST(0 AS BIGINT)"
MONEY_EV = "CAST(value AS DECIMAL(18,2))"


def _ind(event: str) -> str:
    return f"CASE WHEN event_type = '{event}' THEN {BIG1} ELSE {BIG0} END"


GN_ID = "concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING))"
_FACT_KEYS = f"ts AS stat_time_day, user_id AS ad_id, {GN_ID} AS _gn_id"
# the page fact has group ids of its own for every third ad: the source joins it by ad and day
_PAGE_KEYS = (f"ts AS stat_time_day, user_id AS ad_id, CASE WHEN user_id % 3 = 0 "
              f"THEN concat('page-', {GN_ID}) ELSE {GN_ID} END AS _gn_id")


def _measures(cols, given: Mapping[str, str]) -> str:
    return ", ".join(f"{given.get(c, BIG0)} AS {c}" for c in cols)


PLATFORM_SOURCES = {
    "platform_report": f"""
        SELECT CAST(l_shipdate AS DATE) AS date, l_orderkey AS ad_id,
               {PLATFORM} AS publisher_platform,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS spend,
               CAST(l_quantity AS BIGINT) AS clicks,
               CAST(l_quantity AS BIGINT) * 10 + l_linenumber AS impressions
        FROM {{lineitem}}""",
    "platform_report_actions": f"""
        SELECT l_orderkey AS ad_id, {PLATFORM} AS publisher_platform,
               CAST(l_shipdate AS DATE) AS date,
               CASE l_returnflag WHEN 'R' THEN 'purchase' WHEN 'A' THEN 'add_to_cart'
                    ELSE 'view_content' END AS action_type,
               CAST(l_quantity AS DECIMAL(18,2)) AS value
        FROM {{lineitem}}""",
    "platform_report_action_values": f"""
        SELECT l_orderkey AS ad_id, {PLATFORM} AS publisher_platform,
               CAST(l_shipdate AS DATE) AS date,
               CASE l_linestatus WHEN 'F' THEN 'purchase' ELSE 'lead' END AS action_type,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS value
        FROM {{lineitem}}""",
    "ad_history": """
        SELECT CAST(o_orderkey AS STRING) AS id, concat('ad ', CAST(o_orderkey AS STRING)) AS name,
               CAST(o_custkey AS STRING) AS ad_set_id,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE true END AS is_current
        FROM {orders}
        UNION ALL
        SELECT CAST(o_orderkey AS STRING) AS id,
               concat('old ad ', CAST(o_orderkey AS STRING)) AS name,
               CAST(o_custkey AS STRING) AS ad_set_id, false AS is_current
        FROM {orders}""",
    "ad_set_history": """
        SELECT CAST(c_custkey AS STRING) AS id, c_name AS name,
               CAST(c_nationkey AS STRING) AS campaign_id, c_acctbal > 0 AS is_current
        FROM {customer}""",
    "campaign_history": """
        SELECT CAST(n_nationkey AS STRING) AS id, n_name AS name,
               CAST(n_regionkey AS STRING) AS account_id, true AS is_current
        FROM {nation}""",
    "account_history": """
        SELECT CAST(r_regionkey AS STRING) AS account_id, r_name AS name,
               r_regionkey <> 4 AS is_current
        FROM {region}""",
}

CAMPAIGN_SOURCES = {
    "ad_analytics_by_campaign": f"""
        SELECT o_orderdate AS day, o_custkey AS campaign_id,
               CAST(o_totalprice AS DECIMAL(18,2)) AS cost_in_usd, {BIG1} AS clicks,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS impressions,
               CASE WHEN o_orderstatus = 'F' THEN {BIG1} ELSE {BIG0} END
                   AS external_website_conversions,
               o_orderkey % 3 AS comments, o_custkey % 2 AS follows, {BIG1} AS shares,
               CAST(2 AS BIGINT) AS landing_page_clicks, o_orderdate AS _fivetran_synced
        FROM {{orders}}""",
    "campaign_history": """
        SELECT o_custkey AS id,
               concat('campaign ', CAST(o_custkey AS STRING), ' ', o_orderpriority) AS name,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS campaign_group_id,
               CASE o_orderstatus WHEN 'F' THEN CAST(1 AS BIGINT)
                                  WHEN 'O' THEN CAST(2 AS BIGINT) END AS account_id,
               o_orderdate AS last_modified_time, o_orderkey AS version_id
        FROM {orders}""",
    "campaign_group_history": """
        SELECT CAST(s_nationkey AS BIGINT) AS id, s_name AS name,
               CAST(make_date(2020, 1, CAST(1 + s_suppkey % 5 AS INT)) AS {ts_ntz})
                   AS last_modified_time,
               s_suppkey AS version_id
        FROM {supplier}""",
    "account_history": """
        SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name,
               CAST(make_date(2020, 1, 1) AS {ts_ntz}) AS last_modified_time,
               CAST(r_regionkey AS BIGINT) AS version_id
        FROM {region}""",
}

_STAR_FACT = """
        SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS campaign_id,
               l_partkey AS ad_group_id, CAST(l_linenumber AS BIGINT) AS account_id,{kw}
               CAST(l_extendedprice AS DECIMAL(18,2)) AS spend,
               CAST(l_quantity AS BIGINT) AS clicks,
               CAST(l_quantity AS BIGINT) * 10 AS impressions,
               CASE WHEN l_returnflag = 'R' THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END
                   AS conversions,
               CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))
                   AS revenue
        FROM {{lineitem}}"""

STAR_SOURCES = {
    "ad_performance_report": _STAR_FACT.format(kw=""),
    "keyword_performance_report": _STAR_FACT.format(kw=" l_orderkey AS keyword_id,"),
    "goals_and_funnels_report": """
        SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_linenumber AS BIGINT) AS account_id,
               l_partkey AS ad_group_id, l_suppkey AS campaign_id, l_orderkey AS keyword_id,
               CASE WHEN l_linenumber = 7 THEN 'n/a'
                    ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS all_conversions,
               CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) AS all_revenue,
               CAST(l_linenumber AS STRING) AS view_through_conversions,
               CASE l_returnflag WHEN 'R' THEN 'Purchase' WHEN 'A' THEN 'Lead'
                    ELSE 'Newsletter' END AS goal
        FROM {lineitem}""",
    "campaign_history": """
        SELECT s_suppkey AS id, s_name AS name, s_acctbal > 0 AS _gn_active FROM {supplier}""",
    "ad_group_history": """
        SELECT p_partkey AS id, p_name AS name, p_size > 5 AS _gn_active FROM {part}""",
    "account_history": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
               n_regionkey <> 3 AS _gn_active
        FROM {nation}""",
    "keyword_history": """
        SELECT o_orderkey AS id, concat('kw ', o_orderpriority) AS text,
               CASE o_orderstatus WHEN 'F' THEN 'exact' WHEN 'O' THEN 'phrase'
                    ELSE 'broad' END AS match_type,
               o_orderstatus <> 'P' AS _gn_active
        FROM {orders}""",
}

MULTI_FACT_SOURCES = {
    "ads_basic_data_metrics_by_day_report": f"""
        SELECT {_FACT_KEYS}, {MONEY_EV} AS spend, {_ind('click')} AS clicks,
               {BIG0} AS real_time_conversion, {BIG1} AS impressions,
               {_ind('purchase')} AS conversion, {_ind('signup')} AS result,
               {_ind('error')} AS real_time_result, ts AS _fivetran_synced
        FROM {{events}}""",
    ATTRIBUTION[0]: f"""
        SELECT {_FACT_KEYS}, {_measures(ATTRIBUTION[1], {
            'cta_registration': _ind('signup'), 'cta_purchase': _ind('purchase'),
            'cta_conversion': BIG1, 'vta_purchase': MONEY_EV})}
        FROM {{events}} WHERE event_type IN ('signup', 'purchase')""",
    ENGAGEMENT[0]: f"""
        SELECT {_FACT_KEYS}, {_measures(ENGAGEMENT[1], {
            'clicks_on_music_disc': _ind('click'), 'follows': _ind('view'),
            'likes': BIG1, 'profile_visits': BIG1})}
        FROM {{events}} WHERE event_type IN ('click', 'view')""",
    IN_APP_EVENT[0]: f"""
        SELECT {_FACT_KEYS}, {_measures(IN_APP_EVENT[1], {
            'purchase': BIG1, 'checkout': MONEY_EV})}
        FROM {{events}} WHERE event_type = 'purchase'""",
    VIDEO_PLAY[0]: f"""
        SELECT {_FACT_KEYS}, {_measures(VIDEO_PLAY[1], {
            'video_views_p100': BIG1, 'video_views_p25': BIG1, 'video_play_actions': BIG1})}
        FROM {{events}} WHERE event_type = 'view'""",
    PAGE_EVENT[0]: f"""
        SELECT {_PAGE_KEYS},
               CASE WHEN event_type = 'purchase' THEN {BIG1} END AS complete_payment,
               {MONEY_EV} AS value_per_complete_payment,
               {_measures(PAGE_EVENT[1], {'on_web_order': _ind('purchase'),
                                          'button_click': _ind('error')})}
        FROM {{events}} WHERE event_type IN ('purchase', 'error')""",
    "ad_history": """
        SELECT user_id AS ad_id, concat('ad ', CAST(user_id AS STRING)) AS ad_name,
               user_id % 10 AS adgroup_id,
               concat('group ', CAST(user_id % 10 AS STRING)) AS adgroup_name,
               CAST(user_id % 4 AS STRING) AS advertiser_id, user_id % 7 AS campaign_id
        FROM {events} GROUP BY user_id""",
    "campaign_history": """
        SELECT user_id % 7 AS campaign_id,
               concat('campaign ', CAST(user_id % 7 AS STRING)) AS campaign_name,
               CASE WHEN user_id % 7 < 3 THEN 'CONVERSIONS' ELSE 'TRAFFIC' END
                   AS objective_type,
               CAST(user_id % 7 % 3 AS STRING) AS advertiser_id
        FROM {events} GROUP BY user_id % 7""",
    "ad_accounts_history": """
        SELECT CAST(user_id % 3 AS STRING) AS advertiser_id,
               concat('advertiser ', CAST(user_id % 3 AS STRING)) AS name,
               CASE WHEN user_id % 3 = 0 THEN 'USD' ELSE 'EUR' END AS currency
        FROM {events} GROUP BY user_id % 3""",
}

# the same facts with a group id that stands for a user's week, so that a group spans days
# and the source's joins pair them; and ads with several versions
_WEEK_GN_ID = ("concat(CAST(user_id AS STRING), '-', "
               "CAST(CAST(date_trunc('week', ts) AS DATE) AS STRING))")
MULTI_FACT_WEEK_SOURCES = {
    **{name: text.replace(GN_ID, _WEEK_GN_ID) for name, text in MULTI_FACT_SOURCES.items()},
    "ad_history": """
        SELECT user_id AS ad_id, concat('ad ', CAST(user_id AS STRING), ' ', event_type) AS ad_name,
               user_id % 10 AS adgroup_id,
               concat('group ', CAST(user_id % 10 AS STRING)) AS adgroup_name,
               CAST(user_id % 4 AS STRING) AS advertiser_id,
               CASE WHEN event_type <> 'error' THEN user_id % 7 END AS campaign_id
        FROM {events} GROUP BY user_id, event_type""",
    "ad_accounts_history": """
        SELECT CAST(user_id % 3 AS STRING) AS advertiser_id,
               concat('advertiser ', CAST(user_id % 3 AS STRING)) AS name,
               CASE WHEN user_id % 2 = 0 THEN 'USD' ELSE 'EUR' END AS currency
        FROM {events} GROUP BY user_id % 3, user_id % 2""",
}

SOURCES = {
    "platform": PLATFORM_SOURCES,
    "campaign": CAMPAIGN_SOURCES,
    "ad_group": STAR_SOURCES,
    "keyword": STAR_SOURCES,
    "multi_fact": MULTI_FACT_SOURCES,
    "multi_fact_week": MULTI_FACT_WEEK_SOURCES,
}


def _used_tables(text: str) -> list[str]:
    return [t for t in BASE_TABLES if "{" + t + "}" in text]


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet`` of one test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spark_sources(spark: SparkSession, sf_dir: str, kind: str) -> dict[str, DataFrame]:
    """Stand-in source tables of one report kind as lazy Spark DataFrames."""
    used = {t for text in SOURCES[kind].values() for t in _used_tables(text)}
    tables = {t: base_table(spark, sf_dir, t) for t in sorted(used)}
    return {name: spark.sql(text.replace("{ts_ntz}", "TIMESTAMP_NTZ"),
                            **{t: tables[t] for t in _used_tables(text)})
            for name, text in SOURCES[kind].items()}


def catalog_sources(spark: SparkSession, sf_dir: str, kind: str, database: str) -> None:
    """The same stand-ins as persistent views over the files in a catalog schema."""
    for name, text in SOURCES[kind].items():
        sql = text.replace("{ts_ntz}", "TIMESTAMP_NTZ")
        for t in _used_tables(text):
            sql = sql.replace("{" + t + "}", f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`")
        spark.sql(f"CREATE VIEW {database}.{name} AS {sql}")


def duckdb_ctes(kind: str, prefix: str = "") -> str:
    """The same stand-ins as DuckDB CTE definitions (``name AS (...)``, comma-joined)."""
    parts = []
    for name, text in SOURCES[kind].items():
        sql = text.replace("{ts_ntz}", "TIMESTAMP")
        for t in BASE_TABLES:
            sql = sql.replace("{" + t + "}", t)
        parts.append(f"{prefix}{name} AS ({sql})")
    return ",\n".join(parts)
