"""DuckDB oracle SQL for every registered query.

Written in the shape of the source reports (each dimension joined level by level with
LEFT JOINs, pivots over all rows, QUALIFY-style two-window version pick), so that they
check the engine's rewrites - dimension chains joined first, inner-join trimming under an
allow-list, pruned pivots, single-window latest version - rather than repeat them.
"""

from __future__ import annotations

from ..plans.reports import (ATTRIBUTION, BASIC_MEASURES, ENGAGEMENT, IN_APP_EVENT,
                             PAGE_EVENT, VIDEO_PLAY)
from .queries import RAW_PLATFORM
from .specs import RUN_TS
from .standins import duckdb_ctes

RUN_TS_SQL = f"TIMESTAMP '{RUN_TS:%Y-%m-%d %H:%M:%S}'"
RUN_DATE_SQL = f"DATE '{RUN_TS:%Y-%m-%d}'"
TZ_SQL = "'America/New_York'"

_DELIMS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""
_RUNS = f"([^{_DELIMS}]+|[{_DELIMS}]+)"


def initcap_sql(x: str) -> str:
    """INITCAP with punctuation delimiters, DuckDB spelling (no native initcap)."""
    pattern = _RUNS.replace("'", "''")
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '{pattern}'), "
            f"lambda t: upper(t[1]) || lower(t[2:])), '')")


def platform_label_sql(x: str) -> str:
    return (f"CASE WHEN {x} = 'facebook' THEN 'Facebook' WHEN {x} = 'instagram' THEN 'Instagram' "
            f"WHEN {x} = 'messenger' THEN 'Messenger' "
            f"WHEN {x} = 'audience_network' THEN 'Audience Network' "
            f"WHEN {x} = 'unknown' THEN 'Unknown' ELSE {initcap_sql(x)} END")


def local_sql(x: str) -> str:
    return f"timezone({TZ_SQL}, timezone('UTC', {x}))"


M = "CAST(l_extendedprice AS DECIMAL(18,2))"

DAILY_ROLLUP = f"""
SELECT CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linestatus,
       CAST(sum({M}) AS DOUBLE) AS cost,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS clicks,
       CAST(sum(l_linenumber) AS BIGINT) AS impressions,
       CAST(sum(0) AS BIGINT) AS frequency
FROM lineitem GROUP BY 1, 2, 3"""


def _ind(e: str) -> str:
    return f"CASE WHEN event_type = '{e}' THEN 1 ELSE 0 END"


WIDE_ROLLUP = f"""
SELECT CAST(ts AS DATE) AS date, user_id,
       {", ".join(f"CAST(sum({_ind(e)}) AS BIGINT) AS {e}s"
                  for e in ("signup", "purchase", "error", "view", "click"))},
       CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END)
            AS DOUBLE) AS purchase_value,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
       CAST(count(*) AS BIGINT) AS events
FROM events GROUP BY 1, 2"""

PRODUCT_SUM = f"""
SELECT CAST(l_shipdate AS DATE) AS date,
       CAST(sum({M} * CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       CAST(sum({M} * CASE WHEN l_returnflag <> 'N' THEN CAST(l_discount AS DECIMAL(18,2)) END)
            AS DOUBLE) AS revenue_skip_null
FROM lineitem GROUP BY 1"""

CONSTANT_MEASURES = """
SELECT l_returnflag, CAST(sum(0) AS BIGINT) AS frequency, CAST(count(*) AS BIGINT) AS row_count,
       CAST(0 AS BIGINT) AS conversions, '' AS promotion_type,
       CAST(NULL AS TIMESTAMP) AS run_schedule_start, true AS has_actions
FROM lineitem GROUP BY 1"""

CURRENT_ONLY = """
SELECT * FROM (
  SELECT *, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_current
  FROM orders) WHERE is_current = true"""

LATEST_BY = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST) AS r1,
         row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS r2
  FROM orders) WHERE r1 = 1 AND r2 = 1"""


def _snowflake(where: str = "") -> str:
    return f"""
WITH fact AS (SELECT l_orderkey, sum({M}) AS cost, sum(CAST(l_quantity AS BIGINT)) AS qty
              FROM lineitem GROUP BY 1),
o AS (SELECT CAST(o_orderkey AS VARCHAR) AS id,
             CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
             o_orderpriority FROM orders),
c AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name,
             CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation_id
      FROM customer),
n AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name, CAST(n_regionkey AS VARCHAR) AS region_id
      FROM nation),
r AS (SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name FROM region)
SELECT fact.l_orderkey, CAST(fact.cost AS DOUBLE) AS cost, CAST(fact.qty AS BIGINT) AS qty,
       o.o_orderpriority, c.c_name, n.n_name, r.id AS region_id, r.r_name
FROM fact
LEFT JOIN o ON CAST(fact.l_orderkey AS VARCHAR) = o.id
LEFT JOIN c ON o.customer_id = c.id
LEFT JOIN n ON c.nation_id = n.id
LEFT JOIN r ON n.region_id = r.id
{where}"""


SNOWFLAKE_BRANCH = f"""
WITH fact AS (SELECT l_orderkey, sum({M}) AS cost FROM lineitem GROUP BY 1),
newest AS (SELECT * FROM (
    SELECT *, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC NULLS LAST) AS r1,
           row_number() OVER (PARTITION BY o_orderpriority, o_orderdate ORDER BY o_orderkey) AS r2
    FROM orders) WHERE r1 = 1 AND r2 = 1)
SELECT fact.l_orderkey, CAST(fact.cost AS DOUBLE) AS cost, c.c_name,
       newest.o_orderkey AS newest_in_priority
FROM fact
LEFT JOIN orders o ON fact.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND o.o_orderkey % 5 <> 0
LEFT JOIN newest ON o.o_orderpriority = newest.o_orderpriority"""

STAR_JOIN = f"""
WITH fact AS (SELECT l_orderkey, l_partkey, l_suppkey, sum({M}) AS cost
              FROM lineitem GROUP BY 1, 2, 3)
SELECT fact.l_orderkey, fact.l_partkey, fact.l_suppkey, CAST(fact.cost AS DOUBLE) AS cost,
       o.o_orderpriority, p.p_name, s.s_name
FROM fact
LEFT JOIN orders o ON fact.l_orderkey = o.o_orderkey AND fact.l_orderkey % 5 <> 0
LEFT JOIN part p ON fact.l_partkey = p.p_partkey AND fact.l_partkey % 7 <> 0
LEFT JOIN supplier s ON fact.l_suppkey = s.s_suppkey AND fact.l_suppkey % 3 <> 0"""

PIVOT_SINGLE = """
SELECT user_id, CAST(ts AS DATE) AS date,
       CAST(sum(CASE WHEN event_type = 'view' THEN CAST(value AS DECIMAL(18,2)) END)
            AS DOUBLE) AS actions_views,
       CAST(sum(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,2)) END)
            AS DOUBLE) AS actions_clicks
FROM events GROUP BY 1, 2"""

_PM_SRC = """SELECT user_id, CAST(ts AS DATE) AS date, event_type,
                    CAST(value AS VARCHAR) AS amount_txt, props AS props_txt,
                    CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id % 5 AS VARCHAR) END
                        AS qty_txt
             FROM events"""


def _pm_cells() -> str:
    cells = []
    for m, t in (("amount", "DECIMAL(38,2)"), ("props", "DOUBLE"), ("qty", "DOUBLE")):
        for v in ("purchase", "signup"):
            cells.append(f"CAST(CAST(sum(CASE WHEN event_type = '{v}' THEN TRY_CAST({m}_txt "
                         f"AS DOUBLE) END) AS {t}) AS DOUBLE) AS {m}_{v}")
    return ",\n       ".join(cells)


def _pm_names() -> list[str]:
    return [f"{m}_{v}" for m in ("amount", "props", "qty") for v in ("purchase", "signup")]


PIVOT_MULTI = f"""
SELECT user_id, date,
       {_pm_cells()}
FROM ({_PM_SRC}) GROUP BY 1, 2"""

PIVOT_JOIN_BACK = f"""
WITH spine AS (SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS n_events,
                      sum(CAST(value AS DECIMAL(18,2))) AS value FROM events GROUP BY 1, 2),
piv AS ({PIVOT_MULTI})
SELECT spine.user_id, spine.date, CAST(spine.n_events AS BIGINT) AS n_events,
       CAST(spine.value AS DOUBLE) AS value,
       {", ".join("piv." + n for n in _pm_names())}
FROM spine LEFT JOIN piv ON spine.user_id = piv.user_id AND spine.date = piv.date"""

SYNC_INFO_CROSS = f"""
WITH sync_info AS (SELECT max({local_sql('ts')}) AS max_synced_at,
                          max(CAST(ts AS DATE)) AS max_data_date FROM events),
runs AS (SELECT max({RUN_TS_SQL}) AS run_at FROM events),
spine AS (SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n_events
          FROM events GROUP BY 1, 2)
SELECT spine.date, spine.event_type, CAST(spine.n_events AS BIGINT) AS n_events,
       sync_info.max_synced_at AS last_synced_at, sync_info.max_data_date AS last_data_date,
       runs.run_at
FROM spine LEFT JOIN sync_info ON true LEFT JOIN runs ON true"""

REGEX_FILTERS = """
SELECT p_partkey, p_name, p_brand, p_size FROM part
WHERE regexp_matches(p_name, '^small') = true AND regexp_matches(p_brand, '#1$') = false"""

PLATFORM_LABEL = f"""
SELECT c_custkey, raw, {platform_label_sql('raw')} AS platform
FROM (SELECT c_custkey, {RAW_PLATFORM} AS raw FROM customer)"""

STAR_EXCEPT = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_orderdate AS order_date
FROM (SELECT * EXCLUDE (o_totalprice, o_orderpriority) FROM orders)"""

FIELD_SELECTION = """
SELECT CAST(o_orderstatus AS VARCHAR) AS status, CAST(o_orderpriority AS VARCHAR) AS priority,
       CAST(round(o_totalprice / 100000) AS BIGINT) AS price_band,
       CAST(count(*) AS BIGINT) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       CAST(round(max(o_totalprice)) AS BIGINT) AS max_price
FROM orders GROUP BY 1, 2, 3"""


# ---- what the catalog shows of a published report ----------------------------------------
PUBLISHED_SCHEMA = """
WITH n AS (SELECT count(*) AS published_rows FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem)),
shown AS (
  SELECT * FROM (VALUES
    ('column', 'l_orderkey', 'bigint [db_field_name = l_orderkey]'),
    ('column', 'l_partkey', 'bigint [db_field_name = l_partkey]'),
    ('column', 'l_suppkey', 'bigint [db_field_name = l_suppkey]'),
    ('column', 'o_orderpriority', 'string [db_field_name = o_orderpriority]'),
    ('column', 'p_name', 'string [db_field_name = p_name]'),
    ('column', 's_name', 'string [db_field_name = s_name]'),
    ('column', 'cost', 'double [db_field_name = cost]'),
    ('schema', 'comment', 'republished reports'),
    ('schema', 'data_location', 'EU'),
    ('schema', 'friendly_name', 'Reports')) AS t(kind, name, value))
SELECT kind, name, value, CAST(published_rows AS BIGINT) AS published_rows FROM shown, n"""

# ---- multi-fact report ------------------------------------------------------------------
def _fact_cte(name: str, table: str, measures: dict[str, str]) -> str:
    cols = ", ".join(f"sum({src}) AS {out}" for out, src in measures.items())
    return (f"{name} AS (SELECT CAST(stat_time_day AS DATE) AS date, ad_id, _gn_id, {cols} "
            f"FROM {table} GROUP BY 1, 2, 3)")


def _multi_fact_api(mode: str = "as_written", sources: str = "multi_fact") -> str:
    page_measures = {"revenue": "complete_payment * value_per_complete_payment"}
    page_measures.update({c: c for c in PAGE_EVENT[1]})
    ctes = [
        duckdb_ctes(sources),
        "sync_info AS (SELECT max(" + local_sql("_fivetran_synced") + ") AS max_synced_at, "
        "max(CAST(stat_time_day AS DATE)) AS max_data_date "
        "FROM ads_basic_data_metrics_by_day_report)",
        _fact_cte("metrics", "ads_basic_data_metrics_by_day_report", BASIC_MEASURES),
        _fact_cte("attribution", ATTRIBUTION[0], {c: c for c in ATTRIBUTION[1]}),
        _fact_cte("engagement", ENGAGEMENT[0], {c: c for c in ENGAGEMENT[1]}),
        _fact_cte("event", IN_APP_EVENT[0], {c: c for c in IN_APP_EVENT[1]}),
        _fact_cte("video", VIDEO_PLAY[0], {c: c for c in VIDEO_PLAY[1]}),
        _fact_cte("page", PAGE_EVENT[0], page_measures),
    ]
    if mode == "as_written":
        joins = """
LEFT JOIN page ON metrics.ad_id = page.ad_id AND metrics.date = page.date
LEFT JOIN attribution ON metrics.ad_id = attribution.ad_id AND metrics._gn_id = attribution._gn_id
LEFT JOIN engagement ON attribution.ad_id = engagement.ad_id AND attribution._gn_id = engagement._gn_id
LEFT JOIN event ON engagement.ad_id = event.ad_id AND engagement._gn_id = event._gn_id
LEFT JOIN video ON event.ad_id = video.ad_id AND event._gn_id = video._gn_id"""
    elif mode == "chained":
        links = [("metrics", "attribution"), ("attribution", "engagement"),
                 ("engagement", "event"), ("event", "video")]
        joins = "\nLEFT JOIN page ON metrics.ad_id = page.ad_id AND metrics.date = page.date"
        joins += "".join(
            f"\nLEFT JOIN {t} ON {p}.date = {t}.date AND {p}.ad_id = {t}.ad_id "
            f"AND {p}._gn_id = {t}._gn_id" for p, t in links)
    else:
        joins = "".join(
            f"\nLEFT JOIN {t} ON metrics.date = {t}.date AND metrics.ad_id = {t}.ad_id "
            f"AND metrics._gn_id = {t}._gn_id"
            for t in ("page", "attribution", "engagement", "event", "video"))
    fact_cols = ([f"attribution.{c}" for c in ATTRIBUTION[1]]
                 + [f"engagement.{c}" for c in ENGAGEMENT[1]]
                 + [f"event.{c}" for c in IN_APP_EVENT[1]]
                 + [f"video.{c}" for c in VIDEO_PLAY[1]]
                 + ["page.revenue"] + [f"page.{c}" for c in PAGE_EVENT[1]])
    api = f"""api AS (
SELECT metrics.date, metrics.ad_id, metrics._gn_id, metrics.cost, metrics.clicks,
       metrics.impressions, metrics.conversions, metrics.result, metrics.real_time_result,
       metrics.real_time_conversion,
       sync_info.max_synced_at AS last_synced_at, sync_info.max_data_date AS last_data_date,
       ad.ad_name, ad.adgroup_id, ad.adgroup_name, ad.advertiser_id,
       campaign.campaign_id, campaign.campaign_name, campaign.objective_type,
       account.name AS advertiser_name, account.currency,
       {", ".join(fact_cols)},
       '' AS dpa_target_audience_type, '' AS promotion_type
FROM metrics{joins}
LEFT JOIN ad_history ad ON metrics.ad_id = ad.ad_id
LEFT JOIN campaign_history campaign ON ad.campaign_id = campaign.campaign_id
LEFT JOIN ad_accounts_history account ON campaign.advertiser_id = account.advertiser_id
LEFT JOIN sync_info ON true)"""
    return "WITH " + ",\n".join(ctes + [api])


def _stitch_sql(mode: str) -> str:
    return _multi_fact_api(mode) + """
SELECT date, ad_id, _gn_id, CAST(cost AS DOUBLE) AS cost,
       CAST(revenue AS DOUBLE) AS revenue, CAST(cta_purchase AS BIGINT) AS cta_purchase,
       CAST(likes AS BIGINT) AS likes, CAST(purchase AS BIGINT) AS purchase,
       CAST(video_views_p100 AS BIGINT) AS video_views_p100
FROM api"""


def _week_sql(by_day: bool) -> str:
    """Two facts whose ``_gn_id`` is a user's week; the source joins them without the day."""
    day = " AND spine.date = sales.date" if by_day else ""
    return f"""
WITH ev AS (SELECT CAST(ts AS DATE) AS date, user_id AS ad_id, event_type,
                   CAST(value AS DECIMAL(18,2)) AS amount,
                   concat(CAST(user_id AS VARCHAR), '-',
                          CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR)) AS _gn_id
            FROM events),
spine AS (SELECT date, ad_id, _gn_id, sum(amount) AS cost, count(*) AS events FROM ev GROUP BY 1, 2, 3),
sales AS (SELECT date, ad_id, _gn_id, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchases,
                 sum(amount) AS sale_value
          FROM ev WHERE event_type IN ('purchase', 'signup') GROUP BY 1, 2, 3)
SELECT spine.date, spine.ad_id, spine._gn_id, CAST(cost AS DOUBLE) AS cost, CAST(events AS BIGINT) AS events,
       CAST(purchases AS BIGINT) AS purchases, CAST(sale_value AS DOUBLE) AS sale_value
FROM spine LEFT JOIN sales ON spine.ad_id = sales.ad_id AND spine._gn_id = sales._gn_id{day}"""


def report_multi_fact_sql(mode: str, where: str) -> str:
    """The multi-fact report over its stand-ins for one stitching mode and final filter."""
    return _multi_fact_api(mode) + _REPORT_MULTI_FACT_TAIL.replace("{where}", where)


_REPORT_MULTI_FACT_TAIL = """
SELECT CAST(date AS DATE) AS date, CAST(campaign_name AS VARCHAR) AS campaign_name,
       CAST(advertiser_name AS VARCHAR) AS advertiser_name,
       CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(impressions) AS BIGINT) AS impressions,
       CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(conversions) AS BIGINT) AS conversions,
       CAST(sum(revenue) AS DOUBLE) AS revenue,
       CAST(sum(cta_purchase) AS BIGINT) AS cta_purchase, CAST(sum(likes) AS BIGINT) AS likes,
       CAST(sum(purchase) AS BIGINT) AS purchases, CAST(sum(checkout) AS DOUBLE) AS checkout,
       CAST(sum(video_views_p100) AS BIGINT) AS video_views,
       CAST(max(last_synced_at) AS TIMESTAMP) AS last_synced_at,
       CAST(max(last_data_date) AS DATE) AS last_data_date
FROM api
{where}
GROUP BY 1, 2, 3"""

REPORT_MULTI_FACT = report_multi_fact_sql("as_written",
                                          "WHERE CAST(advertiser_id AS BIGINT) IN (0, 1, 2)")

REPORT_MULTI_FACT_WEEK = _multi_fact_api("as_written", "multi_fact_week") + """
SELECT CAST(date AS DATE) AS date, CAST(campaign_name AS VARCHAR) AS campaign_name,
       CAST(currency AS VARCHAR) AS currency, CAST(count(*) AS BIGINT) AS joined_rows,
       CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(clicks) AS BIGINT) AS clicks,
       CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(button_click) AS BIGINT) AS button_clicks,
       CAST(sum(cta_purchase) AS BIGINT) AS cta_purchase,
       CAST(sum(vta_purchase) AS DOUBLE) AS vta_purchase, CAST(sum(likes) AS BIGINT) AS likes,
       CAST(sum(purchase) AS BIGINT) AS purchases, CAST(sum(checkout) AS DOUBLE) AS checkout,
       CAST(sum(video_views_p100) AS BIGINT) AS video_views,
       CAST(max(last_data_date) AS DATE) AS last_data_date
FROM api GROUP BY 1, 2, 3"""

HISTORY_FAN_OUT = """
WITH spine AS (SELECT CAST(ts AS DATE) AS date, user_id, count(*) AS n_events
               FROM events GROUP BY 1, 2),
ad AS (SELECT o_custkey AS ad_id, concat('ad ', CAST(o_orderkey AS VARCHAR)) AS ad_name,
              CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS campaign_id FROM orders),
campaign AS (SELECT CAST(n_nationkey AS BIGINT) AS campaign_id, n_name AS campaign_name,
                    CAST(n_regionkey AS BIGINT) AS advertiser_id FROM nation),
account AS (SELECT CAST(r_regionkey AS BIGINT) AS advertiser_id, r_name AS name FROM region)
SELECT spine.date, spine.user_id, CAST(spine.n_events AS BIGINT) AS n_events, ad.ad_name,
       campaign.campaign_name, account.name AS advertiser_name
FROM spine
LEFT JOIN ad ON spine.user_id = ad.ad_id
LEFT JOIN campaign ON ad.campaign_id = campaign.campaign_id
LEFT JOIN account ON campaign.advertiser_id = account.advertiser_id"""

HISTORY_LATEST = """
WITH spine AS (SELECT CAST(ts AS DATE) AS date, user_id, count(*) AS n_events
               FROM events GROUP BY 1, 2),
ad AS (SELECT ad_id, ad_name, campaign_id FROM (
        SELECT o_custkey AS ad_id, concat('ad ', CAST(o_orderkey AS VARCHAR)) AS ad_name,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS campaign_id,
               rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST) AS r1,
               row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS r2
        FROM orders) WHERE r1 = 1 AND r2 = 1),
campaign AS (SELECT CAST(n_nationkey AS BIGINT) AS campaign_id, n_name AS campaign_name,
                    CAST(n_regionkey AS BIGINT) AS advertiser_id FROM nation),
account AS (SELECT CAST(r_regionkey AS BIGINT) AS advertiser_id, r_name AS name FROM region)
SELECT spine.date, spine.user_id, CAST(spine.n_events AS BIGINT) AS n_events, ad.ad_name,
       campaign.campaign_name, account.name AS advertiser_name
FROM spine
LEFT JOIN ad ON spine.user_id = ad.ad_id
LEFT JOIN campaign ON ad.campaign_id = campaign.campaign_id
LEFT JOIN account ON campaign.advertiser_id = account.advertiser_id"""

# ---- platform report ------------------------------------------------------------------
def report_platform_sql(where: str) -> str:
    """The platform report over its stand-ins, with the final filter given as ``where``."""
    return _REPORT_PLATFORM_BODY.replace("{where}", where)


_REPORT_PLATFORM_BODY = f"""
WITH {duckdb_ctes("platform")},
sync_info AS (SELECT max({RUN_TS_SQL}) AS max_synced_at, max(date) AS max_data_date
              FROM platform_report),
campaigns AS (SELECT * FROM campaign_history WHERE is_current = true),
accounts AS (SELECT * FROM account_history WHERE is_current = true),
ad_sets AS (SELECT * FROM ad_set_history WHERE is_current = true),
ads AS (SELECT * FROM ad_history WHERE is_current = true),
report AS (SELECT date, ad_id, publisher_platform, sum(spend) AS cost, sum(clicks) AS clicks,
                  sum(impressions) AS impressions, sum(0) AS frequency, sum(0) AS reach,
                  0 AS conversions
           FROM platform_report GROUP BY 1, 2, 3),
actions AS (SELECT ad_id, publisher_platform, date,
                   sum(CASE WHEN action_type = 'purchase' THEN value END) AS actions_purchases,
                   sum(CASE WHEN action_type = 'add_to_cart' THEN value END) AS actions_carts
            FROM platform_report_actions GROUP BY 1, 2, 3),
action_values AS (SELECT ad_id, publisher_platform, date,
                   sum(CASE WHEN action_type = 'purchase' THEN value END) AS action_values_purchases,
                   sum(CASE WHEN action_type = 'add_to_cart' THEN value END) AS action_values_carts
            FROM platform_report_action_values GROUP BY 1, 2, 3),
api AS (
  SELECT report.* EXCLUDE (ad_id, publisher_platform),
         {platform_label_sql('report.publisher_platform')} AS platform,
         sync_info.max_synced_at AS last_synced_at, sync_info.max_data_date AS last_data_date,
         true AS has_actions, true AS has_action_values,
         report.ad_id, ads.name AS ad_name, ad_sets.id AS ad_set_id, ad_sets.name AS ad_set_name,
         campaigns.id AS campaign_id, campaigns.name AS campaign_name,
         accounts.account_id AS account_id, accounts.name AS account_name,
         actions.actions_purchases, actions.actions_carts,
         action_values.action_values_purchases, action_values.action_values_carts
  FROM report
  LEFT JOIN ads ON CAST(report.ad_id AS VARCHAR) = CAST(ads.id AS VARCHAR)
  LEFT JOIN ad_sets ON CAST(ads.ad_set_id AS VARCHAR) = CAST(ad_sets.id AS VARCHAR)
  LEFT JOIN campaigns ON CAST(ad_sets.campaign_id AS VARCHAR) = CAST(campaigns.id AS VARCHAR)
  LEFT JOIN accounts ON CAST(campaigns.account_id AS VARCHAR) = CAST(accounts.account_id AS VARCHAR)
  LEFT JOIN actions ON report.date = actions.date
        AND CAST(report.ad_id AS VARCHAR) = CAST(actions.ad_id AS VARCHAR)
        AND report.publisher_platform = actions.publisher_platform
  LEFT JOIN action_values ON report.date = action_values.date
        AND CAST(report.ad_id AS VARCHAR) = CAST(action_values.ad_id AS VARCHAR)
        AND report.publisher_platform = action_values.publisher_platform
  LEFT JOIN sync_info ON true)
SELECT CAST(date AS DATE) AS date, CAST(platform AS VARCHAR) AS platform,
       CAST(campaign_name AS VARCHAR) AS campaign_name, CAST(account_name AS VARCHAR) AS account_name,
       CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(clicks) AS BIGINT) AS clicks,
       CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(reach) AS BIGINT) AS reach,
       CAST(sum(conversions) AS BIGINT) AS conversions,
       CAST(sum(actions_purchases) AS DOUBLE) AS purchases,
       CAST(sum(actions_carts) AS DOUBLE) AS carts,
       CAST(sum(action_values_purchases) AS DOUBLE) AS purchase_value,
       CAST(max(last_synced_at) AS TIMESTAMP) AS last_synced_at,
       CAST(max(last_data_date) AS DATE) AS last_data_date
FROM api
{{where}}
GROUP BY 1, 2, 3, 4"""

REPORT_PLATFORM = report_platform_sql(
    """WHERE account_id IN ('1', '2', '3')
  AND regexp_matches(campaign_name, '_1') = true
  AND regexp_matches(platform, '^Unknown$') = false""")


def _latest(table: str) -> str:
    return (f"(SELECT * FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY last_modified_time "
            f"DESC NULLS LAST) AS r1, row_number() OVER (PARTITION BY id, last_modified_time "
            f"ORDER BY version_id) AS r2 FROM {table}) WHERE r1 = 1 AND r2 = 1)")


def report_campaign_sql(where: str) -> str:
    """The campaign report over its stand-ins with the final filter given as ``where``."""
    return _REPORT_CAMPAIGN_BODY.replace("{where}", where)


_REPORT_CAMPAIGN_BODY = f"""
WITH {duckdb_ctes("campaign")},
sync_info AS (SELECT max({local_sql('_fivetran_synced')}) AS max_synced_at,
                     max(CAST(day AS DATE)) AS max_data_date FROM ad_analytics_by_campaign),
campaign_groups AS {_latest("campaign_group_history")},
campaigns AS {_latest("campaign_history")},
accounts AS {_latest("account_history")},
report AS (SELECT CAST(day AS DATE) AS date, campaign_id, sum(cost_in_usd) AS cost,
                  sum(clicks) AS clicks, sum(impressions) AS impressions,
                  sum(external_website_conversions) AS conversions, sum(0) AS revenue,
                  sum(comments) AS comments, sum(follows) AS follows, sum(shares) AS shares,
                  sum(landing_page_clicks) AS landing_page_clicks
           FROM ad_analytics_by_campaign GROUP BY 1, 2),
api AS (
  SELECT report.date, report.campaign_id, campaigns.name AS campaign_name,
         campaign_groups.name AS campaign_group_name, campaign_groups.id AS campaign_group_id,
         accounts.id AS account_id, accounts.name AS account_name,
         report.clicks, report.cost, report.impressions, report.conversions, report.revenue,
         report.comments, report.follows, report.shares, report.landing_page_clicks,
         CAST(NULL AS TIMESTAMP) AS run_schedule_start,
         CAST(NULL AS TIMESTAMP) AS campaign_group_run_schedule_start,
         sync_info.max_synced_at AS last_synced_at, sync_info.max_data_date AS last_data_date
  FROM report
  LEFT JOIN campaigns ON report.campaign_id = campaigns.id
  LEFT JOIN campaign_groups ON campaigns.campaign_group_id = campaign_groups.id
  LEFT JOIN accounts ON campaigns.account_id = accounts.id
  LEFT JOIN sync_info ON true)
SELECT CAST(date AS DATE) AS date, CAST(campaign_name AS VARCHAR) AS campaign_name,
       CAST(campaign_group_name AS VARCHAR) AS campaign_group_name,
       CAST(account_name AS VARCHAR) AS account_name,
       CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(clicks) AS BIGINT) AS clicks,
       CAST(sum(revenue) AS BIGINT) AS revenue, CAST(sum(conversions) AS BIGINT) AS conversions,
       CAST(sum(comments) AS BIGINT) AS comments,
       CAST(max(last_synced_at) AS TIMESTAMP) AS last_synced_at
FROM api {{where}}
GROUP BY 1, 2, 3, 4"""

REPORT_CAMPAIGN = report_campaign_sql("WHERE account_id IN (1)")


def star_report_sql(keyword: bool, where: str | None = None) -> str:
    """Ad-group or keyword report over their stand-ins; ``where`` replaces the filter."""
    return _star_report(keyword, where)


def _star_report(keyword: bool, where: str | None = None) -> str:
    kw_key = ", keyword_id" if keyword else ""
    gkeys = "1, 2, 3, 4, 5" if keyword else "1, 2, 3, 4"
    kw_join = ("\n        AND report.keyword_id = pivots.keyword_id" if keyword else "")
    kw_dim = ("\n  LEFT JOIN keywords ON report.keyword_id = keywords.id" if keyword else "")
    kw_cols = ("keywords.text AS keyword_text, keywords.match_type AS keyword_match_type,"
               if keyword else "")
    cells = []
    for m in ("all_conversions", "all_revenue", "view_through_conversions"):
        for ev, out in (("Purchase", "purchase"), ("Lead", "lead")):
            cells.append(f"sum(CASE WHEN goal = '{ev}' THEN TRY_CAST({m} AS DOUBLE) END) "
                         f"AS {m}_{out}")
    piv_cols = ", ".join(f"pivots.{m}_{o}" for o in ("purchase", "lead")
                         for m in ("all_conversions", "all_revenue", "view_through_conversions"))
    fact = "keyword_performance_report" if keyword else "ad_performance_report"
    synced = RUN_TS_SQL if keyword else RUN_DATE_SQL
    api = f"""
WITH {duckdb_ctes("keyword" if keyword else "ad_group")},
sync_info AS (SELECT max({synced}) AS max_synced_at, max(date) AS max_data_date FROM {fact}),
campaigns AS (SELECT * FROM campaign_history WHERE _gn_active = true),
accounts AS (SELECT * FROM account_history WHERE _gn_active = true),
ad_groups AS (SELECT * FROM ad_group_history WHERE _gn_active = true),
keywords AS (SELECT * FROM keyword_history WHERE _gn_active = true),
report AS (SELECT date, campaign_id, ad_group_id, account_id{kw_key}, sum(spend) AS cost,
                  sum(clicks) AS clicks, sum(impressions) AS impressions,
                  sum(conversions) AS conversions, sum(revenue) AS revenue
           FROM {fact} GROUP BY {gkeys}),
pivots AS (SELECT date, account_id, ad_group_id, campaign_id{kw_key}, {", ".join(cells)}
           FROM goals_and_funnels_report GROUP BY {gkeys}),
api AS (
  SELECT report.date, report.campaign_id, campaigns.name AS campaign_name, report.ad_group_id,
         ad_groups.name AS ad_group_name, {kw_cols} accounts.id AS account_id,
         accounts.name AS account_name, report.clicks, report.cost, report.impressions,
         report.conversions, report.revenue, sync_info.max_synced_at AS last_synced_at,
         sync_info.max_data_date AS last_data_date, {piv_cols}
  FROM report
  LEFT JOIN pivots ON report.date = pivots.date AND report.account_id = pivots.account_id
        AND report.ad_group_id = pivots.ad_group_id
        AND report.campaign_id = pivots.campaign_id{kw_join}
  LEFT JOIN campaigns ON report.campaign_id = campaigns.id
  LEFT JOIN ad_groups ON report.ad_group_id = ad_groups.id{kw_dim}
  LEFT JOIN accounts ON report.account_id = accounts.id
  LEFT JOIN sync_info ON true)"""
    if keyword:
        return api + """
SELECT CAST(keyword_match_type AS VARCHAR) AS keyword_match_type,
       CAST(account_name AS VARCHAR) AS account_name,
       CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(clicks) AS BIGINT) AS clicks,
       CAST(sum(all_conversions_purchase) AS DOUBLE) AS purchases,
       CAST(count(DISTINCT keyword_text) AS BIGINT) AS keywords,
       CAST(max(last_synced_at) AS TIMESTAMP) AS last_synced_at
FROM api """ + (where or "") + """ GROUP BY 1, 2"""
    return api + """
SELECT CAST(account_name AS VARCHAR) AS account_name, CAST(campaign_name AS VARCHAR) AS campaign_name,
       CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(clicks) AS BIGINT) AS clicks,
       CAST(sum(conversions) AS BIGINT) AS conversions,
       CAST(sum(revenue) AS DOUBLE) AS revenue,
       CAST(sum(all_conversions_purchase) AS DOUBLE) AS purchases,
       CAST(sum(all_revenue_purchase) AS DOUBLE) AS purchase_revenue,
       CAST(round(sum(view_through_conversions_lead)) AS BIGINT) AS lead_views,
       CAST(count(DISTINCT ad_group_name) AS BIGINT) AS ad_groups,
       CAST(max(last_synced_at) AS DATE) AS last_synced_at,
       CAST(max(last_data_date) AS DATE) AS last_data_date
FROM api """ + (where if where is not None else "WHERE account_id IN (1, 2, 3, 4)") + """
GROUP BY 1, 2"""


ORACLE_SQL: dict[str, str] = {
    "daily_rollup": DAILY_ROLLUP,
    "wide_rollup": WIDE_ROLLUP,
    "product_sum": PRODUCT_SUM,
    "constant_measures": CONSTANT_MEASURES,
    "current_only": CURRENT_ONLY,
    "latest_by": LATEST_BY,
    "snowflake_chain": _snowflake(),
    "snowflake_branch": SNOWFLAKE_BRANCH,
    "star_join": STAR_JOIN,
    "pivot_single": PIVOT_SINGLE,
    "pivot_multi": PIVOT_MULTI,
    "pivot_join_back": PIVOT_JOIN_BACK,
    "sync_info_cross": SYNC_INFO_CROSS,
    "account_allow_list": _snowflake("WHERE r.id IN ('1', '2')"),
    "account_allow_list_cast": _snowflake("WHERE CAST(r.id AS BIGINT) IN (1, 2)"),
    "regex_filters": REGEX_FILTERS,
    "platform_label": PLATFORM_LABEL,
    "star_except": STAR_EXCEPT,
    "field_selection": FIELD_SELECTION,
    "multi_fact_stitch": _stitch_sql("as_written"),
    "multi_fact_grain_safe": _stitch_sql("grain_safe"),
    "multi_fact_chained": _stitch_sql("chained"),
    "multi_fact_week": _week_sql(by_day=False),
    "multi_fact_week_chained": _week_sql(by_day=True),
    "history_fan_out": HISTORY_FAN_OUT,
    "history_latest": HISTORY_LATEST,
    "publish_round_trip": STAR_JOIN,
    "report_platform": REPORT_PLATFORM,
    "report_campaign": REPORT_CAMPAIGN,
    "report_ad_group": _star_report(keyword=False),
    "report_keyword": _star_report(keyword=True),
    "published_schema": PUBLISHED_SCHEMA,
    "report_campaign_catalog": REPORT_CAMPAIGN,
    "report_multi_fact": REPORT_MULTI_FACT,
    "report_multi_fact_week": REPORT_MULTI_FACT_WEEK,
    "report_multi_fact_bucketed": REPORT_MULTI_FACT_WEEK,
}
