"""Small source-shaped tables holding the cases listed in FIXTURES.md."""

import datetime as dt

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def platform_tables(spark):
    """Fact ids bigint, dimension ids string, so the string-normalised joins matter."""
    t = {}
    t["platform_report"] = spark.createDataFrame([
        (D1, 1, "facebook", 10.0, 1, 100),
        (D1, 1, "facebook", 5.0, 2, 50),          # same grain: summed
        (D1, 1, "instagram", 3.0, 1, 10),
        (D1, 2, "audience_network", 4.0, 1, 10),  # ad 2 -> missing ad set
        (D2, 3, "unknown", 1.0, 1, 1),            # ad 3 missing
        (D2, 4, "threads_feed", 2.0, 1, 1),       # unmapped with '_'; account missing
        (D2, 1, None, 1.0, 1, 1),                 # NULL platform
        (D2, None, "facebook", 7.0, 1, 1),        # NULL key
    ], "date date, ad_id bigint, publisher_platform string, spend double, clicks bigint, "
       "impressions bigint")
    t["ad_history"] = spark.createDataFrame([
        ("1", "Ad one", "10", True), ("1", "Ad one old", "10", False),
        ("2", "Ad two", "99", True), ("4", "Ad four", "11", True), ("5", "Ad five", "10", None),
    ], "id string, name string, ad_set_id string, is_current boolean")
    t["ad_set_history"] = spark.createDataFrame(
        [("10", "Set ten", "100", True), ("11", "Set eleven", "101", True)],
        "id string, name string, campaign_id string, is_current boolean")
    t["campaign_history"] = spark.createDataFrame(
        [("100", "Camp A", "1000", True), ("101", "Camp B", "1001", True)],
        "id string, name string, account_id string, is_current boolean")
    t["account_history"] = spark.createDataFrame(
        [("1000", "Acct X", True), ("1000", "Acct X old", False)],
        "account_id string, name string, is_current boolean")
    t["platform_report_actions"] = spark.createDataFrame([
        (1, "facebook", D1, "purchase", 2.0), (1, "facebook", D1, "purchase", 3.0),
        (1, "facebook", D1, "view", 9.0),
        (1, "instagram", D1, "view", 1.0),                 # only unlisted values
        (2, "audience_network", D1, "purchase", None),     # listed value, NULL amount
    ], "ad_id bigint, publisher_platform string, date date, action_type string, value double")
    t["platform_report_action_values"] = spark.createDataFrame([
        (1, "facebook", D1, "purchase", 20.0), (1, "facebook", D2, "purchase", 1.0),
    ], "ad_id bigint, publisher_platform string, date date, action_type string, value double")
    return t


def campaign_tables(spark):
    t = {}
    t["ad_analytics_by_campaign"] = spark.sql("""
        SELECT CAST(day AS TIMESTAMP) AS day, campaign_id, cost_in_usd, clicks, impressions,
               external_website_conversions, comments, follows, shares, landing_page_clicks,
               CAST(synced AS TIMESTAMP) AS _fivetran_synced
        FROM VALUES
          ('2024-01-01 10:00:00', 1L, 10.0D, 1L, 10L, 1L, 0L, 0L, 0L, 1L, '2024-01-01 12:00:00'),
          ('2024-01-01 23:00:00', 1L, 5.0D, 2L, 20L, 0L, 1L, 0L, 0L, 0L, '2024-01-02 03:00:00'),
          ('2024-01-02 08:00:00', 2L, 7.0D, 1L, 5L, 0L, 0L, 1L, 1L, 0L, '2024-01-01 05:00:00'),
          ('2024-01-02 09:00:00', 3L, 1.0D, 1L, 1L, 0L, 0L, 0L, 0L, 0L, '2024-01-01 05:00:00')
        AS v(day, campaign_id, cost_in_usd, clicks, impressions, external_website_conversions,
             comments, follows, shares, landing_page_clicks, synced)""")
    t["campaign_history"] = spark.sql("""
        SELECT id, name, campaign_group_id, account_id,
               CAST(t AS TIMESTAMP) AS last_modified_time, version_id
        FROM VALUES
          (1L, 'C1 old', 10L, 100L, '2024-01-01 00:00:00', 1L),
          (1L, 'C1 new', 10L, 100L, '2024-01-05 00:00:00', 2L),
          (2L, 'C2 b', 11L, 101L, '2024-01-03 00:00:00', 9L),
          (2L, 'C2 a', 11L, 101L, '2024-01-03 00:00:00', 4L)
        AS v(id, name, campaign_group_id, account_id, t, version_id)""")
    t["campaign_group_history"] = spark.sql("""
        SELECT id, name, CAST(t AS TIMESTAMP) AS last_modified_time, version_id
        FROM VALUES (10L, 'G10', '2024-01-01 00:00:00', 1L),
                    (11L, 'G11 old', '2023-01-01 00:00:00', 1L),
                    (11L, 'G11', '2024-01-01 00:00:00', 2L)
        AS v(id, name, t, version_id)""")
    t["account_history"] = spark.sql("""
        SELECT id, name, CAST(t AS TIMESTAMP) AS last_modified_time, version_id
        FROM VALUES (100L, 'A100', '2024-01-01 00:00:00', 1L) AS v(id, name, t, version_id)""")
    return t


def star_tables(spark, keyword=False):
    t = {}
    kw = ", keyword_id bigint" if keyword else ""
    facts = [(D1, 1, 10, 100, 5.0, 1, 10, 1.0, 2.0, 7), (D1, 1, 10, 100, 5.0, 1, 10, 0.0, 1.0, 7),
             (D1, 2, 20, 200, 3.0, 2, 20, 1.0, 0.0, 8), (D2, 3, 30, 100, 1.0, 1, 1, 0.0, 0.0, 9)]
    name = "keyword_performance_report" if keyword else "ad_performance_report"
    t[name] = spark.createDataFrame(
        [f if keyword else f[:-1] for f in facts],
        "date date, campaign_id bigint, ad_group_id bigint, account_id bigint, spend double, "
        "clicks bigint, impressions bigint, conversions double, revenue double" + kw)
    goals = [(D1, 100, 10, 1, "Purchase", "2", "10.5", "1", 7),
             (D1, 100, 10, 1, "Purchase", "oops", "1", "0", 7),    # malformed number
             (D1, 100, 10, 1, "Other", "5", "5", "5", 7),          # unlisted goal
             (D1, 200, 20, 2, "Other", "1", "1", "1", 8)]          # key with only unlisted
    t["goals_and_funnels_report"] = spark.createDataFrame(
        [g if keyword else g[:-1] for g in goals],
        "date date, account_id bigint, ad_group_id bigint, campaign_id bigint, goal string, "
        "all_conversions string, all_revenue string, view_through_conversions string" + kw)
    t["campaign_history"] = spark.createDataFrame(
        [(1, "Camp 1", True), (2, "Camp 2", False), (3, "Camp 3", True)],
        "id bigint, name string, _gn_active boolean")
    t["ad_group_history"] = spark.createDataFrame(
        [(10, "AG 10", True), (20, "AG 20", True)], "id bigint, name string, _gn_active boolean")
    t["account_history"] = spark.createDataFrame(
        [(100, "Acct 100", True), (200, "Acct 200", None)],
        "id bigint, name string, _gn_active boolean")
    t["keyword_history"] = spark.createDataFrame(
        [(7, "shoes", "exact", True), (8, "boots", "broad", True)],
        "id bigint, text string, match_type string, _gn_active boolean")
    return t
