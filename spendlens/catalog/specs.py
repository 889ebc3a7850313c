"""Report specifications used by the registered queries and the benchmark."""

from __future__ import annotations

from datetime import datetime

from ..spec import (SELECT_DEFAULT_THEN_ACTIVE, ConversionSpec, ExternalTarget, FieldSpec,
                    RegexFilter, ReportSpec)

RUN_TS = datetime(2024, 2, 1, 12, 0, 0)
TZ = "America/New_York"

PLATFORM_SPEC = ReportSpec(
    target="spendlens_home.platform_report",
    dimensions=(FieldSpec("date", "DATE", "date"),
                FieldSpec("platform", "STRING", "platform"),
                FieldSpec("campaign_name", "STRING", "campaign_name"),
                FieldSpec("account_name", "STRING", "account_name")),
    metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)"),
             FieldSpec("clicks", "INT64", "sum(clicks)"),
             FieldSpec("impressions", "INT64", "sum(impressions)"),
             FieldSpec("reach", "INT64", "sum(reach)"),
             FieldSpec("conversions", "INT64", "sum(conversions)"),
             FieldSpec("purchases", "FLOAT64", "sum(actions_purchases)"),
             FieldSpec("carts", "FLOAT64", "sum(actions_carts)"),
             FieldSpec("purchase_value", "FLOAT64", "sum(action_values_purchases)"),
             FieldSpec("last_synced_at", "DATETIME", "max(last_synced_at)"),
             FieldSpec("last_data_date", "DATE", "max(last_data_date)")),
    account_ids=(1, 2, 3),
    conversions=(ConversionSpec("purchase", "purchases"), ConversionSpec("add_to_cart", "carts")),
    regex_filters=(RegexFilter("campaign_name", "_1", True),
                   RegexFilter("platform", "^Unknown$", False)),
    actions=True, action_values=True, run_ts=RUN_TS,
)

CAMPAIGN_SPEC = ReportSpec(
    target="spendlens_home.campaign_report",
    selection=SELECT_DEFAULT_THEN_ACTIVE,
    dimensions=(FieldSpec("date", "DATE", "date", default=True),
                FieldSpec("campaign_name", "STRING", "campaign_name", default=True),
                FieldSpec("campaign_group_name", "STRING", "campaign_group_name",
                          default=True, active=True),
                FieldSpec("account_name", "STRING", "account_name", active=True),
                FieldSpec("campaign_id", "INT64", "campaign_id")),
    metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)", default=True),
             FieldSpec("clicks", "INT64", "sum(clicks)", default=True),
             FieldSpec("conversions", "INT64", "sum(conversions)", active=True),
             FieldSpec("comments", "INT64", "sum(comments)", active=True),
             FieldSpec("revenue", "INT64", "sum(revenue)", default=True),
             FieldSpec("last_synced_at", "DATETIME", "max(last_synced_at)", active=True),
             FieldSpec("impressions", "INT64", "sum(impressions)")),
    account_ids=(1,), timezone=TZ, history_tiebreak=("version_id",),
    external=ExternalTarget(active=True, database="spendlens_external",
                            location="EU", description="copy for analysts",
                            friendly_name="Campaign reports"),
)

AD_GROUP_SPEC = ReportSpec(
    target="spendlens_home.ad_group_report",
    dimensions=(FieldSpec("account_name", "STRING", "account_name"),
                FieldSpec("campaign_name", "STRING", "campaign_name")),
    metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)"),
             FieldSpec("clicks", "INT64", "sum(clicks)"),
             FieldSpec("conversions", "INT64", "sum(conversions)"),
             FieldSpec("revenue", "FLOAT64", "sum(revenue)"),
             FieldSpec("purchases", "FLOAT64", "sum(all_conversions_purchase)"),
             FieldSpec("purchase_revenue", "FLOAT64", "sum(all_revenue_purchase)"),
             FieldSpec("lead_views", "INT64", "sum(view_through_conversions_lead)"),
             FieldSpec("ad_groups", "INT64", "count(DISTINCT ad_group_name)"),
             FieldSpec("last_synced_at", "DATE", "max(last_synced_at)"),
             FieldSpec("last_data_date", "DATE", "max(last_data_date)")),
    account_ids=(1, 2, 3, 4),
    conversions=(ConversionSpec("Purchase", "purchase"), ConversionSpec("Lead", "lead")),
    pivots=True, run_ts=RUN_TS,
)

KEYWORD_SPEC = ReportSpec(
    target="spendlens_home.keyword_report",
    dimensions=(FieldSpec("keyword_match_type", "STRING", "keyword_match_type"),
                FieldSpec("account_name", "STRING", "account_name")),
    metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)"),
             FieldSpec("clicks", "INT64", "sum(clicks)"),
             FieldSpec("purchases", "FLOAT64", "sum(all_conversions_purchase)"),
             FieldSpec("keywords", "INT64", "count(DISTINCT keyword_text)"),
             FieldSpec("last_synced_at", "DATETIME", "max(last_synced_at)")),
    conversions=(ConversionSpec("Purchase", "purchase"), ConversionSpec("Lead", "lead")),
    pivots=True, run_ts=RUN_TS,
    # neither is read: their joins are left out, after a check that they repeat no row
    unique_ids=("campaign_history", "ad_group_history"),
)

MULTI_FACT_SPEC = ReportSpec(
    target="spendlens_home.multi_fact_report",
    selection=SELECT_DEFAULT_THEN_ACTIVE,
    dimensions=(FieldSpec("date", "DATE", "date", default=True),
                FieldSpec("campaign_name", "STRING", "campaign_name", default=True),
                FieldSpec("advertiser_name", "STRING", "advertiser_name", active=True)),
    metrics=(FieldSpec("cost", "FLOAT64", "sum(cost)", default=True),
             FieldSpec("impressions", "INT64", "sum(impressions)", default=True),
             FieldSpec("clicks", "INT64", "sum(clicks)", default=True),
             FieldSpec("conversions", "INT64", "sum(conversions)", default=True),
             FieldSpec("revenue", "FLOAT64", "sum(revenue)", active=True),
             FieldSpec("cta_purchase", "INT64", "sum(cta_purchase)", active=True),
             FieldSpec("likes", "INT64", "sum(likes)", active=True),
             FieldSpec("purchases", "INT64", "sum(purchase)", active=True),
             FieldSpec("checkout", "FLOAT64", "sum(checkout)", active=True),
             FieldSpec("video_views", "INT64", "sum(video_views_p100)", active=True),
             FieldSpec("last_synced_at", "DATETIME", "max(last_synced_at)", active=True),
             FieldSpec("last_data_date", "DATE", "max(last_data_date)", active=True)),
    account_ids=(0, 1, 2), timezone=TZ,
)

MULTI_FACT_WEEK_SPEC = ReportSpec(
    target="spendlens_home.multi_fact_week_report",
    dimensions=(FieldSpec("date", "DATE", "date"), FieldSpec("campaign_name", "STRING", "campaign_name"),
                FieldSpec("currency", "STRING", "currency")),
    metrics=(FieldSpec("joined_rows", "INT64", "count(*)"), FieldSpec("cost", "FLOAT64", "sum(cost)"),
             FieldSpec("clicks", "INT64", "sum(clicks)"), FieldSpec("revenue", "FLOAT64", "sum(revenue)"),
             FieldSpec("button_clicks", "INT64", "sum(button_click)"),
             FieldSpec("cta_purchase", "INT64", "sum(cta_purchase)"),
             FieldSpec("vta_purchase", "FLOAT64", "sum(vta_purchase)"),
             FieldSpec("likes", "INT64", "sum(likes)"), FieldSpec("purchases", "INT64", "sum(purchase)"),
             FieldSpec("checkout", "FLOAT64", "sum(checkout)"),
             FieldSpec("video_views", "INT64", "sum(video_views_p100)"),
             FieldSpec("last_data_date", "DATE", "max(last_data_date)")), timezone=TZ,
)

REPORT_SPECS = {
    "platform": PLATFORM_SPEC,
    "campaign": CAMPAIGN_SPEC,
    "ad_group": AD_GROUP_SPEC,
    "keyword": KEYWORD_SPEC,
    "multi_fact": MULTI_FACT_SPEC,
    "multi_fact_week": MULTI_FACT_WEEK_SPEC,
}
