"""Whole reports (composites of the operators) and their runner."""

from .reports import (BUILDERS, ad_group_api, ad_group_report, campaign_api, campaign_report,
                      finish, keyword_api, keyword_report, multi_fact_api, multi_fact_report,
                      platform_api, platform_report)
from .compact import bucket_count, compact_facts, store_facts
from .runner import build, run_report

__all__ = ["BUILDERS", "ad_group_api", "ad_group_report", "campaign_api", "campaign_report",
           "finish", "keyword_api", "keyword_report", "multi_fact_api", "multi_fact_report",
           "platform_api", "platform_report", "build", "run_report", "bucket_count", "compact_facts",
           "store_facts"]
