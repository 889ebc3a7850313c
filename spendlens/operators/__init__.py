"""Relational operators of the report engine, each a thin composition of DataFrame calls."""

from .enrich import chain, key_pair, left_join, stitch_facts
from .facts import constant_sum, product_sum, rollup, sum_of
from .filters import account_allow_list, allow_list_predicate, regex_filters, regex_predicate
from .history import assert_unique, current_only, duplicate_keys, latest_by
from .pivot import pivot_metrics, pivot_name
from .shape import build_report, empty_report
from .sync import attach_sync, run_time_literal, sync_info

__all__ = [
    "chain", "key_pair", "left_join", "stitch_facts",
    "constant_sum", "product_sum", "rollup", "sum_of",
    "account_allow_list", "allow_list_predicate", "regex_filters", "regex_predicate",
    "assert_unique", "current_only", "duplicate_keys", "latest_by",
    "pivot_metrics", "pivot_name",
    "build_report", "empty_report",
    "attach_sync", "run_time_literal", "sync_info",
]
