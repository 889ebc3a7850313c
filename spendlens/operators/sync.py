"""Freshness ("sync info"): one row of global maxima attached to every report row."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_time_literal(run_ts: datetime | date, kind: str = "datetime") -> Column:
    """``current_datetime()`` / ``current_date()`` pinned to an injected run time."""
    if kind == "date":
        d = run_ts.date() if isinstance(run_ts, datetime) else run_ts
        return F.lit(d.isoformat()).cast("date")
    if not isinstance(run_ts, datetime):
        run_ts = datetime(run_ts.year, run_ts.month, run_ts.day)
    # from text: a wall-clock literal must not pass through any session or process zone
    return F.lit(run_ts.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def sync_info(df: DataFrame, synced_at: Column, data_date: Column) -> DataFrame:
    """``select max(synced_at) as max_synced_at, max(data_date) as max_data_date from df``.

    A global aggregate always yields exactly one row (NULLs over an empty table). Partial
    maxima are computed per task; only one row per task reaches the final aggregate.
    """
    return df.agg(F.max(synced_at).alias("max_synced_at"),
                  F.max(data_date).alias("max_data_date"))


def whole(df: DataFrame) -> DataFrame:
    """``df`` with a condition that every row meets and that reads every column.

    Two branches of a plan that use different columns of ``df`` then still compute the same
    ``df``, so Spark computes it once and reuses its exchange; without this each branch is
    pruned to its own columns and they differ. Conditions on single columns pass through.
    """
    return df.where(F.xxhash64(*[F.col(c) for c in df.columns]) % 2 < 2)


def rollup_with_sync(report: DataFrame, synced_at: Column | str, data_date: str = "date"
                     ) -> tuple[DataFrame, DataFrame]:
    """A roll-up and the :func:`sync_info` of the rows it was made from, out of one scan.

    A maximum over rows is the maximum of the groups' maxima: ``data_date`` is a grouping
    column, ``synced_at`` the name of a hidden measure (left out of the roll-up returned)
    or a constant. The global maxima read the roll-up's own exchange again.
    """
    kept = whole(report)
    hidden = [synced_at] if isinstance(synced_at, str) else []
    stamp = F.col(synced_at) if isinstance(synced_at, str) else synced_at
    return kept.drop(*hidden), sync_info(kept, stamp, F.col(data_date))


def attach_sync(api: DataFrame, sync: DataFrame) -> DataFrame:
    """``api LEFT JOIN sync ON true`` with the two freshness columns renamed.

    ``sync`` holds exactly one row (see :func:`sync_info`), so joining it on true equals
    reading its two values as scalar subqueries. Spark runs the (merged) subquery once
    as its own small job and inlines the values: no join, no shuffle of ``api``, and
    ``api`` keeps its partitioning for the regroup that follows. A report that reads
    neither column costs nothing: Catalyst drops the unread subquery with its scan.
    """
    return api.select("*",
                      sync.select("max_synced_at").scalar().alias("last_synced_at"),
                      sync.select("max_data_date").scalar().alias("last_data_date"))
