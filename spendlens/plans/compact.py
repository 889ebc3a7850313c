"""Daily facts of the multi-fact report, kept rolled up and bucketed by ad.

The report sums every fact to its grain ``(day, ad, group)`` before anything else, and sums
of sums are sums, so it gives the same rows over facts that are stored at that grain. Stored
as tables with one hash bucket count on ``ad_id``, their partitioning serves the roll-ups
(grouped by more than the bucket key) and every join of the stitching (each has ``ad_id``
among its keys): no exchange stands between the six scans and the stitched rows, given the
setting ``session.BUCKETED_FACTS`` (without it the same rows come with the exchanges).

A bucket is read by one task and cannot be split at run time, so raw facts are not bucketed:
a hot ad would put its rows into one task. At the grain an ad has one row for each day and
group, however many raw rows it had, as the roll-up combines them in each task first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import local_datetime, utc_date
from ..operators.facts import rollup, sum_of
from ..sinks.tables import quote_ident
from ..sources.tables import Loader
from .reports import BASIC_MEASURES, CHAIN_FACTS, FACT_KEYS, LOAD_STAMP, MULTI_FACT, PAGE_EVENT

BUCKET_KEY = "ad_id"
#: Stored bytes that a bucket should hold (one task reads a bucket of all facts).
BUCKET_BYTES = 128 << 20


def bucket_count(stored_bytes: int, least: int = 8) -> int:
    """A power of two that puts about ``BUCKET_BYTES`` of the largest fact into a bucket.

    All facts need the same count; a power of two can be doubled later.
    """
    wanted = max(least, -(-max(0, stored_bytes) // BUCKET_BYTES))
    return 1 << (wanted - 1).bit_length()


def _stored(fact: DataFrame, measures: dict[str, Column], more_keys: tuple[str, ...] = ()) -> DataFrame:
    day = utc_date("stat_time_day", fact.schema["stat_time_day"].dataType)
    return rollup(fact, {"stat_time_day": day, **{k: k for k in (*FACT_KEYS[1:], *more_keys)}}, measures)


def compact_facts(load: Loader, fact_name: str = MULTI_FACT, timezone: str = "UTC") -> dict[str, DataFrame]:
    """The six facts at their grain, by table name, with the columns that the report reads.

    The page fact also keeps ``value_per_complete_payment`` as a key: revenue is a sum of
    products, and those of equal value share it. Of the load stamps in a group the one that
    is latest on the clock of ``timezone`` stays, which is the one that freshness shows.
    """
    basic = load(fact_name, [*FACT_KEYS, *BASIC_MEASURES.values(), LOAD_STAMP])
    clock = local_datetime(LOAD_STAMP, timezone, basic.schema[LOAD_STAMP].dataType)
    out = {fact_name: _stored(basic, {**sum_of(*BASIC_MEASURES.values()), LOAD_STAMP: F.max_by(LOAD_STAMP, clock)})}
    worth = "value_per_complete_payment"
    page = load(PAGE_EVENT[0], [*FACT_KEYS, "complete_payment", worth, *PAGE_EVENT[1]])
    out[PAGE_EVENT[0]] = _stored(page, sum_of("complete_payment", *PAGE_EVENT[1]), (worth,))
    for name, measures in CHAIN_FACTS:
        out[name] = _stored(load(name, [*FACT_KEYS, *measures]), sum_of(*measures))
    return out


def store_facts(spark: SparkSession, load: Loader, database: str, buckets: int, fact_name: str = MULTI_FACT,
                timezone: str = "UTC", append: bool = False) -> list[str]:
    """Write :func:`compact_facts` as tables of ``database`` in ``buckets`` buckets by ad; their names.

    ``append`` adds the rows of a later load (days may recur: the report sums again) to
    tables of the same layout; without it the tables must not exist. Rows are dealt as the
    buckets are, so a bucket is one file of each load.
    """
    names = []
    for name, fact in compact_facts(load, fact_name, timezone).items():
        table = f"{quote_ident(database)}.{quote_ident(name)}"
        dealt = fact.repartition(buckets, BUCKET_KEY)
        (dealt.write.format("parquet").bucketBy(buckets, BUCKET_KEY)
         .mode("append" if append else "errorifexists").saveAsTable(table))
        names.append(table)
    return names
