"""Slowly changing dimension tables: pick the version a report joins to."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def current_only(df: DataFrame, flag: str = "is_current") -> DataFrame:
    """Keep rows whose flag column is true (``flag = true``; a NULL flag drops the row).

    A plain filter: Catalyst pushes it into the Parquet scan.
    """
    return df.where(F.col(flag) == F.lit(True))


def _orderable(dt) -> bool:
    return "map<" not in dt.simpleString() and dt.simpleString() != "variant"


def latest_by(df: DataFrame, keys: Sequence[str], order_by: str,
              tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Exactly one newest row per key.

    Same rows as ``rank() over (partition by keys order by t desc) = 1 and row_number()
    over (partition by keys, t) = 1``: the newest timestamp wins (NULL times last) and
    one row is kept among ties. Ties are broken by ``tiebreak`` columns ascending; by
    default by every other orderable column, so the pick is a function of the data and
    not of row order: a stage Spark recomputes after losing an executor picks the same
    row as the first attempt. (The source leaves the choice arbitrary; ``()`` keeps it so.)

    Written as a single ``row_number() = 1`` so Spark plans a ``WindowGroupLimit``: each
    map task keeps only its newest row per key *before* the shuffle, so a key holding a
    third of the table still ships one row per task, not the whole group.
    """
    if tiebreak is None:
        skip = set(keys) | {order_by}
        tiebreak = [f.name for f in df.schema.fields
                    if f.name not in skip and _orderable(f.dataType)]
    order = [F.col(order_by).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tiebreak]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    rn = "__latest_rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (an aggregate with map-side combine)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_versions"))
              .where(F.col("n_versions") > 1))


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "dimension") -> DataFrame:
    """Opt-in data check: raise if ``keys`` are not unique in ``df``; return ``df``.

    Runs one aggregation job and brings back at most one offending key.
    """
    bad = duplicate_keys(df, keys).take(1)
    if bad:
        raise ValueError(f"{what} is not unique on {list(keys)}: e.g. {bad[0].asDict()}")
    return df
