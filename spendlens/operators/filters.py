"""Row filters of the final report: account allow-list and regex filters."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import RegexFilter, spark_type


def allow_list_predicate(df: DataFrame, column: str, ids: Sequence, cast: str | None = None
                         ) -> Column:
    """``column IN (ids)`` (or ``CAST(column AS cast) IN (ids)``).

    Ids are cast to the compared type explicitly instead of relying on implicit
    coercion, so ``'1'`` and ``1`` meet in one well-defined type. A malformed value
    under a strict cast raises, as the source report does.
    """
    if cast is None:
        target: T.DataType = df.schema[column].dataType
        c = F.col(column)
    else:
        target = spark_type(cast)
        c = F.col(column).cast(target)
    return c.isin([F.lit(v).cast(target) for v in ids])


def account_allow_list(df: DataFrame, column: str, ids: Sequence, cast: str | None = None
                       ) -> DataFrame:
    """Keep rows whose account is listed; no-op for an empty list."""
    ids = tuple(ids or ())
    if not ids:
        return df
    return df.where(allow_list_predicate(df, column, ids, cast))


def regex_predicate(f: RegexFilter) -> Column:
    """``regexp_like(<dimension>, r'<re>') = <result>`` (partial match; NULL drops)."""
    return F.regexp_like(F.expr(f.dimension), F.lit(f.expression)) == F.lit(bool(f.result))


def regex_filters(df: DataFrame, filters: Iterable[RegexFilter] | None) -> DataFrame:
    """AND-combine every regex filter; unset or empty means no filter."""
    for f in filters or ():
        df = df.where(regex_predicate(f))
    return df
