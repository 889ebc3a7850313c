"""Daily fact roll-ups (eager aggregation before any join)."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rollup(df: DataFrame, keys: Mapping[str, Column | str] | list,
           measures: Mapping[str, Column], constants: Mapping[str, Column] | None = None
           ) -> DataFrame:
    """``select keys, agg(...) from df group by keys`` plus literal columns.

    ``keys`` maps output name to a key expression (a list of names is accepted too);
    ``measures`` maps output name to an aggregate expression such as ``F.sum("spend")``;
    ``constants`` are literal columns added after the aggregate (``0 as conversions``).

    Spark plans a partial (map-side) aggregate, one shuffle on the keys and a final
    aggregate, so a hot key is combined inside each task before anything moves.
    """
    if isinstance(keys, (list, tuple)):
        keys = {k: k for k in keys}
    key_cols = [_col(v).alias(k) for k, v in keys.items()]
    aggs = [c.alias(n) for n, c in measures.items()]
    out = df.groupBy(*key_cols).agg(*aggs) if aggs else df.groupBy(*key_cols).agg(
        F.count(F.lit(1)).alias("__n")).drop("__n")
    for name, c in (constants or {}).items():
        out = out.withColumn(name, c)
    return out


def sum_of(*names: str, prefix: str = "") -> dict[str, Column]:
    """``{name: sum(prefix+name)}`` for each measure name (the common case)."""
    return {n: F.sum(F.col(prefix + n)) for n in names}


def constant_sum(value: int = 0) -> Column:
    """``sum(0)``: a bigint 0 per group, never NULL."""
    return F.sum(F.lit(value).cast("bigint"))


def product_sum(a: Column | str, b: Column | str) -> Column:
    """``sum(a * b)``; a row with NULL in either factor contributes nothing."""
    return F.sum(_col(a) * _col(b))
