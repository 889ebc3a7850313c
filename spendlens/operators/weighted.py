"""Joins that multiply rows, as products of counts.

Where a join repeats a row n times and the result is only summed, the sum over the repeats
is n times the value: rows need not be made. The operators here keep one row for each row
of the left side and carry ``ROWS``, how many rows it stands for; its measures are already
multiplied by it, so ``sum(measure)`` and ``sum(ROWS)`` equal ``sum`` and ``count(*)`` over
the literal join. Every side is aggregated by its join key first (a partial aggregate in
each task, one shuffle of the partial sums), so a key with very many rows meets the join as one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .enrich import left_join

#: How many rows of the literal join a row stands for.
ROWS = "__rows"
#: Digits of a multiplied decimal before its multiplication; with a 10-digit count the product has 38.
_DIGITS = 27


def scaled(value: Column, dtype: T.DataType, by: Column) -> Column:
    """``value * by`` without loss: whole numbers as bigint, decimals at their own scale.

    A decimal of more than 27 digits raises instead of being rounded.
    """
    if isinstance(dtype, T.DecimalType):
        if dtype.scale > _DIGITS:
            raise ValueError(f"a measure of {dtype.simpleString()} has too many decimal places to be multiplied")
        cut = value.cast(T.DecimalType(_DIGITS, dtype.scale))
        too_big = F.when(value.isNotNull(), F.raise_error(F.lit("a measure is too large to be multiplied by its row count")))
        return F.coalesce(cut, too_big) * by.cast("decimal(10,0)")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return value.cast("bigint") * by
    return value * by


def _scaled_columns(df: DataFrame, columns: Sequence[str], by: Column) -> dict[str, Column]:
    return {c: scaled(F.col(c), df.schema[c].dataType, by) for c in columns}


def sums_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str], count: str) -> DataFrame:
    """One row for each key without NULLs: the measures' sums and the number of rows.

    Rows with a NULL key never join and are left out.
    """
    known = df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    return known.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures), F.count(F.lit(1)).alias(count))


def versions(df: DataFrame, columns: Mapping[str, str], weight: str) -> DataFrame:
    """A history cut to ``columns`` (output name -> column): its distinct rows, and how often each occurs."""
    return df.groupBy(*(F.col(src).alias(out) for out, src in columns.items())).agg(F.count(F.lit(1)).alias(weight))


def stitch_sums(spine: DataFrame, page: tuple[DataFrame, Sequence[str]] | None,
                chain_facts: Sequence[tuple[DataFrame, Sequence[str]]], measures: Sequence[str],
                date: str = "date", ad: str = "ad_id", gn: str = "_gn_id") -> DataFrame:
    """``stitch_facts(mode="as_written")`` summed for each spine row instead of joined row by row.

    The literal stitching pairs a spine row with every page row of its ``(ad, date)`` and
    with every combination of the chain facts' rows of its ``(ad, gn)``; a missing link
    blanks the rest of the chain. Here each fact is one row a key, with its sums and its
    row count n; a measure is multiplied by the counts of all other facts (1 where nothing
    joins). ``measures`` are the spine's. The result has the spine's rows.
    """
    out, page_rows = spine, F.lit(1).cast("bigint")
    if page:
        sums = sums_by(page[0], [ad, date], page[1], "__n_page")
        out = left_join(out, sums, [(ad, ad), (date, date)], {m: m for m in [*page[1], "__n_page"]})
        page_rows = F.coalesce("__n_page", F.lit(1))
    nested = None
    for i, (df, cols) in reversed(list(enumerate(chain_facts))):
        one = sums_by(df, [ad, gn], cols, f"__n{i}")
        if nested is not None:
            one = left_join(one, nested, [(ad, ad), (gn, gn)], {c: c for c in nested.columns if c not in (ad, gn)})
        nested = one
    if nested is not None:
        out = left_join(out, nested, [(ad, ad), (gn, gn)], {c: c for c in nested.columns if c not in (ad, gn)})

    # rows[i]: the combinations of chain fact i and those after it (1 where nothing joins)
    rows = [F.lit(1).cast("bigint")]
    for i in reversed(range(len(chain_facts))):
        rows.insert(0, F.coalesce(F.col(f"__n{i}") * rows[0], F.lit(1)))
    done = _scaled_columns(out, measures, page_rows * rows[0])
    if page:
        done.update(_scaled_columns(out, page[1], rows[0]))
    ahead = page_rows
    for i, (_, cols) in enumerate(chain_facts):
        done.update(_scaled_columns(out, cols, ahead * rows[i + 1]))
        ahead = ahead * F.col(f"__n{i}")
    order = [c for c in spine.columns] + [m for _, ms in ([page] if page else []) + list(chain_facts) for m in ms]
    return out.select(*[done[c].alias(c) if c in done else F.col(c) for c in order], (page_rows * rows[0]).alias(ROWS))


def weighed(df: DataFrame, measures: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """Multiply the measures and ``ROWS`` by the product of ``weights`` (NULL: 1), which are dropped."""
    by = F.lit(1).cast("bigint")
    for w in weights:
        by = by * F.coalesce(F.col(w), F.lit(1))
    done = _scaled_columns(df, [*measures, ROWS], by)
    return df.select(*[done[c].alias(c) if c in done else F.col(c) for c in df.columns if c not in weights])
