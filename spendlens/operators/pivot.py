"""Long (keys, name, value) metric tables pivoted wide by conversion event."""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import ConversionSpec


def pivot_name(agg_alias: str, value_alias: str) -> str:
    """Output column of one pivot cell: ``<aggregate alias>_<value alias>``."""
    return f"{agg_alias}_{value_alias}"


#: Beyond this many cells Spark compiles neither an aggregate nor a projection of them all.
MOST_CELLS = 90


def pivot_metrics(df: DataFrame, keys: Sequence[str], on: str,
                  values: Sequence[ConversionSpec | tuple[str, str]],
                  measures: Mapping[str, Column],
                  agg: Callable[[Column], Column] = F.sum,
                  prune_unlisted: bool = False) -> DataFrame:
    """``PIVOT(agg(m) AS alias ... FOR on IN ('event' AS out, ...))`` grouped by ``keys``.

    Built as conditional aggregation, ``agg(CASE WHEN on = 'event' THEN m END)``, which is
    one hash aggregate with map-side combine and a single shuffle (Spark's own ``pivot``
    with a value list plans two). Semantics kept from the pivot operator: every key
    group appears, also one whose rows all carry unlisted values (its cells are NULL),
    and a listed value with only NULL amounts gives NULL.

    ``prune_unlisted`` drops rows with unlisted values before the shuffle. Use it only
    when the result is left-joined back by ``keys``: there an all-NULL pivot row and a
    missing one give the same joined row, and the shuffle carries only listed events.

    More than ``MOST_CELLS`` cells take ``_sparse_pivot``: the same columns out of as many
    sums as there are measures.
    """
    pairs = [(v.event_name, v.output_name) if isinstance(v, ConversionSpec) else tuple(v)
             for v in values]
    if not pairs:
        raise ValueError("pivot needs at least one value")
    src = df
    if prune_unlisted:
        src = src.where(F.col(on).isin([e for e, _ in pairs]))
    if len(pairs) * len(measures) > MOST_CELLS and isinstance(df.schema[on].dataType, T.StringType):
        return _sparse_pivot(src, keys, on, pairs, measures, agg)
    cells = []
    for alias, m in measures.items():
        for event, out in pairs:
            cells.append(agg(F.when(F.col(on) == F.lit(event), m)).alias(pivot_name(alias, out)))
    return src.groupBy(*[F.col(k) for k in keys]).agg(*cells)


def _sparse_pivot(src: DataFrame, keys: Sequence[str], on: str, pairs: Sequence[tuple[str, str]],
                  measures: Mapping[str, Column], agg: Callable[[Column], Column]) -> DataFrame:
    """The pivot by way of one row for each key and event that occurs.

    A row of hundreds of conditional sums is as wide for every key as the configuration,
    and too wide for compiled aggregates. Here ``(keys, event)`` is aggregated first, one
    sum a measure with map-side combine; its rows, only those that occur, are then gathered
    by key into a map from event to sums (at most one entry an event), and the cells are
    looked up in it. Both aggregates are narrow; the second shuffle moves aggregated rows.
    """
    names = list(measures)
    event = F.when(F.col(on).isin([e for e, _ in pairs]), F.col(on)).alias("__event")
    by_event = src.groupBy(*[F.col(k) for k in keys], event).agg(*(agg(m).alias(f"__s{i}") for i, m in enumerate(measures.values())))
    entry = F.when(F.col("__event").isNotNull(), F.struct(F.col("__event"), F.struct(*(F.col(f"__s{i}") for i in range(len(names))))))
    # collect_list leaves NULL entries out: a key of unlisted events only has an empty map
    by_key = by_event.groupBy(*[F.col(k) for k in keys]).agg(F.map_from_entries(F.collect_list(entry)).alias("__cells"))
    cell = {e: F.try_element_at("__cells", F.lit(e)) for e, _ in pairs}
    return by_key.select(*[F.col(k) for k in keys], *(cell[e].getField(f"__s{i}").alias(pivot_name(a, out))
                                                      for i, a in enumerate(names) for e, out in pairs))
