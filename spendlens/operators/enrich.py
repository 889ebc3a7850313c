"""Joins that widen a rolled-up fact into the report's ``api`` relation.

Every join in the reports is a LEFT OUTER equi-join. Dimension columns are renamed on
the way in, so the joined relation never holds two columns with the same name.

Join strategy is left to Spark: a dimension that is small by its statistics (or, with
AQE, by the measured size of its shuffle stage) is broadcast; a large one is joined by
sort-merge with AQE's skew split. Nothing here forces a broadcast of data whose size is
unknown.
"""

from __future__ import annotations

import itertools
from collections.abc import Collection
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import string_key

_ids = itertools.count()

_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def key_pair(left: DataFrame, lname: str, right: DataFrame, rname: str,
             normalise: bool) -> tuple[Column, Column]:
    """Join key expressions for ``left.lname = right.rname``.

    With ``normalise`` both sides are compared as ``safe_cast(x AS string)``. When both
    columns already share an integral, string or date type that comparison equals plain
    equality, so the raw columns are used and an existing hash partitioning on them can
    be reused instead of reshuffling on a computed key. Fractional keys are refused
    (``1.0`` and ``1`` differ as strings).
    """
    lc, rc = left[lname], right[rname]
    if not normalise:
        return lc, rc
    lt, rt = _type_of(left, lname), _type_of(right, rname)
    if isinstance(lt, _FRACTIONAL) or isinstance(rt, _FRACTIONAL):
        raise TypeError(f"fractional join key {lname}/{rname}: string form is ambiguous")
    if lt == rt:
        return lc, rc
    return string_key(lc), string_key(rc)


#: Over how many hash values the rows with a NULL link are spread.
NULL_SPREAD = 4096


def _spread(df: DataFrame, links: Sequence[str]) -> Column:
    """0, or for rows with a NULL link a number from 1 that is a function of the row."""
    missing = F.col(links[0]).isNull()
    for name in links[1:]:
        missing = missing | F.col(name).isNull()
    hashed = [F.col(c) for c in df.columns if "map<" not in _type_of(df, c).simpleString()]
    return F.when(missing, 1 + F.pmod(F.xxhash64(*hashed), F.lit(NULL_SPREAD))).otherwise(0)


def left_join(df: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]],
              take: Mapping[str, str], how: str = "left",
              normalise: bool | Collection[str] = False, spread_nulls: bool = False) -> DataFrame:
    """``df LEFT JOIN dim ON df.l = dim.r AND ...``, bringing ``take`` columns along.

    ``normalise`` compares all keys as strings, or only the left keys it names.

    ``take`` maps output name -> dimension column (a join key may be taken too: it is
    NULL where nothing matched). ``how="inner"`` is used by the allow-list trim. Plain
    equi-joins are joined USING the key names, which puts the join keys first in the
    output; select by name downstream.

    ``spread_nulls``: a NULL link joins nothing, yet all rows that have one hash to one
    partition. A second key, 0 on the right and on rows with a link, deals them out over
    all partitions. For sides whose links are often NULL and that are shuffled for this
    join anyway (an existing partitioning by the link alone would not be reused).
    """
    if spread_nulls and how == "left":
        n = next(_ids)
        key = f"__null_{n}"
        df = df.withColumn(key, _spread(df, [l for l, _ in on]))
        # always 0, in a form that is not folded into the left side's condition
        zero = F.pmod(F.xxhash64(*[F.col(r) for _, r in on]), F.lit(1))
        return left_join(df, dim.withColumn(key, zero), [*on, (key, key)], take, how,
                         [l for l, _ in on] if normalise is True else normalise).drop(key)
    left_cols = set(df.columns)
    for out in take:
        if out in left_cols:
            raise ValueError(f"column {out!r} already exists on the left side")
    values = [F.col(src).alias(out) for out, src in take.items()]
    as_text = {l for l, _ in on if (normalise if isinstance(normalise, bool) else l in normalise)}
    if all(l not in as_text or (_type_of(df, l) == _type_of(dim, r) and
                                not isinstance(_type_of(df, l), _FRACTIONAL)) for l, r in on):
        # plain equi-join: name the right keys like the left ones and join USING them,
        # which keeps the left keys and drops the right ones in the same step
        right = dim.select(*[F.col(r).alias(l) for l, r in on], *values)
        return df.join(right, [l for l, _ in on], how)
    n = next(_ids)
    rkeys = [f"__k{n}_{i}" for i in range(len(on))]
    right = dim.select(*[F.col(r).alias(k) for (_, r), k in zip(on, rkeys)], *values)
    cond = None
    for (lname, _), rk in zip(on, rkeys):
        lc, rc = key_pair(df, lname, right, rk, lname in as_text)
        cond = (lc == rc) if cond is None else (cond & (lc == rc))
    return df.join(right, cond, how).drop(*rkeys)


def chain(base: DataFrame, links: Sequence[tuple[DataFrame, Sequence[tuple[str, str]],
                                                  Mapping[str, str], str]],
          normalise: bool = False) -> DataFrame:
    """Snowflake chain built dimension to dimension, the far end first:
    ``base ⟕ (d1 ⟕ (d2 ⟕ d3))``.

    Each link is ``(dim, on, take, how)`` where ``on`` names columns of ``base`` or of an
    earlier link's ``take``. A link hangs below the link whose columns it is joined on, so
    the biggest dimension (``base``) is shuffled once per branch and the low-cardinality
    keys further up only shuffle the small dimensions that hold them. It equals joining
    level by level: ``(F ⟕ A) ⟕ B = F ⟕ (A ⟕ B)`` for an ``A``-``B`` condition that NULL
    never meets, and likewise if all joins of a branch are inner. An inner link below a
    left one is not moved (it would no longer drop rows of ``base``).
    """
    owner: dict[str, int] = {}
    below: dict[int, list[int]] = {}
    for i, (_, on, take, how) in enumerate(links):
        owners = {owner.get(l, -1) for l, _ in on}
        up = owners.pop() if len(owners) == 1 else -1
        if up >= 0 and how == "inner" and links[up][3] != "inner":
            up = -1
        below.setdefault(up, []).append(i)
        owner.update({out: i for out in take})

    def take_of(i: int) -> dict[str, str]:
        out = {o: o for o in links[i][2]}
        for child in below.get(i, ()):
            out.update(take_of(child))
        return out

    def frame(i: int) -> DataFrame:
        dim, on, take, _ = links[i]
        out = dim.select(*[F.col(r).alias(f"__c{i}_{k}") for k, (_, r) in enumerate(on)],
                         *[F.col(src).alias(o) for o, src in take.items()])
        return _attach(out, i)

    def _attach(df: DataFrame, node: int) -> DataFrame:
        for i in below.get(node, ()):
            on = [(l, f"__c{i}_{k}") for k, (l, _) in enumerate(links[i][1])]
            df = left_join(df, frame(i), on, take_of(i), how=links[i][3], normalise=normalise,
                           spread_nulls=True)
        return df

    return _attach(base, -1)


def _nest(chain_facts, keys):
    """``A ⟕ (E ⟕ (Ev ⟕ V))`` on ``keys``: each fact joined to the next one's own keys."""
    df, measures = chain_facts[-1]
    nested, cols = df.select(*keys, *measures), list(measures)
    for df, measures in reversed(chain_facts[:-1]):
        nested = left_join(df.select(*keys, *measures), nested, [(k, k) for k in keys],
                           {m: m for m in cols})
        cols = list(measures) + cols
    return nested, cols


def stitch_facts(spine: DataFrame, page: tuple[DataFrame, Sequence[str]] | None,
                 chain_facts: Sequence[tuple[DataFrame, Sequence[str]]],
                 date: str = "date", ad: str = "ad_id", gn: str = "_gn_id",
                 mode: str = "as_written") -> DataFrame:
    """Stitch several fact roll-ups that share the grain ``(date, ad, gn)``.

    ``as_written`` (default) is the source's join conditions to the letter: ``page`` joins
    on (ad, date) only and the chain on (ad, gn) without the date, so a ``gn`` id seen on
    *k* days pairs every row of its group with every other (up to k⁴ rows per spine row).
    The first chain fact joins the spine, every later one the *previous chain fact*, so a
    missing link blanks everything after it.

    ``chained`` (by name only) joins the same chain on the whole grain, so its joins never
    multiply rows and, all roll-ups being hash-partitioned on that grain, add no shuffle.
    It equals ``as_written`` if no ``(ad, gn)`` spans days, which ``one_day_per_group``
    checks.

    ``grain_safe`` joins every fact straight from the spine on all three keys (no chain:
    a missing attribution row does not blank the others).
    """
    order = spine.columns + [m for _, ms in ([page] if page else []) + list(chain_facts)
                             for m in ms]
    return _stitch(spine, page, chain_facts, date, ad, gn, mode).select(*order)


def _stitch(spine, page, chain_facts, date, ad, gn, mode):
    out = spine
    grain = (date, ad, gn)
    if mode == "chained":
        if page:
            df, measures = page
            out = left_join(out, df, [(ad, ad), (date, date)], {m: m for m in measures})
        if not chain_facts:
            return out
        nested, cols = _nest(chain_facts, grain)
        return left_join(out, nested, [(k, k) for k in grain], {m: m for m in cols})
    if mode == "grain_safe":
        facts = ([page] if page else []) + list(chain_facts)
        for df, measures in facts:
            out = left_join(out, df, [(date, date), (ad, ad), (gn, gn)],
                            {m: m for m in measures})
        return out
    if mode != "as_written":
        raise ValueError(f"unknown stitch mode {mode!r}")
    if page:
        df, measures = page
        out = left_join(out, df, [(ad, ad), (date, date)], {m: m for m in measures})
    if not chain_facts:
        return out
    # ((S ⟕ A) ⟕ E) ⟕ V with each condition reading the previous fact's keys equals
    # S ⟕ (A ⟕ (E ⟕ V)) (left joins associate over null-rejecting conditions), with the
    # same multiplicities. The nested chain joins the narrow facts on their own
    # (ad, gn) columns, so they stay co-partitioned, and the wide spine is shuffled once.
    nested, cols = _nest(chain_facts, (ad, gn))
    return left_join(out, nested, [(ad, ad), (gn, gn)], {m: m for m in cols})


def one_day_per_group(facts: Sequence[DataFrame], date: str = "date", ad: str = "ad_id",
                      gn: str = "_gn_id") -> None:
    """Opt-in data check before ``mode="chained"``: raise if some ``(ad, gn)`` spans days.

    One aggregate per roll-up, of which at most one offending group is brought back.
    """
    for df in facts:
        bad = (df.groupBy(ad, gn).agg(F.min(date).alias("first"), F.max(date).alias("last"))
                 .where(F.col("first") < F.col("last")).take(1))
        if bad:
            raise ValueError(f"chained stitching differs from the source here: {bad[0].asDict()}")
