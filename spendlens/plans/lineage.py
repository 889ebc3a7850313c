"""Which columns a report's expressions can read, and whether its metrics are linear.

Expressions stay texts that Spark resolves. What is asked here needs no syntax tree: the
identifiers in a text are a superset of the columns it reads, and a metric is linear if
nothing but whole ``sum(<measure>)`` and ``count(*)`` calls depends on a measure or on how
many rows there are. Where a text leaves doubt, the answer is the safe one (reads all
columns; not linear).
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import replace

from ..operators.weighted import ROWS
from ..spec import ReportSpec

_NAME = re.compile(r"`([^`]+)`|([A-Za-z_]\w*)")
_CALL = re.compile(r"([A-Za-z_]\w*)\s*\(")
_COUNT_ALL = re.compile(r"\bcount\s*\(\s*(?:\*|1)\s*\)", re.I)
_COUNT_DISTINCT = re.compile(r"\bcount\s*\(\s*distinct\b", re.I)
_SUM = re.compile(r"\bsum\s*\(\s*(`[^`]+`|[A-Za-z_]\w*)\s*\)", re.I)
_STAR = re.compile(r"(?:^|[(,])\s*\*|\*\s*(?:[),]|$|except\b)", re.I)

#: Calls whose value does not change when rows are repeated, and calls on single values.
_SAFE_CALLS = frozenset(("max", "min", "any_value", "coalesce", "ifnull", "nvl", "nullif", "if", "round", "abs", "cast", "try_cast",
                         "try_divide", "greatest", "least", "upper", "lower", "trim", "concat", "date", "to_date"))


def names_read(expressions: Iterable[str]) -> frozenset[str] | None:
    """The lower-case identifiers in the expressions; ``None`` (all) if one takes all columns."""
    names: set[str] = set()
    for text in expressions:
        if _STAR.search(_COUNT_ALL.sub("1", text)):
            return None
        for quoted, plain in _NAME.findall(text):
            names.update(part.strip("` ").lower() for part in (quoted or plain).split("."))
            names.add((quoted or plain).lower())
    return frozenset(names)


def columns_read(spec: ReportSpec, account_column: str) -> frozenset[str] | None:
    """A superset of the ``api`` columns that a report reads (lower case); ``None``: all."""
    names = names_read(f.expression for f in spec.fields)
    if names is None:
        return None
    more = {r.dimension.strip("`").lower() for r in spec.regex_filters}
    return names | more | ({account_column.lower()} if spec.account_ids else set())


def is_read(column: str, read: frozenset[str] | None) -> bool:
    return read is None or column.lower() in read


def _linear(text: str, measures: frozenset[str]) -> str | None:
    """The metric over rows whose measures are already multiplied and that stand for ``ROWS`` rows, if it is linear."""
    if "'" in text or '"' in text:
        return None
    rest = _SUM.sub(lambda m: " 1 " if m[1].strip("`").lower() in measures else m[0], _COUNT_ALL.sub(" 1 ", text))
    calls = {c.lower() for c in _CALL.findall(_COUNT_DISTINCT.sub("max(", rest))}
    names = names_read([rest])
    if names is None or names & measures or calls - _SAFE_CALLS:
        return None
    return _COUNT_ALL.sub(f"coalesce(sum({ROWS}), 0)", text)


def linear(spec: ReportSpec, measures: Iterable[str]) -> ReportSpec | None:
    """The spec over multiplied rows (see ``operators.weighted``), or ``None`` if a field is not linear.

    Dimensions and filters must not read a measure; metrics may read measures as
    ``sum(measure)`` and rows as ``count(*)`` only.
    """
    own = frozenset(m.lower() for m in measures)
    grouped = names_read(d.expression for d in spec.selected_dimensions)
    filtered = {r.dimension.strip("`").lower() for r in spec.regex_filters}
    if grouped is None or (grouped | filtered) & own:
        return None
    picked = {m.name: _linear(m.expression, own) for m in spec.selected_metrics}
    if any(e is None for e in picked.values()):
        return None
    return replace(spec, metrics=tuple(replace(m, expression=picked[m.name]) if m.name in picked else m for m in spec.metrics))
