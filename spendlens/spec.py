"""Report specifications.

A report is described by plain, frozen dataclasses that live on the driver only: which
dimensions and metrics to publish (each a SQL expression over the report's ``api``
relation plus a declared type), which accounts to keep, which conversion events to pivot,
which regex filters to apply and where to write. Nothing here touches data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Iterable, Sequence

from pyspark.sql import types as T

# --- fixed values: declared type names of the source warehouse dialect -> Spark types ---
# INT64 -> bigint, FLOAT64 -> double, STRING -> string, BOOL -> boolean, DATE -> date,
# DATETIME -> timestamp_ntz, TIMESTAMP -> timestamp, NUMERIC -> decimal(38,9),
# BYTES -> binary. Integer aliases INT, INTEGER, SMALLINT, BIGINT, TINYINT, BYTEINT all
# mean INT64; DECIMAL means NUMERIC; BOOLEAN means BOOL.
_DIALECT_TYPES: dict[str, T.DataType] = {
    "INT64": T.LongType(),
    "INT": T.LongType(),
    "INTEGER": T.LongType(),
    "SMALLINT": T.LongType(),
    "BIGINT": T.LongType(),
    "TINYINT": T.LongType(),
    "BYTEINT": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "DECIMAL": T.DecimalType(38, 9),
    "STRING": T.StringType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
    "BYTES": T.BinaryType(),
}

# Spark DDL names accepted as they are (lower case, Spark meaning).
_SPARK_TYPES: dict[str, T.DataType] = {
    "long": T.LongType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "real": T.FloatType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "timestamp_ltz": T.TimestampType(),
    "binary": T.BinaryType(),
}

_DECIMAL_RE = re.compile(r"^\s*(?:decimal|numeric|dec)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)\s*$", re.I)


class SpecError(ValueError):
    """A report specification that cannot produce a valid table."""


def spark_type(declared: str) -> T.DataType:
    """Resolve a declared field type to a Spark ``DataType``; unknown names raise."""
    if not isinstance(declared, str) or not declared.strip():
        raise SpecError(f"empty type name: {declared!r}")
    name = declared.strip()
    if name.upper() in _DIALECT_TYPES:
        return _DIALECT_TYPES[name.upper()]
    if name.lower() in _SPARK_TYPES:
        return _SPARK_TYPES[name.lower()]
    m = _DECIMAL_RE.match(name)
    if m:
        precision, scale = int(m.group(1)), int(m.group(2) or 0)
        if not (0 < precision <= 38 and 0 <= scale <= precision):
            raise SpecError(f"decimal out of range: {declared!r}")
        return T.DecimalType(precision, scale)
    raise SpecError(f"unknown type name: {declared!r}")


@dataclass(frozen=True)
class FieldSpec:
    """One output column: ``CAST(<expression> AS <type>) AS <name>``."""

    name: str
    type: str
    expression: str
    default: bool = False
    active: bool = False

    @property
    def data_type(self) -> T.DataType:
        return spark_type(self.type)

    @property
    def description(self) -> str:
        return f"[db_field_name = {self.name}]"


@dataclass(frozen=True)
class ConversionSpec:
    """A pivoted event value and the suffix of the columns it produces."""

    event_name: str
    output_name: str


@dataclass(frozen=True)
class RegexFilter:
    """Keep rows where ``regexp_like(<dimension>, <expression>) = <result>``."""

    dimension: str
    expression: str
    result: bool = True


@dataclass(frozen=True)
class ExternalTarget:
    """Second place the finished report is copied to (another catalog/database)."""

    active: bool = False
    database: str = ""
    location: str = ""
    description: str = ""
    friendly_name: str = ""


SELECT_ALL = "all"
SELECT_DEFAULT_THEN_ACTIVE = "default_then_active"
STITCH_CHAINED = "chained"
STITCH_AS_WRITTEN = "as_written"
STITCH_GRAIN_SAFE = "grain_safe"
STITCH_MODES = (STITCH_CHAINED, STITCH_AS_WRITTEN, STITCH_GRAIN_SAFE)

_NAME_RE = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def select_fields(fields: Iterable[FieldSpec], mode: str) -> tuple[FieldSpec, ...]:
    """Pick the fields a report publishes.

    ``all`` keeps every field in order. ``default_then_active`` takes the ``default``
    fields first, then appends the ``active`` ones; a field that is both appears once
    (first place). Two *different* fields sharing a name are an error.
    """
    fields = tuple(fields)
    if mode == SELECT_ALL:
        picked = list(fields)
    elif mode == SELECT_DEFAULT_THEN_ACTIVE:
        picked = [f for f in fields if f.default] + [f for f in fields if f.active]
    else:
        raise SpecError(f"unknown selection mode {mode!r}")
    out: list[FieldSpec] = []
    seen: dict[str, FieldSpec] = {}
    for f in picked:
        if f.name in seen:
            if seen[f.name] != f:
                raise SpecError(f"two different fields named {f.name!r}")
            continue
        seen[f.name] = f
        out.append(f)
    return tuple(out)


@dataclass(frozen=True)
class ReportSpec:
    """Everything one report needs; validated on construction."""

    target: str
    dimensions: tuple[FieldSpec, ...]
    metrics: tuple[FieldSpec, ...] = ()
    source: str = ""
    selection: str = SELECT_ALL
    active: bool = True
    table_active: bool = True
    account_ids: tuple = ()
    conversions: tuple[ConversionSpec, ...] = ()
    regex_filters: tuple[RegexFilter, ...] = ()
    actions: bool = False
    action_values: bool = False
    pivots: bool = False
    timezone: str = "UTC"
    run_ts: datetime | None = None
    external: ExternalTarget = field(default_factory=ExternalTarget)
    stitch: str = STITCH_AS_WRITTEN
    history_tiebreak: tuple[str, ...] | None = None
    history_order: str | None = None
    inner_join_trim: bool = True
    #: multi-fact: sum through the stitching by products of counts where all metrics are linear
    factorise: bool = True
    #: dimension tables whose joined rows are unique by id; checked where a join is left out for it
    unique_ids: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for attr in ("dimensions", "metrics", "account_ids", "conversions", "regex_filters", "unique_ids"):
            value = getattr(self, attr)
            if value is None:
                value = ()
            object.__setattr__(self, attr, tuple(value))
        if self.history_tiebreak is not None:  # None: break ties on every other column
            object.__setattr__(self, "history_tiebreak", tuple(self.history_tiebreak))
        if self.stitch not in STITCH_MODES:
            raise SpecError(f"unknown stitch mode {self.stitch!r}")
        if not self.is_active:
            return
        self.validate()

    # ---- derived ------------------------------------------------------------------
    @property
    def is_active(self) -> bool:
        return bool(self.active and self.table_active)

    @property
    def selected_dimensions(self) -> tuple[FieldSpec, ...]:
        return select_fields(self.dimensions, self.selection)

    @property
    def selected_metrics(self) -> tuple[FieldSpec, ...]:
        return select_fields(self.metrics, self.selection)

    @property
    def fields(self) -> tuple[FieldSpec, ...]:
        return self.selected_dimensions + self.selected_metrics

    def schema(self) -> T.StructType:
        """Declared output schema, one column per dimension then metric, with comments."""
        return T.StructType([
            T.StructField(f.name, f.data_type, True, {"comment": f.description})
            for f in self.fields
        ])

    def run_time(self) -> datetime:
        """The injected run time, else now as UTC wall clock (the warehouse default zone)."""
        if self.run_ts is not None:
            return self.run_ts
        return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)

    # ---- validation ---------------------------------------------------------------
    def validate(self) -> None:
        if not self.target:
            raise SpecError("target table name is required")
        dims, mets = self.selected_dimensions, self.selected_metrics
        if not dims:
            raise SpecError("a report needs at least one dimension")
        names = [f.name.lower() for f in dims + mets]  # catalogs compare names case-blind
        dup = sorted({n for n in names if names.count(n) > 1})
        if dup:
            raise SpecError(f"dimension and metric share names: {dup}")
        for f in dims + mets:
            if not _NAME_RE.match(f.name):
                raise SpecError(f"invalid column name {f.name!r}")
            if not f.expression or not f.expression.strip():
                raise SpecError(f"field {f.name!r} has no expression")
            spark_type(f.type)
        outs = [c.output_name for c in self.conversions]
        evs = [c.event_name for c in self.conversions]
        if len(set(outs)) != len(outs) or len(set(evs)) != len(evs):
            raise SpecError("duplicate conversion event or output name")
        for c in self.conversions:
            if not _NAME_RE.match(c.output_name):
                raise SpecError(f"invalid conversion output name {c.output_name!r}")
        if (self.actions or self.action_values or self.pivots) and not self.conversions:
            raise SpecError("pivots are switched on but no conversions are listed")
        for r in self.regex_filters:
            if not r.dimension or r.expression is None:
                raise SpecError(f"incomplete regex filter {r!r}")
        for v in self.account_ids:
            if isinstance(v, bool) or not isinstance(v, (int, str)):
                raise SpecError(f"account id must be int or str, got {v!r}")
        if self.external.active and not self.external.database:
            raise SpecError("external target is active but has no database")


def fields(*rows: Sequence) -> tuple[FieldSpec, ...]:
    """Shorthand: ``fields(("name", "STRING", "expr"), ...)``."""
    return tuple(FieldSpec(*r) for r in rows)

