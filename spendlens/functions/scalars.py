"""Scalar expressions the reports need beyond Spark's built-ins.

All of them are compositions of ``pyspark.sql.functions`` and stay inside the JVM (no
Python UDF), so they run under whole-stage codegen next to the rest of the projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: word delimiters of the warehouse dialect's INITCAP ---
# whitespace and  [ ] ( ) { } / | \ < > ! ? @ " ^ # $ & ~ _ , . : ; * % + -
_DELIMS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""
_WORDS_AND_DELIMS = f"([^{_DELIMS}]+|[{_DELIMS}]+)"

# --- fixed values: publisher platform labels (raw value -> label); others go to INITCAP ---
# facebook -> Facebook, instagram -> Instagram, messenger -> Messenger,
# audience_network -> Audience Network, unknown -> Unknown
PLATFORM_LABELS: tuple[tuple[str, str], ...] = (
    ("facebook", "Facebook"),
    ("instagram", "Instagram"),
    ("messenger", "Messenger"),
    ("audience_network", "Audience Network"),
    ("unknown", "Unknown"),
)


def initcap_delims(col: Column | str) -> Column:
    """INITCAP that also starts a new word after punctuation such as ``_`` and ``-``.

    Spark's ``initcap`` only splits on spaces. Here the lower-cased text is cut into
    alternating runs of word characters and delimiters, every run is passed through
    ``initcap`` (a delimiter run is unchanged) and the runs are glued back together.
    """
    c = F.col(col) if isinstance(col, str) else col
    runs = F.regexp_extract_all(F.lower(c), F.lit(_WORDS_AND_DELIMS), 1)
    return F.array_join(F.transform(runs, lambda t: F.initcap(t)), "")


def label_map(col: Column | str, labels=PLATFORM_LABELS, otherwise=initcap_delims) -> Column:
    """CASE-style label mapping with a fall-back expression for unlisted values."""
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for raw, label in labels:
        out = (F.when(c == F.lit(raw), F.lit(label)) if out is None
               else out.when(c == F.lit(raw), F.lit(label)))
    return out.otherwise(otherwise(c))


def platform_label(col: Column | str) -> Column:
    return label_map(col, PLATFORM_LABELS, initcap_delims)


def _utc_clock(instant: Column) -> Column:
    """The UTC wall clock of an instant, from its microseconds: no session zone is passed
    through, so the repeated hour of a clock change stays what it is."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)"))
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(secs=seconds.cast("decimal(18,6)")))


def local_datetime(col: Column | str, tz: str, input_type: T.DataType | None = None) -> Column:
    """Wall-clock time in ``tz`` of an instant, as ``timestamp_ntz``.

    A ``timestamp`` (instant) input does not depend on the session zone; a
    ``timestamp_ntz`` input is read as UTC wall clock (how load stamps are stored).
    """
    c = F.col(col) if isinstance(col, str) else col
    utc = c if isinstance(input_type, T.TimestampNTZType) else _utc_clock(c.cast("timestamp"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def utc_date(col: Column | str, input_type: T.DataType | None = None) -> Column:
    """``DATE(x)`` of the source dialect: the UTC calendar date of an instant.

    Spark's ``to_date`` of a ``timestamp`` uses the session time zone, so an instant is
    first turned into UTC wall clock; ``timestamp_ntz``, ``date`` and strings are taken
    as they are. The result does not depend on ``spark.sql.session.timeZone``.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(input_type, T.TimestampType):
        return F.to_date(_utc_clock(c))
    return F.to_date(c)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def typed_cast(col: Column, target: T.DataType, source: T.DataType | None = None) -> Column:
    """``CAST(col AS target)`` with the warehouse's float-to-integer rule.

    The warehouse rounds half away from zero when a fractional value becomes an integer;
    Spark truncates. ``round`` is half-away-from-zero in Spark, so apply it first.
    """
    if isinstance(target, _INTEGRAL) and isinstance(source, _FRACTIONAL):
        return F.round(col).cast(target)
    if source is not None and source == target:
        return col
    return col.cast(target)


def string_key(col: Column | str) -> Column:
    """``safe_cast(x AS string)``: the normalised form used by string-keyed joins."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("string")
