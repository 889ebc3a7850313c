"""Reading the source tables of a report."""

from __future__ import annotations

import os
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

Loader = Callable[[str, Sequence[str]], DataFrame]


class MissingColumns(ValueError):
    """A source table lacks columns the report reads."""


def require_columns(df: DataFrame, required: Sequence[str], what: str) -> DataFrame:
    """``df`` cut to the columns the report reads, under the names it reads them by.

    Names are matched as the catalog does, in any letter case (an exact match wins); a
    column that is missing fails early, by name. Cutting here keeps whatever works on
    "all other columns" (such as a tie-break) from reading a wide table whole.
    """
    have: dict[str, str] = {}
    for c in df.columns:
        have.setdefault(c.lower(), c)
    exact = set(df.columns)
    missing = [c for c in required if c.lower() not in have]
    if missing:
        raise MissingColumns(f"{what} lacks columns {missing}; has {sorted(exact)}")
    if not required:
        return df
    return df.select(*[df[quoted(c if c in exact else have[c.lower()])].alias(c)
                       for c in dict.fromkeys(required)])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_table(spark: SparkSession, namespace: str, name: str,
               required: Sequence[str] = ()) -> DataFrame:
    """``FROM <namespace>.<name>``.

    ``namespace`` is a catalog database (``spark.table``) or, when it is a path (has a
    ``/`` or a URI scheme), a directory holding ``<name>`` as Parquet (a directory or a
    ``<name>.parquet`` file). Only the columns a report uses are read: Catalyst prunes
    the scan to them and pushes filters into it.
    """
    if "/" in namespace or "://" in namespace:
        base = namespace.rstrip("/")
        path = f"{base}/{name}"
        if "://" not in base and not os.path.exists(path) and os.path.exists(path + ".parquet"):
            path = path + ".parquet"
        df = spark.read.parquet(path)
    else:
        df = spark.table(f"{namespace}.{name}" if namespace else name)
    return require_columns(df, required, f"{namespace}.{name}")


def loader(spark: SparkSession, namespace: str,
           overrides: Mapping[str, DataFrame] | None = None) -> Loader:
    """A ``(name, required) -> DataFrame`` function; ``overrides`` wins over storage."""
    overrides = dict(overrides or {})

    def load(name: str, required: Sequence[str] = ()) -> DataFrame:
        if name in overrides:
            return require_columns(overrides[name], required, name)
        return read_table(spark, namespace, name, required)

    return load
