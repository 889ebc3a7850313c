"""Run a report end to end: build (or blank), write, optionally republish."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.shape import empty_report
from ..sinks.tables import replace_table, republish
from ..sources.tables import Loader, loader
from ..spec import ReportSpec, SpecError
from .reports import BUILDERS


def build(spark: SparkSession, kind: str, spec: ReportSpec, load: Loader | None = None,
          tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The report as a lazy DataFrame; an inactive spec gives the empty typed table."""
    if kind not in BUILDERS:
        raise KeyError(f"unknown report kind {kind!r}; known: {sorted(BUILDERS)}")
    if not spec.is_active:
        return empty_report(spark, spec)
    if load is None and tables is None and not spec.source:
        raise SpecError("spec.source (database or directory of the source tables) is required")
    load = load or loader(spark, spec.source, tables)
    return BUILDERS[kind](spec, load)


def run_report(spark: SparkSession, kind: str, spec: ReportSpec, load: Loader | None = None,
               tables: Mapping[str, DataFrame] | None = None) -> dict:
    """Replace ``spec.target`` with the report, then republish it if configured.

    The republished copy is read back from the stored table, never recomputed.
    """
    df = build(spark, kind, spec, load, tables)
    replace_table(df, spec.target, spec)
    copied = republish(spark, spec)
    return {"target": spec.target, "external": copied}
