"""Final regroup: the user's dimensions and metrics over the ``api`` relation."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import typed_cast
from ..spec import ReportSpec, SpecError


def build_report(api: DataFrame, spec: ReportSpec) -> DataFrame:
    """``SELECT CAST(dim AS t) AS d, ..., CAST(metric AS t) AS m FROM api GROUP BY dims``.

    * Dimensions are cast *before* grouping (the group-by ordinals point at the casted
      select items), metrics are aggregated first and cast afterwards.
    * Intermediate columns get private names, so a dimension named like an ``api``
      column never captures a metric's reference to that column.
    * Casting a fractional value to an integer type rounds half away from zero.
    * Every output column carries the comment ``[db_field_name = <name>]``.

    One hash aggregate: partial per task, one shuffle on the dimension values.
    """
    dims, mets = spec.selected_dimensions, spec.selected_metrics
    if not dims:
        raise SpecError("a report needs at least one dimension")
    try:
        raw = api.select(*[F.expr(d.expression).alias(f"__d{i}") for i, d in enumerate(dims)])
        raw_types = [f.dataType for f in raw.schema.fields]
    except AnalysisException as e:
        raise SpecError(f"a dimension expression does not resolve: {e}") from e
    dim_cols = [typed_cast(F.expr(d.expression), d.data_type, t).alias(f"__d{i}")
                for i, (d, t) in enumerate(zip(dims, raw_types))]
    agg_cols = [F.expr(m.expression).alias(f"__m{i}") for i, m in enumerate(mets)]
    grouped = api.groupBy(*dim_cols)
    try:
        g = grouped.agg(*agg_cols) if agg_cols else grouped.count().drop("count")
        g_types = {f.name: f.dataType for f in g.schema.fields}
    except AnalysisException as e:
        raise SpecError(f"a metric expression is not a valid aggregate: {e}") from e
    out = [F.col(f"__d{i}").alias(d.name, metadata={"comment": d.description})
           for i, d in enumerate(dims)]
    out += [typed_cast(F.col(f"__m{i}"), m.data_type, g_types[f"__m{i}"])
            .alias(m.name, metadata={"comment": m.description})
            for i, m in enumerate(mets)]
    return g.select(*out)


def empty_report(spark, spec: ReportSpec) -> DataFrame:
    """The declared schema with no rows (inactive report); no source is read."""
    return spark.createDataFrame([], spec.schema())
