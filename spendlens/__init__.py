"""spendlens: paid-media performance reports built as Spark DataFrame plans."""

__version__ = "0.1.0"

from .spec import (ConversionSpec, ExternalTarget, FieldSpec, RegexFilter, ReportSpec,
                   SpecError, fields, spark_type)

__all__ = ["ConversionSpec", "ExternalTarget", "FieldSpec", "RegexFilter", "ReportSpec",
           "SpecError", "fields", "spark_type"]
