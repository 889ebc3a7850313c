import pytest
from pyspark.sql import types as T

from spendlens.spec import (ConversionSpec, ExternalTarget, FieldSpec, RegexFilter, ReportSpec,
                            SpecError, select_fields, spark_type)


def test_type_names_map_to_spark_types():
    assert spark_type("INT64") == T.LongType()
    assert spark_type("integer") == T.LongType()  # dialect alias of INT64, not Spark int
    assert spark_type("FLOAT64") == T.DoubleType()
    assert spark_type("NUMERIC") == T.DecimalType(38, 9)
    assert spark_type("STRING") == T.StringType()
    assert spark_type("BOOL") == T.BooleanType()
    assert spark_type("DATE") == T.DateType()
    assert spark_type("DATETIME") == T.TimestampNTZType()
    assert spark_type("TIMESTAMP") == T.TimestampType()
    assert spark_type("decimal(18, 2)") == T.DecimalType(18, 2)
    assert spark_type("double") == T.DoubleType()
    for bad in ("GEOGRAPHY", "", "decimal(40,2)", "STRUCT<a INT64>"):
        with pytest.raises(SpecError):
            spark_type(bad)


def test_default_then_active_keeps_first_occurrence():
    a = FieldSpec("a", "STRING", "x", default=True)
    b = FieldSpec("b", "STRING", "y", default=True, active=True)
    c = FieldSpec("c", "STRING", "z", active=True)
    d = FieldSpec("d", "STRING", "w")
    assert [f.name for f in select_fields([a, b, c, d], "default_then_active")] == ["a", "b", "c"]
    assert [f.name for f in select_fields([a, b, c, d], "all")] == ["a", "b", "c", "d"]


def test_two_different_fields_with_one_name_raise():
    a = FieldSpec("a", "STRING", "x", default=True)
    a2 = FieldSpec("a", "INT64", "y", active=True)
    with pytest.raises(SpecError):
        select_fields([a, a2], "default_then_active")


def _spec(**kw):
    base = dict(target="db.t", dimensions=(FieldSpec("d", "DATE", "date"),),
                metrics=(FieldSpec("m", "INT64", "sum(x)"),))
    base.update(kw)
    return ReportSpec(**base)


def test_validation_rules():
    with pytest.raises(SpecError):
        _spec(dimensions=())                       # at least one dimension
    with pytest.raises(SpecError):
        _spec(pivots=True)                         # pivots need conversions
    with pytest.raises(SpecError):
        _spec(conversions=(ConversionSpec("a", "x"), ConversionSpec("b", "x")))
    with pytest.raises(SpecError):
        _spec(metrics=(FieldSpec("d", "INT64", "sum(x)"),))  # clashes with dimension
    with pytest.raises(SpecError):
        _spec(metrics=(FieldSpec("D", "INT64", "sum(x)"),))  # names are case-insensitive
    with pytest.raises(SpecError):
        _spec(account_ids=(1.5,))
    with pytest.raises(SpecError):
        _spec(external=ExternalTarget(active=True))
    with pytest.raises(SpecError):
        _spec(regex_filters=(RegexFilter("d", None, True),))
    # an inactive spec is not validated: it only needs its declared schema
    s = _spec(dimensions=(), active=False)
    assert not s.is_active


def test_schema_has_comments_in_order():
    s = _spec(metrics=(FieldSpec("m", "INT64", "sum(x)"), FieldSpec("n", "NUMERIC", "sum(y)")))
    sch = s.schema()
    assert [f.name for f in sch.fields] == ["d", "m", "n"]
    assert sch["m"].metadata == {"comment": "[db_field_name = m]"}
    assert sch["n"].dataType == T.DecimalType(38, 9)
