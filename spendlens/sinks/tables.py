"""Writing reports: replace a table, create a schema, republish a copy."""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shape import empty_report
from ..spec import ExternalTarget, ReportSpec


def quote_ident(name: str) -> str:
    """Quote a (possibly dotted) identifier: ``a.b`` -> ```a`.`b```."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def quote_str(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def conform(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """Project ``df`` onto the declared schema: order, types and column comments."""
    cols = []
    for f in spec.schema().fields:
        cols.append(F.col(quote_ident(f.name)).cast(f.dataType).alias(f.name, metadata=f.metadata))
    return df.select(*cols)


#: How long a replaced version stays readable for queries that have already begun.
KEEP_SECONDS = 24 * 3600
_VERSION = re.compile(r"__v(\d{13})_[0-9a-f]{8}$")


def replace_table(df: DataFrame, name: str, spec: ReportSpec | None = None,
                  fmt: str | None = None, via_staging: bool = False,
                  keep_seconds: float = KEEP_SECONDS) -> None:
    """``CREATE OR REPLACE TABLE name (...declared columns...) AS <df>``.

    The write is the Spark action that runs the whole report plan, once. On a catalog with
    v2 tables (e.g. Delta or Iceberg) it is an atomic ``createOrReplace``, as the source's
    statement is. Spark's session catalog does not support that for its file tables; there
    the result is written to a version table of its own, never changed afterwards, and
    ``name`` is a view that ``CREATE OR REPLACE VIEW`` switches to it in one catalog
    operation: a reader finds the old rows or the new ones, at every moment. A report that
    fails leaves the view as it was, and ``df`` may read what it replaces. Versions that
    were replaced ``keep_seconds`` ago are dropped by a later run. A plain table of that
    name becomes the first version (by renaming, the one moment without a ``name``).
    ``fmt`` picks the table provider (default: the catalog's); ``via_staging`` forces the
    versioned route.
    """
    out = conform(df, spec) if spec is not None else df
    if not via_staging and not _is_view(df.sparkSession, name):
        writer = out.writeTo(name)
        if fmt:
            writer = writer.using(fmt)
        try:
            writer.createOrReplace()
            return
        except Exception as e:  # noqa: BLE001 - only "not supported here" falls through
            if _condition(e) not in ("UNSUPPORTED_FEATURE.TABLE_OPERATION", "UNSUPPORTED_OVERWRITE.TABLE"):
                raise
    _publish_version(out, name, fmt, keep_seconds)


def _condition(e: Exception) -> str | None:
    return getattr(e, "getCondition", getattr(e, "getErrorClass", lambda: None))()


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def _version_name(name: str, millis: int) -> str:
    return f"{name}__v{millis:013d}_{uuid.uuid4().hex[:8]}"


def _publish_version(df: DataFrame, name: str, fmt: str | None, keep_seconds: float) -> None:
    spark = df.sparkSession
    now = time.time_ns() // 1_000_000
    version = _version_name(name, now)
    writer = df.write.mode("errorifexists")
    try:
        (writer.format(fmt) if fmt else writer).saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {quote_ident(version)}")
        raise
    if spark.catalog.tableExists(name) and not _is_view(spark, name):
        spark.sql(f"ALTER TABLE {quote_ident(name)} RENAME TO {quote_ident(_version_name(name, now - 1))}")
    columns = []
    for f in df.schema.fields:
        comment = (f.metadata or {}).get("comment")
        columns.append("`" + f.name.replace("`", "``") + "`" + (f" COMMENT {quote_str(comment)}" if comment else ""))
    spark.sql(f"CREATE OR REPLACE VIEW {quote_ident(name)} ({', '.join(columns)}) AS SELECT * FROM {quote_ident(version)}")
    _drop_versions(spark, name, version, keep_seconds)


def versions_of(spark: SparkSession, name: str) -> list[str]:
    """The version tables behind a published view, oldest first."""
    database, _, table = name.rpartition(".")
    where = f" IN {quote_ident(database)}" if database else ""
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES{where} LIKE {quote_str(table + '__v*')}").collect()]
    own = [t for t in found if (m := _VERSION.search(t)) and t[:m.start()].lower() == table.lower()]
    return [f"{database}.{t}" if database else t for t in sorted(own, key=lambda t: t[-23:])]


def _drop_versions(spark: SparkSession, name: str, current: str, keep_seconds: float) -> None:
    """Drop the versions that were replaced at least ``keep_seconds`` ago."""
    every = versions_of(spark, name)
    for old, new in zip(every, every[1:]):
        replaced = int(_VERSION.search(new)[1]) / 1000
        if old.lower() != current.lower() and replaced + keep_seconds <= time.time():
            spark.sql(f"DROP TABLE IF EXISTS {quote_ident(old)}")


def ensure_schema(spark: SparkSession, database: str, description: str = "",
                  friendly_name: str = "", location: str = "") -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` with a comment and descriptive properties.

    The source's ``location`` is a placement region, not a path, so it is kept as the
    property ``data_location`` rather than as the schema's storage location.
    """
    props = {"friendly_name": friendly_name, "data_location": location}
    prop_sql = ", ".join(f"{quote_str(k)}={quote_str(v)}" for k, v in props.items() if v)
    sql = f"CREATE SCHEMA IF NOT EXISTS {quote_ident(database)}"
    if description:
        sql += f" COMMENT {quote_str(description)}"
    if prop_sql:
        sql += f" WITH DBPROPERTIES ({prop_sql})"
    spark.sql(sql)


def table_name(target: str) -> str:
    return target.split(".")[-1]


def republish(spark: SparkSession, spec: ReportSpec, external: ExternalTarget | None = None
              ) -> str | None:
    """Copy the stored report to the external database (never recomputes it).

    Creates the schema if absent, then replaces ``<database>.<table>`` with
    ``SELECT * FROM <target>`` when the report is active, or with an empty typed table
    when it is not. Returns the written name, or ``None`` when the target is inactive.
    """
    ext = external or spec.external
    if not ext.active:
        return None
    ensure_schema(spark, ext.database, ext.description, ext.friendly_name, ext.location)
    dst = f"{ext.database}.{table_name(spec.target)}"
    src = spark.table(spec.target) if spec.is_active else empty_report(spark, spec)
    replace_table(src, dst, spec)
    return dst
