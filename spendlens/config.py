"""Build a ``ReportSpec`` from a nested ``vars`` mapping (the source reports' configuration).

Users of the source reports keep their settings in one nested variables mapping, usually
loaded from YAML or JSON. ``spec_from_vars`` reads the same keys. Field expressions are run
as Spark SQL, so those written in another dialect must be rewritten; nothing translates them:

    vars[<service>]: account_ids, active, source_dataset_id, conversions,
                     regexp_filters, actions, action_values, pivots,
                     models[<model>]: dimensions, metrics, active, table_id,
                                      stitch, history_order, history_tiebreak
    vars: output_dataset_id, timezone,
          external_project: active, project_id,
                            schema_settings: location, description, friendly_name

Truthiness follows the template language the settings were written for: only a missing
value (None) and ``False`` are false. Fields are picked where ``default`` or ``active``
*equals* true, as the templates filter them.
"""

from __future__ import annotations

from datetime import datetime
from typing import Any, Mapping

from .spec import (SELECT_ALL, SELECT_DEFAULT_THEN_ACTIVE, ConversionSpec, ExternalTarget,
                   FieldSpec, RegexFilter, ReportSpec, SpecError)

# report kinds whose fields are picked as default-then-active; the others take all fields
DEFAULT_THEN_ACTIVE_KINDS = ("campaign", "multi_fact")
# report kinds that copy their result to the external project (the global external-project
# settings do not make the other kinds copy theirs)
REPUBLISH_KINDS = ("campaign", "multi_fact")
# settings that only some report kinds read
REGEX_KINDS = ("platform",)
ACTION_KINDS = ("platform",)
PIVOT_KINDS = ("ad_group", "keyword")
CONVERSION_KINDS = ACTION_KINDS + PIVOT_KINDS


def truthy(value: Any) -> bool:
    return value is not None and value is not False


def _bool_text(value: Any) -> bool:
    if isinstance(value, str):
        low = value.strip().lower()
        if low in ("true", "false"):
            return low == "true"
    return truthy(value)


def _fields(items) -> tuple[FieldSpec, ...]:
    out = []
    for d in items or ():
        try:
            out.append(FieldSpec(name=d["name"], type=d["type"], expression=d["expression"],
                                 default=d.get("default") is True, active=d.get("active") is True))
        except KeyError as e:
            raise SpecError(f"field {d!r} lacks {e}") from e
    return tuple(out)


def spec_from_vars(vars_: Mapping, service: str, model: str, kind: str,
                   run_ts: datetime | None = None, **overrides) -> ReportSpec:
    """The spec of report ``model`` of ``service``; ``kind`` names the report builder
    (``platform``, ``campaign``, ``ad_group``, ``keyword`` or ``multi_fact``)."""
    svc = vars_.get(service) or {}
    mdl = (svc.get("models") or {}).get(model) or {}
    dataset = vars_.get("output_dataset_id") or ""
    table_id = mdl.get("table_id") or model
    regex = svc.get("regexp_filters")
    filters = ()
    if kind in REGEX_KINDS and truthy(regex) and regex != "" and regex != []:
        filters = tuple(RegexFilter(f["dimension"], f["expression"],
                                    _bool_text(f.get("result", True))) for f in regex)
    ext = vars_.get("external_project") or {}
    settings = ext.get("schema_settings") or {}
    project = ext.get("project_id") or ""
    external = ExternalTarget(
        active=truthy(ext.get("active")) and kind in REPUBLISH_KINDS,
        database=f"{project}.{dataset}" if project else dataset,
        location=settings.get("location") or "",
        description=settings.get("description") or "",
        friendly_name=settings.get("friendly_name") or "")
    fields = dict(
        target=f"{dataset}.{table_id}" if dataset else table_id,
        source=svc.get("source_dataset_id") or "",
        selection=(SELECT_DEFAULT_THEN_ACTIVE if kind in DEFAULT_THEN_ACTIVE_KINDS
                   else SELECT_ALL),
        dimensions=_fields(mdl.get("dimensions")),
        metrics=_fields(mdl.get("metrics")),
        active=truthy(svc.get("active")),
        table_active=truthy(mdl.get("active")),
        account_ids=tuple(svc.get("account_ids") or ()),
        conversions=tuple(ConversionSpec(c["event_name"], c["output_name"])
                          for c in (svc.get("conversions") or ()
                                    if kind in CONVERSION_KINDS else ())),
        regex_filters=filters,
        actions=truthy(svc.get("actions")) and kind in ACTION_KINDS,
        action_values=truthy(svc.get("action_values")) and kind in ACTION_KINDS,
        pivots=truthy(svc.get("pivots")) and kind in PIVOT_KINDS,
        timezone=vars_.get("timezone") or "UTC",
        run_ts=run_ts,
        external=external,
    )
    for name in ("stitch", "history_order", "history_tiebreak", "factorise", "unique_ids"):
        if mdl.get(name) is not None:
            value = mdl[name]
            if name == "factorise":
                value = _bool_text(value)
            fields[name] = (value,) if name in ("history_tiebreak", "unique_ids") and isinstance(value, str) else value
    fields.update(overrides)
    return ReportSpec(**fields)
