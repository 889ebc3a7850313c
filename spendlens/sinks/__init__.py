"""Report sinks (catalog tables)."""

from .tables import conform, ensure_schema, quote_ident, replace_table, republish, versions_of

__all__ = ["conform", "ensure_schema", "quote_ident", "replace_table", "republish", "versions_of"]
