"""Source tables: catalog or Parquet reads with an up-front column check."""

from .tables import Loader, MissingColumns, loader, read_table, require_columns

__all__ = ["Loader", "MissingColumns", "loader", "read_table", "require_columns"]
