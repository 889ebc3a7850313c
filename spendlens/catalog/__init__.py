"""Registered queries over the driver's test tables, their DuckDB oracles and stand-ins."""
