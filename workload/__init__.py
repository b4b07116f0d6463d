"""Operators bound to the driver tables, each with its DuckDB equivalent."""
