"""Operator queries over the driver's tables, each with a DuckDB oracle."""
