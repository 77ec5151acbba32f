"""Whole queries, the registry used by the driver, and the DuckDB oracles."""
