"""Oracles: the registered queries as SQL for DuckDB, for comparison only."""
