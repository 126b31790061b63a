"""Registered queries, their DuckDB oracles and plan inspection helpers."""
