"""Registered queries on the benchmark tables and their DuckDB oracle SQL."""
