"""Pipelines (P1-P5), registered queries and their DuckDB oracle SQL."""
