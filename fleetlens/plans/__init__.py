"""Whole-warehouse plans, the query registry and the DuckDB oracle SQL."""
