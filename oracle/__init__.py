"""Independent SQL for every deterministic query, written for DuckDB on the source tables."""
