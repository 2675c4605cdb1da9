"""Oracle SQL for the correctness gate (DuckDB dialect)."""
