"""Independent SQL oracle (DuckDB dialect) for every registered query."""
