"""Independent SQL statements of every query, for DuckDB on the same tables."""
