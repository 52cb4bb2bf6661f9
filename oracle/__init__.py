"""Independent SQL for every registered query, run by DuckDB over the same Parquet tables."""
