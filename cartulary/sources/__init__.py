"""File layouts, delimited input and parquet tables."""
