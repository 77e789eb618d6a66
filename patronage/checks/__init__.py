"""Independent DuckDB statements used to check the Spark results."""
