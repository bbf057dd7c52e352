"""DuckDB statements that the Spark queries are checked against."""
