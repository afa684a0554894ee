"""The reporting data sets, the daily load, target schemas, the query
registry and the DuckDB oracle."""
