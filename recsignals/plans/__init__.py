"""Registered queries: each binds operators to the test-table fixtures and
has (where SQL can express it) an independent DuckDB oracle."""
