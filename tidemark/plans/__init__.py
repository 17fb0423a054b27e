"""Registered query plans (what ``__spark_entry__`` exposes) and their
independent DuckDB oracles."""
