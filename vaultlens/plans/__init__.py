"""Registered jobs, bindings onto the driver tables, and their DuckDB oracles."""
