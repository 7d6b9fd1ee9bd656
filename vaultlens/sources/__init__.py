"""Readers and writers: CSV / Parquet / JSON messages, listings and byte ranges."""
