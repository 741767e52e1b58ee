"""Readers and writers: parquet fixtures, CSV, tracking store."""
