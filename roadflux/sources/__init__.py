"""Readers: raw lines, Parquet zones, catalog tables, streams, dimensions."""
