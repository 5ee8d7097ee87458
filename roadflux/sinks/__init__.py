"""Writers: Parquet zones, catalog, serving tables, messages."""
