"""Fixtures over the supplied tables, the query registry and its SQL oracles."""
