"""Checked queries: stand-in tables, the query registry and its SQL twins."""
