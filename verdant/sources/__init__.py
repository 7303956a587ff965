"""Readers and writers."""

from verdant.sources.tables import TABLES, read_table

__all__ = ["TABLES", "read_table"]
