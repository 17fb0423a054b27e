"""Readers: base Parquet tables, catalog tables by computed name, and the
derived input relations the campaign operators consume."""

from tidemark.sources.tables import read_table, read_parquet, campaign_table, TABLES
from tidemark.sources import relations

__all__ = ["read_table", "read_parquet", "campaign_table", "TABLES", "relations"]
