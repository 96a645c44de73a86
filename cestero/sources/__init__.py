"""Readers of receipts, products and categories."""

from cestero.sources.delimited import DelimitedSource, read_delimited
from cestero.sources.ingest import ingest
from cestero.sources.jdbc import JdbcSource
from cestero.sources.select import open_source

__all__ = ["DelimitedSource", "JdbcSource", "ingest", "open_source", "read_delimited"]
