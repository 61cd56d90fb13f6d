"""Query catalogue over the driver tables, and its DuckDB oracle."""

from tidewater.catalog.oracle import ORACLE
from tidewater.catalog.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
