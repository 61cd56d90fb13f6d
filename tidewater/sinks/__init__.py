"""Sinks (K1-K18): files, catalog tables, topics."""

from tidewater.sinks import files, tables, topic

__all__ = ["files", "tables", "topic"]
