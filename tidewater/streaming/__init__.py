"""Structured Streaming drains."""

from tidewater.streaming.drain import drain_to_files, drain_to_table, file_stream

__all__ = ["drain_to_files", "drain_to_table", "file_stream"]
