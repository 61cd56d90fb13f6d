"""Scans and sources."""

from tidewater.sources.files import (
    preview,
    read_collection,
    read_csv,
    read_csv_by_name,
    read_parquet,
    read_table,
    register,
    rejected_csv,
    rejected_documents,
    rows,
    sql,
)
from tidewater.sources.jdbc import read_jdbc, read_jdbc_split
from tidewater.sources.topic import read_topic, stream_topic, topic_options, topic_security

__all__ = [
    "preview",
    "read_collection",
    "read_csv",
    "read_csv_by_name",
    "read_jdbc",
    "read_jdbc_split",
    "read_parquet",
    "read_table",
    "register",
    "rejected_csv",
    "rejected_documents",
    "rows",
    "sql",
    "read_topic",
    "stream_topic",
    "topic_options",
    "topic_security",
]
