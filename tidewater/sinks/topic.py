"""Topic sink (K4).  Needs the Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_topic(df: DataFrame, options: dict[str, str]) -> None:
    """K4: write the ``value`` column (plus ``key`` if present) to a topic;
    ``options`` from :func:`tidewater.sources.topic.topic_options` with
    ``subscribe=False``."""
    cols = [c for c in ("key", "value", "headers", "partition") if c in df.columns]
    df.select(*cols).write.format("kafka").options(**options).save()
