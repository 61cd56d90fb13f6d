"""Topic (Kafka) sources: option builders plus the batch and stream reads
(S6, S7, S8, T5).

The Kafka connector jar must be on the classpath for ``format("kafka")``.
Credentials always come from the caller (configuration or a secret store),
never from code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The login module and the security settings the jobs use.
SCRAM_LOGIN_MODULE = "org.apache.kafka.common.security.scram.ScramLoginModule"
DEFAULT_PROTOCOL = "SASL_SSL"
DEFAULT_MECHANISM = "SCRAM-SHA-512"


def topic_security(
    user: str,
    secret: str,
    protocol: str = DEFAULT_PROTOCOL,
    mechanism: str = DEFAULT_MECHANISM,
) -> dict[str, str]:
    """SASL options for a source or sink."""
    jaas = f'{SCRAM_LOGIN_MODULE} required username="{user}" password="{secret}";'
    return {
        "kafka.security.protocol": protocol,
        "kafka.sasl.mechanism": mechanism,
        "kafka.sasl.jaas.config": jaas,
    }


def topic_options(
    servers: str,
    topic: str,
    security: dict[str, str] | None = None,
    starting: str | None = "earliest",
    subscribe: bool = True,
    max_offsets_per_batch: int | None = None,
) -> dict[str, str]:
    """Options for a topic read (``subscribe``) or write (``topic``).

    T5: reads start at ``starting`` ("earliest" by default).  For a stream
    drain, ``max_offsets_per_batch`` caps each micro-batch, so a large
    backlog is taken in bounded, separately checkpointed batches.
    """
    opts = {"kafka.bootstrap.servers": servers}
    if subscribe:
        opts["subscribe"] = topic
        if starting is not None:
            opts["startingOffsets"] = starting
        if max_offsets_per_batch:
            opts["maxOffsetsPerTrigger"] = str(max_offsets_per_batch)
    else:
        opts["topic"] = topic
    opts.update(security or {})
    return opts


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Bounded read of a topic, from the start offset to the latest
    offset at the time the query starts."""
    return spark.read.format("kafka").options(**options).load()


def stream_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A topic as a streaming DataFrame."""
    return spark.readStream.format("kafka").options(**options).load()
