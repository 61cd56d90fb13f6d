"""Messages to and from topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators.nested import text_schema, to_nested_value, to_value
from tidewater.sinks.files import write_csv, write_text
from tidewater.sinks.topic import write_topic
from tidewater.streaming.batches import Output, drain_batches
from tidewater.streaming.drain import drain_to_table

# The loan message fields flattened to text, as
# (output column, JSON path).
LOAN_PATHS = (
    ("application_id", "$.application_id"),
    ("customer_id", "$.customer.customer_id"),
    ("region", "$.customer.region"),
    ("age", "$.customer.age"),
    ("income", "$.customer.income"),
    ("employment", "$.customer.employment"),
    ("loan_amount", "$.loan.amount"),
    ("term_months", "$.loan.term_months"),
    ("loan_purpose", "$.loan.purpose"),
    ("currency", "$.loan.currency"),
    ("score", "$.scoring.score"),
    ("risk_level", "$.scoring.risk_level"),
    ("pd", "$.scoring.pd"),
    ("lgd", "$.scoring.lgd"),
    ("decision_status", "$.decision_status"),
    ("submitted_at", "$.submitted_at"),
)


def message_values(df: DataFrame) -> DataFrame:
    """The payload as text (column keeps the name ``value``),
    NULL payloads dropped.  Works on batch and streaming frames."""
    return df.selectExpr("CAST(value AS STRING) AS value").where(F.col("value").isNotNull())


def _ddl(schema: StructType, top: bool = True) -> str:
    """DDL of an all-text layout (``a STRING, b STRUCT<c: STRING>``)."""
    sep = " " if top else ": "
    parts = []
    for f in schema.fields:
        kind = f"STRUCT<{_ddl(f.dataType, top=False)}>" if isinstance(f.dataType, StructType) else "STRING"
        parts.append(f"`{f.name}`{sep}{kind}")
    return ", ".join(parts)


def flat_sql(view: str, paths=LOAN_PATHS, keep: tuple[str, ...] = ()) -> str:
    """SQL text that flattens JSON ``value`` of ``view`` into text columns.

    Plain dotted paths are read from one ``from_json`` parse per message
    against an all-text layout (the same text ``get_json_object`` gives per
    path; of a repeated key the last value); other paths fall back to one ``get_json_object`` each."""
    kept = [f"`{k}`" for k in keep]
    schema = text_schema([path for _, path in paths])
    if schema is None:
        cols = kept + [f"get_json_object(value, '{path}') AS `{name}`" for name, path in paths]
        return f"SELECT {', '.join(cols)} FROM `{view}`"
    fields = []
    for name, path in paths:
        steps = ".".join(f"`{step}`" for step in path[2:].split("."))
        fields.append(f"`_doc`.{steps} AS `{name}`")
    inner = ", ".join(kept + [f"from_json(value, '{_ddl(schema)}', map('allowNonNumericNumbers', 'false')) AS `_doc`"])
    return f"SELECT {', '.join(kept + fields)} FROM (SELECT {inner} FROM `{view}`)"


def flat_messages(spark: SparkSession, df: DataFrame, view: str = "messages", paths=LOAN_PATHS, keep: tuple[str, ...] = ()) -> DataFrame:
    """M14 core: payloads through a named view, flattened with SQL."""
    df.createOrReplaceTempView(view)
    return spark.sql(flat_sql(view, paths, keep))


def stream_flat(spark: SparkSession, sdf: DataFrame, path: str, checkpoint: str, view: str = "received_messages", paths=LOAN_PATHS, timeout: float | None = None) -> DataFrame:
    """M15 core: drain the stream's payloads once (file sink with a
    checkpoint), then flatten the drained table with SQL."""
    drained = drain_to_table(message_values(sdf), view, path, checkpoint, timeout=timeout)
    return flat_messages(spark, drained, view=view, paths=paths)


def stream_text(sdf: DataFrame, path: str, checkpoint: str, out: str, view: str = "received_messages", mode: str = "error", timeout: float | None = None) -> DataFrame:
    """Drain payloads once, then write them as text lines to ``out``
    (fails if ``out`` exists unless ``mode`` says otherwise).  Returns the
    drained table."""
    drained = drain_to_table(message_values(sdf), view, path, checkpoint, timeout=timeout)
    write_text(drained.select("value"), out, mode=mode)
    return drained


def send_rows(df: DataFrame, options: dict[str, str]) -> None:
    """Each row as a JSON ``value``, written to a topic."""
    write_topic(to_value(df), options)


def send_nested(df: DataFrame, layout: Mapping[str, object], options: dict[str, str]) -> None:
    """Table rows shaped into nested JSON messages, written to a topic."""
    write_topic(to_nested_value(df, layout), options)


def run_messages_to_csv(spark: SparkSession, raw: DataFrame, out_path: str, paths=LOAN_PATHS, view: str = "loan_messages") -> DataFrame:
    """M14 end to end: a bounded read of messages (``raw`` has a ``value``
    column, e.g. from :func:`tidewater.sources.topic.read_topic`), payloads
    as text, NULLs dropped, flattened with SQL, written as CSV with a header
    (K2).  Returns the flat frame."""
    flat = flat_messages(spark, message_values(raw), view=view, paths=paths)
    write_csv(flat, out_path)
    return flat


def run_stream_to_csv(
    spark: SparkSession,
    sdf: DataFrame,
    out_path: str,
    drained_path: str,
    checkpoint: str,
    paths=LOAN_PATHS,
    view: str = "received_messages",
    timeout: float | None = None,
) -> DataFrame:
    """M15 end to end: drain the stream once; every batch is added to the
    drained table and, flattened with SQL, to the CSV files with a header
    (K2), once each.  A rerun adds only what is new.  Returns the drained
    table, flattened."""

    def flatten(batch: DataFrame) -> DataFrame:
        # The batch belongs to a session of its own, and so does its view.
        return flat_messages(batch.sparkSession, batch, view=f"{view}_batch", paths=paths)

    outputs = [Output(drained_path), Output(out_path, flatten, "csv", {"header": "true"})]
    values = message_values(sdf)
    drain_batches(values, outputs, checkpoint, timeout=timeout)
    return flat_messages(spark, spark.read.schema(values.schema).parquet(drained_path), view=view, paths=paths)


def run_stream_to_text(
    sdf: DataFrame,
    out_path: str,
    drained_path: str,
    checkpoint: str,
    mode: str = "error",
    view: str = "received_messages",
    timeout: float | None = None,
) -> DataFrame:
    """M16 end to end: drain the stream once and write the payloads as text
    lines to ``out_path`` (fails if it exists unless ``mode`` says otherwise,
    K3)."""
    return stream_text(sdf, drained_path, checkpoint, out_path, view=view, mode=mode, timeout=timeout)
