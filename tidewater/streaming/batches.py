"""Micro-batches written once each, with a ledger.

``foreachBatch`` gives at-least-once: a batch whose commit was lost comes
again.  Here a batch is known by its query and its number.  Its files are
made in a work folder and then moved to their place under names that hold
both; the ledger entry comes last.  A batch that comes again after its entry
is passed over, one that comes again before it replaces its own files.  So a
replay adds nothing, and a second run with the same checkpoint reads and
writes only what is new.  Names that begin with ``_`` are not seen by readers
of the folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sinks.publish import counted

LEDGER = "_ledger"
WORK = "_work"


@dataclass
class Output:
    """One place every batch is written to, after ``change``."""

    path: str
    change: Callable[[DataFrame], DataFrame] | None = None
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    return top.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def write_batch(batch: DataFrame, query: str, number: int, out: Output) -> bool:
    """Write one batch to ``out`` unless the ledger has it; returns whether
    it was written."""
    spark = batch.sparkSession
    files, at = _files(spark, out.path)
    name = f"{query}-{number:09d}"
    entry = at(f"{out.path}/{LEDGER}/{name}")
    if files.exists(entry):
        return False
    if files.exists(at(f"{out.path}/_spark_metadata")):
        raise ValueError(f"{out.path} belongs to a file sink, whose readers would not see other files")
    rows, seen = counted(out.change(batch) if out.change else batch)
    work = f"{out.path}/{WORK}/{name}"
    rows.write.mode("overwrite").format(out.fmt).options(**out.options).save(work)
    old = [s.getPath() for s in files.listStatus(at(out.path)) if s.getPath().getName().startswith(f"{name}-")]
    for path in old:
        files.delete(path, False)
    made = [s.getPath() for s in files.listStatus(at(work)) if s.getPath().getName().startswith("part-")]
    for path in made:
        if not files.rename(path, at(f"{out.path}/{name}-{path.getName()}")):
            raise OSError(f"could not move {path}")
    files.mkdirs(entry.getParent())
    stream = files.create(entry, True)
    stream.write(bytearray(json.dumps({"query": query, "batch": number, "rows": int(seen.get["rows"]), "files": len(made)}).encode()))
    stream.close()
    files.delete(at(work), True)
    return True


def drain_batches(sdf: DataFrame, outputs: list[Output], checkpoint: str, timeout: float | None = None) -> list[int]:
    """Write what the source holds to every output, batch by batch, and stop;
    returns the numbers of the batches written now.

    A batch is read once for all outputs (it is kept until they are done).
    A failure of the stream is raised; ``timeout`` as for a file drain."""
    done: list[int] = []

    def one(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        held = batch.persist() if len(outputs) > 1 else batch
        try:
            if any([write_batch(held, query, number, out) for out in outputs]):
                done.append(number)
        finally:
            if len(outputs) > 1:
                held.unpersist()

    query = sdf.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        finished = query.awaitTermination(timeout)
    except StreamingQueryException as failed:
        raise RuntimeError(f"stream failed: {failed}") from failed
    if finished is False and query.isActive:
        query.stop()
        raise TimeoutError(f"stream not drained within {timeout} s; rerun to continue from the checkpoint")
    return done


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """``query, batch, rows, files`` of every batch written to ``path``."""
    schema = "query STRING, batch BIGINT, rows BIGINT, files BIGINT"
    files, at = _files(spark, path)
    if not files.exists(at(f"{path}/{LEDGER}")):
        return spark.createDataFrame([], schema)
    # Read by full names: names that begin with ``_`` are passed over.
    entries = [s.getPath().toString() for s in files.listStatus(at(f"{path}/{LEDGER}"))]
    return spark.createDataFrame([(t,) for t in _texts(spark, entries)], "text STRING").select(F.from_json("text", schema).alias("e")).select("e.*")


def _texts(spark: SparkSession, paths: list[str]) -> list[str]:
    out = []
    for path in paths:
        files, at = _files(spark, path)
        stream = files.open(at(path))
        out.append(bytes(stream.readAllBytes()).decode())
        stream.close()
    return out
