"""Increments by new files, with a ledger of loads.

An increment that reads every key of its target costs more the larger the
target grows.  Here a ledger table names the files that were loaded, so only
new ones are read; and the target is looked up only from the lowest ``mark``
(a time, a number, a key's first part) of the new rows on, which reaches its
scan as a filter and prunes its partitions and row groups.  Late rows lower
that bound by themselves: the window reaches back as far as they do, and they
are found.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sinks.publish import counted, remove_folder, table_exists
from tidewater.sinks.tables import append_table, new_rows

_FILE = ["path", "length", "modificationTime"]


def ledger_name(table: str) -> str:
    """The table that holds the loads of ``table``."""
    return f"{table}__loads"


def new_files(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """``path, length, modificationTime`` of the files of ``folder`` that
    were not loaded into ``table`` as they are now."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(*_FILE)
    if not table_exists(spark, ledger_name(table)):
        return listed
    return listed.join(spark.table(ledger_name(table)).select(*_FILE), _FILE, "left_anti")


def tail_of(target: DataFrame, mark: str, lowest: object) -> DataFrame:
    """The rows of ``target`` from ``lowest`` on (and those without a mark)."""
    return target.where((F.col(mark) >= F.lit(lowest)) | F.col(mark).isNull())


def load_new_files(spark: SparkSession, folder: str, read: Callable[[list[str]], DataFrame], table: str, cols: Sequence[str], keys: Sequence[str], mark: str, path: str | None = None) -> int:
    """Append the rows of new files whose key the target does not have;
    returns how many.

    ``read`` makes rows of a list of file names.  A key's ``mark`` must not
    change from one delivery to the next (an order's date, an event's time),
    since a key is looked for only from the lowest mark of the new rows on.
    The files are entered in the ledger after the rows are appended: a run
    that fails in between reads them again and finds their keys there."""
    # The names are what the read's own planning lists.
    fresh = new_files(spark, folder, table).collect()
    if not fresh:
        return 0
    work = scratch_path(spark, "new-files")
    read([r["path"] for r in fresh]).select(*cols).write.parquet(f"{work}/read")
    rows = spark.read.parquet(f"{work}/read")
    try:
        bounds = rows.agg(F.min(mark).alias("lowest"), F.count(F.when(F.col(mark).isNull(), 1)).alias("unmarked")).first()
        if table_exists(spark, table):
            target = spark.table(table)
            target = tail_of(target, mark, bounds["lowest"]) if bounds["lowest"] is not None else target.where(F.col(mark).isNull())
        else:
            target = rows.limit(0)
        add, seen = counted(new_rows(rows, target, keys))
        add.write.parquet(f"{work}/add")
        append_table(spark.read.schema(rows.schema).parquet(f"{work}/add"), table, list(cols), path)
        load = spark.createDataFrame(fresh, "path STRING, length BIGINT, modificationTime TIMESTAMP")
        entry = load.select("path", "length", "modificationTime", F.lit(bounds["lowest"]).cast("string").alias("lowest_mark"), F.lit(int(seen.get["rows"])).cast("bigint").alias("rows_of_load"))
        append_table(entry, ledger_name(table), path=f"{path}__loads" if path else None)
        return int(seen.get["rows"])
    finally:
        remove_folder(spark, work)
