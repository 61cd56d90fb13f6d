"""Publishing a table as a whole: a new version beside the old one (K6, K8,
K10, K12).

The new rows are written to a folder of their own, as a table of their own.
Only when that is complete (and passes the caller's check) does the target
change: its location is pointed at the new folder, one catalog operation.  A
source or a write that fails, or a lost driver, leaves the old rows readable.
A target whose columns, buckets or partitions change cannot be repointed: the
new table takes its name instead, by catalog renames that are taken back if
one fails.  (A table at ``path`` stays external; another one is managed.)

The version that was replaced stays until the next publication, for readers
that are still at it, and is removed then.  A table at ``path`` is external,
its versions are folders ``path/v_...``; versions of other tables lie beside
their folder in the database.

Rows are counted while they are written (``DataFrame.observe``), not by
reading the table again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Table property that names the version replaced last.
PREVIOUS = "tidewater.previous"


@dataclass(frozen=True)
class Layout:
    """What the catalog says of a table."""

    columns: tuple[tuple[str, str], ...]
    partitions: tuple[str, ...]
    buckets: str
    bucket_columns: str
    location: str
    external: bool

    def same_as(self, other: Layout) -> bool:
        own, others = ((x.columns, x.partitions, x.buckets, x.bucket_columns) for x in (self, other))
        return own == others


def layout(spark: SparkSession, table: str) -> Layout:
    """Columns, partitions, buckets and place of a catalog table."""
    schema = spark.table(table).schema
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    parted = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    columns = tuple((f.name, f.dataType.simpleString()) for f in schema)
    return Layout(columns, parted, detail.get("Num Buckets", ""), detail.get("Bucket Columns", ""), detail["Location"], detail["Type"] == "EXTERNAL")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def versioned_path(path: str) -> str:
    """A new folder under ``path`` for one version of a table."""
    return f"{path.rstrip('/')}/v_{uuid.uuid4().hex[:12]}"


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted by whatever action reads it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def table_writer(df: DataFrame, mode: str, path: str | None = None, buckets: int | None = None, bucket_by: Sequence[str] | None = None, partition_by: Sequence[str] | None = None):
    """A Parquet table writer; rows of a bucket meet in one task, which
    writes one file for it."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets and bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by)
    return writer


def publish(
    df: DataFrame,
    table: str,
    path: str | None = None,
    buckets: int | None = None,
    bucket_by: Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> int:
    """Make ``df`` the rows of ``table``; returns how many there are.

    ``df`` may read the table itself.  ``check`` gets the written rows and
    raises to keep the old ones."""
    spark = df.sparkSession
    old = layout(spark, table) if table_exists(spark, table) else None
    *database, name = table.split(".")
    new = ".".join([*database, f"{name}__{uuid.uuid4().hex[:12]}"])
    if path or (old and old.external):
        place = versioned_path(path or _root(old.location))
    elif old:
        place = f"{old.location.rstrip('/').rpartition('/')[0]}/{name}__v_{uuid.uuid4().hex[:12]}"
    else:
        place = None
    if buckets and bucket_by:
        df = df.repartition(buckets, *bucket_by)
    rows, seen = counted(df)
    try:
        table_writer(rows, "error", place, buckets, bucket_by, partition_by).saveAsTable(new)
        if check is not None:
            check(spark.table(new))
        _switch(spark, table, old, new, place)
    except BaseException:
        if not (place and table_exists(spark, table) and _same(layout(spark, table).location, place)):
            spark.sql(f"DROP TABLE IF EXISTS {new}")
            remove_folder(spark, place or _own_folder(spark, new))
        raise
    return int(seen.get["rows"])


def _switch(spark: SparkSession, table: str, old: Layout | None, new: str, place: str | None) -> None:
    if old is None:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        return
    before = _property(spark, table)
    made = layout(spark, new)
    if old.same_as(made) and not old.partitions:
        # Prepared first, so that the switch itself is one operation.
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{old.location}')")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
        spark.sql(f"DROP TABLE {new}")
    elif old.external:
        aside = f"{new}_old"
        spark.sql(f"ALTER TABLE {new} SET TBLPROPERTIES ('{PREVIOUS}' = '{old.location}')")
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        except BaseException:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
            raise
        spark.sql(f"DROP TABLE {aside}")
    else:
        # A managed table owns its folder, which a rename may move: it goes,
        # files and all, once the new one is whole.
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    if before and not _same(before, old.location) and not _same(before, place):
        remove_folder(spark, before)


def _property(spark: SparkSession, table: str) -> str | None:
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return held.get(PREVIOUS)


def _root(location: str) -> str:
    """The folder that holds the versions of a table."""
    head, _, last = location.rstrip("/").rpartition("/")
    return head if last.startswith("v_") else location.rstrip("/")


def _own_folder(spark: SparkSession, table: str) -> str:
    """Where a managed table of this name has its files."""
    *database, name = table.split(".")
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE {database[-1] if database else spark.catalog.currentDatabase()}").collect()}
    return f"{about['Location'].rstrip('/')}/{name.lower()}"


def _same(a: str, b: str) -> bool:
    return a.split(":", 1)[-1].strip("/") == b.split(":", 1)[-1].strip("/")


def remove_folder(spark: SparkSession, location: str) -> None:
    """Remove one version's files: a version folder whole, any other folder
    without the versions that lie in it."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(location)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(top):
        return
    inside = list(files.listStatus(top))
    if any(s.getPath().getName().startswith("v_") for s in inside):
        for s in inside:
            if not s.getPath().getName().startswith("v_"):
                files.delete(s.getPath(), True)
    else:
        files.delete(top, True)


def replace_partitions(df: DataFrame, table: str, drop_others: bool = False) -> int:
    """K13 with K12: only the partitions that ``df`` has rows for are
    replaced; the files of the others are not touched.

    The rows are staged first, so a source that fails changes nothing, and
    Spark moves a partition in place only when all its files are written.
    With ``drop_others`` partitions without rows in ``df`` go, after the new
    ones are in place."""
    from tidewater.session import scratch_path

    spark = df.sparkSession
    columns = spark.table(table).columns
    parted = layout(spark, table).partitions
    if not parted:
        raise ValueError(f"{table} has no partitions")
    rows, seen = counted(df.select(*[f"`{c}`" for c in columns]))
    path = scratch_path(spark, "partitions")
    try:
        # Rows of a partition lie together, so each is a file or two.
        rows.write.partitionBy(*parted).parquet(path)
        # A session of its own, since the mode is a setting of the session.
        own = spark.newSession()
        own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        held = own.read.schema(spark.table(table).schema).parquet(path).select(*[f"`{c}`" for c in columns])
        held.write.mode("overwrite").insertInto(table if "." in table else f"{spark.catalog.currentDatabase()}.{table}")
        spark.catalog.refreshTable(table)
        if drop_others:
            kept = {tuple(r) for r in held.select(*parted).distinct().collect()}
            for r in spark.table(table).select(*parted).distinct().collect():
                if tuple(r) not in kept:
                    parts = ", ".join(f"{c} = {'NULL' if v is None else repr(str(v))}" for c, v in zip(parted, r, strict=True))
                    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({parts})")
    finally:
        remove_folder(spark, path)
    return int(seen.get["rows"])
