"""Catalog table sinks and load modes.

Tables are Parquet data source tables.  On a cluster pass ``path`` on the
shared store to make them external (the data outlives a DROP).  Whole
replacements (K6, K8, K10, K12) are published as new versions
(:mod:`tidewater.sinks.publish`): one that fails leaves the old rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators.analytics import top_n
from tidewater.session import scratch_path
from tidewater.sinks.publish import layout, publish, replace_partitions, table_exists, table_writer


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back, so the
    target is touched only once its new rows are whole."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_external(df: DataFrame, table: str, path: str) -> int:
    """K6: external table under ``path``, its rows replaced as a whole.
    Returns the rows written."""
    return publish(df, table, path)


def create_if_absent(df: DataFrame, table: str, path: str | None = None) -> bool:
    """K7: create the table from ``df`` only if it does not exist (never
    refreshed).  Returns True when it was created."""
    if table_exists(df.sparkSession, table):
        return False
    table_writer(df, "ignore", path).saveAsTable(table)
    return True


def replace_table(df: DataFrame, table: str, path: str | None = None) -> int:
    """K8: the table anew from ``df``, with its columns; a rebuild that
    fails leaves the old table.  Returns the rows written."""
    return publish(df, table, path)


def append_table(
    df: DataFrame,
    table: str,
    cols: Sequence[str] | None = None,
    path: str | None = None,
    buckets: int | None = None,
    bucket_by: Sequence[str] | None = None,
) -> None:
    """K9: append rows (set-based; the table is created on first use,
    bucketed by ``bucket_by`` when ``buckets`` is given).  Columns go by
    name; ``cols`` picks them.  A column that the table lacks, or one of the
    table's that the rows lack, raises."""
    if cols:
        df = df.select(*cols)
    if buckets and bucket_by:
        df = df.repartition(buckets, *bucket_by)
    if table_exists(df.sparkSession, table):
        _append_by_name(df, table)
    else:
        table_writer(df, "append", path, buckets, bucket_by).saveAsTable(table)


def _append_by_name(df: DataFrame, table: str) -> None:
    target = df.sparkSession.table(table).columns
    have, known = {c.lower() for c in df.columns}, {c.lower() for c in target}
    if have != known:
        raise ValueError(f"columns do not match {table}: not in the table {sorted(have - known)}, not in the rows {sorted(known - have)}")
    df.select(*[f"`{c}`" for c in target]).write.mode("append").insertInto(table)


def full_refresh(
    df: DataFrame,
    table: str,
    cols: Sequence[str],
    path: str | None = None,
    buckets: int | None = None,
    bucket_by: Sequence[str] | None = None,
) -> int:
    """``df``'s ``cols`` in place of all the table's rows (on a JDBC
    target use :func:`jdbc_options` with ``truncate=True``).  With
    ``buckets`` the table is bucketed by ``bucket_by``.  A load that fails
    leaves the old rows.  Returns the rows written."""
    return publish(df.select(*cols), table, path, buckets, bucket_by)


def new_rows(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not yet in ``target`` (``left_anti``; a
    NULL key part equals NULL), one for each key: of several
    rows with one new key, the first by a hash of the row."""
    keys = list(keys)
    odd = F.lit(False)
    for k in keys:
        odd = odd | F.col(k).isNull()
    # Whole keys meet by equality, so a bucketed target is read without a
    # shuffle; the few with a NULL part meet the target's by a null-safe test.
    rows = df.where(~odd).join(target.select(*keys), keys, "left_anti").select(*df.columns)
    held = target.where(odd).select(*[F.col(k).alias(f"_t_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    rows = rows.unionByName(df.where(odd).join(held, same, "left_anti"))
    return top_n(rows, keys, [F.xxhash64(*[F.col(c) for c in df.columns])], 1)


def append_incremental(
    df: DataFrame,
    table: str,
    cols: Sequence[str],
    keys: Sequence[str] | None = None,
    path: str | None = None,
    buckets: int | None = None,
) -> None:
    """Append without truncating.  Without ``keys`` rows are appended as
    they are (a rerun repeats them); with ``keys`` only rows whose key is new
    are appended, one for each key (NULL counts as a key value), so a rerun
    adds nothing.

    The new rows are staged to the shared scratch folder before the
    append, because the append changes the very table the anti-join reads.
    A target bucketed by ``keys`` (``buckets``, set when the table is made)
    is read for the anti join without a shuffle: only the incoming rows
    move, however large the target grows.
    """
    spark = df.sparkSession
    df = df.select(*cols)
    if keys and table_exists(spark, table):
        df = _staged(new_rows(df, spark.table(table), keys), "new-rows")
    elif keys:
        df = top_n(df, list(keys), [F.xxhash64(*[F.col(c) for c in df.columns])], 1)
    append_table(df, table, None, path, buckets, keys)


def load(
    df: DataFrame,
    table: str,
    cols: Sequence[str],
    mode: str = "auto",
    keys: Sequence[str] | None = None,
    path: str | None = None,
    buckets: int | None = None,
) -> str:
    """M5: pick the load.  ``auto`` runs a full refresh when the target is
    absent or empty and an incremental append otherwise.  With ``keys`` and
    ``buckets`` the target is bucketed by the keys when it is (re)made, so
    later incremental runs do not shuffle it.  Returns the mode used
    ("full" or "incremental")."""
    spark = df.sparkSession
    if mode == "auto":
        mode = "full" if (not table_exists(spark, table) or spark.table(table).isEmpty()) else "incremental"
    if mode == "full":
        full_refresh(df, table, cols, path, buckets, keys)
    elif mode == "incremental":
        append_incremental(df, table, cols, keys, path, buckets)
    else:
        raise ValueError(f"unknown load mode {mode!r}")
    return mode


def replicate(df: DataFrame, table: str, types: Mapping[str, str] | None = None, path: str | None = None) -> int:
    """Cast columns by a type map, then replace the table's rows;
    returns how many there are.

    A table that is there keeps its definition (columns, types, partitions,
    buckets): the rows are cast to its columns, a column the rows lack is
    NULL, one the table lacks raises.  The new rows are published as a
    whole, those of a partitioned table partition by partition, so a source
    that fails leaves the old rows in place.  A table that is not there is
    made from the rows."""
    if types:
        df = df.select(*[(F.col(c).cast(types[c]) if c in types else F.col(c)).alias(c) for c in df.columns])
    spark = df.sparkSession
    if not table_exists(spark, table):
        return publish(df, table, path)
    target = spark.table(table).schema
    have = {c.lower(): c for c in df.columns}
    unknown = sorted(set(have) - {f.name.lower() for f in target})
    if unknown:
        raise ValueError(f"columns not declared in {table}: {unknown}")
    typed = [(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
    held = layout(spark, table)
    if held.partitions:
        return replace_partitions(df.select(*typed), table, drop_others=True)
    buckets = int(held.buckets) if held.buckets else None
    by = [c.strip("`[] ") for c in held.bucket_columns.split(",")] if buckets else None
    return publish(df.select(*typed), table, path if held.external else None, buckets, by)


def create_tables(spark: SparkSession, schemas: Mapping[str, StructType | str], location: str | None = None, replace: bool = True, partitions: Mapping[str, str] | None = None) -> None:
    """(re)create empty tables with the given schemas.  ``replace=False``
    keeps tables that already exist (CREATE TABLE IF NOT EXISTS).
    ``partitions`` names the partition column of a table, by table."""
    for name, schema in schemas.items():
        ddl = schema if isinstance(schema, str) else schema.toDDL()
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        where = f" LOCATION '{location}/{name}'" if location else ""
        by = f" PARTITIONED BY ({partitions[name]})" if partitions and name in partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{by}{where}")


def skip_if_empty(df: DataFrame) -> bool:
    """True when ``df`` has no rows (reads at most one row)."""
    return df.isEmpty()


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None, truncate: bool = False, cascade: bool = False, batch_size: int = 10000) -> dict[str, str]:
    """Options for a JDBC sink: set-based batched inserts; ``truncate`` keeps
    the table definition on overwrite, ``cascade`` truncates dependants."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if truncate:
        opts["truncate"] = "true"
    if cascade:
        opts["cascadeTruncate"] = "true"
    return opts


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "append") -> None:
    """Write to a JDBC table (needs the driver jar on the classpath)."""
    df.write.format("jdbc").options(**options).mode(mode).save()


def replicate_jdbc(df: DataFrame, options: Mapping[str, str], types: Mapping[str, str] | None = None, cascade: bool = False) -> None:
    """K12 on a relational target: cast columns by ``types``, then empty the
    table and load the rows.  The table is truncated, not dropped, so the
    definition the database holds (types, keys) stays; ``cascade`` also
    empties tables that reference it, where the database supports that.
    Rows are written by every task in parallel, in batches."""
    if types:
        df = df.select(*[(F.col(c).cast(types[c]) if c in types else F.col(c)).alias(c) for c in df.columns])
    opts = dict(options)
    opts["truncate"] = "true"
    if cascade:
        opts["cascadeTruncate"] = "true"
    write_jdbc(df, opts, mode="overwrite")
