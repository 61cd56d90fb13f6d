"""Relational table scans over JDBC.

A plain JDBC read is one query on one connection, read by one task.  Give a
numeric, date or timestamp ``partition_column`` with its bounds and the read
is split into ``num_partitions`` range queries that run in parallel (the
bounds only decide the split points; rows outside them are still read, by
the first and last range).  Filters and the selected columns are pushed into
the generated SQL by Spark.  The driver jar must be on the classpath.

Equal ranges of a skewed column are unequal parts.  :func:`read_jdbc_split`
asks the database for the column's quantiles first, so every part has about
as many rows, whatever the values; it takes texts as well.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
) -> DataFrame:
    """A table (``dbtable``) or a query (``query``) read over JDBC;
    ``options`` as built by :func:`tidewater.sinks.tables.jdbc_options`."""
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", str(fetch_size))
    if partition_column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("a partitioned read needs lower, upper and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def sql_literal(value: object) -> str:
    """A value as SQL text, in the form all databases read."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"no split at {value!r}")
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"'{value.isoformat(' ')}'"
    if isinstance(value, dt.date):
        return f"'{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def quoted(url: str, name: str) -> str:
    """A column's name as the database writes it."""
    sign = "`" if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else '"'
    return sign + name.replace(sign, sign * 2) + sign


def split_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """Conditions that hold for every row exactly once: up to the first
    bound (rows without a value too), between bounds, from the last on."""
    cuts = [sql_literal(b) for b in dict.fromkeys(bounds)]
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, f"{column} >= {cuts[-1]}"]


def quantile_queries(url: str, table: str, column: str, rows: int, parts: int) -> list[str]:
    """SQL for the ``parts - 1`` values that cut ``rows`` values of a column
    into equal parts: one pass where the database has ordered-set
    aggregates, else one look at the ordered column for each value."""
    if url.startswith("jdbc:postgresql:"):
        shares = ", ".join(repr(i / parts) for i in range(1, parts))
        return [f"SELECT unnest(percentile_disc(ARRAY[{shares}]) WITHIN GROUP (ORDER BY {column})) AS cut FROM {table}"]
    places = sorted({i * rows // parts for i in range(1, parts)} - {0})
    return [f"SELECT {column} AS cut FROM {table} WHERE {column} IS NOT NULL ORDER BY {column} OFFSET {p} ROWS FETCH NEXT 1 ROWS ONLY" for p in places]


def read_jdbc_split(spark: SparkSession, options: Mapping[str, str], column: str, parts: int, fetch_size: int = 10000) -> DataFrame:
    """A table (``dbtable``) or a query (``query``) read in about
    ``parts`` parts of equal size, cut at quantiles of ``column`` (numbers,
    dates, times or texts) that the database computes.

    The name of ``column`` is taken as it is written in the database, case
    included.  Rows that have no value are in the first part.  A value that holds more
    rows than a part is not cut: it makes one part, of its own size."""
    options = dict(options)
    query = options.pop("query", None)
    table = f"({query}) rows_of_query" if query else options.pop("dbtable")
    reader = spark.read.format("jdbc").options(**options)

    column = quoted(options["url"], column)

    def ask(sql: str) -> list:
        return [r[0] for r in reader.option("query", sql).load().collect()]

    rows = int(ask(f"SELECT COUNT({column}) AS n FROM {table}")[0])
    cuts = [c for sql in quantile_queries(options["url"], table, column, rows, parts) for c in ask(sql)] if rows and parts > 1 else []
    settings = {k: v for k, v in options.items() if k != "url"}
    return spark.read.jdbc(options["url"], table, predicates=split_predicates(column, cuts), properties={**settings, "fetchsize": str(fetch_size)})
