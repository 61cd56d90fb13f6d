"""Dense row ids: gapless numbers that go on from a table's last one (F18,
K14), as a sequence of a database gives them.

A content hash needs no pass of its own, but 64 bits collide at some billions
of rows.  Dense ids take one: the rows are written once with the number of
their partition and their place in it, the partitions' sizes are added up,
and a row's id is what came before its partition plus its place.  The written
rows fix the ids, so a task that runs again gives the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sinks.publish import table_exists

_PLACE_BITS = 33


def dense_ids(df: DataFrame, name: str = "id", order_by: Sequence[Column | str] = (), start: int = 1) -> DataFrame:
    """``df`` with a first column ``name`` (long): ``start``, ``start + 1``,
    ... without gaps.

    With ``order_by`` the ids follow that order (a range shuffle; rows that
    tie come in any order, so give a total order for the same ids on every
    run); without it they follow the partitions, and nothing is shuffled.
    The driver sees one size for each partition, never rows."""
    spark = df.sparkSession
    taken = {c.lower() for c in df.columns}
    if name.lower() in taken:
        raise ValueError(f"the rows have a column {name}")
    place = next(n for n in ("place", *(f"place_{i}" for i in range(len(taken) + 1))) if n not in taken | {name.lower()})
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    path = scratch_path(spark, "dense-ids")
    placed = df.withColumn(place, F.monotonically_increasing_id())
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    part = F.shiftrightunsigned(place, _PLACE_BITS)
    sizes = {r["part"]: r["n"] for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = sorted(sizes)
    before = list(accumulate((sizes[p] for p in parts), initial=start))[:-1]
    # One row for each partition that has rows.
    offsets = spark.createDataFrame(list(zip(parts, before, strict=True)), "part bigint, before bigint")
    own = (F.col("before") + F.col(place).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).alias(name)
    return rows.join(F.broadcast(offsets), part == F.col("part")).select(own, *[F.col(f"`{c}`") for c in df.columns])


def next_id(spark: SparkSession, table: str, name: str = "id") -> int:
    """The first free id of a table: one more than its largest, 1 for a
    table that is empty or not there."""
    if not table_exists(spark, table):
        return 1
    last = spark.table(table).agg(F.max(name).alias("last")).first()["last"]
    return 1 if last is None else int(last) + 1
