"""Key checks a DDL would enforce (K18), as set-based Spark jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Rows breaking a primary key: one line per key value that is NULL in
    any part or appears more than once, with its row count ``n``.

    A grouped count (partial aggregation before the shuffle), so a hot key
    costs one counter per task, not its rows."""
    pk = list(pk)
    any_null = F.lit(False)
    for c in pk:
        any_null = any_null | F.col(c).isNull()
    counts = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(any_null | (F.col("n") > 1))


def fk_orphans(child: DataFrame, parent: DataFrame, cols: Sequence[str] | str, parent_cols: Sequence[str] | str | None = None) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row (``left_anti``).

    The parent side is reduced to its distinct keys first; Spark picks a
    broadcast only when the optimizer's size estimate fits the broadcast
    threshold, otherwise a shuffle join (AQE may still switch at run time).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    parent_cols = cols if parent_cols is None else ([parent_cols] if isinstance(parent_cols, str) else list(parent_cols))
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_cols, cols)]).distinct()
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return child.where(cond).join(keys, on=cols, how="left_anti")


def fk_orphan_counts(child: DataFrame, parent: DataFrame, cols: Sequence[str] | str, parent_cols: Sequence[str] | str | None = None) -> DataFrame:
    """Dangling foreign-key values with the number of child rows holding
    each (``n``).

    The child is first counted per key value (partial aggregation before the
    shuffle), so a key held by a third of all rows reaches the anti join as
    one line per task instead of as its rows."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    counted = child.where(cond).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return fk_orphans(counted, parent, cols, parent_cols)


def check_keys(df: DataFrame, pk: Sequence[str]) -> int:
    """Number of rows breaking the primary key (0 = key holds)."""
    row = key_violations(df, pk).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad")).first()
    return int(row["bad"])


def check_fk(child: DataFrame, parent: DataFrame, cols: Sequence[str] | str, parent_cols: Sequence[str] | str | None = None) -> int:
    """Number of child rows with a dangling foreign key (0 = key holds)."""
    row = fk_orphan_counts(child, parent, cols, parent_cols).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad")).first()
    return int(row["bad"])
