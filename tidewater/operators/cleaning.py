"""Projection, filter and cleaning operators.

Column lists are resolved against ``df.columns`` / ``df.schema`` when the
plan is built, so steps that name absent columns are skipped (P19) and no
data is touched to decide it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType, VariantType

from tidewater.functions.exprs import NUMBER_PRECISION, NUMBER_SCALE, days_before, try_number, try_timestamp
from tidewater.operators.analytics import top_n

# Id texts (lower-cased, not trimmed) that count as missing.
PLACEHOLDER_IDS = ("unknown", "none", "nan", "", "null")

# Id columns that must be present and real.
CRITICAL_IDS = ("customer_id", "restaurant_id", "order_id", "driver_id")

# Name fragments that mark a column as a timestamp, and the
# columns that are numbers, when typing a collection by column name.
TIME_WORDS = ("time", "date", "joined", "created")
NUMBER_COLUMNS = ("order_amount", "rating")


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The subset of ``cols`` that ``df`` has (case-insensitive match)."""
    have = {c.lower(): c for c in df.columns}
    return [have[c.lower()] for c in cols if c.lower() in have]


def drop_if_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns by name; unknown names are ignored."""
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (names with '/' or spaces are fine)."""
    return df.withColumnsRenamed(dict(mapping))


def keep_positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every column is non-null and > 0."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & (F.col(c) > 0)
    return df.where(cond)


def not_null(df: DataFrame, col: str) -> DataFrame:
    """P10: drop rows whose ``col`` is NULL."""
    return df.where(F.col(col).isNotNull())


def drop_placeholder_ids(df: DataFrame, cols: Sequence[str], bad: Sequence[str] = PLACEHOLDER_IDS) -> DataFrame:
    """Drop rows whose id text, lower-cased (not trimmed), is a placeholder."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & ~F.lower(F.col(c).cast("string")).isin(list(bad))
    return df.where(cond)


def since(df: DataFrame, ts: str, days: int, as_of: Column | None = None) -> DataFrame:
    """Rows with ``ts >= as_of - days``; ``as_of`` defaults to now."""
    return df.where(F.col(ts) >= days_before(days, as_of))


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in any of ``cols`` (only those present)."""
    cols = present(df, cols)
    return df.na.drop(subset=cols) if cols else df


def fill_text(df: DataFrame, value: str = "unknown") -> DataFrame:
    """Fill NULL text columns; numbers, dates and booleans stay NULL."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.na.fill(value, subset=cols) if cols else df


def keep_positive_if_present(df: DataFrame, col: str) -> DataFrame:
    """Keep ``col > 0`` when the column exists; NaN and NULL fail."""
    if not present(df, [col]):
        return df
    c = F.col(col)
    if dict(df.dtypes)[present(df, [col])[0]] in ("double", "float"):
        c = F.nanvl(c, F.lit(None).cast("double"))
    return df.where(c > 0)


def _hashable(dt: DataType) -> bool:
    if isinstance(dt, (MapType, VariantType)):
        return False
    if isinstance(dt, ArrayType):
        return _hashable(dt.elementType)
    if isinstance(dt, StructType):
        return all(_hashable(f.dataType) for f in dt.fields)
    return True


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by ``order_by``.

    A rank of one within the key, which Spark limits per task before the
    shuffle: a key holding a third of all rows leaves one row of each task,
    and every row travels once.  Rows that tie on ``order_by`` are told
    apart by a hash of the whole row, so the pick does not depend on the
    order rows arrive in and a recomputed task picks the same row.
    """
    keys = list(keys)
    if all(c in keys for c in df.columns):
        return df.dropDuplicates(keys)
    hashed = [F.col(c) for c in df.columns if _hashable(df.schema[c].dataType)]
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return top_n(df, keys, [*order, F.xxhash64(*hashed), F.hash(*hashed)], 1)


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row dedup (hash aggregate with map-side combine)."""
    return df.dropDuplicates()


def drop_array_columns(df: DataFrame) -> DataFrame:
    """Drop list-typed columns, found from the schema (not a sample row)."""
    keep = [f.name for f in df.schema.fields if not isinstance(f.dataType, ArrayType)]
    return df.select(*keep)


def clean_collection(df: DataFrame, key: str | None = None, order_by: Sequence[Column | str] | None = None, numbers: tuple[int, int] = (NUMBER_PRECISION, NUMBER_SCALE)) -> DataFrame:
    """M6: the cleaning steps a replicated collection goes through.

    1. keyed dedup on ``key`` (first by ``order_by``), when the column exists;
    2. ``order_amount`` and ``rating`` to exact numbers of the precision and
       scale in ``numbers`` (bad text -> NULL, a number that does not fit
       raises);
    3. ``order_amount > 0`` when present, on the number as parsed;
    4. critical id columns: not NULL and not a placeholder text;
    5. NULL text -> "unknown".
    """
    if key and present(df, [key]):
        df = dedup_keep_first(df, [key], order_by or [key])
    for c in present(df, NUMBER_COLUMNS):
        df = df.withColumn(c, try_number(c, *numbers))
    df = keep_positive_if_present(df, "order_amount")
    ids = present(df, CRITICAL_IDS)
    if ids:
        df = df.na.drop(subset=ids)
        df = drop_placeholder_ids(df, ids)
    return fill_text(df)


def type_by_name(df: DataFrame, column_types: Mapping[str, str] | None = None, numbers: tuple[int, int] = (NUMBER_PRECISION, NUMBER_SCALE)) -> DataFrame:
    """M7 typing: explicit ``column_types`` first; else by name - a time word
    or an ``_at`` suffix gives a timestamp (bad text -> NULL), the number
    columns give decimals (``numbers``: precision and scale), everything else
    stays as it is."""
    out = []
    for f in df.schema.fields:
        name, low = f.name, f.name.lower()
        if column_types and name in column_types:
            target = column_types[name]
            if target in ("timestamp", "timestamp_ntz"):
                out.append(try_timestamp(name).alias(name))
            else:
                out.append(F.col(name).try_cast(target).alias(name))
        elif any(w in low for w in TIME_WORDS) or low.endswith("_at"):
            out.append(try_timestamp(name).alias(name))
        elif low in NUMBER_COLUMNS:
            out.append(try_number(name, *numbers).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)
