"""Scalar expressions (F1-F19).  All are built-in Spark functions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Exact numbers parsed from text (F9): 20 digits before the point, 18 after.
NUMBER_PRECISION, NUMBER_SCALE = 38, 18


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def upper_text(col: Column | str) -> Column:
    """upper case."""
    return F.upper(_c(col))


def label(cond: Column, yes, no) -> Column:
    """two-way label; a NULL test takes the ``no`` branch."""
    return F.when(cond, yes).otherwise(no)


def first_match(cases: Sequence[tuple[Column, object]], default) -> Column:
    """ordered multi-branch label, the first true test wins."""
    if not cases:
        return F.lit(default)
    expr = F.when(cases[0][0], cases[0][1])
    for cond, value in cases[1:]:
        expr = expr.when(cond, value)
    return expr.otherwise(default)


def per_hundred(num: Column | str, den: Column | str, safe: bool = False) -> Column:
    """``num / den * 100.0``; ``safe`` gives NULL on a zero divisor."""
    ratio = F.try_divide(_c(num), _c(den)) if safe else _c(num) / _c(den)
    return ratio * F.lit(100.0)


def absolute(col: Column | str) -> Column:
    """absolute value."""
    return F.abs(_c(col))


def round_half_up(col: Column | str, digits: int) -> Column:
    """Round half away from zero to ``digits`` places."""
    return F.round(_c(col), digits)


def round_half_even(col: Column | str, digits: int) -> Column:
    """Scale, round half to even on the binary value, scale back
    (what a float ``round`` in a data-frame library does)."""
    scale = 10.0**digits
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale)


def to_int(col: Column | str) -> Column:
    """Cast to int; bad text raises (ANSI)."""
    return _c(col).cast("int")


def to_decimal(col: Column | str, precision: int = 18, scale: int = 4) -> Column:
    """Cast text to an exact number; bad text raises (ANSI)."""
    return _c(col).cast(f"decimal({precision},{scale})")


def to_text(col: Column | str) -> Column:
    """F7c/F7d/F15: any value (bytes, ids, nodes) as text."""
    return _c(col).cast("string")


def lower_text(col: Column | str) -> Column:
    """F8: lower case of the value's text form."""
    return F.lower(_c(col).cast("string"))


def try_number(col: Column | str, precision: int = NUMBER_PRECISION, scale: int = NUMBER_SCALE) -> Column:
    """exact number or NULL for bad text.  NaN becomes NULL too, so a
    later ``> 0`` test drops it (Spark orders NaN above every number).

    A readable number that does not fit (too large, or so small that nothing
    would be left of it) raises: it is never turned into NULL or zero."""
    text = _c(col).cast("string")
    # 'NaN', 'Infinity' and non-numbers all fail the decimal cast.
    kind = f"decimal({precision},{scale})"
    number, rough = text.try_cast(kind), text.try_cast("double")
    finite = rough.isNotNull() & ~F.isnan(rough) & (F.abs(rough) < F.lit(float("inf")))
    lost = finite & (number.isNull() | ((number == 0) & (rough != 0)))
    return F.when(lost, F.raise_error(F.concat(F.lit(f"number does not fit {kind}: "), text)).cast(kind)).otherwise(number)


def try_timestamp(col: Column | str, fmt: str | None = None) -> Column:
    """timestamp without zone, or NULL for text that is not one."""
    c = _c(col).cast("string")
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    # Read without a zone, so the session's zone cannot move a value.
    doc = F.to_json(F.struct(c.alias("t")))
    return F.from_json(doc, "t TIMESTAMP_NTZ", {"timestampNTZFormat": fmt})["t"]


def parse_ts(col: Column | str, fmt: str = "dd-MM-yyyy HH:mm") -> Column:
    """timestamp (no zone) from text in a fixed format; bad text raises."""
    return F.to_timestamp_ntz(_c(col), F.lit(fmt))


def day_of(col: Column | str) -> Column:
    """date part of a timestamp."""
    return F.to_date(_c(col))


def year_of(col: Column | str) -> Column:
    """year as int."""
    return F.year(_c(col))


def days_before(days: int, as_of: Column | None = None) -> Column:
    """``as_of`` (default: the local clock, no zone) minus ``days``."""
    base = as_of if as_of is not None else F.localtimestamp()
    return base - F.make_dt_interval(F.lit(days))


def flag(cond: Column) -> Column:
    """F16: boolean flag; a NULL test gives false."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def key_default(col: Column | str, default: str = "unknown") -> Column:
    """the value, or ``default`` when it is absent or NULL."""
    return F.coalesce(_c(col), F.lit(default))


def surrogate_id(*cols: Column | str) -> Column:
    """a stable 64-bit row id from the row's content (same input, same
    id on every rerun).  Include what tells equal rows apart, such as the
    position in the parent's list.  Use ``monotonically_increasing_id`` when
    only uniqueness within one run is needed."""
    return F.xxhash64(*[_c(c) for c in cols])


def const(value) -> Column:
    """constant column."""
    return F.lit(value)
