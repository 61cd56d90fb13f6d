"""Sums and means of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so a plain ``avg`` changes its last bits
with the partitioning.  Here every value is cut into whole multiples of a few
powers of two, fixed for the column, and the multiples are added as longs:
no step rounds, so the parts of a sum are the same in any order.

One pass finds the greatest and the least magnitude of every column and the
number of rows; they fix the powers of two.  Each part keeps as many bits of
a value as leave room for that many rows in a long (50 for a few rows, 42 for
a million, 25 for a hundred billion), and there are as many parts as it takes to keep every
bit of every value: two for values within five orders of magnitude, more for
wider columns.  The second pass is the caller's own aggregate.

NaN and infinities give what ``avg`` and ``sum`` give; a mean is found
without its sum, so it is finite whenever the values are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 53
_LEAST = -1074
_LONG = 62
_WHOLE = 50
_STEP = 1000


def _times(c: str, power: int) -> str:
    """SQL of ``c * 2**power``, in steps that a double can hold."""
    while abs(power) > _STEP:
        step = _STEP if power > 0 else -_STEP
        c, power = f"({c} * {2.0**step!r}D)", power - step
    return f"({c} * {2.0**power!r}D)" if power else c


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _units(top: float, least: float, rows: int) -> list[int]:
    """Powers of two of the parts, greatest first."""
    high = math.frexp(top)[1]
    low = max(math.frexp(least)[1] - _BITS, _LEAST)
    step = min(_WHOLE, _LONG - rows.bit_length())
    if step < 1:
        raise OverflowError(f"{rows} rows are too many for sums in longs")
    return [max(high - j * step, low) for j in range(1, max(1, math.ceil((high - low) / step)) + 1)]


class SteadySums:
    """Order-free sums and means of some columns of ``frame``.

    ``frame`` is the input with helper columns; aggregate it by any keys with
    :meth:`sum` and :meth:`mean`.  A filter or a projection of the input that
    keeps the helper columns may come between.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str]):
        self._helpers = {c: f"steady_{i}" for i, c in enumerate(dict.fromkeys(columns))}
        taken = {c.lower() for c in df.columns}
        while any(h.lower() in name for h in self._helpers.values() for name in taken):
            self._helpers = {c: f"{h}_" for c, h in self._helpers.items()}
        bounds = _bounds(df, self._helpers)
        self._odd = {c: b["odd"] for c, b in bounds.items()}
        self._of: dict[str, list[int]] = {c: _units(b["top"], b["least"], b["rows"]) if b["top"] else [] for c, b in bounds.items()}
        for level in range(max(map(len, self._of.values()), default=0)):
            df = df.withColumns({self._rest(c, level): F.expr(self._remainder(c, level)) for c, units in self._of.items() if level < len(units)})
        self.frame = df

    # Expressions are written as SQL: there are dozens of steps for a column.

    def _rest(self, column: str, level: int) -> str:
        return f"{self._helpers[column]}_{level}"

    def _part(self, column: str, level: int) -> str:
        """Whole multiples of the unit of ``level`` left at that level."""
        return f"CAST({_times(_name(self._rest(column, level)), -self._of[column][level])} AS BIGINT)"

    def _remainder(self, column: str, level: int) -> str:
        if not level:
            x = f"CAST({_name(column)} AS DOUBLE)"
            return f"CASE WHEN abs({x}) < double('Infinity') THEN {x} END" if self._odd[column] else x
        before = _times(f"CAST({self._part(column, level - 1)} AS DOUBLE)", self._of[column][level - 1])
        return f"{_name(self._rest(column, level - 1))} - {before}"

    def _sums(self, column: str) -> list[tuple[str, int]]:
        """The exact parts of the sum, greatest first, and their units."""
        return [(f"coalesce(sum({self._part(column, i)}), 0L)", unit) for i, unit in enumerate(self._of[column])]

    def _together(self, column: str, terms: list[str]) -> Column:
        """Terms, each exact or far below the first, added from the last on;
        NULL if there is no value."""
        total = "0.0D"
        for term in reversed(terms):
            total = f"({total} + {term})"
        x = f"CAST({_name(column)} AS DOUBLE)"
        if self._odd[column]:
            total += f" + sum(CASE WHEN abs({x}) < double('Infinity') THEN 0.0D ELSE {x} END)"
        return F.expr(f"CASE WHEN count({_name(column)}) > 0 THEN {total} END")

    def sum(self, column: str) -> Column:
        """Sum of ``column``; NULL if there is no value."""
        terms = []
        for part, unit in self._sums(column):
            # A long in two halves that a double holds.
            terms.append(_times(f"CAST(shiftright({part}, 30) AS DOUBLE)", unit + 30))
            terms.append(_times(f"CAST(({part} & {(1 << 30) - 1}L) AS DOUBLE)", unit))
        return self._together(column, terms)

    def mean(self, column: str) -> Column:
        """Mean of ``column``, rounded once; NULL if there is no value.

        A long division of the parts by the count: what one part leaves over
        goes to the next."""
        n, terms, left, above = f"count({_name(column)})", [], None, 0
        for part, unit in self._sums(column):
            if left is not None:
                part = f"({left} * {1 << (above - unit)}L + {part})"
            terms.append(_times(f"CAST(({part} div {n}) AS DOUBLE)", unit))
            left, above = f"({part} % {n})", unit
        if left is not None:
            terms.append(_times(f"(CAST({left} AS DOUBLE) / {n})", above))
        return self._together(column, terms)


def _bounds(df: DataFrame, names: Mapping[str, str]) -> dict[str, dict]:
    """Greatest and least magnitude of the finite values other than zero,
    whether there are others, and the rows."""
    size = {c: F.abs(F.col(f"`{c}`").cast("double")) for c in names}
    wide = [agg for c, h in names.items() for agg in (F.max(size[c]).alias(f"{h}_top"), F.min(F.when(size[c] > 0, size[c])).alias(f"{h}_least"))]
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), *wide).first()
    odd = [c for c, h in names.items() if row[f"{h}_top"] is not None and not math.isfinite(row[f"{h}_top"])]
    tops = {c: row[f"{h}_top"] for c, h in names.items()}
    if odd:
        finite = df.agg(*[F.max(F.when(size[c] < float("inf"), size[c])).alias(names[c]) for c in odd]).first()
        tops.update({c: finite[names[c]] for c in odd})
    return {c: {"top": tops[c], "least": row[f"{h}_least"], "rows": row["n_rows"], "odd": c in odd} for c, h in names.items()}
