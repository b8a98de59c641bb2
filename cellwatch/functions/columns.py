"""Column expressions shared by the operators (all built-in, JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellwatch import schema as S

__all__ = [
    "ntz_literal", "epoch_seconds", "hour_floor", "day_floor", "second_floor", "exact_sum", "exact_sum_over",
    "exact_sum_sql", "guarded_ratio", "severity_band", "round6", "relative_deviation", "fmt4", "fmt2",
]

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_seconds(col: str | Column) -> Column:
    """Seconds since epoch of a TIMESTAMP_NTZ value, independent of the session time zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), c)


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a Python datetime (or ISO text), independent of the
    Python process time zone and of the session time zone."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


# Floors of TIMESTAMP_NTZ values from their own fields: date_trunc would go through the session
# zone and move the hours that a clock change skips or repeats.

def hour_floor(ts: str) -> str:
    """SQL text: the hour of a TIMESTAMP_NTZ expression."""
    return f"make_timestamp_ntz(year({ts}), month({ts}), day({ts}), hour({ts}), 0, 0)"


def second_floor(ts: str) -> str:
    """SQL text: the second of a TIMESTAMP_NTZ expression."""
    return f"make_timestamp_ntz(year({ts}), month({ts}), day({ts}), hour({ts}), minute({ts}), second({ts}))"


def day_floor(ts: str) -> str:
    """SQL text: the start of day of a TIMESTAMP_NTZ expression."""
    return f"make_timestamp_ntz(year({ts}), month({ts}), day({ts}), 0, 0, 0)"


# High part of the sums: units of 1e-4, in blocks of 2^30; what lies below a unit is summed beside it.
_UNITS = 10_000
_BITS = 30


def exact_sum_sql(expr: str) -> str:
    """SQL text of ``exact_sum`` over a SQL expression (one parse on the JVM side)."""
    unit = f"CAST(RINT(({expr}) * {_UNITS}D) AS BIGINT)"
    high = (f"CAST(SUM(SHIFTRIGHT({unit}, {_BITS})) AS DOUBLE) * {1 << _BITS}D"
            f" + CAST(SUM({unit} & {(1 << _BITS) - 1}L) AS DOUBLE)")
    return f"(({high}) / {_UNITS}D + SUM(({expr}) - {unit} / {_UNITS}D))"


def exact_sum(col: str | Column) -> Column:
    """Sum of doubles at full input precision, the same in any task order to the last digits.

    Each value is split into whole units of 1e-4, summed as integers (in two parts, so a total
    over all history cannot overflow), and the rest, at most 5e-5 each. Values of up to four
    decimals have no rest: their sum is exact and bit-identical however tasks are re-executed. For
    others only the sum of the rests depends on the order, by far less than the total's last digit.
    A value beyond 9.2e14 raises in ANSI mode instead of wrapping. NULLs are skipped.
    """
    if isinstance(col, str):
        return F.expr(exact_sum_sql(f"`{col}`"))
    return _exact(col, lambda summed: summed)


def exact_sum_over(col: str, window) -> Column:
    """``exact_sum`` as a window aggregate."""
    return _exact(F.col(col), lambda summed: summed.over(window))


def _exact(value: Column, scope) -> Column:
    """The sum from its parts: blocks of units and units by shift and mask (both exact for negatives), rests."""
    unit = F.rint(value * F.lit(float(_UNITS))).cast("long")
    blocks = scope(F.sum(F.shiftright(unit, _BITS).cast("long"))).cast("double")
    units = scope(F.sum(unit.bitwiseAND(F.lit((1 << _BITS) - 1)))).cast("double")
    return ((blocks * float(1 << _BITS) + units) / float(_UNITS)
            + scope(F.sum(value - unit / float(_UNITS))))


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num/den`` when ``den > 0`` else ``0.0`` (NULL den gives 0.0 too)."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def severity_band(total: Column, bands=S.SEVERITY_BANDS) -> Column:
    medium, high, critical = bands
    return (F.when(total >= critical, "critical")
            .when(total >= high, "high")
            .when(total >= medium, "medium")
            .otherwise("low"))


def round6(c: Column) -> Column:
    return F.round(c, 6)


def relative_deviation(x: Column, base: Column) -> Column:
    """``(x - base) / |base| * 100``; NULL when the base is 0 or NULL."""
    return F.when(F.abs(base) > 0, (x - base) / F.abs(base) * 100.0)


def fmt4(c: Column) -> Column:
    return F.format_string("%.4f", c)


def fmt2(c: Column) -> Column:
    return F.format_string("%.2f", c)
