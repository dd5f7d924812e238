"""Column expressions: calendars, labels, breaks, cell areas, the normal distribution."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """a / b; null for a zero denominator (an infinite ratio is missing data)."""
    return col(a) / F.nullif(col(b), F.lit(0.0))


def finite(c: str | Column) -> Column:
    return col(c).isNotNull() & ~F.isnan(col(c)) & (F.abs(col(c)) < F.lit(float("inf")))


def month_of_day(day: str | Column) -> Column:
    """Month of a day of the year (1 to 366)."""
    return F.month(F.date_add(F.lit("2024-01-01").cast("date"), col(day).cast("int") - 1))


def month_of_dekad(dekad: str | Column) -> Column:
    """Month of a ten-day period (1 to 36)."""
    return F.ceil(col(dekad) / 3).cast("int")


def wrap_month(m: str | Column) -> Column:
    """1 to 12 for any whole month number."""
    return (F.pmod(col(m) - 1, F.lit(12)) + 1).cast("int")


def classify(value: str | Column, direction: str | Column, threshold: str | Column | float) -> Column:
    """1 beyond the threshold (strictly), else 0; null stays null. Directions: > G g, or < L l."""
    v, t = col(value), threshold if isinstance(threshold, Column) else F.col(threshold) if isinstance(threshold, str) else F.lit(threshold)
    d = direction if isinstance(direction, Column) else F.lit(direction)
    beyond = F.when(d.isin(">", "G", "g"), v > t).when(d.isin("<", "L", "l"), v < t)
    return beyond.cast("int")


def interval_class(value: str | Column, breaks: list[tuple[float, float, int]], closed: str = "right") -> Column:
    """The class of the interval (from, to] (or [from, to) with closed='left'); null outside of all."""
    v, out = col(value), None
    for lo, hi, k in breaks:
        inside = (v > lo) & (v <= hi) if closed == "right" else (v >= lo) & (v < hi)
        out = F.when(inside, k) if out is None else out.when(inside, k)
    return out


def recode(value: str | Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        hit = col(value) == F.lit(k)
        out = F.when(hit, F.lit(v)) if out is None else out.when(hit, F.lit(v))
    return out


def cell_area_km2(lat_south: str | Column, lat_north: str | Column, dlon: float) -> Column:
    """Area of a cell on the sphere."""
    return F.lit(EARTH_KM**2 * math.radians(dlon)) * (F.sin(F.radians(col(lat_north))) - F.sin(F.radians(col(lat_south))))


def normal_tail(z: str | Column) -> Column:
    """P(Z > z) of a standard normal Z, to double precision also far out; z is not below 0. A power series up to 3, a continued fraction beyond."""
    x = col(z)
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    first = F.struct(x.alias("term"), x.alias("total"))

    def grow(s: Column, k: Column) -> Column:
        term = s["term"] * x * x / (2 * k + 1)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    near = 0.5 - density * F.aggregate(F.sequence(F.lit(1), F.lit(60)), first, grow, lambda s: s["total"])
    far = density / F.aggregate(F.sequence(F.lit(60), F.lit(1), F.lit(-1)), x, lambda d, k: x + k / d)
    return F.when(x < 3, near).otherwise(far)


def normal_cdf(z: str | Column) -> Column:
    """Standard normal distribution function."""
    tail = normal_tail(F.abs(col(z)))
    return F.when(col(z) >= 0, 1 - tail).otherwise(tail)


def nice_step(span: str | Column) -> Column:
    """A round step for about ten classes: the power of ten below a tenth of the span, times 1, 2 or 5."""
    raw = col(span) / 10
    unit = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    return unit * F.when(raw / unit < 2, 1.0).when(raw / unit < 5, 2.0).otherwise(5.0)


def break_sequence(low: str | Column, high: str | Column) -> Column:
    """Breaks from low to high, both rounded outwards to a tenth, in steps of the power of ten next to a tenth of the span (upwards from 1 on, else downwards); null without a span."""
    power = F.log10((col(high) - col(low)) / 10)
    step = F.pow(F.lit(10.0), F.when(power > 0, F.ceil(power)).otherwise(F.floor(power)))
    first, last = F.floor(col(low) * 10) / 10, F.ceil(col(high) * 10) / 10
    return F.transform(F.sequence(F.lit(0).cast("bigint"), F.floor((last - first) / step + 1e-10)), lambda k: first + k * step)


def pretty_step(low: str | Column, high: str | Column, n: int = 10) -> tuple[Column, Column, Column]:
    """(step, first, last): round breaks first * step, ..., last * step that cover low to high in about n intervals.

    The step is 1, 2 or 5 times a power of ten, or ten times it: the next larger one as long as it is nearer (by 1.5 and 2.75 parts) to an n-th of the span. Without
    a span, the n-th is of the value itself. With fewer than a third of n intervals, more are added on both sides (above only, from 0 on). `first` and `last`
    read a column _step that holds the step.
    """
    low, high = col(low).cast("double"), col(high).cast("double")
    most, least = F.greatest(F.abs(low), F.abs(high)), n // 3
    flat = (high - low) < F.when((low == 0) & (high == 0), 1.0).otherwise(most) * (1 + 1 / 2.5) * max(1, n) * 2.220446049250313e-16 * 3
    point = F.when((low == 0) & (high == 0), 1.0).otherwise(F.when(most > 10, 9 + most / 10).otherwise(most)) * 0.75 / max(1, least)
    cell = F.when(flat, point).otherwise((high - low) / max(1, n))
    base = F.pow(F.lit(10.0), F.floor(F.log10(cell)))
    two, five, ten = 2 * base - cell < 1.5 * (cell - base), 5 * base - cell < 2.75 * (cell - 2 * base), 10 * base - cell < 1.5 * (cell - 5 * base)
    step = base * F.when(two & five & ten, 10.0).when(two & five, 5.0).when(two, 2.0).otherwise(1.0)
    first, last = F.floor(low / F.col("_step") + 1e-10), F.ceil(high / F.col("_step") - 1e-10)
    lack = least - (last - first)
    up = F.when((low == 0) & (first == 0) & (high != 0), lack).when(first >= 0, F.floor(lack / 2)).otherwise(F.ceil(lack / 2))
    down = F.when((low == 0) & (first == 0) & (high != 0), 0).when(first >= 0, F.ceil(lack / 2)).otherwise(F.floor(lack / 2))
    return step, F.when(lack > 0, first - down).otherwise(first), F.when(lack > 0, last + up).otherwise(last)
