"""From one grid to another: which cells meet, and with what weight, from the two definitions alone.

Every old cell tells the new ones it takes part in by arithmetic on its column and row, so a regrid is one pass over the values and one grouping by new cell: no
pair table, no join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridrisk.functions.scalars import cell_area_km2, safe_ratio


@dataclass(frozen=True)
class Grid:
    """nx columns from x0 eastwards and ny rows from y0 northwards, of dx by dy; cell = row * nx + column, from 0."""

    x0: float
    y0: float
    dx: float
    dy: float
    nx: int
    ny: int

    def __post_init__(self) -> None:
        if not (self.dx > 0 and self.dy > 0 and self.nx > 0 and self.ny > 0):
            raise ValueError("a grid has cells of positive size, one at least")

    def column(self, cell: str | Column) -> Column:
        return (F.col(cell) if isinstance(cell, str) else cell) % self.nx

    def row(self, cell: str | Column) -> Column:
        return F.floor((F.col(cell) if isinstance(cell, str) else cell) / self.nx)

    def cell_of(self, x: Column, y: Column) -> Column:
        """The cell of a point, null outside; a point on a line belongs to the cell east or north of it."""
        i, j = F.floor((x - self.x0) / self.dx), F.floor((y - self.y0) / self.dy)
        return F.when((i >= 0) & (i < self.nx) & (j >= 0) & (j < self.ny), j * self.nx + i)

    def area(self, cell: str | Column, sphere: bool = False) -> Column:
        """Area of a cell: in squared units, or km2 on the sphere (coordinates in degrees)."""
        if not sphere:
            return F.lit(self.dx * self.dy)
        south = self.y0 + self.row(cell) * self.dy
        return cell_area_km2(south, south + self.dy, self.dx)


def _near(i: Column, o0: float, od: float, on: int, n0: float, nd: float, nn: int) -> Column:
    """[(new index, 1)]: new cells whose centre lies in old cell i (its lower line included)."""

    def first(k: Column) -> Column:
        return F.ceil((o0 + k * od - n0) / nd - 0.5)

    return _span(F.greatest(first(i), F.lit(0)), F.least(first(i + 1) - 1, F.lit(nn - 1)), lambda j: F.lit(1.0))


def _linear(i: Column, o0: float, od: float, on: int, n0: float, nd: float, nn: int, beyond: bool = False) -> Column:
    """[(new index, weight)]: new cells whose centre lies less than one old cell from the centre of old cell i, inside of the old grid unless beyond."""

    def place(j: Column) -> Column:  # the new centre, in old cells from the first old centre on
        return (n0 + (j + 0.5) * nd - o0) / od - 0.5

    def weight(j: Column) -> Column:
        w = 1 - F.abs(place(j) - i)
        return w if beyond else F.when((place(j) >= -0.5) & (place(j) <= on - 0.5), w).otherwise(0.0)

    lo, hi = (F.floor((o0 + (i + k) * od - n0) / nd - 0.5) for k in (-0.5, 1.5))
    return F.filter(_span(F.greatest(lo, F.lit(0)), F.least(hi + 1, F.lit(nn - 1)), weight), lambda s: s["w"] > 1e-12)


def _overlap(i: Column, o0: float, od: float, on: int, n0: float, nd: float, nn: int, measure=lambda a: a) -> Column:
    """[(new index, weight)]: the share of old cell i that lies in each new cell, by the measure of a coordinate."""
    a, b = o0 + i * od, o0 + (i + 1) * od

    def share(j: Column) -> Column:
        lo, hi = F.greatest(a, n0 + j * nd), F.least(b, n0 + (j + 1) * nd)
        return F.when(hi > lo, (measure(hi) - measure(lo)) / (measure(b) - measure(a))).otherwise(0.0)

    return F.filter(_span(F.greatest(F.floor((a - n0) / nd), F.lit(0)), F.least(F.ceil((b - n0) / nd), F.lit(nn - 1)), share), lambda s: s["w"] > 1e-12)


def _span(lo: Column, hi: Column, weight) -> Column:
    whole = F.when(lo <= hi, F.sequence(lo.cast("long"), hi.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.transform(whole, lambda j: F.struct(j.alias("j"), weight(j).cast("double").alias("w")))


def pairs(df: DataFrame, old: Grid, new: Grid, how: str = "bilinear", cell: str = "cell", sphere: bool = False, beyond: bool = False) -> DataFrame:
    """df once for each new cell that its old cell takes part in: new_cell and weight. nearest: 1; bilinear: by distance of centres (beyond: also for
    new centres less than half an old cell outside of the old grid); area: the share of the old cell."""
    sides = {"nearest": _near, "bilinear": partial(_linear, beyond=beyond), "area": _overlap}
    if how not in sides:
        raise ValueError(f"how must be one of {', '.join(sides)}")
    if beyond and how != "bilinear":
        raise ValueError("beyond is for bilinear weights")
    f, known = sides[how], df.where((F.col(cell) >= 0) & (F.col(cell) < old.nx * old.ny))
    sine = {"measure": lambda a: F.sin(F.radians(a))} if how == "area" and sphere else {}
    rows = known.withColumns({"_i": F.explode(f(old.column(cell), old.x0, old.dx, old.nx, new.x0, new.dx, new.nx))})
    rows = rows.withColumn("_j", F.explode(f(old.row(cell), old.y0, old.dy, old.ny, new.y0, new.dy, new.ny, **sine)))
    return rows.withColumns({"new_cell": F.col("_j.j") * new.nx + F.col("_i.j"), "weight": F.col("_i.w") * F.col("_j.w")}).drop("_i", "_j")


def regrid(df: DataFrame, old: Grid, new: Grid, keys: list[str] = (), how: str = "bilinear", mass: bool = False, sphere: bool = False, cell: str = "cell", value: str = "value", beyond: bool = False) -> DataFrame:
    """cell (of the new grid), keys, value.

    Values are taken over (nearest), or averaged by weight over the old cells that have one: missing cells and the grid's edge leave the
    others' weights to make up the whole. mass: values are amounts of a cell; they go as densities and come back times the new area, and by overlap (how area) each is
    shared out, so that what lies inside of the new grid keeps its sum. New cells that meet no value have no row. beyond (bilinear): new cells whose centre lies
    outside of the old grid, but less than half an old cell, take their value from its edge.
    """
    rows = df.where(F.col(value).isNotNull())
    if mass and how != "area":
        rows = rows.withColumn(value, F.col(value) / old.area(cell, sphere))
    rows = pairs(rows, old, new, how, cell, sphere, beyond)
    if how == "area" and not mass:  # by overlapping area
        rows = rows.withColumn("weight", F.col("weight") * old.area(cell, sphere))
    total = F.sum(F.col(value) * F.col("weight"))
    out = rows.groupBy(F.col("new_cell").alias(cell), *keys).agg((total if how == "area" and mass else safe_ratio(total, F.sum("weight"))).alias(value))
    return out.withColumn(value, F.col(value) * new.area(cell, sphere)) if mass and how != "area" else out
