"""Grids: cell ids, resampling, areas, polygons to cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import col


def coarsen(df: DataFrame, factor: int, keys: list[str], how: str = "sum") -> DataFrame:
    """Cells x, y (whole numbers) put together by factor x factor."""
    agg = {"sum": F.sum, "mean": F.avg}[how]
    return df.groupBy(F.floor(F.col("x") / factor).cast("long").alias("x"), F.floor(F.col("y") / factor).cast("long").alias("y"), *keys).agg(agg("value").alias("value"))


def nearest(df: DataFrame, factor: int) -> DataFrame:
    """Each cell refined to factor x factor cells of the same value."""
    steps = F.sequence(F.lit(0), F.lit(factor - 1))
    fine = df.withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps))
    return fine.withColumns({"x": F.col("x") * factor + F.col("_i"), "y": F.col("y") * factor + F.col("_j")}).drop("_i", "_j")


def conserve_mass(df: DataFrame, factor: int, area: float = 1.0) -> DataFrame:
    """Density, refine, times the new area: the sum stays."""
    dense = df.withColumn("value", F.col("value") / area)
    return nearest(dense, factor).withColumn("value", F.col("value") * area / (factor * factor))


def bilinear(df: DataFrame, at: DataFrame) -> DataFrame:
    """Values at points px, py from the four cells around; weights of missing cells are left out."""
    px, py = F.floor("px"), F.floor("py")
    corners = F.explode(F.array(*(F.struct((px + i).cast("long").alias("x"), (py + j).cast("long").alias("y"), (F.abs(F.col("px") - px - (1 - i)) * F.abs(F.col("py") - py - (1 - j))).alias("w")) for i in (0, 1) for j in (0, 1))))
    near = at.withColumn("_c", corners).select("px", "py", F.col("_c.x").alias("x"), F.col("_c.y").alias("y"), F.col("_c.w").alias("w")).where("w > 0").join(df, ["x", "y"])
    return near.groupBy("px", "py").agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("value"))


def crossings(x: str | Column, y: str | Column, ring: str | Column) -> Column:
    """How many edges of the ring, an array of (x, y) corners, the ray from the point to the right crosses."""
    n = F.size(col(ring))

    def crossed(acc: Column, i: Column) -> Column:
        a, b = F.get(col(ring), i), F.get(col(ring), F.pmod(i + 1, n))
        over = (a["y"] > col(y)) != (b["y"] > col(y))
        at = (b["x"] - a["x"]) * (col(y) - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return acc + F.when(over & (col(x) < at), 1).otherwise(0)

    return F.aggregate(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), F.lit(0), crossed)


def in_ring(x: str | Column, y: str | Column, ring: str | Column) -> Column:
    """Whether the point lies inside of the ring."""
    return crossings(x, y, ring) % 2 == 1


def in_rings(x: str | Column, y: str | Column, rings: str | Column) -> Column:
    """Whether the point lies inside of an odd number of the rings: parts add, holes take away."""
    return F.aggregate(col(rings), F.lit(0), lambda acc, ring: acc + crossings(x, y, ring)) % 2 == 1


def with_rings(zones: DataFrame) -> DataFrame:
    """zones with `rings`, an array of rings, whether they came with that or with one ring."""
    return zones if "rings" in zones.columns else zones.withColumn("rings", F.array("ring"))


def assign_zones(cells: DataFrame, zones: DataFrame, tile: int = 5, last: bool = False) -> DataFrame:
    """The zone of each cell centre: bounding boxes dealt over tiles, then the test of the rings.

    zones: zone_id, and ring or rings (parts and holes, even-odd over all of them). Where zones overlap the smallest id wins, or the largest (last:
    as if zones were drawn in the order of their ids). A hole belongs to whichever zone fills it.
    """
    ringed = with_rings(zones)
    corners = F.flatten("rings")
    xs, ys = F.transform(corners, lambda p: p["x"]), F.transform(corners, lambda p: p["y"])
    box = ringed.withColumns({"x0": F.array_min(xs), "x1": F.array_max(xs), "y0": F.array_min(ys), "y1": F.array_max(ys)})
    tx = F.explode(F.sequence(F.floor(F.col("x0") / tile), F.floor(F.col("x1") / tile)))
    ty = F.explode(F.sequence(F.floor(F.col("y0") / tile), F.floor(F.col("y1") / tile)))
    tiled = box.withColumn("tx", tx).withColumn("ty", ty)
    own = cells.withColumns({"tx": F.floor(F.col("x") / tile), "ty": F.floor(F.col("y") / tile)})
    hit = own.join(tiled, ["tx", "ty"]).where(F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))).where(in_rings("x", "y", "rings"))
    return hit.groupBy("cell").agg((F.max if last else F.min)("zone_id").alias("zone_id"))


def first_per_cell(df: DataFrame, order: list[str]) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy("cell").orderBy(*order))).where("_r = 1").drop("_r")
