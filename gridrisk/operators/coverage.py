"""The share of each grid cell that a zone covers, and statistics weighted by it.

A ring is walked edge by edge. An edge is cut at every grid line it crosses; a piece adds, in its own cell, the area to its right and, to all
cells further right in its row, its height. The sums by cell and their running sum along a row are the exact covered areas, so the work follows the
length of the outlines: rings are never compared with cells, and the cells inside of a zone come from the gaps between two outline cells of a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import safe_ratio
from gridrisk.operators.grid import crossings, with_rings
from gridrisk.operators.ordered import same_keys, weighted_quantiles
from gridrisk.operators.zonal import pretty_histogram
from gridrisk.sources.shared import pinned

#: Shares under it are what is left of sums that cancel.
LEAST = 1e-9


def _twice_area(ring: Column) -> Column:
    """Twice the signed area: positive if the corners go round to the left."""
    n = F.size(ring)

    def add(acc: Column, i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, F.pmod(i + 1, n))
        return acc + a["x"] * b["y"] - b["x"] * a["y"]

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), add)


def outlines(zones: DataFrame) -> DataFrame:
    """zone_id, sign, a, b: the edges of all rings; sign turns areas right of an edge into the zone's, holes taken out (a ring inside of an odd number of the zone's other rings is a hole)."""
    rings = with_rings(zones).select("zone_id", "rings", F.posexplode("rings").alias("nth", "ring")).where(F.size("ring") >= 3)
    a, b = F.get("ring", F.lit(0)), F.get("ring", F.lit(1))
    inside = F.aggregate(F.sequence(F.lit(0), F.size("rings") - 1), F.lit(0), lambda acc, i: acc + F.when(i != F.col("nth"), crossings("mx", "my", F.get("rings", i)) % 2).otherwise(0))
    told = rings.withColumns({"mx": (a["x"] + b["x"]) / 2, "my": (a["y"] + b["y"]) / 2}).withColumn("hole", inside % 2 == 1)
    sign = -F.signum(_twice_area(F.col("ring"))) * F.when(F.col("hole"), -1).otherwise(1)
    each = told.select("zone_id", sign.alias("sign"), "ring", F.posexplode("ring").alias("i", "a"))
    return each.select("zone_id", "sign", "a", F.get("ring", F.pmod(F.col("i") + 1, F.size("ring"))).alias("b"))


def _pieces(edges: DataFrame, size: float, x0: float, y0: float) -> DataFrame:
    """zone_id, x, y (the cell), own (area right of the piece in it) and onward (height), in cells."""

    def at(p: str, c: str) -> Column:
        return (F.col(f"{p}.{c}") - (x0 if c == "x" else y0)) / size

    own = edges.select("zone_id", "sign", *(at(p, c).alias(f"{p}{c}") for p in "ab" for c in "xy")).where("ay <> by")

    def cuts(c: str) -> Column:
        lo, hi = F.least(f"a{c}", f"b{c}"), F.greatest(f"a{c}", f"b{c}")
        none = F.array().cast("array<bigint>")
        lines = F.when((F.col(f"a{c}") != F.col(f"b{c}")) & (F.ceil(lo) <= F.floor(hi)), F.sequence(F.ceil(lo), F.floor(hi))).otherwise(none)
        return F.transform(lines, lambda k: (k - F.col(f"a{c}")) / (F.col(f"b{c}") - F.col(f"a{c}")))

    t = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), cuts("x"), cuts("y"))))
    parts = F.zip_with(F.slice("t", F.lit(1), F.size("t") - 1), F.slice("t", F.lit(2), F.size("t") - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    cut = own.withColumn("t", t).withColumn("t", F.explode(parts)).withColumn("m", (F.col("t.p") + F.col("t.q")) / 2)
    mx, my = (F.col(f"a{c}") + (F.col(f"b{c}") - F.col(f"a{c}")) * F.col("m") for c in "xy")
    height = F.col("sign") * (F.col("by") - F.col("ay")) * (F.col("t.q") - F.col("t.p"))
    return cut.select("zone_id", F.floor(mx).cast("long").alias("x"), F.floor(my).cast("long").alias("y"), height.alias("onward"), (height * (F.floor(mx) + 1 - mx)).alias("own"))


def coverage(zones: DataFrame, size: float = 1.0, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """zone_id, x, y, fraction: the share of each cell (column x, row y of a grid of squares of `size` from (x0, y0) on) inside of a zone, where there is any.

    zones: zone_id, ring or rings (arrays of corners x, y; closing the ring is optional). Several rings are parts or holes, whichever way round they go; rings of a
    zone may not cross. Zones may overlap: each has its own shares. Rings of fewer than three corners are left out.
    """
    sums = _pieces(outlines(zones), size, x0, y0).groupBy("zone_id", "y", "x").agg(F.sum("own").alias("own"), F.sum("onward").alias("onward"))
    row = Window.partitionBy("zone_id", "y").orderBy("x")
    along = sums.withColumns({"upto": F.sum("onward").over(row.rowsBetween(Window.unboundedPreceding, 0)), "next": F.lead("x").over(row)})
    outline = along.select("zone_id", "x", "y", (F.col("own") + F.col("upto") - F.col("onward")).alias("fraction"))
    gaps = along.where((F.abs("upto") > LEAST) & (F.col("next") > F.col("x") + 1))
    inner = gaps.select("zone_id", F.explode(F.sequence(F.col("x") + 1, F.col("next") - 1)).alias("x"), "y", F.col("upto").alias("fraction"))
    return outline.unionByName(inner).where(F.col("fraction") > LEAST).withColumn("fraction", F.least("fraction", F.lit(1.0)))


def covered_statistics(cells: DataFrame, shares: DataFrame, keys: list[str], value: str = "value", bins: int = 10, rule: str = "interpolated") -> DataFrame:
    """zone_id, keys, mean, low, high, median (mean and median weighted by the covered share), breaks and counts of round bins of the values.

    cells: x, y, keys, value. shares: zone_id, x, y, fraction. Cells without a value take no part; a zone and key without any has no row.
    """
    by = ["zone_id", *keys]
    rows = pinned(cells.where(F.abs(F.col(value).cast("double")) < float("inf")).join(shares.where("fraction > 0"), ["x", "y"]).select(*by, value, "fraction"))
    stats = rows.groupBy(*by).agg(safe_ratio(F.sum(F.col(value) * F.col("fraction")), F.sum("fraction")).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"))
    for more in (weighted_quantiles(rows, by, value, "fraction", [0.5], rule).withColumnRenamed("q50", "median"), pretty_histogram(rows, by, value, bins)):
        named = more.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(by)), *more.columns[len(by) :])
        stats = stats.join(named, same_keys(by)).drop(*(f"_k{i}" for i in range(len(by))))
    return stats
