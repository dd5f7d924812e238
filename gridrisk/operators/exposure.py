"""Exposure: disaggregation of national totals, gap filling, hazard x exposure, comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridrisk.functions.scalars import safe_ratio

#: Livestock units per head.
LIVESTOCK_UNITS = {"cattle": 0.7, "poultry": 0.01, "goats": 0.1, "pigs": 0.2, "sheep": 0.1}
#: Fixed value: t(0.975) with 4 degrees of freedom (five models).
T_975_4 = 2.776445105


def share_of_total(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """share: value over the keys' sum (sum first, then a join: a key may hold most rows)."""
    total = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    return df.join(total, keys).withColumn("share", safe_ratio(value, "_total")).drop("_total")


def distribute(shares: DataFrame, totals: DataFrame, keys: list[str], total: str = "total") -> DataFrame:
    return shares.join(totals, keys, "left").withColumn("allocated", F.col("share") * F.col(total))


def nearby_fill(df: DataFrame, edges: DataFrame, unit: str, region: str, keys: list[str], value: str = "value", include_self: bool = False) -> DataFrame:
    """value, else the neighbours' mean, else the region's mean without the unit itself, else the mean of all; `source` says which."""
    if not df.where(F.col(region).isNull()).isEmpty():
        raise ValueError(f"a {unit} has no {region}")
    near = edges.join(df.select(F.col(unit).alias("neighbour"), *keys, F.col(value).alias("_v")), "neighbour").groupBy(unit, *keys).agg(F.avg("_v").alias("_near"))
    regions = df.groupBy(region, *keys).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    whole = df.groupBy(*keys).agg(F.avg(value).alias("_all"))
    own, has = F.coalesce(F.col(value), F.lit(0.0)), F.col(value).isNotNull().cast("int")
    mean = safe_ratio("_sum", F.col("_n").cast("double")) if include_self else safe_ratio(F.col("_sum") - own, (F.col("_n") - has).cast("double"))
    rows = df.join(near, [unit, *keys], "left").join(regions, [region, *keys])
    rows = rows.join(whole, keys) if keys else rows.join(F.broadcast(whole), F.lit(True))  # one row
    rows = rows.withColumn("_region", mean)
    source = F.when(F.col(value).isNotNull(), "own").when(F.col("_near").isNotNull(), "neighbours").when(F.col("_region").isNotNull(), "region").when(F.col("_all").isNotNull(), "all")
    return rows.withColumn("source", source).withColumn("filled", F.coalesce(value, "_near", "_region", "_all")).drop("_near", "_region", "_all", "_sum", "_n")


def nearby_levels(df: DataFrame, places: DataFrame, edges: DataFrame, value: str = "value") -> DataFrame:
    """df (unit, crop, value) with the means of what the neighbours (near), the others of the region (of_region) and the whole continent (of_continent) have.

    places: unit, region, continent (every unit of df). edges: unit, neighbour.
    """
    rows = df.join(places, "unit")
    near = edges.join(df.select(F.col("unit").alias("neighbour"), "crop", F.col(value).alias("_v")), "neighbour").groupBy("unit", "crop").agg(F.avg("_v").alias("near"))
    region = rows.groupBy("region", "crop").agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    continent = rows.groupBy("continent", "crop").agg(F.avg(value).alias("of_continent"))
    rows = rows.join(near, ["unit", "crop"], "left").join(region, ["region", "crop"]).join(continent, ["continent", "crop"])
    others = safe_ratio(F.col("_sum") - F.coalesce(value, F.lit(0.0)), (F.col("_n") - F.col(value).isNotNull().cast("int")).cast("double"))
    return rows.withColumn("of_region", others).drop("_sum", "_n")


def hybrid_value(production: DataFrame, prices: DataFrame, world: DataFrame, places: DataFrame, edges: DataFrame, per: float = 1000.0, digits: int = 0) -> DataFrame:
    """unit, crop and the value of production in five ways, each the unit's own production times a price: own, near, of_region, of_continent (over `per`, rounded) and of_world.

    The world's price is its value over its production, already in the value's units. value: the first of the five that there is, and step its name; value_nearby leaves
    the world out, value_world has nothing between own and world. A unit without production has none.

    production: unit, crop, production. prices: unit, crop, price (may be null). world: crop, value, production.
    """
    levels = nearby_levels(prices.select("unit", "crop", F.col("price").alias("own")), places, edges, "own")
    of_world = world.groupBy("crop").agg(safe_ratio(F.sum("value"), F.sum("production").cast("double")).alias("_world"))
    rows = production.join(levels, ["unit", "crop"], "left").join(of_world, "crop", "left")
    steps = ["own", "near", "of_region", "of_continent"]
    rows = rows.withColumns({s: F.round(F.col("production") * F.col(s) / per, digits) for s in steps} | {"of_world": F.col("production") * F.col("_world")})
    name = F.coalesce(*(F.when(F.col(s).isNotNull(), F.lit(s)) for s in (*steps, "of_world")))
    return rows.select("unit", "crop", *steps, "of_world", F.coalesce(*steps, "of_world").alias("value"), name.alias("step"), F.coalesce(*steps).alias("value_nearby"), F.coalesce("own", "of_world").alias("value_world"))


def risk_times_exposure(freq: DataFrame, exposure: DataFrame, p: str = "p", value: str = "value") -> DataFrame:
    """at_risk = frequency x exposure, by cell; crops come with the exposure."""
    return freq.join(exposure, "cell").withColumn("at_risk", F.col(p) * F.col(value))


def generic_fan_out(freq: DataFrame, exposure: DataFrame, generic: str = "generic-crop") -> DataFrame:
    """A generic frequency against each crop's exposure, and against the sum of all crops as the generic crop."""
    whole = exposure.groupBy("cell").agg(F.sum("value").alias("value")).withColumn("crop", F.lit(generic))
    return risk_times_exposure(freq, exposure.select("cell", "crop", "value").unionByName(whole))


def no_hazard(any_rows: DataFrame, totals: DataFrame, keys: list[str], value: str = "value", total: str = "total") -> DataFrame:
    rest = any_rows.join(totals, keys).withColumn(value, F.col(total) - F.col(value)).withColumn("hazard", F.lit("no hazard")).drop(total)
    return any_rows.unionByName(rest)


def hazard_groups(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Sums by number of hazards in the label, and by each hazard in any combination."""
    n = F.size(F.split("hazard", r"\+"))
    number = df.groupBy(*keys, F.concat(n.cast("string"), F.when(n == 1, F.lit(" hazard")).otherwise(" hazards")).alias("hazard_group")).agg(F.sum(value).alias(value))
    kind = F.explode(F.split("hazard", r"\+"))
    any_ = df.select(*keys, value, kind.alias("_k")).groupBy(*keys, F.concat("_k", F.lit(" (any)")).alias("hazard_group")).agg(F.sum(value).alias(value))
    return number.unionByName(any_)


def compare(before: DataFrame, after: DataFrame, keys: list[str], total: str | None = None) -> DataFrame:
    """diff and percent of change, keyed; a key on one side only has nulls for the other, not a shifted row (check with quality.same_keys)."""
    both = before.withColumnRenamed("value", "before").join(after.withColumnRenamed("value", "after"), keys, "full")
    return both.withColumn("diff", F.col("after") - F.col("before")).withColumn("pct", 100 * safe_ratio("diff", "before"))


def confidence(df: DataFrame, mean: str, sd: str, n: int = 5) -> DataFrame:
    half = F.lit(T_975_4 / n**0.5) * F.col(sd)
    return df.withColumns({"cv": 100 * safe_ratio(sd, mean), "low": F.col(mean) - half, "high": F.col(mean) + half})


def livestock_units(df: DataFrame, heads: dict[str, str]) -> DataFrame:
    """units: the weighted heads of the named columns."""
    return df.withColumn("units", sum((F.coalesce(F.col(c), F.lit(0.0)) * LIVESTOCK_UNITS[k] for k, c in heads.items()), F.lit(0.0)))


def two_seasons(df: DataFrame, w1: str, w2: str, total: str) -> DataFrame:
    """Split of a total over two seasons by weight (half each without weights)."""
    share2 = F.coalesce(safe_ratio(w2, F.col(w1) + F.col(w2)), F.lit(0.5))
    return df.withColumn("share2", share2).withColumn("season2", F.col(total) * F.col("share2")).withColumn("season1", F.col(total) - F.col("season2"))


def production_value(production: DataFrame, prices: DataFrame, keys: list[str]) -> DataFrame:
    return production.join(prices, keys).withColumn("worth", F.round(F.col("quantity") * F.col("price"), 2))
