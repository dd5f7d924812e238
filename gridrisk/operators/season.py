"""Seasons: crop calendars, annual and rolling windows, season values with completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridrisk.functions.scalars import col, wrap_month

#: The rolling three-month seasons and the year (label, first month, length).
SEASONS = (("JFM", 1, 3), ("FMA", 2, 3), ("MAM", 3, 3), ("AMJ", 4, 3), ("MJJ", 5, 3), ("JJA", 6, 3), ("JAS", 7, 3), ("ASO", 8, 3), ("SON", 9, 3), ("OND", 10, 3), ("NDJ", 11, 3), ("DJF", 12, 3), ("annual", 1, 12))


def statistic(value: str | Column, stat: str) -> Column:
    """The named aggregate; an unknown name is an error."""
    known = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min}
    if stat not in known:
        raise ValueError(f"statistic {stat!r} is not one of {sorted(known)}")
    return known[stat](col(value))


def calendar(df: DataFrame, plant: str, harvest: str) -> DataFrame:
    """Month numbers wrapped to 1..12 and `span`, the months after planting that belong to the season."""
    p, h = wrap_month(plant), wrap_month(harvest)
    return df.withColumns({plant: p, harvest: h}).withColumn("span", F.when(F.col(harvest) >= F.col(plant), F.col(harvest) - F.col(plant)).otherwise(F.col(harvest) + 12 - F.col(plant)))


def in_season(series: DataFrame, cal: DataFrame | None, cell: str = "cell", plant: str | int = "plant", annual: bool = False) -> DataFrame:
    """Rows of the season with season_year: months counted from planting, `span` of them (annual: twelve)."""
    joined = series.join(cal, cell) if cal is not None else series
    start = F.lit(plant) if isinstance(plant, int) else F.col(plant)
    off = F.col("year") * 12 + F.col("month") - start
    span = F.lit(11) if annual else F.col("span")
    return joined.withColumn("season_year", F.floor(off / 12).cast("int")).withColumn("_pos", F.pmod(off, F.lit(12))).where(F.col("_pos") <= span).drop("_pos")


def roll_up(series: DataFrame, cal: DataFrame, keys: list[str], stat: str, annual: bool = False, years: tuple[int, int] | None = None) -> DataFrame:
    """One value per cell, keys and season year; the last input year, whose season may be cut, is dropped. With years (first, last) given, the input isn't read a second time to find them."""
    out = in_season(series, cal, annual=annual).groupBy("cell", *keys, "season_year").agg(statistic("value", stat).alias("value"), F.count("value").alias("n_months"))
    if years:
        return out.where((F.col("season_year") >= years[0]) & (F.col("season_year") < years[1]))
    last = series.agg(F.max("year").alias("_last"), F.min("year").alias("_first"))
    return out.join(F.broadcast(last), (F.col("season_year") < F.col("_last")) & (F.col("season_year") >= F.col("_first"))).drop("_last", "_first")  # one row


def rolling_seasons(series: DataFrame, keys: list[str], stat: str, seasons=SEASONS) -> DataFrame:
    """value and n_value for each season of each year (a season belongs to the year in which it begins), with whether all its months are there."""
    spark = series.sparkSession
    table = spark.createDataFrame([*seasons], "season string, first int, months int")
    pos = F.pmod(F.col("month") - F.col("first"), F.lit(12))
    rows = series.join(F.broadcast(table), pos < F.col("months"))  # 13 rows
    year = F.when(F.col("month") >= F.col("first"), F.col("year")).otherwise(F.col("year") - 1).cast("int")
    return rows.withColumn("season_year", year).groupBy(*keys, "season", "season_year").agg(statistic("value", stat).alias("value"), F.count("value").alias("n_value"), (F.countDistinct("month") == F.first("months")).alias("complete"))


def quarters(series: DataFrame, keys: list[str]) -> DataFrame:
    """keys, q (0: December to February, then in threes), first_year (of the quarter's first month), complete (all three months are there) and the quarter's sum."""
    q = F.expr("cast((month % 12) div 3 as int)")
    first = F.when((F.col("q") == 0) & (F.col("month") < 12), F.col("year") - 1).otherwise(F.col("year"))
    return series.withColumn("q", q).groupBy(*keys, "q", first.alias("first_year")).agg((F.countDistinct("month") == 3).alias("complete"), F.sum("value").alias("value"))


def month_runs(series: DataFrame, keys: list[str]) -> DataFrame:
    """Islands of consecutive months, labelled with their first year and month."""
    from pyspark.sql import Window

    at = F.col("year") * 12 + F.col("month") - 1
    w = Window.partitionBy(*keys).orderBy("_at")
    rows = series.select(*keys, "year", "month", at.alias("_at")).distinct().withColumn("_island", F.col("_at") - F.row_number().over(w))
    return rows.groupBy(*keys, "_island").agg(F.min("_at").alias("_a"), F.count(F.lit(1)).alias("n_months")).select(*keys, F.floor(F.col("_a") / 12).cast("int").alias("first_year"), (F.pmod("_a", F.lit(12)) + 1).cast("int").alias("first_month"), "n_months")
