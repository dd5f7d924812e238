"""Anomalies, first and last years, robust trends, variation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import normal_tail, safe_ratio


def anomalies(df: DataFrame, keys: list[str], first: int, last: int) -> DataFrame:
    base = df.where(F.col("year").between(first, last)).groupBy(*keys).agg(F.avg("value").alias("baseline_value"))
    return df.join(base, keys, "left").withColumn("anomaly", F.col("value") - F.col("baseline_value"))


def first_and_last(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """Means of the first and last n years and their difference."""
    w = Window.partitionBy(*keys)
    rows = df.withColumns({"_a": F.row_number().over(w.orderBy("year")), "_z": F.row_number().over(w.orderBy(F.desc("year")))})
    out = rows.groupBy(*keys).agg(F.avg(F.when(F.col("_a") <= n, F.col("value"))).alias("first_mean"), F.avg(F.when(F.col("_z") <= n, F.col("value"))).alias("last_mean"))
    return out.withColumn("change", F.col("last_mean") - F.col("first_mean"))


#: Years of a series at most: pairs grow with its square, so a longer one (days, say) is an error.
YEARS = 200


def _pairs(df: DataFrame, keys: list[str]) -> DataFrame:
    """All pairs of years in a series; a series is one value a year, YEARS of them at most (checked as the pairs are made)."""
    long = F.raise_error(F.concat(F.lit(f"a series has more than {YEARS} values: "), F.to_json(F.struct(*keys)))).cast("boolean")
    checked = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.when(F.col("_n") <= YEARS, True).otherwise(long)).drop("_n")
    df = df.join(checked, keys)
    a, b = df.select(*keys, F.col("year").alias("y1"), F.col("value").alias("v1")), df.select(*keys, F.col("year").alias("y2"), F.col("value").alias("v2"))
    return a.join(b, keys).where(F.col("y1") < F.col("y2"))


def theil_sen(df: DataFrame, keys: list[str]) -> DataFrame:
    """Median of all pair slopes and the median intercept."""
    slope = _pairs(df, keys).groupBy(*keys).agg(F.median((F.col("v2") - F.col("v1")) / (F.col("y2") - F.col("y1"))).alias("slope"))
    return df.join(slope, keys).groupBy(*keys, "slope").agg(F.median(F.col("value") - F.col("slope") * F.col("year")).alias("intercept"))


def mann_kendall(df: DataFrame, keys: list[str]) -> DataFrame:
    """S, its variance with ties, z and the two-sided p."""
    s = _pairs(df, keys).groupBy(*keys).agg(F.sum(F.signum(F.col("v2") - F.col("v1"))).cast("long").alias("s"))
    t = df.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("t")).groupBy(*keys).agg(F.sum("t").alias("n"), F.sum(F.col("t") * (F.col("t") - 1) * (2 * F.col("t") + 5)).alias("ties"))
    out = t.join(s, keys).withColumn("var", (F.col("n") * (F.col("n") - 1) * (2 * F.col("n") + 5) - F.col("ties")) / 18.0)
    out = out.withColumn("z", F.when(F.col("s") == 0, 0.0).otherwise(safe_ratio(F.col("s") - F.signum(F.col("s").cast("double")), F.sqrt("var"))))
    return out.withColumn("p", 2 * normal_tail(F.abs("z"))).drop("ties")


def sen_interval(df: DataFrame, keys: list[str], z: float = 1.959964) -> DataFrame:
    """Confidence limits of the Sen slope: the ranks (N -+ z sqrt(var)) / 2 of the sorted pair slopes."""
    w = Window.partitionBy(*keys)
    slopes = _pairs(df, keys).withColumn("_s", (F.col("v2") - F.col("v1")) / (F.col("y2") - F.col("y1")))
    ranked = slopes.withColumns({"_r": F.row_number().over(w.orderBy("_s")), "_n": F.count(F.lit(1)).over(w)}).join(mann_kendall(df, keys).select(*keys, "var"), keys)
    half = F.lit(z) * F.sqrt("var")
    lo, hi = F.greatest(F.round((F.col("_n") - half) / 2), F.lit(1.0)), F.least(F.round((F.col("_n") + half) / 2) + 1, F.col("_n").cast("double"))
    return ranked.groupBy(*keys).agg(F.max(F.when(F.col("_r") == lo, F.col("_s"))).alias("slope_low"), F.max(F.when(F.col("_r") == hi, F.col("_s"))).alias("slope_high"))


def variation(df: DataFrame, keys: list[str], least: int = 10) -> DataFrame:
    """Coefficient of variation; null under `least` values or for a constant series."""
    ok = (F.count("value") >= least) & (F.countDistinct("value") > 1)
    return df.groupBy(*keys).agg(F.when(ok, safe_ratio(F.stddev_samp("value"), F.avg("value"))).alias("cv"))


def linear_fit(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Slope, intercept, adjusted R2, RMSE, mean ratio and the CV left after the fit."""
    n, r2 = F.count(F.lit(1)), F.regr_r2(y, x)
    sse = F.regr_syy(y, x) * (1 - r2)
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), (1 - (1 - r2) * (n - 1) / F.nullif(n - 2, F.lit(0))).alias("adj_r2"),
        F.sqrt(sse / n).alias("rmse"), safe_ratio(F.sqrt(sse / (n - 1)), F.avg(y)).alias("detrended_cv"),
    )
