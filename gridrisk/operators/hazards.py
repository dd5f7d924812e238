"""Thresholds, frequencies, ensembles, compound hazards and severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import classify, col, safe_ratio

#: Codes of compound hazards.
COMBOS = ((1, "dry"), (10, "heat"), (11, "dry+heat"), (100, "wet"), (101, "dry+wet"), (110, "heat+wet"), (111, "dry+heat+wet"))


def classify_all(series: DataFrame, thresholds: DataFrame, on: list[str], value: str = "value") -> DataFrame:
    """Every series value against every distinct threshold of its key: columns direction, threshold, flag."""
    distinct = thresholds.select(*on, "direction", "threshold").distinct()
    return series.join(distinct, on).withColumn("flag", classify(value, F.col("direction"), F.col("threshold")))  # thresholds: a table of classes, fixed in size


def share_beyond(value: str, direction: str, threshold: float) -> Column:
    """Share of all rows beyond the threshold; missing values count in the denominator."""
    return F.sum(F.coalesce(classify(value, direction, threshold), F.lit(0))) / F.count(F.lit(1))


def exceedance(value: str, direction: str, threshold: float, how: str = "mean") -> Column:
    """Mean or largest distance beyond the threshold; 0 if never beyond, null without values."""
    hit = F.when(classify(value, direction, threshold) == 1, F.abs(col(value) - F.lit(threshold)))
    got = F.avg(hit) if how == "mean" else F.max(hit)
    return F.when(F.count(col(value)) > 0, F.coalesce(got, F.lit(0.0)))


def class_profile(df: DataFrame, keys: list[str], value: str, direction: str, threshold: float, share: float) -> DataFrame:
    """Per key: mean, its class, share of years beyond, its class, mean and largest exceedance."""
    m, p = F.avg(value), F.avg(classify(value, direction, threshold))
    return df.groupBy(*keys).agg(
        m.alias("mean"), classify(m, direction, threshold).alias("mean_class"), p.alias("share"), (p > share).cast("int").alias("share_class"),
        exceedance(value, direction, threshold).alias("exceed_mean"), exceedance(value, direction, threshold, "max").alias("exceed_max"),
    )


def frequency(df: DataFrame, keys: list[str], flag: str = "flag") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(flag).alias("frequency"))


def ensemble(df: DataFrame, keys: list[str], value: str = "value", strict: bool = True) -> DataFrame:
    """Mean and sd over models; strict: null if a model's value is missing."""
    whole = F.count(value) == F.count(F.lit(1)) if strict else F.lit(True)
    return df.groupBy(*keys).agg(F.when(whole, F.avg(value)).alias("mean"), F.when(whole, F.stddev_samp(value)).alias("sd"), F.count(F.lit(1)).alias("n_models"))


def compound_code(df: DataFrame, keys: list[str], hazard: str = "hazard", flag: str = "flag", skip_missing: bool = False) -> DataFrame:
    """dry + 10 heat + 100 wet per key; null if one of the three is missing (or 0 for it)."""

    def one(name: str) -> Column:
        got = F.max(F.when(F.col(hazard) == name, F.col(flag)))
        return F.coalesce(got, F.lit(0)) if skip_missing else got

    return df.groupBy(*keys).agg((one("dry") + one("heat") * 10 + one("wet") * 100).alias("code"))


def interactions(codes: DataFrame, keys: list[str], code: str = "code") -> DataFrame:
    """Frequency of each exact combination and of any hazard."""
    exact = [F.avg((F.col(code) == c).cast("int")).alias(n.replace("+", "_")) for c, n in COMBOS]
    return codes.groupBy(*keys).agg(F.avg((F.col(code) >= 1).cast("int")).alias("any_hazard"), *exact)


def hazard_combinations(wide: DataFrame, hazards: list[str], keys: list[str]) -> DataFrame:
    """Label of the hazards that are set, their number, and a dense number of the combination by (number, label)."""
    label = F.array_join(F.filter(F.array(*(F.when(F.col(h) == 1, F.lit(h)) for h in hazards)), lambda x: x.isNotNull()), "+")
    n = sum((F.coalesce(F.col(h), F.lit(0)) for h in hazards), F.lit(0)).cast("int")
    rows = wide.select(*keys, F.when(n == 0, "none").otherwise(label).alias("label"), n.alias("n_hazards"))
    index = rows.select("label", "n_hazards").distinct()  # at most 2 ** len(hazards) rows
    index = index.withColumn("combo", (F.dense_rank().over(Window.orderBy("n_hazards", "label")) - 1).cast("int"))
    return rows.join(F.broadcast(index), ["label", "n_hazards"])


def exclusive_from_overlaps(df: DataFrame, one: str, two: str, three: str, total: str) -> DataFrame:
    """Areas with exactly one, two and three hazards from the overlapping sums, any, and their percent of the total."""
    return df.withColumns({"only_one": col(one) - 2 * col(two) + 3 * col(three), "only_two": col(two) - 3 * col(three), "only_three": col(three)}).withColumn("any_hazard", F.col("only_one") + F.col("only_two") + F.col("only_three")).withColumn("any_pct", 100 * safe_ratio("any_hazard", total))


def any_of_independent(df: DataFrame, keys: list[str], p: str) -> DataFrame:
    return df.groupBy(*keys).agg((1 - F.product(1 - col(p))).alias("p_any"), F.product(col(p)).alias("p_all"))


def hazard_index(df: DataFrame, keys: list[str], severity: str = "severity", p: str = "frequency") -> DataFrame:
    """Exclusive shares of moderate, severe, extreme (not below 0), weighted 1, 2, 3."""
    m, s, e = (F.coalesce(F.max(F.when(F.col(severity) == x, F.col(p))), F.lit(0.0)) for x in ("Moderate", "Severe", "Extreme"))
    return df.groupBy(*keys).agg(F.greatest(m - s, F.lit(0.0)).alias("moderate"), F.greatest(s - e, F.lit(0.0)).alias("severe"), e.alias("extreme")).withColumn("hazard_index", F.col("moderate") + 2 * F.col("severe") + 3 * F.col("extreme"))


def merged_severity(df: DataFrame, keys: list[str], weights: dict[str, int], severity: str = "severity", flag: str = "flag") -> DataFrame:
    """The worst severity that is set, as number and label; 0 and None if none is."""
    w = F.coalesce(*(F.when(F.col(severity) == k, F.lit(v)) for k, v in weights.items()))
    out = df.groupBy(*keys).agg(F.max(F.col(flag) * w).alias("severity_class"))
    label = F.when(F.col("severity_class") == 0, "None")
    for k, v in weights.items():
        label = label.when(F.col("severity_class") == v, k)
    return out.withColumn("label", label)


def suspect_series(df: DataFrame, keys: list[str], low: float = -10, high: float = 3000, value: str = "value", drop: bool = False) -> DataFrame:
    """suspect_value_flag for all rows of a series with any value outside [low, high]; drop leaves those out."""
    bad = F.coalesce(((F.col(value) < low) | (F.col(value) > high)).cast("int"), F.lit(0))
    out = df.withColumn("suspect_value_flag", F.max(bad).over(Window.partitionBy(*keys)) == 1)
    return out.where("not suspect_value_flag") if drop else out


def heat_days(daily: DataFrame, keys: list[str], value: str, thresholds: list[float]) -> DataFrame:
    """Days above each threshold, in one pass over the days: counts by threshold, then one row for each."""
    counts = daily.groupBy(*keys).agg(*(F.sum((F.col(value) > t).cast("int")).alias(f"_t{i}") for i, t in enumerate(thresholds)))
    rows = F.array(*(F.struct(F.lit(float(t)).alias("threshold"), F.coalesce(F.col(f"_t{i}"), F.lit(0)).alias("days")) for i, t in enumerate(thresholds)))
    return counts.select(*keys, F.inline(rows))


def merge_over_crops(df: DataFrame, cell: str, n_hazards: str = "n_hazards", flag: str = "flag") -> DataFrame:
    """Per cell over all crops: at risk of exactly one, exactly two, any."""
    return df.groupBy(cell).agg(*(F.max(F.when(F.col(n_hazards) == k, F.col(flag)).otherwise(0)).alias(n) for k, n in ((1, "one"), (2, "two"))), F.max(flag).alias("any_hazard"))
