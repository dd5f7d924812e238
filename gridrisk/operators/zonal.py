"""Zones: zonal statistics, admin hierarchy, weighted statistics, histograms, disputed areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import pretty_step, safe_ratio
from gridrisk.operators.ordered import same_keys, weighted_quantiles  # noqa: F401  (a zonal statistic too)

ADMIN = ["admin0", "admin1", "admin2"]


def zonal(cells: DataFrame, cell_zone: DataFrame, keys: list[str], zone: list[str], stats: tuple[str, ...] = ("mean",), value: str = "value") -> DataFrame:
    """Statistics of the cells of each zone: an equi-join on the cell, then one aggregation."""
    made = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "sd": F.stddev_samp, "n": F.count}
    return cells.join(cell_zone, "cell").groupBy(*zone, *keys).agg(*(made[s](value).alias(s) for s in stats))


def roll_up_admin(df: DataFrame, keys: list[str], value: str = "value", levels: list[str] = ADMIN) -> DataFrame:
    """Sums at every admin level, lower levels null. The finest sums come first, so that only they are expanded to the levels."""
    df = df.groupBy(*levels, *keys).agg(F.sum(value).alias(value))
    sets = [[F.col(c) for c in [*levels[: n + 1], *keys]] for n in range(len(levels))]
    return df.groupingSets(sets, *levels, *keys).agg(F.sum(value).alias(value))


def margins(df: DataFrame, keys: list[str], value: str = "value", label: str = "all") -> DataFrame:
    """Sums over every subset of the keys; a key summed over reads `all`."""
    out = df.groupBy(*keys).agg(F.sum(value).alias(value)).cube(*keys).agg(F.sum(value).alias(value), *(F.grouping(k).alias(f"_g_{k}") for k in keys))
    return out.select(*(F.when(F.col(f"_g_{k}") == 1, label).otherwise(F.col(k)).alias(k) for k in keys), value)


def weighted_mean(value: str, weight: str):
    return safe_ratio(F.sum(F.col(value) * F.col(weight)), F.sum(F.when(F.col(value).isNotNull(), F.col(weight))))


def histogram(df: DataFrame, keys: list[str], value: str, low: float, width: float, bins: int) -> DataFrame:
    """Counts of right-closed bins (the first one closed on both sides) as an ordered array; values outside aren't counted."""
    at = F.when(F.col(value) == low, 1).otherwise(F.ceil((F.col(value) - low) / width)).cast("int")
    counts = df.where((F.col(value) >= low) & (F.col(value) <= low + width * bins)).groupBy(*keys).agg(*(F.sum((at == b).cast("int")).alias(f"_b{b}") for b in range(1, bins + 1)))
    return counts.select(*keys, F.array(*(F.col(f"_b{b}") for b in range(1, bins + 1))).alias("counts"))


def pretty_histogram(df: DataFrame, keys: list[str], value: str, bins: int = 10) -> DataFrame:
    """breaks and counts as ordered arrays: about `bins` equal bins of a 1-2-5 step over each key's range, so their number differs by key.

    Bins are right-closed, the first one closed on both sides; a value within 1e-7 of a step above a break counts as on it. Counts are summed
    by bin before anything is put together, so a key's rows never meet in one task. Nulls and values that aren't finite aren't counted; a key without others is left out.
    """
    rows = df.where(F.abs(F.col(value).cast("double")) < float("inf"))
    ends = rows.groupBy(*keys).agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    step, first, last = pretty_step("_lo", "_hi", bins)
    ends = ends.withColumn("_step", step).withColumns({"_first": first, "_last": last})
    named = ends.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_step", "_first", "_last")
    at = F.greatest(F.ceil(F.col(value) / F.col("_step") - F.col("_first") - 1e-7), F.lit(1)).cast("int")
    counts = rows.join(named, same_keys(keys)).groupBy(*keys, "_step", "_first", "_last", at.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    # a row for each bin from here on
    made = counts.groupBy(*keys, "_step", "_first", "_last").agg(F.map_from_entries(F.collect_list(F.struct("_bin", "_n"))).alias("_of"))
    size = (F.col("_last") - F.col("_first")).cast("int")
    breaks = F.transform(F.sequence(F.lit(0), size), lambda i: (F.col("_first") + i) * F.col("_step"))
    return made.select(*keys, breaks.alias("breaks"), F.transform(F.sequence(F.lit(1), size), lambda i: F.coalesce(F.try_element_at("_of", i), F.lit(0).cast("long"))).alias("counts"))


def area_share(df: DataFrame, keys: list[str], area: str, **conditions) -> DataFrame:
    """Percent of the area that meets each condition."""
    return df.groupBy(*keys).agg(*(safe_ratio(100 * F.sum(F.when(c, F.col(area)).otherwise(0.0)), F.sum(area)).alias(n) for n, c in conditions.items()))


def transition_matrix(df: DataFrame, before: str, after: str, area: str, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys, (F.col(before) + 10 * F.col(after)).alias("transition")).agg(F.sum(area).alias("area"))


def merge_disputed(df: DataFrame, claims: DataFrame, code: str, keys: list[str], value: str = "value", cells: str = "n_cells") -> DataFrame:
    """Rows of disputed codes join their claimant's: means are weighted by cell counts. claims: disputed, claimant."""
    joined = df.join(claims, F.col(code) == F.col("disputed"), "left").withColumn(code, F.coalesce("claimant", code))
    return joined.groupBy(code, *keys).agg(safe_ratio(F.sum(F.col(value) * F.col(cells)), F.sum(cells)).alias(value), F.sum(cells).alias(cells))


def majority(df: DataFrame, child: str, parent: str) -> DataFrame:
    """The parent that most rows of a child have (ties: the smallest)."""
    n = df.groupBy(child, parent).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("_r", F.row_number().over(Window.partitionBy(child).orderBy(F.desc("n"), parent))).where("_r = 1").drop("_r")


def second_zone_table(zones: DataFrame, second: DataFrame, zone: str, other: str) -> DataFrame:
    """zone, other, cells, pct: how many cells of each zone lie in each of the second zones, and their percent of the zone's cells in any. zones: cell, zone. second: cell, other."""
    both = zones.select("cell", zone).join(second.select("cell", other), "cell").groupBy(zone, other).agg(F.count(F.lit(1)).alias("cells"))
    whole = both.groupBy(zone).agg(F.sum("cells").alias("_whole"))
    return both.join(whole, zone).select(zone, other, "cells", (100.0 * safe_ratio("cells", F.col("_whole").cast("double"))).alias("pct"))


def share_of_total_row(df: DataFrame, zone: str, kind: str, value: str = "value", total: str = "total") -> DataFrame:
    """df with a row `total` for each zone (sums of its numbers) and pct: each value's percent of that row's."""
    numbers = [c for c in df.columns if c not in (zone, kind)]
    rows = df.unionByName(df.groupBy(zone).agg(*(F.sum(c).alias(c) for c in numbers)).withColumn(kind, F.lit(total)))
    whole = F.max(F.when(F.col(kind) == total, F.col(value))).over(Window.partitionBy(zone))
    return rows.withColumn("pct", 100 * safe_ratio(value, whole))


def dominant(df: DataFrame, keys: list[str], label: str, value: str) -> DataFrame:
    """The label with the largest value; equal ones are joined in order."""
    top = df.withColumn("_m", F.max(value).over(Window.partitionBy(*keys))).where(F.col(value) == F.col("_m"))
    return top.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(label)), "+").alias(label), F.first("_m").alias(value))


def top_and_other(df: DataFrame, group: str, value: str, n: int, label: str = "other") -> DataFrame:
    """Sums of the n largest groups, the rest as one."""
    total = df.groupBy(group).agg(F.sum(value).alias(value))
    top = total.orderBy(F.desc(value), group).limit(n).select(F.col(group).alias("_top"))  # n rows
    return total.join(F.broadcast(top), F.col(group) == F.col("_top"), "left").groupBy(F.when(F.col("_top").isNull(), label).otherwise(F.col(group)).alias(group)).agg(F.sum(value).alias(value))
