"""Returns: adoption curves, benefits, discounting, NPV, MIRR, IRR, avoided loss."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import col, safe_ratio


def adoption(goal: str | Column, rate: float, year: str | Column, digits: int | None = None) -> Column:
    """Adoption after n years: each closes `rate` of the gap to the goal; with digits, rounded every year as a fold."""
    if digits is None:
        return col(goal) * (1 - F.pow(F.lit(1 - rate), col(year)))
    return F.aggregate(F.sequence(F.lit(1), col(year)), F.lit(0.0), lambda a, _: F.round(a + (col(goal) - a) * rate, digits))


def adoption_average(df: DataFrame, goals: list[float], rate: float, first_year: int, value: str = "value") -> DataFrame:
    """goal, year and the means of what adopters have, what others have, and the percent that adopts, for every goal. The first year of adoption is first_year."""
    rows = df.withColumn("goal", F.explode(F.array(*map(F.lit, goals)))).withColumn("_a", adoption(F.col("goal"), rate, F.col("year") - (first_year - 1)))
    share = F.col(value) * F.col("_a")
    return rows.groupBy("goal", "year").agg(F.avg(share).alias("adopters"), F.avg(F.col(value) - share).alias("others"), F.avg(100 * F.col("_a")).alias("pct"))


def avoided_loss(sd_without: str | Column, sd_with: str | Column) -> Column:
    """Expected lower-half loss that a smaller spread avoids, not below 0; null for a negative spread."""
    gain = (col(sd_without) - col(sd_with)) / math.sqrt(2 * math.pi)
    return F.when(col(sd_with) >= 0, F.greatest(gain, F.lit(0.0)))


def running(keys: list[str], by: str = "t"):
    return Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def npv(df: DataFrame, keys: list[str], rate: float, flow: str = "flow", t: str = "t") -> DataFrame:
    return df.withColumn("npv", F.sum(col(flow) / F.pow(F.lit(1 + rate), col(t))).over(running(keys, t)))


def mirr(df: DataFrame, keys: list[str], finance: float, reinvest: float, flow: str = "flow", t: str = "t") -> DataFrame:
    """Modified internal rate of return of each prefix; null without inflow, outflow or time."""
    w = running(keys, t)
    inflow = F.sum(F.greatest(col(flow), F.lit(0.0)) / F.pow(F.lit(1 + reinvest), col(t))).over(w) * F.pow(F.lit(1 + reinvest), col(t))
    outflow = F.sum(F.greatest(-col(flow), F.lit(0.0)) / F.pow(F.lit(1 + finance), col(t))).over(w)
    rows = df.withColumns({"_in": inflow, "_out": outflow})
    ok = (F.col("_in") > 0) & (F.col("_out") > 0) & (col(t) > 0)
    return rows.withColumn("mirr", F.when(ok, F.pow(F.col("_in") / F.col("_out"), 1.0 / col(t)) - 1)).drop("_in", "_out")


def irr(df: DataFrame, keys: list[str], flow: str = "flow", t: str = "t", low: float = -0.9, high: float = 10.0, steps: int = 60) -> DataFrame:
    """Internal rate of return of each prefix by bisection on the collected flows (a project's years); null where the ends don't differ in sign."""
    rows = df.withColumn("_flows", F.collect_list(F.struct(col(t).cast("double").alias("t"), col(flow).cast("double").alias("c"))).over(running(keys, t)))

    def worth(flows: Column, r: Column) -> Column:
        return F.aggregate(flows, F.lit(0.0), lambda a, x: a + x["c"] / F.pow(1 + r, x["t"]))

    flows = F.col("_flows")
    start = F.struct(F.lit(low).alias("lo"), F.lit(high).alias("hi"), worth(flows, F.lit(low)).alias("at"))

    def halve(s: Column, _: Column) -> Column:
        mid = (s["lo"] + s["hi"]) / 2
        up = F.signum(worth(flows, mid)) == F.signum(s["at"])
        return F.struct(F.when(up, mid).otherwise(s["lo"]).alias("lo"), F.when(up, s["hi"]).otherwise(mid).alias("hi"), s["at"].alias("at"))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)
    crosses = F.signum(worth(flows, F.lit(low))) * F.signum(worth(flows, F.lit(high))) < 0
    return rows.withColumn("irr", F.when(crosses, (end["lo"] + end["hi"]) / 2)).drop("_flows")


def discounted_ratio(df: DataFrame, keys: list[str], rate: float, benefit: str, cost: str, t: str = "t", delay: int = 0) -> DataFrame:
    """Running discounted benefits (delayed by some years) over costs."""
    late = F.lag(benefit, delay, 0.0).over(Window.partitionBy(*keys).orderBy(t)) if delay else col(benefit)
    d = F.pow(F.lit(1 + rate), col(t))
    rows = df.withColumn("_late", late)
    return rows.withColumn("bcr", safe_ratio(F.sum(F.col("_late") / d).over(running(keys, t)), F.sum(col(cost) / d).over(running(keys, t)))).drop("_late")
