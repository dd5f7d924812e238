"""The driver's tables seen as cell series, zones, exposure and thresholds."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Rows that a task gets where it holds nearly every row once for each grouping: some 70 MB for each.
ROWS_PER_TASK = 250_000


def cells(spark: SparkSession, sf: str, rows_per_task: int | None = None) -> DataFrame:
    """cell, year, month, model, hazard, scenario, value.

    rows_per_task: rows go out by key before they are summed (nearly every one has a key of its own, so sums before the shuffle save nothing), about so
    many to a task; what a task holds stays the same however large the table is.
    """
    t = table(spark, sf, "lineitem")
    keys = {"cell": F.col("l_suppkey"), "year": F.year("l_shipdate"), "month": F.month("l_shipdate"), "model": F.col("l_linenumber"), "hazard": F.col("l_returnflag"), "scenario": F.col("l_linestatus")}
    rows = t.select(*(c.alias(k) for k, c in keys.items()), "l_quantity")
    if rows_per_task:
        rows = rows.repartition(max(spark.sparkContext.defaultParallelism, math.ceil(t.count() / rows_per_task)), *keys)
    return rows.groupBy(*keys).agg(F.sum("l_quantity").alias("value"))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("cell"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(F.sum("l_quantity").alias("value"))


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("cell")).distinct().select("cell", (F.col("cell") % 12 + 1).cast("int").alias("plant"), (F.col("cell") % 3 + 2).cast("int").alias("span"))


def zones(spark: SparkSession, sf: str) -> DataFrame:
    n, r = F.broadcast(table(spark, sf, "nation")), F.broadcast(table(spark, sf, "region"))  # 25 and 5 rows, whatever the scale
    return (
        table(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("cell"), F.col("s_name").alias("admin2"), F.col("n_name").alias("admin1"), F.col("r_name").alias("admin0"), F.col("n_nationkey").alias("admin1_code"), F.col("r_regionkey").alias("admin0_code"))
    )


def yearly(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("cell"), F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("hazard")).agg(F.sum("l_quantity").alias("value"))


def flags(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("hazard") == "A", "dry").when(F.col("hazard") == "N", "heat").otherwise("wet")
    flag = F.when(F.col("hazard") == "A", F.col("value") < 700).otherwise(F.col("value") > 700).cast("int")
    return yearly(spark, sf).select("cell", "year", name.alias("hazard"), flag.alias("flag"))


def exposure(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("crop"))
    return table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_suppkey").alias("cell"), "crop").agg(F.sum("l_extendedprice").alias("value"))


def nation_years(spark: SparkSession, sf: str) -> DataFrame:
    n, r = F.broadcast(table(spark, sf, "nation")), F.broadcast(table(spark, sf, "region"))
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy(F.col("n_name").alias("admin1"), F.col("r_name").alias("admin0"), F.year("o_orderdate").alias("year")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))


def heat_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return flags(spark, sf).where("hazard = 'heat'").groupBy("cell").agg(F.avg("flag").alias("p"))
