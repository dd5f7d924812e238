"""Queries of listings, gates, sidecars and writes by key, over files that they write to the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridrisk.operators import rules as R
from gridrisk.plans import fixtures as X
from gridrisk.plans.registry import SQL, query
from gridrisk.plans.rule_queries import subset_rows
from gridrisk.plans.source_queries import scratch
from gridrisk.sources import keyed as K


def _model_files(spark, sf):
    """A folder of files, one a scenario, hazard and model; returns its path."""
    path, keys = scratch(spark, "models"), ["scenario", "hazard", "model"]
    X.cells(spark, sf).groupBy(*keys, "cell").agg(F.sum("value").alias("value")).repartition(*keys).write.partitionBy(*keys).parquet(path)
    return path


@query("s10_listed_files", "SELECT scenario, hazard, count(DISTINCT model) AS files FROM cells GROUP BY ALL", "cells")
def _(spark, sf):
    found = K.files(spark, _model_files(spark, sf), "*.parquet")
    return found.groupBy(*(K.folder_key("path", k).alias(k) for k in ("scenario", "hazard"))).agg(F.count(F.lit(1)).alias("files"))


@query("s11_listed_series", "SELECT scenario, count(DISTINCT model) FILTER (hazard = 'A') AS A, count(DISTINCT model) FILTER (hazard = 'N') AS N, count(DISTINCT model) FILTER (hazard = 'R') AS R FROM cells GROUP BY ALL", "cells")
def _(spark, sf):
    found = K.files(spark, _model_files(spark, sf), "*.parquet")
    keys = found.select(*(K.folder_key("path", k).alias(k) for k in ("scenario", "hazard", "model")))
    return K.complete_series(keys, ["scenario"], (0, 7), by="hazard", of=["A", "N", "R"])  # seven models, or a scenario that has none of the hazard


@query("s16_written_sidecar", "SELECT count(*) AS n_rows, list_sort(list(DISTINCT hazard)) AS hazard, list_sort(list(DISTINCT year)) AS year, CAST(min(cell) AS VARCHAR) AS cell_least, CAST(max(cell) AS VARCHAR) AS cell_most, 'lineitem' AS source FROM yearly", "yearly")
def _(spark, sf):
    meta = K.write_described(X.yearly(spark, sf), scratch(spark, "described"), ["hazard", "year", "cell"], ["hazard"], source="lineitem")
    return meta.select("n_rows", "hazard", "year", "cell_least", "cell_most", "source")


@query("s17_missing_keys", "SELECT cell, year, hazard, value, hazard <> 'A' AS second FROM yearly", "yearly")
def _(spark, sf):
    """The second run finds hazard A there and makes the others only."""
    path, y = scratch(spark, "missing"), X.yearly(spark, sf)
    K.write_missing(y.where("hazard = 'A'"), lambda todo: K.rows_of(y.withColumn("second", F.lit(False)), todo, ["hazard"]), path, ["hazard"])
    K.write_missing(y, lambda todo: K.rows_of(y.withColumn("second", F.lit(True)), todo, ["hazard"]), path, ["hazard"])
    return spark.read.parquet(path).select("cell", "year", "hazard", "value", "second")


@query("f13_keyed_write", SQL["f13_analytic_subset"])
def _(spark, sf):
    """The subset in one write, a folder for each combination, severity and period."""
    path, keys = scratch(spark, "subset"), ["hazard_vars", "severity", "scenario_x_time"]
    own = R.analytic_subset(subset_rows(spark, sf), "dry+heat+wet", {"Brand#15": "THI", "Brand#25": "THI"}, ["A", "N"], [("F", "1997"), ("O", "1998")], ["Brand#9"])
    sums = own.groupBy("crop", *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    K.write_missing(own, lambda todo: K.rows_of(sums, todo, keys), path, keys, sort=["crop"])
    return spark.read.schema(sums.schema).parquet(path).select(*sums.columns)
