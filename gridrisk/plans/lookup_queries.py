"""Queries of masks, second zone tables, labels, gates and patches; their SQL states each rule by itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridrisk.functions.scalars import break_sequence, interval_class, recode, safe_ratio
from gridrisk.operators import economics as E
from gridrisk.operators import exposure as G
from gridrisk.operators import grid, rules
from gridrisk.operators import season as S
from gridrisk.operators import zonal as Z
from gridrisk.plans import fixtures as X
from gridrisk.plans.exposure_queries import FILL, OTHERS
from gridrisk.plans.exposure_queries import _edges as edges
from gridrisk.plans.registry import query
from gridrisk.plans.source_queries import scratch
from gridrisk.sources import tables as IO

#: Bins of prices (from, width, how many).
LOW, WIDTH, BINS = 900, 150, 8
_bins = ", ".join(f"CAST(coalesce(sum(n) FILTER (v {'>=' if b == 0 else '>'} {LOW + b * WIDTH} AND v <= {LOW + (b + 1) * WIDTH}), 0) AS BIGINT)" for b in range(BINS))


@query("a30_weighted_median_histogram", f"SELECT * FROM (WITH t AS (SELECT p_brand AS crop, p_retailprice AS v, sum(l_quantity) AS w, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL), r AS (SELECT *, sum(w) OVER (PARTITION BY crop ORDER BY v ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY crop) AS total FROM t) SELECT crop, sum(v * w) / sum(w) AS mean, min(v) AS low, max(v) AS high, min(v) FILTER (run >= 0.5 * total) AS median, [{_bins}] AS counts FROM r GROUP BY crop)")
def _(spark, sf):
    part = X.table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("crop"), F.col("p_retailprice").alias("price"))
    rows = X.table(spark, sf, "lineitem").select("l_partkey", F.col("l_quantity").alias("weight")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    stats = rows.groupBy("crop").agg(Z.weighted_mean("price", "weight").alias("mean"), F.min("price").alias("low"), F.max("price").alias("high"))
    middle = Z.weighted_quantiles(rows, ["crop"], "price", "weight", [0.5]).withColumnRenamed("q50", "median")
    bins = Z.histogram(rows, ["crop"], "price", LOW, WIDTH, BINS)
    return stats.join(middle, "crop").join(bins, "crop", "left").withColumn("counts", F.coalesce("counts", F.array_repeat(F.lit(0).cast("long"), BINS)))


@query("a61_herd_losses", "SELECT * FROM (WITH h AS (SELECT c_nationkey AS code, CASE WHEN c_mktsegment = 'BUILDING' THEN 'cattle' ELSE 'goats' END AS animal, greatest(c_acctbal, 0) AS heads, -(c_custkey % 10) / 100.0 AS change FROM customer), s AS (SELECT code, sum(heads * change) / nullif(sum(heads), 0) AS change, coalesce(sum(heads) FILTER (animal = 'cattle'), 0) / nullif(sum(heads), 0) AS share, sum(heads * change * 0.3) AS meat, sum(heads * change * 0.7) AS milk FROM h GROUP BY code) SELECT code, 'meat' AS product, change, meat AS loss, meat * share AS cattle_loss, meat * (1 - share) AS other_loss FROM s UNION ALL SELECT code, 'milk', change, milk, milk * share, milk * (1 - share) FROM s)")
def _(spark, sf):
    heads, change = F.greatest("c_acctbal", F.lit(0.0)), -(F.col("c_custkey") % 10) / 100.0
    animal = F.when(F.col("c_mktsegment") == "BUILDING", "cattle").otherwise("goats")
    h = X.table(spark, sf, "customer").select(F.col("c_nationkey").alias("code"), animal.alias("animal"), heads.alias("heads"), change.alias("change"), (heads * change * 0.3).alias("meat"), (heads * change * 0.7).alias("milk"))
    return rules.livestock_loss(h, ["code"], "cattle")


@query("g15_highland_mask", "SELECT cell, year, hazard || '-highland' AS hazard, value * coalesce(m, 0) AS value FROM yearly LEFT JOIN (SELECT s_suppkey AS k, CAST(s_acctbal > 5000 AS INT) AS m FROM supplier WHERE s_suppkey % 7 <> 0) ON k = cell UNION ALL SELECT cell, year, hazard || '-tropical', value * (1 - coalesce(m, 0)) FROM yearly LEFT JOIN (SELECT s_suppkey AS k, CAST(s_acctbal > 5000 AS INT) AS m FROM supplier WHERE s_suppkey % 7 <> 0) ON k = cell", "yearly")
def _(spark, sf):
    mask = X.table(spark, sf, "supplier").where("s_suppkey % 7 <> 0").select(F.col("s_suppkey").alias("cell"), (F.col("s_acctbal") > 5000).cast("int").alias("inside"))
    return rules.mask_split(X.yearly(spark, sf), mask, "hazard")


@query("g24_sowing_over_crops", "SELECT cell, median(s) AS median, avg(s) AS mean FROM (SELECT cell, model, coalesce(median(month) FILTER (hazard = 'A'), median(month) FILTER (hazard = 'N')) AS s FROM cells GROUP BY ALL) GROUP BY cell", "cells")
def _(spark, sf):
    season = F.when(F.col("hazard") == "A", "first").when(F.col("hazard") == "N", "single")
    return rules.merged_sowing(X.cells(spark, sf).select("cell", F.col("model").alias("crop"), season.alias("season"), "month"))


@query("g30_adoption_average", "SELECT goal, year, avg(value * a) AS adopters, avg(value - value * a) AS others, avg(100 * a) AS pct FROM (SELECT *, goal * (1 - pow(0.9, year - 1994)) AS a FROM natyear, (VALUES (CAST(0.1 AS DOUBLE)), (0.3), (0.5)) g(goal)) GROUP BY ALL", "natyear")
def _(spark, sf):
    return E.adoption_average(X.nation_years(spark, sf), [0.1, 0.3, 0.5], 0.1, 1995)


@query("g39_recoded_solutions", "SELECT DISTINCT p_brand AS solution, CASE CAST(p_size % 3 AS INT) - 1 WHEN -1 THEN 'decrease' WHEN 0 THEN 'no change' WHEN 1 THEN 'increase' END AS effect, CASE CAST(p_partkey % 3 AS INT) - 1 WHEN -1 THEN 'decrease' WHEN 0 THEN 'no change' WHEN 1 THEN 'increase' END AS income, contains(p_type, 'PROMO') AS promoted, contains(p_name, 'a') AS named FROM part")
def _(spark, sf):
    p = X.table(spark, sf, "part").select(F.col("p_brand").alias("solution"), (F.col("p_size") % 3 - 1).alias("e"), (F.col("p_partkey") % 3 - 1).alias("i"), "p_type", "p_name")
    return rules.recoded(p, {"e": "effect", "i": "income"}, {"promoted": ("p_type", "PROMO"), "named": ("p_name", "a")}, ["solution"])


#: Classes of moisture and of warmth.
MOIST, WARM = ("arid", "semi-arid", "sub-humid", "humid"), ("cool", "warm", "hot")
_label = " ".join(f"WHEN {m + 1 + 10 * (w + 1)} THEN '{warm} {moist}'" for m, moist in enumerate(MOIST) for w, warm in enumerate(WARM))


@query("g41_labelled_zones", f"SELECT cell, k AS class, CASE k {_label} END AS label FROM (SELECT cell, CASE WHEN v <= 500 THEN 1 WHEN v <= 700 THEN 2 WHEN v <= 900 THEN 3 ELSE 4 END + 10 * (1 + CAST(cell % 3 AS INT)) AS k FROM (SELECT cell, avg(value) AS v FROM yearly GROUP BY cell))", "yearly")
def _(spark, sf):
    far = float("inf")
    moist = interval_class("v", [(-far, 500.0, 1), (500.0, 700.0, 2), (700.0, 900.0, 3), (900.0, far, 4)])
    warm = recode(F.col("cell") % 3, {0: 1, 1: 2, 2: 3})
    labels = spark.createDataFrame([(m + 1 + 10 * (w + 1), f"{warm_} {moist_}") for m, moist_ in enumerate(MOIST) for w, warm_ in enumerate(WARM)], "class int, label string")  # twelve rows
    k = X.yearly(spark, sf).groupBy("cell").agg(F.avg("value").alias("v")).select("cell", (moist + 10 * warm).alias("class"))
    return k.join(F.broadcast(labels), "class", "left").select("cell", "class", "label")


@query("j09_touching_cells", "SELECT cell, CASE WHEN x <= 4 AND y <= 4 THEN 1 ELSE 2 END AS zone_id FROM (SELECT DISTINCT l_suppkey AS cell, l_suppkey % 10 AS x, l_suppkey // 10 AS y FROM lineitem) WHERE (x <= 4 AND y <= 4) OR (x BETWEEN 2 AND 8 AND y BETWEEN 2 AND 8)")
def _(spark, sf):
    z = spark.createDataFrame([(1, [(0.25, 0.25), (4.25, 0.25), (4.25, 4.25), (0.25, 4.25)]), (2, [(2.25, 2.25), (8.25, 2.25), (8.25, 8.25), (2.25, 8.25)])], "zone_id int, ring array<struct<x:double,y:double>>")
    c = X.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("cell"), (F.col("l_suppkey") % 10).cast("long").alias("x"), F.expr("l_suppkey div 10").alias("y")).distinct()
    centre = grid.assign_zones(c.withColumns({"x": F.col("x") + 0.5, "y": F.col("y") + 0.5}), z)
    edge = c.join(rules.touching_cells(z, 1.0), ["x", "y"]).select("cell", "zone_id")
    return centre.unionByName(edge).groupBy("cell").agg(F.min("zone_id").alias("zone_id"))


@query("j11_second_zone_table", "SELECT * FROM (WITH b AS (SELECT cell, crop AS basin FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY n DESC, crop) AS r FROM (SELECT l_suppkey AS cell, p_brand AS crop, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)) WHERE r = 1) SELECT admin1, basin, count(*) AS cells, 100.0 * count(*) / sum(count(*)) OVER (PARTITION BY admin1) AS pct FROM zones JOIN b USING (cell) GROUP BY admin1, basin)", "zones")
def _(spark, sf):
    part = X.table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("basin"))
    basins = Z.majority(X.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("cell"), "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey")), "cell", "basin")
    return Z.second_zone_table(X.zones(spark, sf), basins, "admin1", "basin")


@query("s11_complete_gate", "SELECT scenario, hazard, count(DISTINCT model) AS n_models, count(DISTINCT year) AS n_years FROM cells GROUP BY ALL", "cells")
def _(spark, sf):
    counts = X.cells(spark, sf).groupBy("scenario", "hazard").agg(F.countDistinct("model").alias("n_models"), F.countDistinct("year").alias("n_years"))
    return IO.require_complete(counts, "n_models", (7,))  # models are line numbers, 1 to 7: all of them must be there


@query("s18_patch_partition", "SELECT cell, year, CASE WHEN hazard = 'R' AND scenario = 'F' THEN 'A' ELSE hazard END AS hazard, scenario, value FROM (SELECT cell, year, hazard, scenario, sum(value) AS value FROM cells GROUP BY ALL)", "cells")
def _(spark, sf):
    path = scratch(spark, "patched")
    IO.write_table(X.cells(spark, sf).groupBy("cell", "year", "hazard", "scenario").agg(F.sum("value").alias("value")), path, keys=["scenario"])
    IO.patch_partition(spark, path, "scenario", "F", {"hazard": F.when(F.col("hazard") == "R", "A").otherwise(F.col("hazard"))})
    return spark.read.parquet(path).select("cell", "year", "hazard", "scenario", "value")


@query("w02_quarter_patterns", "SELECT cell, q, CASE WHEN q = 0 AND month < 12 THEN year - 1 ELSE year END AS first_year, count(DISTINCT month) = 3 AS complete, sum(value) AS value FROM (SELECT *, CAST((month % 12) // 3 AS INT) AS q FROM monthly) GROUP BY ALL", "monthly")
def _(spark, sf):
    return S.quarters(X.monthly(spark, sf), ["cell"])


@query("c06_break_sequence", "SELECT hazard, list_transform(range(0, CAST(floor((b - a) / s + 1e-10) AS BIGINT) + 1), lambda k: a + k * s) AS breaks FROM (SELECT hazard, floor(lo * 10) / 10 AS a, ceil(hi * 10) / 10 AS b, pow(10.0, CASE WHEN log10((hi - lo) / 10) > 0 THEN ceil(log10((hi - lo) / 10)) ELSE floor(log10((hi - lo) / 10)) END) AS s FROM (SELECT hazard, min(value) / 7 AS lo, max(value) / 7 AS hi FROM yearly GROUP BY hazard))", "yearly")
def _(spark, sf):
    ends = X.yearly(spark, sf).groupBy("hazard").agg((F.min("value") / 7).alias("lo"), (F.max("value") / 7).alias("hi"))
    return ends.select("hazard", break_sequence("lo", "hi").alias("breaks"))


UNIT = "SELECT n_name AS admin1, r_name AS admin0, sum(c_acctbal) / nullif(count(*) FILTER (c_acctbal > 0 AND c_nationkey % 4 <> 0), 0) AS value FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"


def _filled_units(spark, sf):
    n = X.table(spark, sf, "nation").join(X.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("admin1"), F.col("r_name").alias("admin0"))
    heads = F.count(F.when((F.col("c_acctbal") > 0) & (F.col("c_nationkey") % 4 != 0), 1)).cast("double")
    units = X.table(spark, sf, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("admin1", "admin0").agg(safe_ratio(F.sum("c_acctbal"), heads).alias("value"))  # 25 nations
    return G.nearby_fill(units, edges(units), "admin1", "admin0", [])


@query("g43_filled_unit_value", "SELECT * FROM (" + FILL.format(UNIT, OTHERS) + ")")
def _(spark, sf):
    return _filled_units(spark, sf)


@query("g43_fill_levels", "SELECT source, count(*) AS n, avg(filled) AS mean, min(filled) AS low, max(filled) AS high, stddev_samp(filled) AS sd FROM (" + FILL.format(UNIT, OTHERS) + ") GROUP BY source")
def _(spark, sf):
    f = F.col("filled")
    return _filled_units(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.avg(f).alias("mean"), F.min(f).alias("low"), F.max(f).alias("high"), F.stddev_samp(f).alias("sd"))
