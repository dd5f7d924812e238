"""Queries of joins, tidy steps, scalar functions, overlays and country tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import month_of_day, month_of_dekad, safe_ratio
from gridrisk.operators import hazards as H
from gridrisk.operators import zonal as Z
from gridrisk.plans import fixtures as X
from gridrisk.plans.registry import query
from gridrisk.plans.source_queries import scratch
from gridrisk.sources import tables as IO


@query("a17_combination_classes", "SELECT any_value(n) AS n, label, count(*) AS cells FROM (SELECT cell, CASE WHEN d + h + w = 0 THEN 'none' ELSE concat_ws('+', CASE WHEN d = 1 THEN 'dry' END, CASE WHEN h = 1 THEN 'heat' END, CASE WHEN w = 1 THEN 'wet' END) END AS label, CAST(d + h + w AS INT) AS n FROM (SELECT cell, CAST(avg(flag) FILTER (hazard = 'dry') > 0.3 AS INT) AS d, CAST(avg(flag) FILTER (hazard = 'heat') > 0.3 AS INT) AS h, CAST(avg(flag) FILTER (hazard = 'wet') > 0.3 AS INT) AS w FROM flags GROUP BY cell) WHERE d IS NOT NULL AND h IS NOT NULL AND w IS NOT NULL) GROUP BY label", "flags")
def _(spark, sf):
    f = H.frequency(X.flags(spark, sf), ["cell", "hazard"]).withColumn("c", (F.col("frequency") > 0.3).cast("int"))
    wide = f.groupBy("cell").pivot("hazard", ["dry", "heat", "wet"]).agg(F.max("c")).dropna()
    return H.hazard_combinations(wide, ["dry", "heat", "wet"], ["cell"]).groupBy("label", F.col("n_hazards").alias("n")).agg(F.count(F.lit(1)).alias("cells"))


RISK = "SELECT admin0, admin1, crop, sum(p * value) AS at_risk, sum(value) AS total FROM freq JOIN exposure USING (cell) JOIN zones USING (cell) GROUP BY ALL"


@query("a39_region_risk_table", f"SELECT admin0, admin1, sum(at_risk) FILTER (crop = 'Brand#11') AS b11, sum(at_risk) FILTER (crop = 'Brand#12') AS b12, sum(at_risk) FILTER (crop = 'Brand#13') AS b13, sum(at_risk) FILTER (crop NOT IN ('Brand#11', 'Brand#12', 'Brand#13')) AS others, 100 * sum(at_risk) / nullif(sum(total), 0) AS pct FROM ({RISK}) GROUP BY ALL", "freq", "exposure", "zones")
def _(spark, sf):
    brands = ["Brand#11", "Brand#12", "Brand#13"]
    r = X.heat_frequency(spark, sf).join(X.exposure(spark, sf), "cell").join(X.zones(spark, sf), "cell").withColumn("at_risk", F.col("p") * F.col("value"))
    each = [F.sum(F.when(F.col("crop") == b, F.col("at_risk"))).alias(f"b{b[-2:]}") for b in brands]
    return r.groupBy("admin0", "admin1").agg(*each, F.sum(F.when(~F.col("crop").isin(brands), F.col("at_risk"))).alias("others"), (100 * safe_ratio(F.sum("at_risk"), F.sum("value"))).alias("pct"))


@query("a40_severity_risk_table", "SELECT admin1, hazard, avg(f) AS share_mean, stddev_samp(f) AS share_sd, avg(m) AS mean_mean, stddev_samp(m) AS mean_sd FROM (SELECT cell, hazard, avg(CAST(value > 700 AS INT)) AS f, avg(value) AS m FROM yearly GROUP BY ALL) JOIN zones USING (cell) GROUP BY ALL", "yearly", "zones")
def _(spark, sf):
    each = H.class_profile(X.yearly(spark, sf), ["cell", "hazard"], "value", ">", 700.0, 0.5).join(X.zones(spark, sf), "cell")
    return each.groupBy("admin1", "hazard").agg(F.avg("share").alias("share_mean"), F.stddev_samp("share").alias("share_sd"), F.avg("mean").alias("mean_mean"), F.stddev_samp("mean").alias("mean_sd"))


@query("a55_model_mean_difference", "SELECT hazard, coalesce(CAST(model AS VARCHAR), 'all') AS model, a - b AS diff FROM (SELECT hazard, model, avg(value) FILTER (scenario = 'O') AS a, avg(value) FILTER (scenario = 'F') AS b FROM cells GROUP BY GROUPING SETS ((hazard, model), (hazard)))", "cells")
def _(spark, sf):
    c = X.cells(spark, sf)

    def mean(s):
        return F.avg(F.when(F.col("scenario") == s, F.col("value")))

    g = c.groupingSets([[F.col("hazard"), F.col("model")], [F.col("hazard")]], "hazard", "model").agg((mean("O") - mean("F")).alias("diff"))
    return g.select("hazard", F.coalesce(F.col("model").cast("string"), F.lit("all")).alias("model"), "diff")


@query("a61_livestock_loss", "SELECT admin1, product, sum(CASE WHEN product = 'meat' THEN loss * share ELSE loss * (1 - share) END) AS loss FROM (SELECT admin1, c_acctbal * 0.1 AS loss, (c_custkey % 10) / 10.0 AS share FROM customer JOIN (SELECT DISTINCT admin1, admin1_code FROM zones) ON c_nationkey = admin1_code), (VALUES ('meat'), ('milk')) p(product) GROUP BY ALL", "zones")
def _(spark, sf):
    c = X.table(spark, sf, "customer").join(X.zones(spark, sf).select("admin1", "admin1_code").distinct(), F.col("c_nationkey") == F.col("admin1_code"))
    share, loss = F.col("c_custkey") % 10 / 10.0, F.col("c_acctbal") * 0.1
    w = c.groupBy("admin1").agg(F.sum(loss * share).alias("meat"), F.sum(loss * (1 - share)).alias("milk"))
    return w.unpivot("admin1", ["meat", "milk"], "product", "loss")


@query("c01_patterns", "SELECT regexp_replace(p_name, '[aeiou]', '', 'g') AS bare, regexp_matches(p_name, 'an') AS has_an, count(*) AS n FROM part GROUP BY ALL")
def _(spark, sf):
    return X.table(spark, sf, "part").groupBy(F.regexp_replace("p_name", "[aeiou]", "").alias("bare"), F.col("p_name").rlike("an").alias("has_an")).agg(F.count(F.lit(1)).alias("n"))


@query("c03_day_to_month", "SELECT DISTINCT CAST(dayofyear(o_orderdate) AS INT) AS day, CAST(month(DATE '2024-01-01' + CAST(dayofyear(o_orderdate) - 1 AS INT)) AS INT) AS month, CAST(ceil(ceil(dayofyear(o_orderdate) / 10.17) / 3) AS INT) AS dekad_month FROM orders")
def _(spark, sf):
    d = X.table(spark, sf, "orders").select(F.dayofyear("o_orderdate").alias("day")).distinct()
    return d.select("day", month_of_day("day").alias("month"), month_of_dekad(F.ceil(F.col("day") / 10.17)).alias("dekad_month"))


@query("c05_rounding", "SELECT cell, year, hazard, ceil(value / 7) AS up, floor(value / 7) AS down, abs(value - 700) AS distance, sqrt(value) AS root, log10(value) AS lg, least(value, 700) AS capped FROM yearly WHERE value > 0", "yearly")
def _(spark, sf):
    v = F.col("value")
    return X.yearly(spark, sf).where("value > 0").select("cell", "year", "hazard", F.ceil(v / 7).cast("double").alias("up"), F.floor(v / 7).cast("double").alias("down"), F.abs(v - 700).alias("distance"), F.sqrt(v).alias("root"), F.log10(v).alias("lg"), F.least(v, F.lit(700.0)).alias("capped"))


@query("c08_code_to_name", "SELECT c_nationkey AS code, n_name AS name, count(*) AS n FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def _(spark, sf):
    names = F.broadcast(X.table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("name")))  # 25 rows
    return X.table(spark, sf, "customer").join(names, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy(F.col("c_nationkey").alias("code"), "name").agg(F.count(F.lit(1)).alias("n"))


@query("c10_units", "SELECT p_brand AS crop, sum(p_retailprice) * 1000 AS small, sum(p_retailprice) / 1e6 AS large FROM part GROUP BY ALL")
def _(spark, sf):
    return X.table(spark, sf, "part").groupBy(F.col("p_brand").alias("crop")).agg((F.sum("p_retailprice") * 1000).alias("small"), (F.sum("p_retailprice") / 1e6).alias("large"))


@query("c11_coalesce_chain", "SELECT cell, year, hazard, coalesce(nullif(CASE WHEN value > 900 THEN value END, 950), CASE WHEN value < 500 THEN value * 2 END, -1) AS picked FROM yearly", "yearly")
def _(spark, sf):
    v = F.col("value")
    return X.yearly(spark, sf).select("cell", "year", "hazard", F.coalesce(F.nullif(F.when(v > 900, v), F.lit(950.0)), F.when(v < 500, v * 2), F.lit(-1.0)).alias("picked"))


@query("f15_tidy", "SELECT hazard AS kind, cell, year, round(value / 3, 1) AS amount FROM yearly", "yearly")
def _(spark, sf):
    df = X.yearly(spark, sf).withColumn("value", F.col("value") / 3).withColumnsRenamed({"hazard": "kind", "value": "amount"})
    return df.select("kind", "cell", "year", *(F.round(c, 1).alias(c) for c, t in df.dtypes if t == "double"))


@query("f21_pick_table", "SELECT admin1, year, value FROM natyear WHERE admin0 IN (SELECT r_name FROM region WHERE r_regionkey IN (0, 2)) AND year = 1998", "natyear")
def _(spark, sf):
    regions = F.broadcast(X.table(spark, sf, "region").where("r_regionkey in (0, 2)").select(F.col("r_name").alias("admin0")))
    return X.nation_years(spark, sf).where("year = 1998").join(regions, "admin0", "left_semi").select("admin1", "year", "value")


@query("g39_solutions", "SELECT DISTINCT p_brand AS solution, CASE p_size % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'gain' ELSE 'loss' END AS effect, contains(p_type, 'PROMO') AS promoted FROM part")
def _(spark, sf):
    effect = F.when(F.col("p_size") % 3 == 0, "none").when(F.col("p_size") % 3 == 1, "gain").otherwise("loss")
    return X.table(spark, sf, "part").select(F.col("p_brand").alias("solution"), effect.alias("effect"), F.contains("p_type", F.lit("PROMO")).alias("promoted")).distinct()


@query("j03_inner", "SELECT cell, year, hazard, value, admin1 FROM yearly JOIN zones USING (cell)", "yearly", "zones")
def _(spark, sf):
    return X.yearly(spark, sf).join(X.zones(spark, sf).select("cell", "admin1"), "cell")


@query("j06_lookup", "SELECT l_returnflag AS code, CASE l_returnflag WHEN 'A' THEN 'dry' WHEN 'R' THEN 'wet' END AS label, count(*) AS n FROM lineitem GROUP BY ALL")
def _(spark, sf):
    names = spark.createDataFrame([("A", "dry"), ("R", "wet")], "code string, label string")
    n = X.table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(names), "code", "left").select("code", "label", "n")


@query("j11_basin_overlay", "SELECT admin1, cell // 16 AS basin, count(*) AS cells, 100.0 * count(*) / (SELECT count(*) FROM zones) AS pct FROM zones GROUP BY ALL", "zones")
def _(spark, sf):
    z = X.zones(spark, sf).withColumn("basin", F.expr("cell div 16"))
    whole = z.agg(F.count(F.lit(1)).alias("whole"))
    return z.groupBy("admin1", "basin").agg(F.count(F.lit(1)).alias("cells")).join(F.broadcast(whole), F.lit(True)).select("admin1", "basin", "cells", (100.0 * F.col("cells") / F.col("whole")).alias("pct"))


@query("j14_season_pairing", "SELECT a.cell, a.year, total1, total2, w FROM (SELECT cell, year, sum(value) AS total1 FROM monthly WHERE month <= 6 GROUP BY ALL) a LEFT JOIN (SELECT cell, year, sum(value) AS total2 FROM monthly WHERE month BETWEEN 9 AND 10 GROUP BY ALL) b ON a.cell = b.cell AND a.year = b.year LEFT JOIN (SELECT cell, avg(value) AS w FROM monthly GROUP BY cell) c ON a.cell = c.cell", "monthly")
def _(spark, sf):
    m = X.monthly(spark, sf)
    a = m.where("month <= 6").groupBy("cell", "year").agg(F.sum("value").alias("total1"))
    b = m.where("month between 9 and 10").groupBy("cell", "year").agg(F.sum("value").alias("total2"))
    return a.join(b, ["cell", "year"], "left").join(m.groupBy("cell").agg(F.avg("value").alias("w")), "cell", "left")


@query("j17_disputed_lookup", "SELECT admin1_code, coalesce(claimant, admin1_code) AS owner, count(*) AS cells FROM zones LEFT JOIN (VALUES (3, 7), (12, 7), (20, 4)) c(disputed, claimant) ON admin1_code = disputed GROUP BY ALL", "zones")
def _(spark, sf):
    claims = F.broadcast(spark.createDataFrame([(3, 7), (12, 7), (20, 4)], "disputed int, claimant int"))
    return X.zones(spark, sf).join(claims, F.col("admin1_code") == F.col("disputed"), "left").groupBy("admin1_code", F.coalesce("claimant", "admin1_code").alias("owner")).agg(F.count(F.lit(1)).alias("cells"))


@query("o04_union_fill", "SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier")
def _(spark, sf):
    c = X.table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return c.unionByName(X.table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")), allowMissingColumns=True)


@query("o07_split_append", "SELECT cell, year, hazard, CASE WHEN value > 900 THEN 900 ELSE value END AS value FROM yearly", "yearly")
def _(spark, sf):
    y = X.yearly(spark, sf)
    return y.where("value > 900").withColumn("value", F.lit(900.0)).unionByName(y.where("value <= 900"))


@query("r06_coordinate_join", "SELECT CAST(l_suppkey % 10 AS BIGINT) AS x, CAST(l_suppkey // 10 AS BIGINT) AS y, sum(l_quantity) AS value, any_value(s_acctbal) AS other FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey")
def _(spark, sf):
    at = [(F.col("cell") % 10).alias("x"), F.expr("cell div 10").alias("y")]
    a = X.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("cell")).agg(F.sum("l_quantity").alias("value")).select(*at, "value")
    b = X.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("cell"), "s_acctbal").select(*at, F.col("s_acctbal").alias("other"))
    return a.join(b, ["x", "y"])


@query("s07_tagged_files", "SELECT hazard AS country, count(*) AS n FROM yearly GROUP BY ALL", "yearly")
def _(spark, sf):
    path = scratch(spark, "countries")
    IO.write_table(X.yearly(spark, sf), path, keys=["hazard"])
    return IO.tagged(spark, [path], r"hazard=(\w)", "country").groupBy("country").agg(F.count(F.lit(1)).alias("n"))


@query("s08_adaptation_csv", "SELECT c_mktsegment AS segment, round(avg(c_acctbal), 2) AS mean FROM customer GROUP BY ALL")
def _(spark, sf):
    path = scratch(spark, "adaptation")
    IO.write_csv(X.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.round(F.avg("c_acctbal"), 2).alias("mean")), path)
    return IO.read_lookup(spark, path, "segment string, mean double", encoding="ISO-8859-1")


@query("s09_json_sidecar", "SELECT count(*) AS n_rows, list_sort(list(DISTINCT hazard)) AS hazard FROM yearly", "yearly")
def _(spark, sf):
    path = scratch(spark, "sidecar")
    IO.write_sidecar(X.yearly(spark, sf), ["hazard"], path)
    return IO.read_json(spark, path).select("n_rows", "hazard")


@query("s15_csv_write", "SELECT n_name AS admin1, n_regionkey AS region FROM nation")
def _(spark, sf):
    path = scratch(spark, "csv")
    IO.write_csv(X.table(spark, sf, "nation").select(F.col("n_name").alias("admin1"), F.col("n_regionkey").alias("region")), path)
    return IO.read_lookup(spark, path, "admin1 string, region int")


@query("s06_cell_table", "SELECT l_suppkey AS cell, CAST(l_suppkey % 10 AS DOUBLE) AS x, CAST(l_suppkey // 10 AS DOUBLE) AS y, l_returnflag || '_' || CAST(year(l_shipdate) AS VARCHAR) AS layer, sum(l_quantity) AS value FROM lineitem GROUP BY ALL")
def _(spark, sf):
    layer = F.concat_ws("_", "hazard", F.col("year").cast("string")).alias("layer")
    return X.yearly(spark, sf).select("cell", (F.col("cell") % 10).cast("double").alias("x"), F.expr("cast(cell div 10 as double)").alias("y"), layer, "value")


@query("w02_pattern_groups", "SELECT cell, year, n_months = 3 AS complete FROM (SELECT cell, year, count(DISTINCT month) FILTER (month IN (6, 7, 8)) AS n_months FROM monthly GROUP BY ALL)", "monthly")
def _(spark, sf):
    return X.monthly(spark, sf).groupBy("cell", "year").agg((F.countDistinct(F.when(F.col("month").isin(6, 7, 8), F.col("month"))) == 3).alias("complete"))


@query("o02_dominant_crop", "SELECT admin1, crop FROM (SELECT admin1, crop, row_number() OVER (PARTITION BY admin1 ORDER BY v DESC, crop) AS r FROM (SELECT admin1, crop, sum(value) AS v FROM exposure JOIN zones USING (cell) GROUP BY ALL)) WHERE r = 1", "exposure", "zones")
def _(spark, sf):
    v = X.exposure(spark, sf).join(X.zones(spark, sf), "cell").groupBy("admin1", "crop").agg(F.sum("value").alias("v"))
    w = Window.partitionBy("admin1").orderBy(F.desc("v"), "crop")
    return v.withColumn("r", F.row_number().over(w)).where("r = 1").select("admin1", "crop")


@query("a59_child_parent", "SELECT cell, scenario, n FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY n DESC, scenario) AS r FROM (SELECT cell, scenario, count(*) AS n FROM cells GROUP BY ALL)) WHERE r = 1", "cells")
def _(spark, sf):
    return Z.majority(X.cells(spark, sf), "cell", "scenario")
