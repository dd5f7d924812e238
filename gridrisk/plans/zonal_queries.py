"""Queries of the zonal, hierarchy, trend, grid and quality operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import cell_area_km2, nice_step, safe_ratio
from gridrisk.operators import grid as R
from gridrisk.operators import hazards as H
from gridrisk.operators import quality
from gridrisk.operators import season as S
from gridrisk.operators import trend as T
from gridrisk.operators import zonal as Z
from gridrisk.plans import fixtures as X
from gridrisk.plans.registry import query

SEASON_FLAG = "SELECT cell, season_year, CAST(value > 100 AS INT) AS flag FROM season"


@query("flagship_hazard_frequency", f"SELECT admin0, admin1, admin2, avg(p) AS mean, count(p) AS n FROM (SELECT cell, avg(flag) AS p FROM ({SEASON_FLAG}) GROUP BY cell) JOIN zones USING (cell) GROUP BY GROUPING SETS ((admin0), (admin0, admin1), (admin0, admin1, admin2))", "season", "zones")
def _(spark, sf):
    from gridrisk.functions.scalars import classify

    totals = S.roll_up(X.monthly(spark, sf), X.calendar(spark, sf), [], "sum")
    freq = H.frequency(totals.withColumn("flag", classify("value", ">", 100.0)), ["cell"]).withColumnRenamed("frequency", "p")
    rows = freq.join(X.zones(spark, sf), "cell")
    sets = [[F.col(c) for c in Z.ADMIN[: n + 1]] for n in range(3)]
    return rows.groupingSets(sets, *Z.ADMIN).agg(F.avg("p").alias("mean"), F.count("p").alias("n"))


@query("a25_zonal_mean_sum", "SELECT admin1, hazard, avg(value) AS mean, sum(value) AS sum FROM yearly JOIN zones USING (cell) GROUP BY ALL", "yearly", "zones")
def _(spark, sf):
    return Z.zonal(X.yearly(spark, sf), X.zones(spark, sf).select("cell", "admin1"), ["hazard"], ["admin1"], ("mean", "sum"))


@query("a26_zonal_by_level", "SELECT CASE WHEN grouping(admin2) = 0 THEN 'admin2' WHEN grouping(admin1) = 0 THEN 'admin1' ELSE 'admin0' END AS level, coalesce(admin2, admin1, admin0) AS zone, hazard, 'mean' AS stat, round(avg(value), 2) AS value FROM yearly JOIN zones USING (cell) GROUP BY GROUPING SETS ((admin0, hazard), (admin0, admin1, hazard), (admin0, admin1, admin2, hazard))", "yearly", "zones")
def _(spark, sf):
    sets = [[F.col(c) for c in (*Z.ADMIN[:depth], "hazard")] for depth in (1, 2, 3)]  # one scan for all levels
    rows = X.yearly(spark, sf).join(X.zones(spark, sf), "cell").groupingSets(sets, *Z.ADMIN, "hazard").agg(F.avg("value").alias("mean"), F.grouping("admin1").alias("no1"), F.grouping("admin2").alias("no2"))
    level = F.when(F.col("no1") == 1, "admin0").when(F.col("no2") == 1, "admin1").otherwise("admin2")
    return rows.select(level.alias("level"), F.coalesce("admin2", "admin1", "admin0").alias("zone"), "hazard", F.lit("mean").alias("stat"), F.round("mean", 2).alias("value"))


@query("a27_zonal_spread", "SELECT admin1, min(value) AS min, max(value) AS max, stddev_samp(value) AS sd FROM yearly JOIN zones USING (cell) GROUP BY ALL", "yearly", "zones")
def _(spark, sf):
    return Z.zonal(X.yearly(spark, sf), X.zones(spark, sf).select("cell", "admin1"), [], ["admin1"], ("min", "max", "sd"))


@query("a28_admin_roll_up", "SELECT admin0, admin1, admin2, hazard, sum(value) AS value FROM yearly JOIN zones USING (cell) GROUP BY GROUPING SETS ((admin0, hazard), (admin0, admin1, hazard), (admin0, admin1, admin2, hazard))", "yearly", "zones")
def _(spark, sf):
    return Z.roll_up_admin(X.yearly(spark, sf).join(X.zones(spark, sf), "cell"), ["hazard"])


@query("a29_margins", "SELECT CASE WHEN grouping(admin0) = 1 THEN 'all' ELSE admin0 END AS admin0, CASE WHEN grouping(crop) = 1 THEN 'all' ELSE crop END AS crop, round(sum(value), 2) AS value FROM exposure JOIN zones USING (cell) GROUP BY CUBE (admin0, crop)", "exposure", "zones")
def _(spark, sf):
    return Z.margins(X.exposure(spark, sf).join(X.zones(spark, sf), "cell"), ["admin0", "crop"]).withColumn("value", F.round("value", 2))


@query("a30_weighted_zone_stats", "SELECT p_brand AS crop, sum(p_retailprice * l_quantity) / sum(l_quantity) AS mean, min(p_retailprice) AS low, max(p_retailprice) AS high FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand")
def _(spark, sf):
    rows = _priced(spark, sf)
    return rows.groupBy("crop").agg(Z.weighted_mean("price", "weight").alias("mean"), F.min("price").alias("low"), F.max("price").alias("high"))


def _priced(spark, sf):
    part = X.table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("crop"), F.col("p_retailprice").alias("price"))
    return X.table(spark, sf, "lineitem").select("l_partkey", F.col("l_quantity").alias("weight")).join(part, F.col("l_partkey") == F.col("p_partkey"))


QUANT = "WITH t AS (SELECT p_brand AS crop, p_retailprice AS v, sum(l_quantity) AS w FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL), r AS (SELECT *, sum(w) OVER (PARTITION BY crop ORDER BY v ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY crop) AS total FROM t) SELECT crop, {} FROM r GROUP BY crop"


@query("w07_weighted_quantiles", QUANT.format(", ".join(f"min(v) FILTER (run >= {p} * total) AS q{round(p * 100)}" for p in (0.1, 0.5, 0.9))))
def _(spark, sf):
    return Z.weighted_quantiles(_priced(spark, sf), ["crop"], "price", "weight", [0.1, 0.5, 0.9])


@query("a31_weighted_deciles", QUANT.format("[" + ", ".join(f"min(v) FILTER (run >= {p / 10} * total)" for p in range(1, 10)) + "] AS deciles"))
def _(spark, sf):
    q = Z.weighted_quantiles(_priced(spark, sf), ["crop"], "price", "weight", [p / 10 for p in range(1, 10)])
    return q.select("crop", F.array(*(f"q{p}0" for p in range(1, 10))).alias("deciles"))


@query("a32_two_stage_models", "SELECT hazard, avg(m) AS mean, max(m) AS high, min(m) AS low, stddev_samp(m) AS sd, median(m) AS median FROM (SELECT hazard, model, avg(value) AS m FROM cells GROUP BY ALL) GROUP BY hazard", "cells")
def _(spark, sf):
    m = X.cells(spark, sf).groupBy("hazard", "model").agg(F.avg("value").alias("m"))
    return m.groupBy("hazard").agg(F.avg("m").alias("mean"), F.max("m").alias("high"), F.min("m").alias("low"), F.stddev_samp("m").alias("sd"), F.median("m").alias("median"))


@query("a33_histogram", "SELECT hazard, list_transform(range(1, 11), lambda b: len(list_filter(l, lambda x: x = b))) AS counts FROM (SELECT hazard, list(CAST(CASE WHEN value = 0 THEN 1 ELSE ceil(value / 200) END AS INT)) AS l FROM yearly WHERE value BETWEEN 0 AND 2000 GROUP BY hazard)", "yearly")
def _(spark, sf):
    return Z.histogram(X.yearly(spark, sf), ["hazard"], "value", 0, 200, 10)


@query("a34_area_share", "SELECT admin1, 100 * sum(CASE WHEN value > 700 THEN a ELSE 0 END) / sum(a) AS above, 100 * sum(CASE WHEN value < 500 THEN a ELSE 0 END) / sum(a) AS below FROM (SELECT admin1, value, CAST(1 + cell % 5 AS DOUBLE) AS a FROM yearly JOIN zones USING (cell)) GROUP BY admin1", "yearly", "zones")
def _(spark, sf):
    rows = X.yearly(spark, sf).join(X.zones(spark, sf), "cell").withColumn("a", (F.col("cell") % 5 + 1).cast("double"))
    return Z.area_share(rows, ["admin1"], "a", above=F.col("value") > 700, below=F.col("value") < 500)


@query("a35_occurrences", "SELECT cell, hazard, round(avg(flag) * 20) AS occurrences FROM flags GROUP BY ALL", "flags")
def _(spark, sf):
    return H.frequency(X.flags(spark, sf), ["cell", "hazard"]).select("cell", "hazard", F.round(F.col("frequency") * 20).alias("occurrences"))


BOTH = "SELECT cell, CAST(CASE WHEN f > 400 THEN 3 WHEN f > 200 THEN 2 ELSE 1 END AS INT) AS hist, CAST(CASE WHEN o > 400 THEN 3 WHEN o > 200 THEN 2 ELSE 1 END AS INT) AS fut, CAST(1 + cell % 5 AS DOUBLE) AS area FROM (SELECT cell, coalesce(sum(value) FILTER (scenario = 'F'), 0) / 7 AS f, coalesce(sum(value) FILTER (scenario = 'O'), 0) / 7 AS o FROM cells GROUP BY cell)"


def _both(spark, sf):
    w = X.cells(spark, sf).groupBy("cell").pivot("scenario", ["F", "O"]).agg(F.sum("value")).select("cell", *((F.coalesce(F.col(c), F.lit(0.0)) / 7).alias(c) for c in "FO"))

    def k(c):
        return F.when(F.col(c) > 400, 3).when(F.col(c) > 200, 2).otherwise(1)

    return w.select("cell", k("F").alias("hist"), k("O").alias("fut"), (F.col("cell") % 5 + 1).cast("double").alias("area"))


@query("a36_transition_matrix", f"SELECT admin0, hist + 10 * fut AS transition, sum(area) AS area FROM ({BOTH}) JOIN zones USING (cell) GROUP BY ALL", "cells", "zones")
def _(spark, sf):
    return Z.transition_matrix(_both(spark, sf).join(X.zones(spark, sf), "cell"), "hist", "fut", "area", ["admin0"])


@query("a38_presence_agreement", f"SELECT CASE WHEN hist >= 2 AND fut >= 2 THEN 'both' WHEN hist >= 2 THEN 'past' WHEN fut >= 2 THEN 'future' ELSE 'neither' END AS presence, hist = fut AS agrees, count(*) AS n FROM ({BOTH}) GROUP BY ALL", "cells")
def _(spark, sf):
    h, f = F.col("hist") >= 2, F.col("fut") >= 2
    p = F.when(h & f, "both").when(h, "past").when(f, "future").otherwise("neither")
    return _both(spark, sf).groupBy(p.alias("presence"), (F.col("hist") == F.col("fut")).alias("agrees")).agg(F.count(F.lit(1)).alias("n"))


@query("a43_trends_by_zone", "SELECT admin1, year, m AS mean, CAST(year - min(year) OVER (PARTITION BY admin1) + 1 AS INT) AS nth, CASE WHEN m >= 0 AND m < 600 THEN 'low' WHEN m >= 600 AND m < 800 THEN 'mid' WHEN m >= 800 THEN 'high' END AS severity FROM (SELECT admin1, year, avg(value) AS m FROM yearly JOIN zones USING (cell) GROUP BY ALL)", "yearly", "zones")
def _(spark, sf):
    limits = spark.createDataFrame([(0.0, 600.0, "low"), (600.0, 800.0, "mid"), (800.0, 1e9, "high")], "lower double, upper double, severity string")
    m = Z.zonal(X.yearly(spark, sf), X.zones(spark, sf).select("cell", "admin1"), ["year"], ["admin1"])
    rows = m.join(F.broadcast(limits), (F.col("mean") >= F.col("lower")) & (F.col("mean") < F.col("upper")), "left")
    return rows.select("admin1", "year", "mean", (F.col("year") - F.min("year").over(Window.partitionBy("admin1")) + 1).cast("int").alias("nth"), "severity")


@query("a46_distinct_sets", "SELECT admin1, count(DISTINCT year) AS n_years, list_sort(list(DISTINCT hazard)) AS hazards FROM yearly JOIN zones USING (cell) GROUP BY admin1", "yearly", "zones")
def _(spark, sf):
    return X.yearly(spark, sf).join(X.zones(spark, sf), "cell").groupBy("admin1").agg(F.countDistinct("year").alias("n_years"), F.array_sort(F.collect_set("hazard")).alias("hazards"))


CLAIMS = [(3, 7), (12, 7), (20, 4)]


@query("a56_disputed_merge", "SELECT coalesce(claimant, admin1_code) AS admin1_code, hazard, sum(mean * n) / sum(n) AS value, CAST(sum(n) AS BIGINT) AS n_cells FROM (SELECT admin1_code, hazard, avg(value) AS mean, count(*) AS n FROM yearly JOIN zones USING (cell) GROUP BY ALL) LEFT JOIN (VALUES " + ", ".join(map(str, CLAIMS)) + ") c(disputed, claimant) ON admin1_code = disputed GROUP BY ALL", "yearly", "zones")
def _(spark, sf):
    m = Z.zonal(X.yearly(spark, sf), X.zones(spark, sf).select("cell", "admin1_code"), ["hazard"], ["admin1_code"], ("mean", "n")).withColumnsRenamed({"mean": "value", "n": "n_cells"})
    return Z.merge_disputed(m, spark.createDataFrame(CLAIMS, "disputed int, claimant int"), "admin1_code", ["hazard"])


@query("a57_cells_per_zone", "SELECT admin1_code, count(*) AS n_cells FROM zones GROUP BY ALL", "zones")
def _(spark, sf):
    return X.zones(spark, sf).groupBy("admin1_code").agg(F.count(F.lit(1)).alias("n_cells"))


@query("a58_keep_last_of_groups", "SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_quantity DESC) AS r, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE n = 2 AND r = 1")
def _(spark, sf):
    w = Window.partitionBy("l_orderkey")
    rows = X.table(spark, sf, "lineitem").withColumns({"r": F.row_number().over(w.orderBy(F.desc("l_linenumber"), F.desc("l_quantity"))), "n": F.count(F.lit(1)).over(w)})
    return rows.where("n = 2 and r = 1").select("l_orderkey", "l_linenumber", "l_quantity")


@query("a59_majority", "SELECT cell, hazard, n FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY n DESC, hazard) AS r FROM (SELECT cell, hazard, count(*) AS n FROM cells GROUP BY ALL)) WHERE r = 1", "cells")
def _(spark, sf):
    return Z.majority(X.cells(spark, sf), "cell", "hazard")


@query("a60_duplicate_guard", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(spark, sf):
    return X.table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("s12_data_quality", "SELECT hazard, count(*) AS n_rows, count(*) - count(v) AS n_null, count(*) FILTER (v < 10) AS n_low, count(*) - count(DISTINCT (cell, year, month, model, scenario)) AS n_duplicate FROM (SELECT *, nullif(value, 50) AS v FROM cells) GROUP BY hazard", "cells")
def _(spark, sf):
    rows = X.cells(spark, sf, X.ROWS_PER_TASK).withColumn("v", F.nullif("value", F.lit(50.0)))
    return quality.audit(rows, ["hazard"], ["cell", "year", "month", "model", "scenario"], "v", 10)


@query("s11_completeness", "SELECT scenario, count(*) FILTER (hazard = 'A') AS n_A, count(*) FILTER (hazard = 'N') AS n_N, count(*) FILTER (hazard = 'R') AS n_R, count(DISTINCT year) AS n_years FROM cells GROUP BY scenario", "cells")
def _(spark, sf):
    c = X.cells(spark, sf)
    counts = c.groupBy("scenario").agg(*(F.count(F.when(F.col("hazard") == h, 1)).alias(f"n_{h}") for h in "ANR"), F.countDistinct("year").alias("n_years"))
    return counts


@query("a68_availability_matrix", "SELECT model, sum(CAST(a > 0 AS INT)) + 0 AS present, CAST(sum(a) AS BIGINT) AS files FROM (SELECT model, hazard || scenario AS k, count(*) AS a FROM cells GROUP BY ALL) GROUP BY model ORDER BY files DESC".replace("sum(CAST(a > 0 AS INT)) + 0", "CAST(sum(CAST(a > 0 AS INT)) AS BIGINT)"), "cells")
def _(spark, sf):
    n = X.cells(spark, sf).groupBy("model", F.concat("hazard", "scenario").alias("k")).agg(F.count(F.lit(1)).alias("a"))
    return n.groupBy("model").agg(F.sum((F.col("a") > 0).cast("int")).alias("present"), F.sum("a").alias("files")).orderBy(F.desc("files"))


@query("o03_missing_months", "SELECT cell, 84 - count(*) AS missing FROM monthly GROUP BY cell HAVING count(*) < 84", "monthly")
def _(spark, sf):
    return X.monthly(spark, sf).groupBy("cell").agg((84 - F.count(F.lit(1))).alias("missing")).where("missing > 0").orderBy(F.desc("missing"))


@query("a49_first_last", "SELECT admin1, a AS first_mean, z AS last_mean, z - a AS change FROM (SELECT admin1, avg(value) FILTER (r <= 3) AS a, avg(value) FILTER (q <= 3) AS z FROM (SELECT *, row_number() OVER (PARTITION BY admin1 ORDER BY year) AS r, row_number() OVER (PARTITION BY admin1 ORDER BY year DESC) AS q FROM natyear) GROUP BY admin1)", "natyear")
def _(spark, sf):
    return T.first_and_last(X.nation_years(spark, sf), ["admin1"], 3)


@query("w04_anomaly", "SELECT n.admin1, n.admin0, n.year, value, b AS baseline_value, value - b AS anomaly FROM natyear n LEFT JOIN (SELECT admin1, avg(value) AS b FROM natyear WHERE year BETWEEN 1995 AND 1997 GROUP BY admin1) USING (admin1)", "natyear")
def _(spark, sf):
    return T.anomalies(X.nation_years(spark, sf), ["admin1"], 1995, 1997)


PAIRS = "SELECT a.admin1, a.year AS y1, b.year AS y2, a.value AS v1, b.value AS v2 FROM natyear a JOIN natyear b ON a.admin1 = b.admin1 AND a.year < b.year"


@query("a50_theil_sen", f"SELECT admin1, slope, median(value - slope * year) AS intercept FROM natyear JOIN (SELECT admin1, median((v2 - v1) / (y2 - y1)) AS slope FROM ({PAIRS}) GROUP BY admin1) USING (admin1) GROUP BY ALL", "natyear")
def _(spark, sf):
    return T.theil_sen(X.nation_years(spark, sf), ["admin1"])


MK = f"SELECT admin1, n, s, (n * (n - 1) * (2 * n + 5) - ties) / 18.0 AS var FROM (SELECT admin1, CAST(sum(sign(v2 - v1)) AS BIGINT) AS s FROM ({PAIRS}) GROUP BY admin1) JOIN (SELECT admin1, CAST(sum(t) AS BIGINT) AS n, CAST(sum(t * (t - 1) * (2 * t + 5)) AS BIGINT) AS ties FROM (SELECT admin1, value, count(*) AS t FROM natyear GROUP BY ALL) GROUP BY admin1) USING (admin1)"


@query("a51_mann_kendall", f"SELECT admin1, n, s, CAST(var AS DOUBLE) AS var, CASE WHEN s = 0 THEN 0 ELSE (s - sign(s)) / sqrt(var) END AS z FROM ({MK})", "natyear")
def _(spark, sf):
    return T.mann_kendall(X.nation_years(spark, sf), ["admin1"]).drop("p")


#: Two-sided p by the series of the normal integral, its terms by logarithms of the gamma function.
MK_P = "1 - 2 * exp(-z * z / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(150), lambda k: exp((2 * k + 1) * ln(z) - (k + 1) * ln(2) - lgamma(k + 1.5) + ln(pi()) / 2)))"


@query("a51_mann_kendall_p", f"SELECT admin1, round(CASE WHEN z > 0 THEN {MK_P} ELSE 1 END, 9) AS p FROM (SELECT admin1, CASE WHEN s = 0 THEN 0 ELSE abs(s - sign(s)) / sqrt(var) END AS z FROM ({MK}))", "natyear")
def _(spark, sf):
    return T.mann_kendall(X.nation_years(spark, sf), ["admin1"]).select("admin1", F.round("p", 9).alias("p"))


@query("a52_sen_interval", f"SELECT admin1, max(sl) FILTER (r = greatest(round((n - 1.959964 * sqrt(var)) / 2), 1)) AS slope_low, max(sl) FILTER (r = least(round((n + 1.959964 * sqrt(var)) / 2) + 1, n)) AS slope_high FROM (SELECT admin1, (v2 - v1) / (y2 - y1) AS sl, row_number() OVER (PARTITION BY admin1 ORDER BY (v2 - v1) / (y2 - y1)) AS r, count(*) OVER (PARTITION BY admin1) AS n FROM ({PAIRS})) JOIN (SELECT admin1, var FROM ({MK})) USING (admin1) GROUP BY admin1", "natyear")
def _(spark, sf):
    return T.sen_interval(X.nation_years(spark, sf), ["admin1"])


@query("a53_trend_ensemble", "SELECT admin0, stat, avg(v) AS mean, min(v) AS low, max(v) AS high FROM (UNPIVOT (SELECT admin0, admin1, avg(value) AS average, stddev_samp(value) AS spread FROM natyear GROUP BY ALL) ON average, spread INTO NAME stat VALUE v) GROUP BY ALL", "natyear")
def _(spark, sf):
    w = X.nation_years(spark, sf).groupBy("admin0", "admin1").agg(F.avg("value").alias("average"), F.stddev_samp("value").alias("spread"))
    return w.unpivot(["admin0", "admin1"], ["average", "spread"], "stat", "v").groupBy("admin0", "stat").agg(F.avg("v").alias("mean"), F.min("v").alias("low"), F.max("v").alias("high"))


@query("a47_variation", "SELECT admin1, CASE WHEN count(value) >= 5 AND count(DISTINCT value) > 1 THEN stddev_samp(value) / avg(value) END AS cv FROM natyear GROUP BY admin1", "natyear")
def _(spark, sf):
    return T.variation(X.nation_years(spark, sf), ["admin1"], 5)


@query("a48_detrended_variation", "SELECT admin1, regr_slope(value, year) AS slope, sqrt(regr_syy(value, year) * (1 - regr_r2(value, year)) / (count(*) - 1)) / avg(value) AS detrended_cv, 1 - (1 - regr_r2(value, year)) * (count(*) - 1) / (count(*) - 2) AS adj_r2 FROM natyear GROUP BY admin1", "natyear")
def _(spark, sf):
    return T.linear_fit(X.nation_years(spark, sf), ["admin1"], "year", "value").select("admin1", "slope", "detrended_cv", "adj_r2")


@query("a66_fit_quality", "SELECT admin0, regr_slope(value, year) AS slope, regr_intercept(value, year) AS intercept, sqrt(regr_syy(value, year) * (1 - regr_r2(value, year)) / count(*)) AS rmse FROM natyear GROUP BY admin0", "natyear")
def _(spark, sf):
    return T.linear_fit(X.nation_years(spark, sf), ["admin0"], "year", "value").select("admin0", "slope", "intercept", "rmse")


@query("a44_multi_year_mean", "SELECT admin1, coalesce(avg(value) FILTER (year BETWEEN 1999 AND 2000), avg(value) FILTER (year BETWEEN 1995 AND 2001)) AS mean, median(value) FILTER (year BETWEEN 1996 AND 2000) AS median FROM natyear GROUP BY admin1", "natyear")
def _(spark, sf):
    def within(a, b):
        return F.when(F.col("year").between(a, b), F.col("value"))

    return X.nation_years(spark, sf).groupBy("admin1").agg(F.coalesce(F.avg(within(1999, 2000)), F.avg(within(1995, 2001))).alias("mean"), F.median(within(1996, 2000)).alias("median"))


@query("a45_last_price", "SELECT admin1, arg_max(value, year) FILTER (year % 3 <> 0) AS last, min(value) AS low, max(value) AS high, count(value) FILTER (year % 3 <> 0) AS n FROM natyear GROUP BY admin1", "natyear")
def _(spark, sf):
    rows = X.nation_years(spark, sf).withColumn("price", F.when(F.col("year") % 3 != 0, F.col("value")))
    return rows.groupBy("admin1").agg(F.max_by("price", F.when(F.col("price").isNotNull(), F.col("year"))).alias("last"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("price").alias("n"))


GRID = "SELECT l_suppkey % 10 AS x, l_suppkey // 10 AS y, sum(l_quantity) AS value FROM lineitem GROUP BY ALL"


def _grid(spark, sf):
    return X.table(spark, sf, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("x"), F.expr("l_suppkey div 10").alias("y")).agg(F.sum("l_quantity").alias("value"))


@query("r04_coarsen_sum", f"SELECT x // 2 AS x, y // 2 AS y, sum(value) AS value FROM ({GRID}) GROUP BY ALL")
def _(spark, sf):
    return R.coarsen(_grid(spark, sf), 2, [])


@query("r02_nearest", f"SELECT x * 2 + i AS x, y * 2 + j AS y, value FROM ({GRID}), range(2) a(i), range(2) b(j)")
def _(spark, sf):
    return R.nearest(_grid(spark, sf), 2)


@query("r01_conserve_mass", f"SELECT x * 2 + i AS x, y * 2 + j AS y, value / 4 AS value FROM ({GRID}), range(2) a(i), range(2) b(j)")
def _(spark, sf):
    return R.conserve_mass(_grid(spark, sf), 2)


@query("r03_bilinear", f"SELECT px, py, sum(w * value) / sum(w) AS value FROM (SELECT x AS cx, y AS cy, x + 0.25 AS px, y + 0.5 AS py, x + i AS x, y + j AS y, (CASE WHEN i = 0 THEN 0.75 ELSE 0.25 END) * 0.5 AS w FROM ({GRID}), range(2) a(i), range(2) b(j)) JOIN ({GRID}) USING (x, y) GROUP BY ALL".replace("x + 0.25 AS px, y + 0.5 AS py", "CAST(x + 0.25 AS DOUBLE) AS px, CAST(y + 0.5 AS DOUBLE) AS py"))
def _(spark, sf):
    g = _grid(spark, sf)
    return R.bilinear(g, g.select((F.col("x") + 0.25).cast("double").alias("px"), (F.col("y") + 0.5).cast("double").alias("py")))


@query("r05_cell_area", "SELECT DISTINCT l_suppkey // 10 AS y, 6371.0088 * 6371.0088 * radians(0.05) * (sin(radians((l_suppkey // 10) * 0.05 + 0.05)) - sin(radians((l_suppkey // 10) * 0.05))) AS km2 FROM lineitem")
def _(spark, sf):
    y = _grid(spark, sf).select("y").distinct()
    return y.select("y", cell_area_km2(F.col("y") * 0.05, F.col("y") * 0.05 + 0.05, 0.05).alias("km2"))


@query("j09_zone_assignment", "SELECT cell, CASE WHEN x > 0.5 AND x < 4.5 AND y > 0.5 AND y < 4.5 THEN 1 ELSE 2 END AS zone_id FROM (SELECT DISTINCT l_suppkey AS cell, l_suppkey % 10 AS x, l_suppkey // 10 AS y FROM lineitem) WHERE x > 0.5 AND y > 0.5 AND x < 8.5 AND y < 8.5 AND ((x < 4.5 AND y < 4.5) OR (x > 2.5 AND y > 2.5))")
def _(spark, sf):
    def ring(a, b):
        return [(a, a), (b, a), (b, b), (a, b)]

    z = spark.createDataFrame([(1, ring(0.5, 4.5)), (2, ring(2.5, 8.5))], "zone_id int, ring array<struct<x:double,y:double>>")
    c = X.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("cell"), (F.col("l_suppkey") % 10).cast("double").alias("x"), F.expr("cast(l_suppkey div 10 as double)").alias("y")).distinct()
    return R.assign_zones(c, z)


@query("f18_extent", f"SELECT * FROM ({GRID}) WHERE x BETWEEN 2 AND 6 AND y BETWEEN 1 AND 4")
def _(spark, sf):
    return _grid(spark, sf).where("x between 2 and 6 and y between 1 and 4")


@query("f17_cell_mask", "SELECT cell, year, hazard, value FROM yearly WHERE cell IN (SELECT cell FROM zones WHERE admin0_code = 1)", "yearly", "zones")
def _(spark, sf):
    return X.yearly(spark, sf).join(X.zones(spark, sf).where("admin0_code = 1"), "cell", "left_semi")


@query("j04_anti", "SELECT cell, year, hazard, value FROM yearly WHERE cell NOT IN (SELECT cell FROM zones WHERE admin0_code = 1)", "yearly", "zones")
def _(spark, sf):
    return X.yearly(spark, sf).join(X.zones(spark, sf).where("admin0_code = 1"), "cell", "left_anti")


@query("j10_zone_overlay", "SELECT *, 100 * value / sum(value) OVER (PARTITION BY admin0) AS pct FROM (SELECT admin0, cell % 4 AS class, sum(value) AS value FROM yearly JOIN zones USING (cell) GROUP BY ALL)", "yearly", "zones")
def _(spark, sf):
    g = X.yearly(spark, sf).join(X.zones(spark, sf), "cell").groupBy("admin0", (F.col("cell") % 4).alias("class")).agg(F.sum("value").alias("value"))
    return g.withColumn("pct", 100 * F.col("value") / F.sum("value").over(Window.partitionBy("admin0")))


@query("c06_nice_breaks", "SELECT hazard, u * (CASE WHEN r / u < 2 THEN 1.0 WHEN r / u < 5 THEN 2.0 ELSE 5.0 END) AS step FROM (SELECT hazard, (max(value) - min(value)) / 10 AS r, pow(10.0, floor(log10((max(value) - min(value)) / 10))) AS u FROM yearly GROUP BY hazard)", "yearly")
def _(spark, sf):
    return X.yearly(spark, sf).groupBy("hazard").agg((F.max("value") - F.min("value")).alias("span")).select("hazard", nice_step("span").alias("step"))


@query("f12_admin_subset", "SELECT admin0, admin1, hazard, sum(value) AS value FROM yearly JOIN zones USING (cell) GROUP BY ALL", "yearly", "zones")
def _(spark, sf):
    rows = Z.roll_up_admin(X.yearly(spark, sf).join(X.zones(spark, sf), "cell"), ["hazard"])
    return rows.where("admin2 is null and admin1 is not null").drop("admin2")


@query("a67_reconcile_totals", "SELECT admin1, a / 1e6 AS millions, a / nullif(b, 0) AS ratio FROM (SELECT admin1, sum(value) AS a FROM exposure JOIN zones USING (cell) GROUP BY admin1) JOIN (SELECT admin1, sum(value) AS b FROM natyear GROUP BY admin1) USING (admin1)", "exposure", "zones", "natyear")
def _(spark, sf):
    a = X.exposure(spark, sf).join(X.zones(spark, sf), "cell").groupBy("admin1").agg(F.sum("value").alias("a"))
    b = X.nation_years(spark, sf).groupBy("admin1").agg(F.sum("value").alias("b"))
    return a.join(b, "admin1").select("admin1", (F.col("a") / 1e6).alias("millions"), safe_ratio("a", "b").alias("ratio"))
