"""Queries of the season, threshold, frequency, ensemble and compound-hazard operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import classify, interval_class, recode, safe_ratio, wrap_month
from gridrisk.operators import hazards as H
from gridrisk.operators import season as S
from gridrisk.plans import fixtures as X
from gridrisk.plans.registry import query

THRESHOLDS = ((">", 20.0, "Moderate"), (">", 60.0, "Severe"), (">", 120.0, "Extreme"), ("<", 30.0, "Moderate"), ("<", 10.0, "Severe"))
T_SQL = "t(direction, threshold, severity) AS (VALUES " + ", ".join(f"('{d}', CAST({t} AS DOUBLE), '{s}')" for d, t, s in THRESHOLDS) + ")"
FLAG = "CASE WHEN direction = '>' THEN CAST(value > threshold AS INT) ELSE CAST(value < threshold AS INT) END"


def thresholds(spark):
    return spark.createDataFrame([*THRESHOLDS], "direction string, threshold double, severity string")


def season(spark, sf):
    return S.roll_up(X.monthly(spark, sf), X.calendar(spark, sf), [], "sum")


@query("a01_season_annual", "SELECT cell, season_year, max(value) AS value, count(value) AS n_months FROM pos WHERE season_year >= (SELECT min(year) FROM monthly) AND season_year < (SELECT max(year) FROM monthly) GROUP BY ALL", "pos")
def _(spark, sf):
    return S.roll_up(X.monthly(spark, sf), X.calendar(spark, sf), [], "max", annual=True)


@query("a02_season_calendar", "SELECT * FROM season", "season")
def _(spark, sf):
    return season(spark, sf)


@query("a03_calendar_variants", "SELECT cell, plant, (plant + span - 1) % 12 + 1 AS harvest, (plant + 5 - 2) % 12 + 1 AS harvest5, CAST(CASE WHEN (plant + span - 1) % 12 + 1 >= plant THEN (plant + span - 1) % 12 + 1 - plant ELSE (plant + span - 1) % 12 + 13 - plant END AS INT) AS span, month(DATE '2024-01-01' + CAST(plant * 30 - 1 AS INT)) AS day_month FROM calendar", "calendar")
def _(spark, sf):
    from gridrisk.functions.scalars import month_of_day

    c = X.calendar(spark, sf).withColumns({"harvest": F.col("plant") + F.col("span"), "harvest5": wrap_month(F.col("plant") + 4), "day_month": month_of_day(F.col("plant") * 30).cast("long")})
    return S.calendar(c, "plant", "harvest")


@query("j08_cell_month_ranges", "SELECT cell, year, month, season_year, value FROM pos WHERE pos <= span", "pos")
def _(spark, sf):
    return S.in_season(X.monthly(spark, sf), X.calendar(spark, sf)).select("cell", "year", "month", "season_year", "value")


@query("w01_rolling_seasons", "SELECT admin1, season, season_year, sum(value) AS value, count(value) AS n_value, count(DISTINCT month) = any_value(months) AS complete FROM (SELECT admin1, season, months, month, value, CAST(CASE WHEN month >= first THEN year ELSE year - 1 END AS INT) AS season_year FROM monthly JOIN zones USING (cell), (VALUES " + ", ".join(str(x) for x in S.SEASONS) + ") s(season, first, months) WHERE (month - first + 12) % 12 < months) GROUP BY admin1, season, season_year", "monthly", "zones")
def _(spark, sf):
    return S.rolling_seasons(X.monthly(spark, sf).join(X.zones(spark, sf), "cell"), ["admin1"], "sum")


@query("w02_month_runs", "SELECT cell, CAST(floor(min(mth) / 12) AS INT) AS first_year, CAST(min(mth) % 12 + 1 AS INT) AS first_month, count(*) AS n_months FROM (SELECT cell, mth, mth - row_number() OVER (PARTITION BY cell ORDER BY mth) AS island FROM (SELECT DISTINCT cell, year * 12 + month - 1 AS mth FROM monthly)) GROUP BY cell, island", "monthly")
def _(spark, sf):
    return S.month_runs(X.monthly(spark, sf), ["cell"])


@query("w03_season_n_value", "SELECT cell, season_year, avg(value) AS mean, count(value) AS n_value FROM pos WHERE pos <= span GROUP BY ALL", "pos")
def _(spark, sf):
    return S.in_season(X.monthly(spark, sf), X.calendar(spark, sf)).groupBy("cell", "season_year").agg(F.avg("value").alias("mean"), F.count("value").alias("n_value"))


@query("f01_classify", "SELECT cell, year, month, CAST(nullif(value, 50) > 100 AS INT) AS above, CAST(nullif(value, 50) < 30 AS INT) AS below FROM monthly", "monthly")
def _(spark, sf):
    v = F.nullif("value", F.lit(50.0))
    return X.monthly(spark, sf).select("cell", "year", "month", classify(v, "G", 100.0).alias("above"), classify(v, "l", 30.0).alias("below"))


@query("f02_all_thresholds", f"SELECT cell, season_year, direction, threshold, {FLAG} AS flag FROM season, (SELECT DISTINCT direction, threshold FROM (VALUES " + ", ".join(f"('{d}', CAST({t} AS DOUBLE))" for d, t, _ in THRESHOLDS) + ") t(direction, threshold))", "season")
def _(spark, sf):
    one = season(spark, sf).withColumn("index_name", F.lit("total"))
    return H.classify_all(one, thresholds(spark).withColumn("index_name", F.lit("total")), ["index_name"]).select("cell", "season_year", "direction", "threshold", "flag")


@query("f03_share_beyond", "SELECT cell, CAST(sum(CAST(coalesce(nullif(value, 50) > 100, false) AS INT)) AS DOUBLE) / count(*) AS share FROM monthly GROUP BY cell", "monthly")
def _(spark, sf):
    return X.monthly(spark, sf).withColumn("v", F.nullif("value", F.lit(50.0))).groupBy("cell").agg(H.share_beyond("v", ">", 100.0).alias("share"))


@query("f04_interval_class", "SELECT cell, season_year, CASE WHEN value > 0 AND value <= 50 THEN 1 WHEN value > 50 AND value <= 150 THEN 2 WHEN value > 150 AND value <= 10000 THEN 3 END AS class_right, CASE WHEN value >= 0 AND value < 50 THEN 1 WHEN value >= 50 AND value < 150 THEN 2 WHEN value >= 150 AND value < 10000 THEN 3 END AS class_left FROM season", "season")
def _(spark, sf):
    breaks = [(0, 50, 1), (50, 150, 2), (150, 10000, 3)]
    return season(spark, sf).select("cell", "season_year", interval_class("value", breaks).alias("class_right"), interval_class("value", breaks, "left").alias("class_left"))


@query("f05_recode", "SELECT hazard, CASE hazard WHEN 'A' THEN 'dry' WHEN 'N' THEN 'heat' END AS label, count(*) AS n FROM yearly GROUP BY ALL", "yearly")
def _(spark, sf):
    return X.yearly(spark, sf).withColumn("label", recode("hazard", {"A": "dry", "N": "heat"})).groupBy("hazard", "label").agg(F.count(F.lit(1)).alias("n"))


@query("f06_range_clean", "SELECT cell, year, hazard, CASE WHEN value >= 300 AND value <= 1500 THEN value END AS value FROM yearly", "yearly")
def _(spark, sf):
    return X.yearly(spark, sf).withColumn("value", F.when(F.col("value").between(300, 1500), F.col("value")))


@query("f10_suspect_flag", "SELECT cell, year, hazard, value, max(CAST(value < 200 OR value > 2000 AS INT)) OVER (PARTITION BY cell, hazard) = 1 AS suspect_value_flag FROM yearly", "yearly")
def _(spark, sf):
    return H.suspect_series(X.yearly(spark, sf), ["cell", "hazard"], 200, 2000)


@query("f11_finite", "SELECT cell, year, hazard, 1 / nullif(value - 700, 0) AS inverse FROM yearly WHERE value <> 700", "yearly")
def _(spark, sf):
    from gridrisk.functions.scalars import finite

    inverse = F.when(F.col("value") == 700, F.lit(float("inf"))).otherwise(1 / F.nullif(F.col("value") - 700, F.lit(0.0)))
    return X.yearly(spark, sf).withColumn("inverse", inverse).where(finite("inverse")).select("cell", "year", "hazard", "inverse")


@query("a04_frequency", "SELECT cell, hazard, avg(flag) AS frequency FROM flags GROUP BY ALL", "flags")
def _(spark, sf):
    return H.frequency(X.flags(spark, sf), ["cell", "hazard"])


MODELS = "SELECT cell, scenario, hazard, model, nullif(sum(value), 50) AS value FROM cells GROUP BY ALL"


def _models(spark, sf):
    return X.cells(spark, sf).groupBy("cell", "scenario", "hazard", "model").agg(F.nullif(F.sum("value"), F.lit(50.0)).alias("value"))


for _name, _strict in (("a05_ensemble_strict", True), ("a06_ensemble_tolerant", False)):
    _whole = "CASE WHEN count(value) = count(*) THEN {} END" if _strict else "{}"

    @query(_name, f"SELECT cell, scenario, hazard, {_whole.format('avg(value)')} AS mean, {_whole.format('stddev_samp(value)')} AS sd, count(*) AS n_models FROM ({MODELS}) GROUP BY ALL", "cells")
    def _(spark, sf, strict=_strict):
        return H.ensemble(_models(spark, sf), ["cell", "scenario", "hazard"], strict=strict)


@query("a07_series_mean_sd", "SELECT cell, avg(value) AS mean, stddev_samp(value) AS sd FROM season GROUP BY cell", "season")
def _(spark, sf):
    return season(spark, sf).groupBy("cell").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))


@query("a08_descriptives", "SELECT cell, hazard, avg(value) AS mean, min(value) AS low, max(value) AS high, stddev_samp(value) AS sd FROM yearly GROUP BY ALL", "yearly")
def _(spark, sf):
    return X.yearly(spark, sf).groupBy("cell", "hazard").agg(F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"), F.stddev_samp("value").alias("sd"))


@query("a09_class_profile", "SELECT cell, hazard, avg(value) AS mean, CAST(avg(value) > 700 AS INT) AS mean_class, avg(CAST(value > 700 AS INT)) AS share, CAST(avg(CAST(value > 700 AS INT)) > 0.4 AS INT) AS share_class, coalesce(avg(CASE WHEN value > 700 THEN value - 700 END), 0) AS exceed_mean, coalesce(max(CASE WHEN value > 700 THEN value - 700 END), 0) AS exceed_max FROM yearly GROUP BY ALL", "yearly")
def _(spark, sf):
    return H.class_profile(X.yearly(spark, sf), ["cell", "hazard"], "value", ">", 700.0, 0.4)


@query("a10_exceedance", "SELECT cell, CASE WHEN count(v) > 0 THEN coalesce(avg(CASE WHEN v < 500 THEN 500 - v END), 0) END AS mean_below, CASE WHEN count(v) > 0 THEN coalesce(max(CASE WHEN v < 500 THEN 500 - v END), 0) END AS max_below FROM (SELECT cell, CASE WHEN cell % 7 <> 0 THEN value END AS v FROM yearly) GROUP BY cell", "yearly")
def _(spark, sf):
    rows = X.yearly(spark, sf).select("cell", F.when(F.col("cell") % 7 != 0, F.col("value")).alias("v"))
    return rows.groupBy("cell").agg(H.exceedance("v", "<", 500.0).alias("mean_below"), H.exceedance("v", "<", 500.0, "max").alias("max_below"))


@query("a11_threshold_batch", f"SELECT hazard, direction || severity AS level, avg({FLAG}) AS share FROM yearly, (VALUES ('>', CAST(600 AS DOUBLE), 'Moderate'), ('>', 900, 'Severe'), ('<', 400, 'Moderate')) t(direction, threshold, severity) GROUP BY ALL", "yearly")
def _(spark, sf):
    t = spark.createDataFrame([(">", 600.0, "Moderate"), (">", 900.0, "Severe"), ("<", 400.0, "Moderate")], "direction string, threshold double, severity string")
    rows = X.yearly(spark, sf).join(F.broadcast(t), F.lit(True)).withColumn("flag", classify("value", F.col("direction"), F.col("threshold")))
    return rows.groupBy("hazard", F.concat("direction", "severity").alias("level")).agg(F.avg("flag").alias("share"))


@query("a12_compound_code", "SELECT * FROM codes", "codes")
def _(spark, sf):
    return H.compound_code(X.flags(spark, sf), ["cell", "year"])


_COMBO_SQL = ", ".join(f"avg(CAST(code = {c} AS INT)) AS {n.replace('+', '_')}" for c, n in H.COMBOS)


@query("a13_interactions", f"SELECT cell, avg(CAST(code >= 1 AS INT)) AS any_hazard, {_COMBO_SQL} FROM codes GROUP BY cell", "codes")
def _(spark, sf):
    return H.interactions(H.compound_code(X.flags(spark, sf), ["cell", "year"]), ["cell"])


@query("a14_any_hazard", "SELECT cell, avg(CAST(code >= 1 AS INT)) AS any_hazard FROM codes GROUP BY cell", "codes")
def _(spark, sf):
    return H.interactions(H.compound_code(X.flags(spark, sf), ["cell", "year"]), ["cell"]).select("cell", "any_hazard")


@query("a15_interaction_ensemble", "SELECT admin1, combo AS hazard, avg(p) AS mean, stddev_samp(p) AS sd, count(*) AS n_models FROM (UNPIVOT (SELECT cell, avg(CAST(code >= 1 AS INT)) AS any_hazard, " + _COMBO_SQL + " FROM codes GROUP BY cell) ON COLUMNS(* EXCLUDE cell) INTO NAME combo VALUE p) JOIN zones USING (cell) GROUP BY ALL", "codes", "zones")
def _(spark, sf):
    wide = H.interactions(H.compound_code(X.flags(spark, sf), ["cell", "year"]), ["cell"])
    long = wide.unpivot("cell", [c for c in wide.columns if c != "cell"], "hazard", "value").join(X.zones(spark, sf).select("cell", "admin1"), "cell")
    return H.ensemble(long, ["admin1", "hazard"])


@query("a16_hazard_combinations", "WITH w AS (SELECT cell, year, max(flag) FILTER (hazard = 'dry') AS dry, max(flag) FILTER (hazard = 'heat') AS heat, max(flag) FILTER (hazard = 'wet') AS wet FROM f GROUP BY ALL), l AS (SELECT cell, year, CASE WHEN coalesce(dry, 0) + coalesce(heat, 0) + coalesce(wet, 0) = 0 THEN 'none' ELSE concat_ws('+', CASE WHEN dry = 1 THEN 'dry' END, CASE WHEN heat = 1 THEN 'heat' END, CASE WHEN wet = 1 THEN 'wet' END) END AS label, CAST(coalesce(dry, 0) + coalesce(heat, 0) + coalesce(wet, 0) AS INT) AS n_hazards FROM w) SELECT *, CAST(dense_rank() OVER (ORDER BY n_hazards, label) - 1 AS INT) AS combo FROM l".replace("WITH w AS", "SELECT * FROM (WITH w AS").replace("FROM f GROUP", "FROM flags GROUP") + ")", "flags")
def _(spark, sf):
    wide = X.flags(spark, sf).groupBy("cell", "year").pivot("hazard", ["dry", "heat", "wet"]).agg(F.max("flag"))
    return H.hazard_combinations(wide, ["dry", "heat", "wet"], ["cell", "year"])


@query("a18_inclusion_exclusion", "SELECT admin1, s1 - 2 * s2 + 3 * s3 AS only_one, s2 - 3 * s3 AS only_two, s3 AS only_three, s1 - s2 + s3 AS any_hazard, 100.0 * (s1 - s2 + s3) / nullif(total, 0) AS any_pct FROM (SELECT admin1, CAST(sum(CAST(code % 10 + code // 10 % 10 + code // 100 AS INT)) AS BIGINT) AS s1, CAST(sum(CASE code % 10 + code // 10 % 10 + code // 100 WHEN 2 THEN 1 WHEN 3 THEN 3 ELSE 0 END) AS BIGINT) AS s2, CAST(sum(CAST(code = 111 AS INT)) AS BIGINT) AS s3, count(*) AS total FROM codes JOIN zones USING (cell) WHERE code IS NOT NULL GROUP BY admin1)", "codes", "zones")
def _(spark, sf):
    c = H.compound_code(X.flags(spark, sf), ["cell", "year"]).where("code is not null").join(X.zones(spark, sf), "cell")
    n = F.expr("code % 10 + code div 10 % 10 + code div 100")
    sums = c.groupBy("admin1").agg(F.sum(n).cast("long").alias("s1"), F.sum(F.when(n == 2, 1).when(n == 3, 3).otherwise(0)).alias("s2"), F.sum((F.col("code") == 111).cast("int")).alias("s3"), F.count(F.lit(1)).alias("total"))
    return H.exclusive_from_overlaps(sums, "s1", "s2", "s3", "total").select("admin1", "only_one", "only_two", "only_three", "any_hazard", "any_pct")


@query("a19_union_probability", "SELECT cell, 1 - product(1 - p) AS p_any, product(p) AS p_all FROM (SELECT cell, hazard, avg(flag) AS p FROM flags GROUP BY ALL) GROUP BY cell", "flags")
def _(spark, sf):
    return H.any_of_independent(H.frequency(X.flags(spark, sf), ["cell", "hazard"]), ["cell"], "frequency")


@query("a20_independent_pairs", "SELECT a.cell, a.hazard AS one, b.hazard AS two, a.p * b.p AS p FROM (SELECT cell, hazard, avg(flag) AS p FROM flags GROUP BY ALL) a JOIN (SELECT cell, hazard, avg(flag) AS p FROM flags GROUP BY ALL) b ON a.cell = b.cell AND a.hazard < b.hazard", "flags")
def _(spark, sf):
    f = H.frequency(X.flags(spark, sf), ["cell", "hazard"])
    wide = f.groupBy("cell").pivot("hazard", ["dry", "heat", "wet"]).agg(F.first("frequency"))
    rows = F.array(*(F.struct(F.lit(a).alias("one"), F.lit(b).alias("two"), (F.col(a) * F.col(b)).alias("p")) for a, b in (("dry", "heat"), ("dry", "wet"), ("heat", "wet"))))
    return wide.select("cell", F.inline(rows)).where("p is not null")


@query("a21_risk_mask", "SELECT cell, hazard, CAST(avg(flag) >= 0.5 AS INT) AS risk FROM flags GROUP BY ALL", "flags")
def _(spark, sf):
    return H.frequency(X.flags(spark, sf), ["cell", "hazard"]).select("cell", "hazard", (F.col("frequency") >= 0.5).cast("int").alias("risk"))


@query("a22_merge_over_crops", "SELECT cell, max(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS one, max(CASE WHEN n = 2 THEN 1 ELSE 0 END) AS two, max(CAST(n >= 1 AS INT)) AS any_hazard FROM (SELECT cell, code % 10 + code // 10 % 10 + code // 100 AS n FROM codes WHERE code IS NOT NULL) GROUP BY cell", "codes")
def _(spark, sf):
    n = F.expr("code % 10 + code div 10 % 10 + code div 100")
    c = H.compound_code(X.flags(spark, sf), ["cell", "year"]).where("code is not null").withColumn("n_hazards", n).withColumn("flag", (F.col("n_hazards") >= 1).cast("int"))
    return H.merge_over_crops(c, "cell")


SEV = "SELECT cell, severity, avg(CAST(value > threshold AS INT)) AS p FROM yearly, (VALUES (CAST(500 AS DOUBLE), 'Moderate'), (700, 'Severe'), (900, 'Extreme')) t(threshold, severity) GROUP BY ALL"


def _severities(spark, sf):
    t = spark.createDataFrame([(500.0, "Moderate"), (700.0, "Severe"), (900.0, "Extreme")], "threshold double, severity string")
    return X.yearly(spark, sf).join(F.broadcast(t), F.lit(True)).groupBy("cell", "severity").agg(F.avg((F.col("value") > F.col("threshold")).cast("int")).alias("frequency"))


@query("a23_hazard_index", f"SELECT *, moderate + 2 * severe + 3 * extreme AS hazard_index FROM (SELECT cell, greatest(m - s, 0) AS moderate, greatest(s - e, 0) AS severe, e AS extreme FROM (SELECT cell, max(p) FILTER (severity = 'Moderate') AS m, max(p) FILTER (severity = 'Severe') AS s, max(p) FILTER (severity = 'Extreme') AS e FROM ({SEV}) GROUP BY cell))", "yearly")
def _(spark, sf):
    return H.hazard_index(_severities(spark, sf), ["cell"])


@query("a24_merged_severity", f"SELECT cell, severity_class, CASE severity_class WHEN 0 THEN 'None' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'Severe' ELSE 'Extreme' END AS label FROM (SELECT cell, CAST(max(CAST(p >= 0.4 AS INT) * CASE severity WHEN 'Moderate' THEN 1 WHEN 'Severe' THEN 2 ELSE 3 END) AS INT) AS severity_class FROM ({SEV}) GROUP BY cell)", "yearly")
def _(spark, sf):
    return H.merged_severity(_severities(spark, sf).withColumn("flag", (F.col("frequency") >= 0.4).cast("int")), ["cell"], {"Moderate": 1, "Severe": 2, "Extreme": 3})


@query("f20_severity_labels", f"SELECT severity, CASE severity WHEN 'Moderate' THEN 1 WHEN 'Severe' THEN 2 ELSE 3 END AS weight, avg(p) AS mean FROM ({SEV}) GROUP BY ALL", "yearly")
def _(spark, sf):
    return _severities(spark, sf).withColumn("weight", recode("severity", {"Moderate": 1, "Severe": 2, "Extreme": 3})).groupBy("severity", "weight").agg(F.avg("frequency").alias("mean"))


@query("a63_heat_days", "SELECT user_id AS cell, CAST(threshold AS DOUBLE) AS threshold, CAST(coalesce(sum(CAST(value > threshold AS INT)), 0) AS BIGINT) AS days FROM events, range(20, 51) r(threshold) GROUP BY ALL")
def _(spark, sf):
    daily = X.table(spark, sf, "events").select(F.col("user_id").alias("cell"), "value")
    return H.heat_days(daily, ["cell"], "value", [float(t) for t in range(20, 51)])


@query("a62_monthly_from_daily", "SELECT user_id AS cell, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, avg((hi + lo) / 2) AS tavg, sum(total) AS total FROM (SELECT user_id, CAST(ts AS DATE) AS ts, max(value) AS hi, min(value) AS lo, sum(value) AS total FROM events GROUP BY ALL) GROUP BY ALL")
def _(spark, sf):
    days = X.table(spark, sf, "events").groupBy(F.col("user_id").alias("cell"), F.to_date("ts").alias("day")).agg(F.max("value").alias("hi"), F.min("value").alias("lo"), F.sum("value").alias("total"))
    return days.groupBy("cell", F.year("day").alias("year"), F.month("day").alias("month")).agg(F.avg((F.col("hi") + F.col("lo")) / 2).alias("tavg"), F.sum("total").alias("total"))


@query("a64_monthly_profile", "SELECT month, CAST(model AS VARCHAR) AS model, avg(value) AS mean FROM cells GROUP BY ALL UNION ALL SELECT month, 'ENSEMBLE', avg(mean) FROM (SELECT month, model, avg(value) AS mean FROM cells GROUP BY ALL) GROUP BY month", "cells")
def _(spark, sf):
    each = X.cells(spark, sf).groupBy("month", F.col("model").cast("string").alias("model")).agg(F.avg("value").alias("mean"))
    return each.unionByName(each.groupBy("month").agg(F.avg("mean").alias("mean")).withColumn("model", F.lit("ENSEMBLE")))


@query("a65_month_row_sums", "SELECT cell, year, sum(value) AS total FROM monthly GROUP BY ALL HAVING sum(value) > 0", "monthly")
def _(spark, sf):
    wide = X.monthly(spark, sf).groupBy("cell", "year").pivot("month", list(range(1, 13))).agg(F.sum("value"))
    return wide.select("cell", "year", sum((F.coalesce(F.col(str(m)), F.lit(0.0)) for m in range(1, 13)), F.lit(0.0)).alias("total")).where("total > 0")


@query("a70_share_of_years", "SELECT admin1, label, CAST(count(*) AS DOUBLE) / any_value(n_years) AS share FROM (SELECT admin1, year, CASE WHEN value > 15000 THEN 'high' ELSE 'low' END AS label, (SELECT count(DISTINCT year) FROM monthly) AS n_years FROM (SELECT admin1, year, sum(value) AS value FROM monthly JOIN zones USING (cell) GROUP BY ALL)) GROUP BY admin1, label", "monthly", "zones")
def _(spark, sf):
    y = X.monthly(spark, sf).join(X.zones(spark, sf), "cell").groupBy("admin1", "year").agg(F.sum("value").alias("value"))
    n = X.monthly(spark, sf).agg(F.countDistinct("year").alias("n_years"))
    label = F.when(F.col("value") > 15000, "high").otherwise("low").alias("label")
    return y.join(F.broadcast(n), F.lit(True)).groupBy("admin1", label).agg((F.count(F.lit(1)) / F.first("n_years")).alias("share"))


@query("a69_calendar_histogram", "SELECT plant, span, count(*) AS n FROM calendar GROUP BY ALL", "calendar")
def _(spark, sf):
    return X.calendar(spark, sf).groupBy("plant", "span").agg(F.count(F.lit(1)).alias("n"))


@query("w10_dense_index", "SELECT cell, year, CAST(dense_rank() OVER (PARTITION BY cell ORDER BY year) AS INT) AS nth, CAST(row_number() OVER (PARTITION BY cell ORDER BY value DESC, year) AS INT) AS by_value FROM (SELECT cell, year, sum(value) AS value FROM monthly GROUP BY ALL)", "monthly")
def _(spark, sf):
    y = X.monthly(spark, sf).groupBy("cell", "year").agg(F.sum("value").alias("value"))
    return y.select("cell", "year", F.dense_rank().over(Window.partitionBy("cell").orderBy("year")).alias("nth"), F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("value"), "year")).alias("by_value"))


@query("a37_area_past_future", "SELECT admin1, sum(CASE WHEN s = 'F' AND v > 20 THEN v ELSE 0 END) AS past, sum(CASE WHEN s = 'O' AND v > 20 THEN v ELSE 0 END) AS future, sum(CASE WHEN s = 'O' AND v > 20 THEN v ELSE 0 END) - sum(CASE WHEN s = 'F' AND v > 20 THEN v ELSE 0 END) AS diff, 100 * (sum(CASE WHEN s = 'O' AND v > 20 THEN v ELSE 0 END) - sum(CASE WHEN s = 'F' AND v > 20 THEN v ELSE 0 END)) / nullif(sum(CASE WHEN s = 'F' AND v > 20 THEN v ELSE 0 END), 0) AS pct FROM (SELECT cell, scenario AS s, month, sum(value) AS v FROM cells GROUP BY ALL) JOIN zones USING (cell) GROUP BY admin1", "cells", "zones")
def _(spark, sf):
    v = X.cells(spark, sf).groupBy("cell", "scenario", "month").agg(F.sum("value").alias("v")).join(X.zones(spark, sf), "cell")

    def area(s):
        return F.sum(F.when((F.col("scenario") == s) & (F.col("v") > 20), F.col("v")).otherwise(0))

    return v.groupBy("admin1").agg(area("F").alias("past"), area("O").alias("future")).withColumn("diff", F.col("future") - F.col("past")).withColumn("pct", 100 * safe_ratio("diff", "past"))
