"""Queries of the exposure, economics, reshape, join and scalar operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import safe_ratio
from gridrisk.operators import economics as E
from gridrisk.operators import exposure as G
from gridrisk.operators import hazards as H
from gridrisk.operators import zonal as Z
from gridrisk.plans import fixtures as X
from gridrisk.plans.registry import query


@query("g01_cell_share", "SELECT cell, crop, round(value, 2) AS value, value / nullif(sum(value) OVER (PARTITION BY admin1, crop), 0) AS share FROM exposure JOIN zones USING (cell)", "exposure", "zones")
def _(spark, sf):
    rows = X.exposure(spark, sf).join(X.zones(spark, sf).select("cell", "admin1"), "cell")
    return G.share_of_total(rows, ["admin1", "crop"]).select("cell", "crop", F.round("value", 2).alias("value"), "share")


@query("g02_distribute", "SELECT cell, crop, share * total AS allocated FROM (SELECT cell, crop, admin1, value / nullif(sum(value) OVER (PARTITION BY admin1, crop), 0) AS share FROM exposure JOIN zones USING (cell)) LEFT JOIN (SELECT admin1, sum(value) AS total FROM natyear GROUP BY admin1) USING (admin1)", "exposure", "zones", "natyear")
def _(spark, sf):
    rows = X.exposure(spark, sf).join(X.zones(spark, sf).select("cell", "admin1"), "cell")
    totals = X.nation_years(spark, sf).groupBy("admin1").agg(F.sum("value").alias("total"))
    return G.distribute(G.share_of_total(rows, ["admin1", "crop"]), totals, ["admin1"]).select("cell", "crop", "allocated")


@query("g03_split_crop", "SELECT cell, coalesce(part, crop) AS part, sum(value * coalesce(ratio, 1)) AS value FROM exposure LEFT JOIN (VALUES ('Brand#11', 'arabica', 0.7), ('Brand#11', 'robusta', 0.3)) r(c, part, ratio) ON c = crop GROUP BY ALL", "exposure")
def _(spark, sf):
    parts = F.inline(F.array(F.struct(F.lit("arabica").alias("part"), F.lit(0.7).alias("ratio")), F.struct(F.lit("robusta").alias("part"), F.lit(0.3).alias("ratio"))))
    e = X.exposure(spark, sf)
    split = e.where("crop = 'Brand#11'").select("cell", "value", parts)
    rows = split.unionByName(e.where("crop <> 'Brand#11'").select("cell", "value", F.col("crop").alias("part"), F.lit(1.0).alias("ratio")))
    return rows.groupBy("cell", "part").agg(F.sum(F.col("value") * F.col("ratio")).alias("value"))


@query("g04_irrigated_share", "SELECT cell, hazard, year, value * coalesce(s, 0) AS irrigated, value * (1 - coalesce(s, 0)) AS rainfed FROM (SELECT *, CASE WHEN cell % 3 <> 0 THEN (cell % 10) / 10.0 END AS s FROM yearly)", "yearly")
def _(spark, sf):
    s = F.coalesce(F.when(F.col("cell") % 3 != 0, F.col("cell") % 10 / 10.0), F.lit(0.0))
    return X.yearly(spark, sf).select("cell", "hazard", "year", (F.col("value") * s).alias("irrigated"), (F.col("value") * (1 - s)).alias("rainfed"))


@query("g05_production_value", "SELECT n_name AS admin1, p_brand AS crop, round(sum(l_quantity) * any_value(price), 2) AS worth FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN (SELECT p_brand AS b, round(avg(p_retailprice), 2) AS price FROM part GROUP BY p_brand) ON b = p_brand GROUP BY ALL")
def _(spark, sf):
    part = X.table(spark, sf, "part")
    made = X.table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).join(X.zones(spark, sf), F.col("l_suppkey") == F.col("cell")).groupBy("admin1", F.col("p_brand").alias("crop")).agg(F.sum("l_quantity").alias("quantity"))
    prices = part.groupBy(F.col("p_brand").alias("crop")).agg(F.round(F.avg("p_retailprice"), 2).alias("price"))
    return G.production_value(made, prices, ["crop"]).select("admin1", "crop", "worth")


@query("g06_sibling_price", "SELECT p_brand AS crop, count(*) AS n FROM part GROUP BY p_brand UNION ALL SELECT 'sibling of ' || p_brand, count(*) FROM part WHERE p_brand IN ('Brand#11', 'Brand#12') GROUP BY p_brand")
def _(spark, sf):
    n = X.table(spark, sf, "part").groupBy(F.col("p_brand").alias("crop")).agg(F.count(F.lit(1)).alias("n"))
    return n.unionByName(n.where(F.col("crop").isin("Brand#11", "Brand#12")).withColumn("crop", F.concat(F.lit("sibling of "), "crop")))


@query("g07_complete_keys", "SELECT admin1, CAST(y AS INT) AS year, value FROM (SELECT DISTINCT admin1 FROM zones) z, range(1994, 2003) r(y) LEFT JOIN (SELECT admin1 AS a, year, value FROM natyear) ON a = admin1 AND year = y", "natyear", "zones")
def _(spark, sf):
    keys = X.zones(spark, sf).select("admin1").distinct().select("admin1", F.explode(F.sequence(F.lit(1994), F.lit(2002))).alias("year"))
    return keys.join(X.nation_years(spark, sf).select("admin1", "year", "value"), ["admin1", "year"], "left")


BLANK = "SELECT admin1, admin0, CASE WHEN substr(admin1, length(admin1)) NOT IN ('1', '4', '7', 'A', 'N', 'E') THEN v END AS value FROM (SELECT admin1, admin0, sum(value) AS v FROM natyear GROUP BY ALL)"


def _blank(spark, sf):
    v = X.nation_years(spark, sf).groupBy("admin1", "admin0").agg(F.sum("value").alias("v"))
    return v.select("admin1", "admin0", F.when(~F.expr("substr(admin1, length(admin1))").isin("1", "4", "7", "A", "N", "E"), F.col("v")).alias("value"))


NEAR = "SELECT a.admin1, b.admin1 AS neighbour FROM ({0}) a JOIN ({0}) b ON a.admin0 = b.admin0 AND a.admin1 < b.admin1 AND length(a.admin1) = length(b.admin1)"
FILL = "WITH v AS ({0}), e AS (" + NEAR.format("SELECT * FROM v") + "), near AS (SELECT e.admin1, avg(v.value) AS m FROM e JOIN v ON neighbour = v.admin1 GROUP BY e.admin1), w AS (SELECT v.*, near.m, {1} AS region, avg(value) OVER () AS whole FROM v LEFT JOIN near USING (admin1)) SELECT admin1, admin0, value, CASE WHEN value IS NOT NULL THEN 'own' WHEN m IS NOT NULL THEN 'neighbours' WHEN region IS NOT NULL THEN 'region' WHEN whole IS NOT NULL THEN 'all' END AS source, coalesce(value, m, region, whole) AS filled FROM w"
OTHERS = "(sum(value) OVER (PARTITION BY admin0) - coalesce(value, 0)) / nullif(count(value) OVER (PARTITION BY admin0) - CAST(value IS NOT NULL AS INT), 0)"


def _edges(v):
    a, b = v.select("admin1", "admin0"), v.select(F.col("admin1").alias("neighbour"), F.col("admin0").alias("z"))
    return a.join(b, (F.col("admin0") == F.col("z")) & (F.col("admin1") < F.col("neighbour")) & (F.length("admin1") == F.length("neighbour"))).select("admin1", "neighbour")


for _name, _self, _sql in (("g08_nearby_fill", False, OTHERS), ("g09_fill_with_self", True, "avg(value) OVER (PARTITION BY admin0)")):

    @query(_name, "SELECT * FROM (" + FILL.format(BLANK, _sql) + ")", "natyear")
    def _(spark, sf, include=_self):
        v = _blank(spark, sf)
        return G.nearby_fill(v, _edges(v), "admin1", "admin0", [], include_self=include)


@query("j15_neighbour_mean", "SELECT * FROM (WITH v AS (SELECT admin1, admin0, v AS value FROM (SELECT admin1, admin0, sum(value) AS v FROM natyear GROUP BY ALL)) SELECT e.admin1, avg(value) AS mean FROM (" + NEAR.format("SELECT * FROM v") + ") e JOIN v ON neighbour = v.admin1 GROUP BY e.admin1)", "natyear")
def _(spark, sf):
    v = X.nation_years(spark, sf).groupBy("admin1", "admin0").agg(F.sum("value").alias("value"))
    return _edges(v).join(v.select(F.col("admin1").alias("neighbour"), "value"), "neighbour").groupBy("admin1").agg(F.avg("value").alias("mean"))


@query("g10_price_ladder", "SELECT admin1, coalesce(avg(value) FILTER (year = 2002), median(value) FILTER (year BETWEEN 1999 AND 2001), (SELECT avg(value) FROM natyear)) AS price FROM natyear GROUP BY admin1", "natyear")
def _(spark, sf):
    y = X.nation_years(spark, sf)
    rows = y.groupBy("admin1").agg(F.avg(F.when(F.col("year") == 2002, F.col("value"))).alias("a"), F.median(F.when(F.col("year").between(1999, 2001), F.col("value"))).alias("b"))
    return rows.join(F.broadcast(y.agg(F.avg("value").alias("c"))), F.lit(True)).select("admin1", F.coalesce("a", "b", "c").alias("price"))


@query("g11_hybrid_ladder", "SELECT cell, crop, coalesce(CASE WHEN cell % 4 = 0 THEN v END, CASE WHEN cell % 3 = 0 THEN n END, w) AS value FROM (SELECT cell, crop, round(value, 2) AS v, avg(value) OVER (PARTITION BY admin1, crop) AS n, avg(value) OVER (PARTITION BY crop) AS w FROM exposure JOIN zones USING (cell))", "exposure", "zones")
def _(spark, sf):
    rows = X.exposure(spark, sf).join(X.zones(spark, sf).select("cell", "admin1"), "cell")
    n, w = rows.groupBy("admin1", "crop").agg(F.avg("value").alias("n")), rows.groupBy("crop").agg(F.avg("value").alias("w"))
    own = F.when(F.col("cell") % 4 == 0, F.round("value", 2))
    return rows.join(n, ["admin1", "crop"]).join(w, "crop").select("cell", "crop", F.coalesce(own, F.when(F.col("cell") % 3 == 0, F.col("n")), "w").alias("value"))


@query("g13_period_ratio", "SELECT admin1, avg(value) FILTER (year >= 1999) / nullif(avg(value) FILTER (year < 1998), 0) AS ratio FROM natyear GROUP BY admin1", "natyear")
def _(spark, sf):
    y = X.nation_years(spark, sf)
    return y.groupBy("admin1").agg(safe_ratio(F.avg(F.when(F.col("year") >= 1999, F.col("value"))), F.avg(F.when(F.col("year") < 1998, F.col("value")))).alias("ratio"))


@query("g14_livestock_units", "SELECT cell, 0.7 * coalesce(a, 0) + 0.1 * coalesce(n, 0) + 0.01 * coalesce(r, 0) AS units FROM (SELECT cell, sum(value) FILTER (hazard = 'A') AS a, sum(value) FILTER (hazard = 'N') AS n, sum(value) FILTER (hazard = 'R') AS r FROM yearly GROUP BY cell)", "yearly")
def _(spark, sf):
    w = X.yearly(spark, sf).groupBy("cell").pivot("hazard", ["A", "N", "R"]).agg(F.sum("value"))
    return G.livestock_units(w, {"cattle": "A", "goats": "N", "poultry": "R"}).select("cell", "units")


@query("g15_mask_split", "SELECT cell, hazard || CASE WHEN m = 1 THEN '-highland' ELSE '-tropical' END AS kind, sum(value) AS value FROM (SELECT *, CAST(cell % 2 AS INT) AS m FROM yearly) GROUP BY ALL", "yearly")
def _(spark, sf):
    kind = F.concat("hazard", F.when(F.col("cell") % 2 == 1, "-highland").otherwise("-tropical")).alias("kind")
    return X.yearly(spark, sf).groupBy("cell", kind).agg(F.sum("value").alias("value"))


@query("g16_risk_exposure", "SELECT admin1, crop, sum(p * value) AS at_risk FROM freq JOIN exposure USING (cell) JOIN zones USING (cell) GROUP BY ALL", "freq", "exposure", "zones")
def _(spark, sf):
    r = G.risk_times_exposure(X.heat_frequency(spark, sf), X.exposure(spark, sf)).join(X.zones(spark, sf), "cell")
    return r.groupBy("admin1", "crop").agg(F.sum("at_risk").alias("at_risk"))


@query("j16_generic_fan_out", "SELECT crop, sum(at_risk) AS at_risk FROM (SELECT crop, p * value AS at_risk FROM freq JOIN exposure USING (cell) UNION ALL SELECT 'generic-crop', p * v FROM freq JOIN (SELECT cell, sum(value) AS v FROM exposure GROUP BY cell) USING (cell)) GROUP BY crop", "freq", "exposure")
def _(spark, sf):
    return G.generic_fan_out(X.heat_frequency(spark, sf), X.exposure(spark, sf)).groupBy("crop").agg(F.sum("at_risk").alias("at_risk"))


INT = "SELECT admin1, combo AS hazard, sum(p) AS value FROM (UNPIVOT (SELECT cell, " + ", ".join(f"avg(CAST(code = {c} AS INT)) AS \"{n}\"" for c, n in H.COMBOS) + " FROM codes GROUP BY cell) ON COLUMNS(* EXCLUDE cell) INTO NAME combo VALUE p) JOIN zones USING (cell) GROUP BY ALL"


def _combos(spark, sf):
    w = H.interactions(H.compound_code(X.flags(spark, sf), ["cell", "year"]), ["cell"])
    names = {n.replace("+", "_"): n for _, n in H.COMBOS}
    long = w.unpivot("cell", list(names), "k", "v").withColumn("hazard", F.replace("k", F.lit("_"), F.lit("+")))
    return long.join(X.zones(spark, sf), "cell").groupBy("admin1", "hazard").agg(F.sum("v").alias("value"))


@query("g17_no_hazard", f"SELECT * FROM (WITH i AS ({INT}), t AS (SELECT admin1, CAST(count(*) AS DOUBLE) AS total FROM zones GROUP BY admin1), a AS (SELECT admin1, sum(value) AS value FROM i GROUP BY admin1) SELECT admin1, 'any' AS hazard, value FROM a UNION ALL SELECT admin1, 'no hazard', total - value FROM a JOIN t USING (admin1))", "codes", "zones")
def _(spark, sf):
    any_ = _combos(spark, sf).groupBy("admin1").agg(F.sum("value").alias("value")).withColumn("hazard", F.lit("any"))
    totals = X.zones(spark, sf).groupBy("admin1").agg(F.count(F.lit(1)).cast("double").alias("total"))
    return G.no_hazard(any_, totals, ["admin1"])


@query("g18_hazard_groups", f"SELECT admin1, hazard_group, sum(value) AS value FROM (SELECT admin1, (len(string_split(hazard, '+'))) || CASE WHEN len(string_split(hazard, '+')) = 1 THEN ' hazard' ELSE ' hazards' END AS hazard_group, value FROM ({INT}) UNION ALL SELECT admin1, unnest(string_split(hazard, '+')) || ' (any)', value FROM ({INT})) GROUP BY ALL", "codes", "zones")
def _(spark, sf):
    return G.hazard_groups(_combos(spark, sf), ["admin1"])


@query("g19_scenario_compare", "SELECT admin1, b AS before, a AS after, a - b AS diff, 100 * (a - b) / nullif(b, 0) AS pct FROM (SELECT admin1, sum(value) FILTER (scenario = 'F') AS b, sum(value) FILTER (scenario = 'O') AS a FROM cells JOIN zones USING (cell) GROUP BY admin1)", "cells", "zones")
def _(spark, sf):
    v = X.cells(spark, sf).join(X.zones(spark, sf), "cell").groupBy("admin1", "scenario").agg(F.sum("value").alias("value"))
    one = {s: v.where(F.col("scenario") == s).select("admin1", "value") for s in "FO"}
    return G.compare(one["F"], one["O"], ["admin1"])


@query("g19_confidence", f"SELECT hazard, m AS mean, s AS sd, 100 * s / nullif(m, 0) AS cv, m - {G.T_975_4} / sqrt(5) * s AS low, m + {G.T_975_4} / sqrt(5) * s AS high FROM (SELECT hazard, avg(v) AS m, stddev_samp(v) AS s FROM (SELECT hazard, model, sum(value) AS v FROM cells GROUP BY ALL) GROUP BY hazard)", "cells")
def _(spark, sf):
    v = X.cells(spark, sf).groupBy("hazard", "model").agg(F.sum("value").alias("v")).groupBy("hazard").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"))
    return G.confidence(v, "mean", "sd")


@query("g20_crop_shares", "SELECT admin0, crop, v / sum(v) OVER (PARTITION BY admin0) AS share FROM (SELECT admin0, crop, sum(value) AS v FROM exposure JOIN zones USING (cell) GROUP BY ALL)", "exposure", "zones")
def _(spark, sf):
    v = X.exposure(spark, sf).join(X.zones(spark, sf), "cell").groupBy("admin0", "crop").agg(F.sum("value").alias("value"))
    return G.share_of_total(v, ["admin0"]).select("admin0", "crop", "share")


@query("g21_two_seasons", "SELECT cell, year, s AS share2, t * s AS season2, t - t * s AS season1 FROM (SELECT cell, year, t, coalesce(w2 / nullif(w1 + w2, 0), 0.5) AS s FROM (SELECT cell, year, sum(value) AS t, sum(value) FILTER (month <= 6) AS w1, sum(value) FILTER (month > 6) AS w2 FROM monthly GROUP BY ALL))", "monthly")
def _(spark, sf):
    m = X.monthly(spark, sf).groupBy("cell", "year").agg(F.sum("value").alias("t"), F.sum(F.when(F.col("month") <= 6, F.col("value"))).alias("w1"), F.sum(F.when(F.col("month") > 6, F.col("value"))).alias("w2"))
    return G.two_seasons(m, "w1", "w2", "t").select("cell", "year", "share2", "season2", "season1")


@query("g29_adoption", "SELECT n_name AS admin1, CAST(t AS INT) AS t, 0.6 * (1 - pow(0.8, t)) AS adopted FROM nation, range(1, 17) r(t)")
def _(spark, sf):
    rows = X.table(spark, sf, "nation").select(F.col("n_name").alias("admin1"), F.explode(F.sequence(F.lit(1), F.lit(16))).alias("t"))
    return rows.select("admin1", "t", E.adoption(F.lit(0.6), 0.2, "t").alias("adopted"))


@query("g30_adopters", "SELECT admin1, year, value * a AS adopters, value - value * a AS others, 100 * a AS pct FROM (SELECT *, 0.5 * (1 - pow(0.9, year - 1994)) AS a FROM natyear)", "natyear")
def _(spark, sf):
    a = E.adoption(F.lit(0.5), 0.1, F.col("year") - 1994)
    return X.nation_years(spark, sf).withColumn("a", a).select("admin1", "year", (F.col("value") * F.col("a")).alias("adopters"), (F.col("value") - F.col("value") * F.col("a")).alias("others"), (100 * F.col("a")).alias("pct"))


@query("g31_impact", "SELECT admin1, impact, total * (1 + impact) AS result, total * impact AS marginal, total * impact - total * impact / 1.5 AS project_benefit FROM (SELECT admin1, sum(value) AS total FROM natyear GROUP BY admin1), (VALUES (CAST(0.05 AS DOUBLE)), (0.1), (0.2)) i(impact)", "natyear")
def _(spark, sf):
    t = X.nation_years(spark, sf).groupBy("admin1").agg(F.sum("value").alias("total"))
    t = t.withColumn("impact", F.explode(F.array(*map(F.lit, (0.05, 0.1, 0.2))))).withColumn("marginal", F.col("total") * F.col("impact"))
    return t.select("admin1", "impact", (F.col("total") * (1 + F.col("impact"))).alias("result"), "marginal", (F.col("marginal") - F.col("marginal") / 1.5).alias("project_benefit"))


@query("g32_avoided_loss", "SELECT admin1, greatest((cv - 0.8 * cv) / sqrt(2 * pi()), 0) AS avoided FROM (SELECT admin1, stddev_samp(value) / avg(value) AS cv FROM natyear GROUP BY admin1)", "natyear")
def _(spark, sf):
    cv = X.nation_years(spark, sf).groupBy("admin1").agg((F.stddev_samp("value") / F.avg("value")).alias("cv"))
    return cv.select("admin1", E.avoided_loss("cv", F.col("cv") * 0.8).alias("avoided"))


FLOW = "SELECT admin1, year - 1995 AS t, CASE WHEN year = 1995 THEN -2 * value ELSE value END AS flow FROM natyear"


def _flows(spark, sf):
    return X.nation_years(spark, sf).select("admin1", (F.col("year") - 1995).alias("t"), F.when(F.col("year") == 1995, -2 * F.col("value")).otherwise(F.col("value")).alias("flow"))


@query("g33_npv", f"SELECT admin1, t, flow, sum(flow / pow(1.05, t)) OVER (PARTITION BY admin1 ORDER BY t ROWS UNBOUNDED PRECEDING) AS npv FROM ({FLOW})", "natyear")
def _(spark, sf):
    return E.npv(_flows(spark, sf), ["admin1"], 0.05)


@query("g34_mirr", f"SELECT admin1, t, flow, CASE WHEN i > 0 AND o > 0 AND t > 0 THEN pow(i / o, 1.0 / t) - 1 END AS mirr FROM (SELECT *, sum(greatest(flow, 0) / pow(1.04, t)) OVER w * pow(1.04, t) AS i, sum(greatest(-flow, 0) / pow(1.06, t)) OVER w AS o FROM ({FLOW}) WINDOW w AS (PARTITION BY admin1 ORDER BY t ROWS UNBOUNDED PRECEDING))", "natyear")
def _(spark, sf):
    return E.mirr(_flows(spark, sf), ["admin1"], 0.06, 0.04)


#: Net present value of a list of flows at a rate.
WORTH = "list_sum(list_transform(flows, lambda x: x.flow / pow(1 + {}, x.t)))"
IRR = (
    f"WITH RECURSIVE f AS (SELECT admin1, t, list({{'t': t, 'flow': flow}}) OVER (PARTITION BY admin1 ORDER BY t ROWS UNBOUNDED PRECEDING) AS flows FROM ({FLOW})), "
    f"b AS (SELECT 0 AS step, admin1, t, flows, CAST(-0.9 AS DOUBLE) AS lo, CAST(10 AS DOUBLE) AS hi, sign({WORTH.format('CAST(-0.9 AS DOUBLE)')}) AS low_sign FROM f WHERE sign({WORTH.format('CAST(-0.9 AS DOUBLE)')}) * sign({WORTH.format('CAST(10 AS DOUBLE)')}) < 0 "
    f"UNION ALL SELECT step + 1, admin1, t, flows, CASE WHEN up THEN mid ELSE lo END, CASE WHEN up THEN hi ELSE mid END, low_sign FROM (SELECT *, (lo + hi) / 2 AS mid, sign({WORTH.format('(lo + hi) / 2')}) = low_sign AS up FROM b WHERE step < 60)) "
    "SELECT admin1, t, round((lo + hi) / 2, 6) AS irr FROM f LEFT JOIN (SELECT admin1, t, lo, hi FROM b WHERE step = 60) USING (admin1, t)"
)


@query("g35_irr", f"SELECT * FROM ({IRR})", "natyear")
def _(spark, sf):
    return E.irr(_flows(spark, sf), ["admin1"]).select("admin1", "t", F.round("irr", 6).alias("irr"))


@query("g36_discounted_bcr", f"SELECT admin1, t, sum(late / pow(1.05, t)) OVER w / nullif(sum(cost / pow(1.05, t)) OVER w, 0) AS bcr FROM (SELECT admin1, t, cost, lag(flow, 2, 0) OVER (PARTITION BY admin1 ORDER BY t) AS late FROM (SELECT admin1, t, flow, CAST(1000 + 10 * t AS DOUBLE) AS cost FROM ({FLOW}))) WINDOW w AS (PARTITION BY admin1 ORDER BY t ROWS UNBOUNDED PRECEDING)", "natyear")
def _(spark, sf):
    rows = _flows(spark, sf).withColumn("cost", (1000 + 10 * F.col("t")).cast("double"))
    return E.discounted_ratio(rows, ["admin1"], 0.05, "flow", "cost", delay=2).select("admin1", "t", "bcr")


@query("w09_shift", f"SELECT admin1, t, lag(flow, 3, 0) OVER (PARTITION BY admin1 ORDER BY t) AS shifted FROM ({FLOW})", "natyear")
def _(spark, sf):
    return _flows(spark, sf).select("admin1", "t", F.lag("flow", 3, 0.0).over(Window.partitionBy("admin1").orderBy("t")).alias("shifted"))


@query("g37_crop_ranking", "SELECT crop, round(sum(value), 2) AS value FROM exposure GROUP BY crop ORDER BY 2 DESC LIMIT 10", "exposure")
def _(spark, sf):
    return X.exposure(spark, sf).groupBy("crop").agg(F.round(F.sum("value"), 2).alias("value")).orderBy(F.desc("value")).limit(10)


@query("w12_dominant", "SELECT cell, string_agg(hazard, '+' ORDER BY hazard) AS hazard, any_value(v) AS value FROM (SELECT cell, hazard, v, max(v) OVER (PARTITION BY cell) AS m FROM (SELECT cell, hazard, sum(value) AS v FROM yearly GROUP BY ALL)) WHERE v = m GROUP BY cell", "yearly")
def _(spark, sf):
    v = X.yearly(spark, sf).groupBy("cell", "hazard").agg(F.sum("value").alias("value"))
    return Z.dominant(v, ["cell"], "hazard", "value")


@query("o02_top_and_other", "WITH v AS (SELECT crop, sum(value) AS s FROM e GROUP BY crop), t AS (SELECT crop FROM v ORDER BY s DESC LIMIT 5) SELECT CASE WHEN crop IN (SELECT crop FROM t) THEN crop ELSE 'other' END AS crop, round(sum(s), 2) AS value FROM v GROUP BY 1".replace("FROM e ", "FROM (SELECT p_brand AS crop, sum(l_extendedprice) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_brand) "))
def _(spark, sf):
    return Z.top_and_other(X.exposure(spark, sf), "crop", "value", 5).withColumn("value", F.round("value", 2))


@query("g40_system_crosstab", "SELECT admin0, crop, 100 * v / sum(v) OVER (PARTITION BY admin0) AS pct FROM (SELECT admin0, crop, sum(value) AS v FROM exposure JOIN zones USING (cell) GROUP BY ALL)", "exposure", "zones")
def _(spark, sf):
    v = X.exposure(spark, sf).join(X.zones(spark, sf), "cell").groupBy("admin0", "crop").agg(F.sum("value").alias("value"))
    return G.share_of_total(v, ["admin0"]).select("admin0", "crop", (100 * F.col("share")).alias("pct"))


@query("g42_unified_exposure", "SELECT lower(replace(p_brand, '#', '-')) AS crop, 'usd' AS unit, round(sum(l_extendedprice), 2) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL UNION ALL SELECT 'livestock-' || c_mktsegment, 'head', round(sum(c_acctbal), 2) FROM customer GROUP BY ALL")
def _(spark, sf):
    crops = X.exposure(spark, sf).groupBy(F.lower(F.replace("crop", F.lit("#"), F.lit("-"))).alias("crop")).agg(F.round(F.sum("value"), 2).alias("value")).withColumn("unit", F.lit("usd"))
    stock = X.table(spark, sf, "customer").groupBy(F.concat(F.lit("livestock-"), "c_mktsegment").alias("crop")).agg(F.round(F.sum("c_acctbal"), 2).alias("value")).withColumn("unit", F.lit("head"))
    return crops.unionByName(stock)


@query("g44_currency", "SELECT admin1, year, value / rate AS usd FROM natyear JOIN (SELECT DISTINCT year, 1 + (year - 1995) * 0.05 AS rate FROM natyear) USING (year)", "natyear")
def _(spark, sf):
    y = X.nation_years(spark, sf)
    rates = y.select("year").distinct().withColumn("rate", 1 + (F.col("year") - 1995) * 0.05)
    return y.join(rates, "year").select("admin1", "year", (F.col("value") / F.col("rate")).alias("usd"))


@query("a41_headline_pivot", "SELECT scenario, year, sum(value) FILTER (hazard = 'A') AS A, sum(value) FILTER (hazard = 'N') AS N, sum(value) FILTER (hazard = 'R') AS R FROM cells GROUP BY ALL", "cells")
def _(spark, sf):
    return X.cells(spark, sf).groupBy("scenario", "year").pivot("hazard", ["A", "N", "R"]).agg(F.sum("value"))


@query("a42_history_compare", "SELECT cell, hazard, h AS before, f AS after, f - h AS diff, 100 * (f - h) / nullif(h, 0) AS pct FROM (SELECT cell, hazard, sum(value) FILTER (year <= 1997) AS h, sum(value) FILTER (year >= 1999) AS f FROM yearly GROUP BY ALL) WHERE h IS NOT NULL OR f IS NOT NULL", "yearly")
def _(spark, sf):
    y = X.yearly(spark, sf)
    a, b = (y.where(c).groupBy("cell", "hazard").agg(F.sum("value").alias("value")) for c in ("year <= 1997", "year >= 1999"))
    return G.compare(a, b, ["cell", "hazard"])


@query("a71_exposure_pct", "SELECT admin1, crop, round(value, 2) AS value, 100 * value / sum(value) OVER (PARTITION BY crop) AS pct FROM (SELECT admin1, crop, sum(value) AS value FROM exposure JOIN zones USING (cell) GROUP BY ALL)", "exposure", "zones")
def _(spark, sf):
    v = X.exposure(spark, sf).join(X.zones(spark, sf), "cell").groupBy("admin1", "crop").agg(F.sum("value").alias("value"))
    return G.share_of_total(v, ["crop"]).select("admin1", "crop", F.round("value", 2).alias("value"), (100 * F.col("share")).alias("pct"))


@query("a54_change_ensemble", "SELECT hazard, avg(d) AS mean, max(d) AS high, min(d) AS low, stddev_samp(d) AS sd, avg(100 * d / nullif(b, 0)) AS pct FROM (SELECT hazard, model, b, a - b AS d FROM (SELECT hazard, model, sum(value) FILTER (year <= 1997) AS b, sum(value) FILTER (year >= 1999) AS a FROM cells GROUP BY ALL)) GROUP BY hazard", "cells")
def _(spark, sf):
    c = X.cells(spark, sf)
    a, b = (c.where(w).groupBy("hazard", "model").agg(F.sum("value").alias("value")) for w in ("year <= 1997", "year >= 1999"))
    return G.compare(a, b, ["hazard", "model"]).groupBy("hazard").agg(F.avg("diff").alias("mean"), F.max("diff").alias("high"), F.min("diff").alias("low"), F.stddev_samp("diff").alias("sd"), F.avg("pct").alias("pct"))


@query("p01_unpivot", "SELECT cell, k, v FROM (UNPIVOT (SELECT cell, sum(value) FILTER (hazard = 'A') AS A, sum(value) FILTER (hazard = 'N') AS N, sum(value) FILTER (hazard = 'R') AS R FROM yearly GROUP BY cell) ON A, N, R INTO NAME k VALUE v)", "yearly")
def _(spark, sf):
    w = X.yearly(spark, sf).groupBy("cell").pivot("hazard", ["A", "N", "R"]).agg(F.sum("value"))
    return w.unpivot("cell", ["A", "N", "R"], "k", "v").where("v is not null")


@query("p02_pivot", "SELECT cell, " + ", ".join(f"sum(value) FILTER (hazard = '{h}') AS {h}_total, max(value) FILTER (hazard = '{h}') AS {h}_top" for h in "ANR") + " FROM yearly GROUP BY cell", "yearly")
def _(spark, sf):
    return X.yearly(spark, sf).groupBy("cell").pivot("hazard", ["A", "N", "R"]).agg(F.sum("value").alias("total"), F.max("value").alias("top"))


@query("p03_unequal_depth", "SELECT admin0, NULL AS admin1, count(*) AS n FROM zones GROUP BY admin0 UNION ALL SELECT admin0, admin1, count(*) FROM zones GROUP BY ALL", "zones")
def _(spark, sf):
    z = X.zones(spark, sf)
    return z.groupBy("admin0").agg(F.count(F.lit(1)).alias("n")).unionByName(z.groupBy("admin0", "admin1").agg(F.count(F.lit(1)).alias("n")), allowMissingColumns=True)


@query("j01_cellwise", "SELECT a.cell, a.year, a.value - b.value AS diff, a.value * b.value AS product FROM yearly a JOIN yearly b ON a.cell = b.cell AND a.year = b.year AND a.hazard = 'A' AND b.hazard = 'R'", "yearly")
def _(spark, sf):
    y = X.yearly(spark, sf)
    a, b = (y.where(F.col("hazard") == h).select("cell", "year", F.col("value").alias(h)) for h in "AR")
    return a.join(b, ["cell", "year"]).select("cell", "year", (F.col("A") - F.col("R")).alias("diff"), (F.col("A") * F.col("R")).alias("product"))


@query("j02_null_safe_left", "WITH k AS (SELECT CASE WHEN cell % 5 <> 0 THEN admin1 END AS admin1, count(*) AS n FROM z GROUP BY 1) SELECT k.admin1, n, m FROM k LEFT JOIN (SELECT CASE WHEN cell % 7 <> 0 THEN admin1 END AS admin1, count(*) AS m FROM z GROUP BY 1) r ON k.admin1 IS NOT DISTINCT FROM r.admin1".replace("FROM z ", "FROM (SELECT s_suppkey AS cell, n_name AS admin1 FROM supplier JOIN nation ON s_nationkey = n_nationkey) "))
def _(spark, sf):
    z = X.zones(spark, sf)
    k, r = (z.groupBy(F.when(F.col("cell") % d != 0, F.col("admin1")).alias("admin1")).agg(F.count(F.lit(1)).alias(n)) for d, n in ((5, "n"), (7, "m")))
    return k.alias("k").join(r.alias("r"), F.expr("k.admin1 <=> r.admin1"), "left").select("k.admin1", "n", "m")


@query("j05_expansion", "SELECT n_name AS admin1, a AS adoption, CAST(y AS INT) AS year FROM nation, (VALUES (CAST(0.1 AS DOUBLE)), (0.3), (0.5)) v(a), range(1, 17) r(y)")
def _(spark, sf):
    n = X.table(spark, sf, "nation").select(F.col("n_name").alias("admin1"))
    return n.withColumn("adoption", F.explode(F.array(*map(F.lit, (0.1, 0.3, 0.5))))).withColumn("year", F.explode(F.sequence(F.lit(1), F.lit(16))))


@query("j07_many_to_many", "SELECT species, count(DISTINCT p_partkey) AS parts, avg(p_size) AS size FROM (SELECT p_partkey, p_size, unnest(string_split(p_type, ' ')) AS species FROM part) GROUP BY species")
def _(spark, sf):
    s = X.table(spark, sf, "part").select("p_partkey", "p_size", F.explode(F.split("p_type", " ")).alias("species"))
    return s.groupBy("species").agg(F.countDistinct("p_partkey").alias("parts"), F.avg("p_size").alias("size"))


@query("j13_mean_sd_join", "SELECT cell, hazard, avg(value) AS value, stddev_samp(value) AS value_sd, 'ENSEMBLE' AS model FROM yearly GROUP BY ALL", "yearly")
def _(spark, sf):
    return X.yearly(spark, sf).groupBy("cell", "hazard").agg(F.avg("value").alias("value"), F.stddev_samp("value").alias("value_sd")).withColumn("model", F.lit("ENSEMBLE"))


@query("w05_group_total", "SELECT cell, year, hazard, value, sum(value) OVER (PARTITION BY cell) AS total FROM yearly", "yearly")
def _(spark, sf):
    return X.yearly(spark, sf).withColumn("total", F.sum("value").over(Window.partitionBy("cell")))


@query("w06_first_last_rows", "SELECT cell, hazard, year, value FROM (SELECT *, row_number() OVER (PARTITION BY cell, hazard ORDER BY year DESC) AS r FROM yearly) WHERE r <= 2", "yearly")
def _(spark, sf):
    w = Window.partitionBy("cell", "hazard").orderBy(F.desc("year"))
    return X.yearly(spark, sf).withColumn("r", F.row_number().over(w)).where("r <= 2").drop("r")


@query("w08_running_sum", "SELECT cell, hazard, year, sum(value) OVER (PARTITION BY cell, hazard ORDER BY year ROWS UNBOUNDED PRECEDING) AS running FROM yearly", "yearly")
def _(spark, sf):
    return X.yearly(spark, sf).select("cell", "hazard", "year", F.sum("value").over(E.running(["cell", "hazard"], "year")).alias("running"))


@query("w11_group_size", "SELECT cell, hazard, year, count(*) OVER (PARTITION BY cell, hazard) AS n FROM yearly", "yearly")
def _(spark, sf):
    return X.yearly(spark, sf).select("cell", "hazard", "year", F.count(F.lit(1)).over(Window.partitionBy("cell", "hazard")).alias("n"))


@query("o01_sort", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey")
def _(spark, sf):
    return X.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc_nulls_last("c_acctbal"), "c_custkey")


@query("o05_distinct", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def _(spark, sf):
    return X.table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus").distinct()


@query("o06_set_difference", "SELECT p_brand FROM part WHERE p_size < 25 EXCEPT ALL SELECT p_brand FROM part WHERE p_size >= 25")
def _(spark, sf):
    p = X.table(spark, sf, "part")
    return p.where("p_size < 25").select("p_brand").exceptAll(p.where("p_size >= 25").select("p_brand"))


@query("f07_split_name", "SELECT split_part(p_name, ' ', 1) AS first, split_part(p_type, ' ', 1) AS kind, count(*) AS n FROM part GROUP BY ALL")
def _(spark, sf):
    return X.table(spark, sf, "part").groupBy(F.split("p_name", " ").getItem(0).alias("first"), F.split("p_type", " ").getItem(0).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("f08_ordered_relabel", "SELECT regexp_replace(regexp_replace(p_brand, '^Brand', 'crop', 'g'), '#', '_', 'g') AS label, count(*) AS n FROM part GROUP BY ALL")
def _(spark, sf):
    return X.table(spark, sf, "part").groupBy(F.regexp_replace(F.regexp_replace("p_brand", "^Brand", "crop"), "#", "_").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("f09_alias", "SELECT CASE WHEN hazard = 'A' THEN 'PTOT_' || CASE WHEN cell % 2 = 0 THEN 'L' ELSE 'G' END ELSE regexp_replace('NTxS38', '[0-9]+$', '') END AS alias, count(*) AS n FROM yearly GROUP BY ALL", "yearly")
def _(spark, sf):
    a = F.when(F.col("hazard") == "A", F.concat_ws("_", F.lit("PTOT"), F.when(F.col("cell") % 2 == 0, "L").otherwise("G"))).otherwise(F.regexp_replace(F.lit("NTxS38"), "[0-9]+$", ""))
    return X.yearly(spark, sf).groupBy(a.alias("alias")).agg(F.count(F.lit(1)).alias("n"))


@query("f16_blank_outliers", "SELECT admin1, year, CASE WHEN NOT (year = 1997 AND admin1 IN (SELECT n_name FROM nation WHERE n_nationkey IN (3, 5))) THEN value END AS value FROM natyear", "natyear")
def _(spark, sf):
    bad = X.table(spark, sf, "nation").where(F.col("n_nationkey").isin(3, 5)).select(F.col("n_name").alias("admin1"), F.lit(1997).alias("year"), F.lit(True).alias("bad"))
    return X.nation_years(spark, sf).join(F.broadcast(bad), ["admin1", "year"], "left").select("admin1", "year", F.when(F.col("bad").isNull(), F.col("value")).alias("value"))  # a hand-made list


@query("f19_periods", "SELECT period, admin1, avg(value) AS mean FROM natyear JOIN (VALUES ('early', 1995, 1997), ('late', 1998, 2001)) p(period, a, b) ON year BETWEEN a AND b GROUP BY ALL", "natyear")
def _(spark, sf):
    p = spark.createDataFrame([("early", 1995, 1997), ("late", 1998, 2001)], "period string, a int, b int")
    return X.nation_years(spark, sf).join(F.broadcast(p), F.col("year").between(F.col("a"), F.col("b"))).groupBy("period", "admin1").agg(F.avg("value").alias("mean"))


@query("s03_predicate_read", "SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F' AND l_quantity > 40")
def _(spark, sf):
    return X.table(spark, sf, "lineitem").where(F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "F") & (F.col("l_quantity") > 40)).select("l_suppkey", "l_quantity")


@query("s18_patch", "SELECT CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'A' ELSE l_returnflag END AS flag, count(*) AS n FROM lineitem GROUP BY ALL")
def _(spark, sf):
    flag = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "A").otherwise(F.col("l_returnflag"))
    return X.table(spark, sf, "lineitem").groupBy(flag.alias("flag")).agg(F.count(F.lit(1)).alias("n"))
