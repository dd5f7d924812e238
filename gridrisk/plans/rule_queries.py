"""Queries of the workflow's rules, fed by lookups that are derived from the given tables; their SQL states each rule by itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridrisk.operators import exposure as G
from gridrisk.operators import rules as R
from gridrisk.operators import zonal as Z
from gridrisk.plans import fixtures as X
from gridrisk.plans.registry import query


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


LAYERS = "k AS (SELECT l_suppkey AS cell, p_brand AS commodity, CAST(sum(l_extendedprice) AS DOUBLE) AS vop, CAST(sum(l_quantity) AS DOUBLE) AS ha, CAST(count(*) AS DOUBLE) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL), e AS (SELECT cell, commodity, 'vop' AS variable, vop AS value FROM k UNION ALL SELECT cell, commodity, 'ha', ha FROM k UNION ALL SELECT cell, commodity, 'n', n FROM k)"


def _layers(spark, sf):
    part = X.table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("commodity"))
    k = X.table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_suppkey").alias("cell"), "commodity").agg(F.sum("l_extendedprice").alias("vop"), F.sum("l_quantity").alias("ha"), F.count(F.lit(1)).cast("double").alias("n"))
    return k.unpivot(["cell", "commodity"], ["vop", "ha", "n"], "variable", "value")


@query("g16_selected_exposure", "SELECT * FROM (WITH " + LAYERS + ", f AS (SELECT cell, CASE hazard WHEN 'heat' THEN 'Brand#11' WHEN 'wet' THEN 'Brand#15' ELSE 'generic-crop' END AS commodity, avg(flag) AS p FROM flags GROUP BY ALL), crops AS (SELECT * FROM e WHERE commodity NOT LIKE '%5' AND variable <> 'n') SELECT commodity, variable, sum(r) AS at_risk, count(*) AS n_cells FROM (SELECT e.commodity, variable, p * value AS r FROM f JOIN e USING (cell, commodity) WHERE (commodity LIKE '%5' AND variable <> 'ha') OR (commodity NOT LIKE '%5' AND variable <> 'n') UNION ALL SELECT crops.commodity, variable, p * value FROM f JOIN crops USING (cell) WHERE f.commodity = 'generic-crop' UNION ALL SELECT 'generic-crop', variable, p * v FROM f JOIN (SELECT cell, variable, sum(value) AS v FROM crops GROUP BY ALL) USING (cell) WHERE f.commodity = 'generic-crop') GROUP BY ALL)", "flags")
def _(spark, sf):
    layers = _layers(spark, sf)
    commodity = F.when(F.col("hazard") == "heat", "Brand#11").when(F.col("hazard") == "wet", "Brand#15").otherwise("generic-crop").alias("commodity")
    freq = X.flags(spark, sf).groupBy("cell", commodity).agg(F.avg("flag").alias("p"))
    kinds = layers.select("commodity").distinct().withColumn("kind", F.when(F.col("commodity").endswith("5"), "livestock").otherwise("crop"))
    return R.selected_exposure(freq, layers, kinds).groupBy("commodity", "variable").agg(F.sum("at_risk").alias("at_risk"), F.count(F.lit(1)).alias("n_cells"))


@query("g07_national_statistics", "SELECT iso3, crop, CAST(y AS INT) AS year, value FROM (SELECT n_name AS iso3 FROM nation WHERE n_regionkey IN (0, 2)) c CROSS JOIN (VALUES ('maize'), ('millet')) k(crop) CROSS JOIN range(1993, 2003) r(y) LEFT JOIN (SELECT n_name AS iso3, CASE o_orderstatus WHEN 'F' THEN 'maize' ELSE 'millet' END AS crop, year(o_orderdate) AS y, sum(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND c_mktsegment = 'BUILDING' GROUP BY ALL) USING (iso3, crop, y)")
def _(spark, sf):
    orders = X.table(spark, sf, "orders").join(X.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    df = orders.select(F.col("c_nationkey").alias("area"), F.col("o_orderstatus").alias("item"), F.col("c_mktsegment").alias("element"), F.col("o_orderpriority").alias("unit"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("value"))
    items = _frame(spark, [("F", "maize"), ("O", "millet"), ("P", "millet")], "item string, crop string")
    areas = X.table(spark, sf, "nation").where("n_regionkey in (0, 2)").select(F.col("n_nationkey").alias("area"), F.col("n_name").alias("iso3"))
    return R.national_statistics(df, items, areas, "BUILDING", ["1-URGENT", "2-HIGH"], 1993, 2002)


PRICES = "o AS (SELECT n_name AS unit, o_orderpriority AS crop, CAST(year(o_orderdate) AS INT) AS year, avg(o_totalprice) AS price, any_value(n_nationkey) AS nk FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3), p AS (SELECT unit, crop, year, price FROM o WHERE NOT ((nk + ascii(crop)) % 3 = 0 AND year >= 2000) AND (nk + ascii(crop)) % 4 <> 1 AND NOT (nk % 5 = 1 AND nk > 10)), places AS (SELECT n_name AS unit, r_name AS region, CASE WHEN r_regionkey < 2 THEN 'south' ELSE 'north' END AS continent FROM nation JOIN region ON n_regionkey = r_regionkey), edges AS (SELECT a.n_name AS unit, b.n_name AS neighbour FROM nation a JOIN nation b ON b.n_nationkey = a.n_nationkey + 1 OR b.n_nationkey = a.n_nationkey - 1)"


_LADDER = """own AS (SELECT pl.*, c.crop, t.recent, t.longer FROM places pl CROSS JOIN (SELECT DISTINCT crop FROM p) c LEFT JOIN (SELECT unit, crop, median(price) FILTER (year BETWEEN 2000 AND 2001) AS recent, median(price) FILTER (year BETWEEN 1996 AND 2001) AS longer FROM p GROUP BY ALL) t ON t.unit = pl.unit AND t.crop = c.crop),
g AS (SELECT crop, median(price) AS glo FROM (SELECT o_orderpriority AS crop, year(o_orderdate) AS y, avg(o_totalprice) AS price FROM orders GROUP BY ALL) WHERE y BETWEEN 2000 AND 2001 GROUP BY crop),
m AS (SELECT own.*, glo, (SELECT avg(o2.recent) FROM edges JOIN own o2 ON o2.unit = edges.neighbour WHERE edges.unit = own.unit AND o2.crop = own.crop) AS near, avg(recent) OVER (PARTITION BY region, own.crop) AS reg, avg(recent) OVER (PARTITION BY continent, own.crop) AS con, avg(longer) OVER (PARTITION BY own.crop) AS lon FROM own LEFT JOIN g USING (crop)),
f AS (SELECT unit, crop, lon, CASE WHEN crop = '5-LOW' THEN coalesce(glo, con) ELSE coalesce(recent, longer, near, reg, con, glo) END AS price, CASE WHEN crop = '5-LOW' THEN CASE WHEN glo IS NOT NULL THEN 'of_all' WHEN con IS NOT NULL THEN 'of_continent' END WHEN recent IS NOT NULL THEN 'recent' WHEN longer IS NOT NULL THEN 'longer' WHEN near IS NOT NULL THEN 'near' WHEN reg IS NOT NULL THEN 'of_region' WHEN con IS NOT NULL THEN 'of_continent' WHEN glo IS NOT NULL THEN 'of_all' END AS step FROM m)
SELECT unit, crop, CASE WHEN crop = '2-HIGH' AND price < 150000 THEN lon ELSE price END AS price, CASE WHEN crop = '2-HIGH' AND price < 150000 THEN 'of_longer' ELSE step END AS step FROM f"""


@query("g10_full_price_ladder", "SELECT * FROM (WITH " + PRICES + ", " + _LADDER + ")")
def _(spark, sf):
    nation, region = X.table(spark, sf, "nation"), X.table(spark, sf, "region")
    orders = X.table(spark, sf, "orders").join(X.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    o = orders.groupBy(F.col("n_name").alias("unit"), F.col("o_orderpriority").alias("crop"), F.year("o_orderdate").alias("year"), F.col("n_nationkey").alias("nk")).agg(F.avg("o_totalprice").alias("price"))
    k = F.col("nk") + F.ascii("crop")
    p = o.where(~((k % 3 == 0) & (F.col("year") >= 2000)) & (k % 4 != 1) & ~((F.col("nk") % 5 == 1) & (F.col("nk") > 10))).drop("nk")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("unit"), F.col("r_name").alias("region"), F.when(F.col("r_regionkey") < 2, "south").otherwise("north").alias("continent"))
    near = nation.select(F.col("n_name").alias("unit"), F.explode(F.array(F.col("n_nationkey") - 1, F.col("n_nationkey") + 1)).alias("at"))
    edges = near.join(nation.select(F.col("n_nationkey").alias("at"), F.col("n_name").alias("neighbour")), "at").select("unit", "neighbour")
    world = X.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("crop"), F.year("o_orderdate").alias("year")).agg(F.avg("o_totalprice").alias("price"))
    return R.price_ladder(p, places, edges, (2000, 2001), ["5-LOW"], {"2-HIGH": 150000.0}, world, longer=4)


def _places(spark, sf):
    """unit, region, continent of the nations, and pairs of those with numbers next to each other."""
    nation, region = X.table(spark, sf, "nation"), X.table(spark, sf, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("unit"), F.col("r_name").alias("region"), F.when(F.col("r_regionkey") < 2, "south").otherwise("north").alias("continent"))
    near = nation.select(F.col("n_name").alias("unit"), F.explode(F.array(F.col("n_nationkey") - 1, F.col("n_nationkey") + 1)).alias("at"))
    return places, near.join(nation.select(F.col("n_nationkey").alias("at"), F.col("n_name").alias("neighbour")), "at").select("unit", "neighbour")


_HYBRID = """q AS (SELECT n_name AS unit, p_brand AS crop, n_nationkey AS k, p_size, l_quantity AS quantity, l_extendedprice AS worth FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
u AS (SELECT unit, crop, any_value(k) AS k, sum(quantity) AS production, sum(worth) / sum(quantity) AS price FROM q GROUP BY ALL), pr AS (SELECT unit, crop, CASE WHEN (k + length(crop) + ascii(right(crop, 1))) % 3 = 0 THEN price END AS price FROM u WHERE crop <> 'Brand#11'),
wo AS (SELECT crop, sum(worth) / 1000 / sum(quantity) AS wp FROM q WHERE crop <> 'Brand#22' GROUP BY crop),
l AS (SELECT pr.*, region, continent, (SELECT avg(p2.price) FROM edges JOIN pr p2 ON p2.unit = edges.neighbour AND p2.crop = pr.crop WHERE edges.unit = pr.unit) AS nb, (sum(price) OVER (PARTITION BY region, crop) - coalesce(price, 0)) / nullif(count(price) OVER (PARTITION BY region, crop) - CAST(price IS NOT NULL AS INT), 0) AS rg, avg(price) OVER (PARTITION BY continent, crop) AS ct FROM pr JOIN places USING (unit)),
v AS (SELECT u.unit, u.crop, round(production * l.price / 1000, 2) AS own, round(production * nb / 1000, 2) AS near, round(production * rg / 1000, 2) AS of_region, round(production * ct / 1000, 2) AS of_continent, production * wp AS of_world FROM u LEFT JOIN l ON l.unit = u.unit AND l.crop = u.crop LEFT JOIN wo ON wo.crop = u.crop)
SELECT *, coalesce(own, near, of_region, of_continent, of_world) AS value, CASE WHEN own IS NOT NULL THEN 'own' WHEN near IS NOT NULL THEN 'near' WHEN of_region IS NOT NULL THEN 'of_region' WHEN of_continent IS NOT NULL THEN 'of_continent' WHEN of_world IS NOT NULL THEN 'of_world' END AS step, coalesce(own, near, of_region, of_continent) AS value_nearby, coalesce(own, of_world) AS value_world FROM v"""


@query("g11_five_steps", "SELECT * FROM (WITH " + PRICES + ", " + _HYBRID + ")")
def _(spark, sf):
    part = X.table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("crop"))
    who = X.table(spark, sf, "supplier").join(X.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("unit"), F.col("n_nationkey").alias("k"))
    q = X.table(spark, sf, "lineitem").join(who, F.col("l_suppkey") == F.col("s_suppkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    u = q.groupBy("unit", "crop", "k").agg(F.sum("l_quantity").alias("production"), (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("price"))
    known = (F.col("k") + F.length("crop") + F.ascii(F.right("crop", F.lit(1)))) % 3 == 0
    prices = u.where("crop <> 'Brand#11'").select("unit", "crop", F.when(known, F.col("price")).alias("price"))
    world = q.where("crop <> 'Brand#22'").groupBy("crop").agg((F.sum("l_extendedprice") / 1000).alias("value"), F.sum("l_quantity").alias("production"))
    return G.hybrid_value(u.select("unit", "crop", "production"), prices, world, *_places(spark, sf), digits=2)


@query("g03_split_by_production", "SELECT * FROM (WITH c AS (SELECT c_nationkey AS unit, c_mktsegment AS crop, sum(c_acctbal) AS value FROM customer GROUP BY ALL), r AS (SELECT s_nationkey AS unit, CASE WHEN s_suppkey % 3 = 0 THEN 'robusta' ELSE 'arabica' END AS part, CAST(count(*) AS DOUBLE) AS production FROM supplier WHERE s_nationkey % 4 <> 0 GROUP BY ALL), w AS (SELECT part, sum(production) / (SELECT sum(production) FROM r) AS s FROM r GROUP BY part) SELECT unit, crop, value FROM c WHERE crop <> 'MACHINERY' UNION ALL SELECT c.unit, w.part, c.value * CASE WHEN c.unit IN (SELECT unit FROM r) THEN coalesce(r.production / (SELECT sum(x.production) FROM r x WHERE x.unit = c.unit), 0) ELSE w.s END FROM c CROSS JOIN w LEFT JOIN r ON r.unit = c.unit AND r.part = w.part WHERE c.crop = 'MACHINERY')")
def _(spark, sf):
    c = X.table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("unit"), F.col("c_mktsegment").alias("crop")).agg(F.sum("c_acctbal").alias("value"))
    part = F.when(F.col("s_suppkey") % 3 == 0, "robusta").otherwise("arabica").alias("part")
    r = X.table(spark, sf, "supplier").where("s_nationkey % 4 <> 0").groupBy(F.col("s_nationkey").alias("unit"), part).agg(F.count(F.lit(1)).cast("double").alias("production"))
    return R.split_by_ratio(c, r, "MACHINERY")


@query("g06_sibling_prices", "SELECT * FROM (WITH p AS (SELECT p_size AS unit, p_brand AS crop, avg(p_retailprice) AS price FROM part GROUP BY ALL), s(crop, sibling) AS (VALUES ('Brand#11', 'Brand#12'), ('Brand#11', 'arabica'), ('Brand#13', 'Brand#14')) SELECT unit, crop, price FROM p UNION ALL SELECT p.unit, sibling, price FROM p JOIN s USING (crop) WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.unit = p.unit AND q.crop = sibling))")
def _(spark, sf):
    p = X.table(spark, sf, "part").groupBy(F.col("p_size").alias("unit"), F.col("p_brand").alias("crop")).agg(F.avg("p_retailprice").alias("price"))
    return R.copy_to_siblings(p, _frame(spark, [("Brand#11", "Brand#12"), ("Brand#11", "arabica"), ("Brand#13", "Brand#14")], "crop string, sibling string"))


SEASONS = "q AS (SELECT l_suppkey AS cell, n_name AS admin0, CASE WHEN l_suppkey % 7 <> 0 THEN 1 + min(dayofyear(l_shipdate)) FILTER (l_linenumber = 1) % 36 END AS s1, CASE WHEN l_suppkey % 7 <> 0 THEN 1 + min(dayofyear(l_shipdate)) FILTER (l_linenumber = 2) % 36 END AS e1, CASE WHEN l_suppkey % 5 = 0 THEN 1 + min(dayofyear(l_shipdate)) FILTER (l_linenumber = 3) % 36 END AS s2, CASE WHEN l_suppkey % 5 = 0 THEN 1 + min(dayofyear(l_shipdate)) FILTER (l_linenumber = 4) % 36 END AS e2 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)"


def _dekads(spark, sf):
    """Seasons of each cell in dekads, with a total for either."""
    own = X.table(spark, sf, "lineitem").join(X.table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(X.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    day = {c: F.min(F.when(F.col("l_linenumber") == i, F.dayofyear("l_shipdate"))) % 36 + 1 for i, c in enumerate(("s1", "e1", "s2", "e2"), 1)}
    q = own.groupBy(F.col("l_suppkey").alias("cell"), F.col("n_name").alias("admin0")).agg(*(v.alias(k) for k, v in day.items()), *(F.sum(F.when(F.col("l_linenumber") == n, F.col("l_quantity"))).alias(c) for c, n in (("rain1", 1), ("rain2", 3))))
    q = q.select("cell", "admin0", *(F.when(F.col("cell") % 7 != 0, F.col(c)).alias(c) for c in ("s1", "e1", "rain1")), *(F.when(F.col("cell") % 5 == 0, F.col(c)).alias(c) for c in ("s2", "e2", "rain2")))
    return q.withColumns({"lgp1": F.col("e1") - F.col("s1"), "lgp2": F.col("e2") - F.col("s2")})


LATE = ["NATION_3", "NATION_4", "NATION_7", "NATION_11"]


@query("g22_repair_seasons", "SELECT * FROM (WITH " + SEASONS + ", b AS (SELECT *, coalesce(s1 > 30 AND s2 IS NULL AND admin0 IN ('NATION_3', 'NATION_4', 'NATION_7', 'NATION_11'), false) AS late FROM q), c AS (SELECT cell, admin0, CASE WHEN NOT late THEN s1 END AS s1, CASE WHEN NOT late THEN e1 END AS e1, CASE WHEN NOT late THEN e1 - s1 END AS l1, CASE WHEN late THEN s1 ELSE s2 END AS s2, CASE WHEN late THEN e1 ELSE e2 END AS e2, CASE WHEN late THEN e1 - s1 ELSE e2 - s2 END AS l2 FROM b), d AS (SELECT cell, admin0, " + ", ".join(f"month(DATE '2024-01-01' + CAST(10 * {x} AS INT)) AS {x}" for x in ("s1", "e1", "s2", "e2")) + ", ceil(l1 / 3.0) AS l1, ceil(l2 / 3.0) AS l2 FROM c), e AS (SELECT cell, admin0, s1, s2, l1, l2, " + ", ".join(f"CASE WHEN s{i} = e{i} THEN CASE WHEN e{i} = 12 THEN 1 ELSE e{i} + 1 END ELSE e{i} END AS e{i}" for i in (1, 2)) + " FROM d) SELECT cell, admin0, " + ", ".join(f"CAST(coalesce({x}1, {x}2) AS INT) AS {y}1, CAST(CASE WHEN {x}1 IS NOT NULL THEN {x}2 END AS INT) AS {y}2" for x, y in (("s", "s"), ("e", "e"), ("l", "lgp"))) + " FROM e)")
def _(spark, sf):
    return R.repair_seasons(_dekads(spark, sf).drop("rain1", "rain2"), LATE)


@query("g22_moved_totals", "SELECT * FROM (WITH " + SEASONS.replace(" FROM lineitem", ", CASE WHEN l_suppkey % 7 <> 0 THEN sum(l_quantity) FILTER (l_linenumber = 1) END AS r1, CASE WHEN l_suppkey % 5 = 0 THEN sum(l_quantity) FILTER (l_linenumber = 3) END AS r2 FROM lineitem") + ", b AS (SELECT *, coalesce(s1 > 20 AND s2 IS NULL AND admin0 <> 'NATION_1', false) AS late FROM q) SELECT cell, CASE WHEN NOT late THEN r1 END AS rain1, CASE WHEN late THEN r1 ELSE r2 END AS rain2 FROM b)")
def _(spark, sf):
    q = _dekads(spark, sf)
    countries = [r[0] for r in X.table(spark, sf, "nation").where("n_name <> 'NATION_1'").select("n_name").collect()]  # 24 names
    return R.repair_seasons(q, countries, 20, [("rain1", "rain2")]).select("cell", "rain1", "rain2")


CLAIMS = "cl(disputed, claimant, iso3) AS (VALUES (1, 2, 'N2'), (1, 3, 'N3'), (5, 2, 'N2'), (5, 10, 'N10'), (9, 10, 'N10'), (9, 3, 'N3')), s0 AS (SELECT s_nationkey AS code, CASE WHEN s_suppkey % 3 = 0 THEN 'part' END AS admin1, CAST(s_suppkey % 4 AS INT) AS scenario, s_acctbal AS v FROM supplier), z AS (SELECT code, coalesce(iso3, 'N' || code) AS iso3, admin1, scenario, sum(CASE WHEN v > 0 THEN v END) AS value FROM s0 LEFT JOIN cl ON disputed = code GROUP BY ALL), w AS (SELECT s_nationkey AS code, count(*) AS n_cells FROM supplier GROUP BY ALL), codes AS (SELECT disputed AS code FROM cl UNION SELECT claimant FROM cl)"
for _how, _sql in (("mean", "sum(value * n_cells) / nullif(sum(n_cells) FILTER (value IS NOT NULL), 0)"), ("sum", "coalesce(sum(value), 0)"), ("min", "min(value)"), ("max", "max(value)")):

    @query(f"a56_merge_claims_{_how}", "SELECT * FROM (WITH " + CLAIMS + f" SELECT code, iso3, admin1, scenario, value FROM z WHERE admin1 IS NOT NULL OR code NOT IN (SELECT code FROM codes) UNION ALL SELECT CAST(substr(iso3, 2) AS INT), iso3, NULL, scenario, {_sql} FROM z JOIN w USING (code) WHERE admin1 IS NULL AND code IN (SELECT code FROM codes) GROUP BY iso3, scenario)")
    def _(spark, sf, how=_how):
        """Each disputed code has a row for either claimant, as zonal tables have."""
        claims = _frame(spark, [(1, 2, "N2"), (1, 3, "N3"), (5, 2, "N2"), (5, 10, "N10"), (9, 10, "N10"), (9, 3, "N3")], "disputed long, claimant long, iso3 string")
        s = X.table(spark, sf, "supplier").withColumn("code", F.col("s_nationkey").cast("long"))
        named = s.join(F.broadcast(claims.select(F.col("disputed").alias("code"), "iso3")), "code", "left").withColumn("iso3", F.coalesce("iso3", F.concat(F.lit("N"), F.col("code").cast("string"))))  # six rows
        z = named.groupBy("code", "iso3", F.when(F.col("s_suppkey") % 3 == 0, "part").alias("admin1"), (F.col("s_suppkey") % 4).cast("int").alias("scenario")).agg(F.sum(F.when(F.col("s_acctbal") > 0, F.col("s_acctbal"))).alias("value"))
        return R.merge_claims(z, claims, s.groupBy("code").agg(F.count(F.lit(1)).alias("n_cells")), "code", ["iso3", "scenario"], how)


@query("r01_regrid_areas", "SELECT * FROM (WITH m AS (SELECT cell, sum(value) AS value FROM cells GROUP BY cell) SELECT n AS cell, value / nullif(cos(radians(cell % 60)), 0) * cos(radians(cell % 60 + 0.25 * (n % 2))) / 2 AS value FROM (SELECT cell, value, unnest([2 * cell, 2 * cell + 1]) AS n FROM m))", "cells")
def _(spark, sf):
    m = X.cells(spark, sf).groupBy("cell").agg(F.sum("value").alias("value"))
    old = m.select("cell", F.cos(F.radians(F.col("cell") % 60)).alias("area"))
    pairs = m.select(F.col("cell").alias("nearest"), F.explode(F.array(F.col("cell") * 2, F.col("cell") * 2 + 1)).alias("cell"))
    new = pairs.select("cell", (F.cos(F.radians(F.col("nearest") % 60 + 0.25 * (F.col("cell") % 2))) / 2).alias("area"))
    return R.regrid(m, old, new, pairs)


SPECIES = "sp AS (SELECT p_brand AS crop, p_size AS opt, p_size + 0.5 * (p_partkey % 7) AS mid, p_size + 10.25 AS abs FROM part)"
for _name, _dir, _mid in (("g25_crop_thresholds", "below", "mid"), ("g25_high_rain_thresholds", "above", "ceil(mid)")):

    @query(_name, "SELECT * FROM (WITH " + SPECIES + " " + " UNION ALL ".join(f"SELECT crop, '{s}' AS severity, CAST(avg({c}) AS DOUBLE) AS threshold, 'H' AS hazard FROM sp GROUP BY crop" for s, c in (("moderate", "opt"), ("severe", _mid), ("extreme", "abs"))) + ")")
    def _(spark, sf, direction=_dir):
        return R.crop_thresholds(_species(spark, sf), "H", direction)


def _species(spark, sf):
    part = X.table(spark, sf, "part")
    return part.select(F.col("p_brand").alias("crop"), F.col("p_size").cast("double").alias("opt"), (F.col("p_size") + 0.5 * (F.col("p_partkey") % 7)).alias("mid"), (F.col("p_size") + 10.25).alias("abs"))


_LIMITS = "sp AS (SELECT CAST(p_partkey AS VARCHAR) AS species, p_size % 13 + 4.5 AS topt0, p_size % 13 - 2.25 AS tabs0, p_size % 17 + 25.75 AS topt1, p_size % 17 + 32.5 + p_partkey % 4 AS tabs1, 300.0 + p_size AS ropt0, 250.0 - p_size AS rabs0, CASE WHEN p_partkey % 9 <> 0 THEN 900.0 + p_size END AS ropt1, 1500.5 + p_partkey % 7 AS rabs1 FROM part WHERE p_partkey % 5 <> 0), o AS (SELECT p_brand AS crop, sp.* FROM part JOIN sp ON species = CAST(p_partkey AS VARCHAR))"
_RAIN_TEMP = [(k, d, s, x) for k, d, xs in (("PTOT", "<", ("ropt0", "(ropt0 + rabs0) / 2", "rabs0")), ("PTOT", ">", ("ropt1", "ceil((ropt1 + rabs1) / 2)", "rabs1")), ("TAVG", "<", ("topt0", "(topt0 + tabs0) / 2", "tabs0")), ("TAVG", ">", ("topt1", "(topt1 + tabs1) / 2", "tabs1"))) for s, x in zip(("Moderate", "Severe", "Extreme"), xs, strict=True)]
_HOT = [(k, x, s, n) for k, x, days in (("NTxM", "trunc(topt1)", (7, 14, 21)), ("NTxS", "ceil((topt1 + tabs1) / 2)", (7, 14, 21)), ("NTxE", "trunc(tabs1)", (1, 5, 10))) for s, n in zip(("Moderate", "Severe", "Extreme"), days, strict=True)]


@query("g25_ecocrop_table", "SELECT * FROM (WITH " + _LIMITS + " " + " UNION ALL ".join([f"SELECT '{k}' AS index_name, '{s}' AS description, '{d}' AS direction, crop, CAST(avg({x}) AS DOUBLE) AS threshold FROM o GROUP BY crop" for k, d, s, x in _RAIN_TEMP] + [f"SELECT '{k}' || CAST(ceil(avg({x})) AS BIGINT), '{s}', '>', crop, {n}.0 FROM o GROUP BY crop" for k, x, s, n in _HOT]) + ")")
def _(spark, sf):
    part = X.table(spark, sf, "part")
    crops = part.groupBy(F.col("p_brand").alias("crop")).agg(F.array_join(F.collect_list(F.col("p_partkey").cast("string")), " ; ").alias("sci_name"))
    n, k = F.col("p_size"), F.col("p_partkey")
    limits = {"temp_opt_min": n % 13 + 4.5, "temp_abs_min": n % 13 - 2.25, "temp_opt_max": n % 17 + 25.75, "temp_abs_max": n % 17 + 32.5 + k % 4, "rain_opt_min": n + 300.0, "rain_abs_min": 250.0 - n, "rain_opt_max": F.when(k % 9 != 0, n + 900.0), "rain_abs_max": k % 7 + 1500.5}
    species = part.where("p_partkey % 5 <> 0").select(k.cast("string").alias("species"), *(v.cast("double").alias(c) for c, v in limits.items()))
    return R.ecocrop_thresholds(crops, species)


THRESHOLDS = "th AS (SELECT p_brand AS crop, p_type AS hazard, CASE p_size % 2 WHEN 0 THEN 'severe' ELSE 'extreme' END AS severity, avg(p_retailprice) AS threshold FROM part WHERE p_partkey % 11 <> 0 GROUP BY ALL)"


def _thresholds(spark, sf):
    return X.table(spark, sf, "part").where("p_partkey % 11 <> 0").groupBy(F.col("p_brand").alias("crop"), F.col("p_type").alias("hazard"), F.when(F.col("p_size") % 2 == 0, "severe").otherwise("extreme").alias("severity")).agg(F.avg("p_retailprice").alias("threshold"))


@query("g26_inherited_thresholds", "SELECT * FROM (WITH " + THRESHOLDS + " SELECT a.crop, hazard, severity, threshold FROM th CROSS JOIN (VALUES ('cattle'), ('goats')) a(crop) WHERE th.crop = 'Brand#11' AND hazard <> 'ECONOMY')")
def _(spark, sf):
    generic = _thresholds(spark, sf).where("crop = 'Brand#11'").select("hazard", "severity", "threshold")
    return R.inherit_thresholds(generic, _frame(spark, [("cattle",), ("goats",)], "crop string"), ["ECONOMY"])


def _combos(spark, sf):
    """Every three kinds in order: a list of part types, whose number doesn't grow with the rows."""
    kinds = X.table(spark, sf, "part").agg(F.array_sort(F.collect_set("p_type")).alias("k"))
    for name, after in (("heat", "k"), ("wet", "after_heat"), ("dry", "after_wet")):
        kinds = kinds.select("*", F.posexplode(after).alias("i", name)).withColumn(f"after_{name}", F.slice(after, F.col("i") + 2, F.size(after))).drop("i")
    return kinds.select("heat", "wet", "dry")


#: Interactions of a fixed and a free kind.
INTERACTIONS = [R.Interaction("ECONOMY", "SMALL", "MEDIUM", heat_fixed=True), R.Interaction("PROMO", "LARGE", "STANDARD"), R.Interaction("PROMO", "SMALL", "STANDARD", kind="animal")]
_simple = ", ".join(f"('{i.kind}', '{i.heat}', '{i.wet}', '{i.dry}')" for i in INTERACTIONS)
_CLASSES = f"c AS (SELECT DISTINCT p_brand || CASE WHEN p_size % 5 = 0 THEN '-tropical' ELSE '' END AS crop, CASE p_size % 2 WHEN 0 THEN 'Severe' ELSE 'Extreme' END AS severity, split_part(p_type, ' ', 1) AS hazard, replace(replace(split_part(p_type, ' ', 1) || '_' || length(p_brand) || p_size % 3 || '.tif', '.tif', ''), '_', '-') AS full_ FROM part), i(kind, h, w, d) AS (VALUES {_simple}), t AS (SELECT x.crop, x.severity, kind, h AS heat_simple, w AS wet_simple, d AS dry_simple, x.full_ AS heat, y.full_ AS wet, z.full_ AS dry, z.full_ || '+' || x.full_ || '+' || y.full_ AS code, x.crop IN ('Brand#11', 'Brand#23-tropical') AND kind = 'crop' AS in_short FROM i JOIN c x ON x.hazard = h JOIN c y ON y.hazard = w AND y.crop = x.crop AND y.severity = x.severity JOIN c z ON z.hazard = d AND z.crop = x.crop AND z.severity = x.severity WHERE (kind = 'animal') = contains(x.crop, '-tropical'))"


def _classes(spark, sf):
    kind = F.element_at(F.split("p_type", " "), 1)
    name = F.concat(kind, F.lit("_"), F.length("p_brand").cast("string"), (F.col("p_size") % 3).cast("string"), F.lit(".tif"))
    crop = F.concat("p_brand", F.when(F.col("p_size") % 5 == 0, "-tropical").otherwise(""))
    return X.table(spark, sf, "part").select(crop.alias("crop"), F.when(F.col("p_size") % 2 == 0, "Severe").otherwise("Extreme").alias("severity"), kind.alias("hazard"), name.alias("file"))


@query("g27_interaction_table", "SELECT * FROM (WITH " + _CLASSES + " SELECT crop, severity, kind, heat_simple, wet_simple, dry_simple, heat, wet, dry, code, in_short FROM t)")
def _(spark, sf):
    return R.interaction_table(_classes(spark, sf), INTERACTIONS, short=["Brand#11", "Brand#23-tropical"])


@query("g27_distinct_combinations", "SELECT * FROM (WITH " + _CLASSES + " SELECT severity, kind, heat_simple, wet_simple, dry_simple, heat, wet, dry, code, bool_or(in_short) AS in_short FROM t GROUP BY ALL)")
def _(spark, sf):
    return R.distinct_combinations(R.interaction_table(_classes(spark, sf), INTERACTIONS, short=["Brand#11", "Brand#23-tropical"]))


@query("g27_interaction_catalogue", "SELECT * FROM (WITH " + THRESHOLDS + " SELECT a.crop, a.severity, a.hazard AS heat, b.hazard AS wet, c.hazard AS dry, a.threshold AS heat_threshold, b.threshold AS wet_threshold, c.threshold AS dry_threshold FROM th a JOIN th b ON a.crop = b.crop AND a.severity = b.severity JOIN th c ON a.crop = c.crop AND a.severity = c.severity WHERE a.hazard < b.hazard AND b.hazard < c.hazard)")
def _(spark, sf):
    return R.interaction_catalogue(_thresholds(spark, sf), _combos(spark, sf))


@query("g28_crop_bundle", "SELECT * FROM (WITH " + THRESHOLDS + " SELECT crop, severity, hazard, threshold FROM th WHERE EXISTS (SELECT 1 FROM (SELECT crop AS c, severity AS s FROM th GROUP BY ALL HAVING count(*) >= 3) WHERE c = crop AND s = severity))")
def _(spark, sf):
    th = _thresholds(spark, sf)
    return R.crop_bundle(th, R.interaction_catalogue(th, _combos(spark, sf))).select("crop", "severity", "hazard", "threshold")


FIELDS = ["scenario", "timeframe", "hazard", "severity", "crop", "variable", "stat"]
RULES = [(r"#", "-"), (r"^([A-Z]+)\.", "$1_"), (r"\.\.+", "_"), (r"\.", "_")]


@query("f08_split_labels", "SELECT * FROM (WITH l AS (SELECT p_partkey, p_type || '.' || p_size || '..' || p_brand || '.sev' || CASE WHEN p_partkey % 3 = 0 THEN '.maize.vop.mean' WHEN p_partkey % 3 = 1 THEN '.maize..mean' ELSE '.a.b.c.d.e' END AS label FROM part), r AS (SELECT p_partkey, string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(label, '#', '-', 'g'), '^([A-Z]+)\\.', '\\1_', 'g'), '\\.\\.+', '_', 'g'), '\\.', '_', 'g'), '_') AS f FROM l) SELECT p_partkey, " + ", ".join(f"CASE WHEN len(f) <= 7 THEN nullif(f[{i + 1}], '') END AS {n}" for i, n in enumerate(FIELDS)) + ", CAST(" + " + ".join(f"CAST(coalesce(len(f) > 7 OR f[{i + 1}] IS NULL OR f[{i + 1}] = '', true) AS INT)" for i in range(7)) + " AS INT) AS n_missing FROM r)")
def _(spark, sf):
    tail = F.when(F.col("p_partkey") % 3 == 0, ".maize.vop.mean").when(F.col("p_partkey") % 3 == 1, ".maize..mean").otherwise(".a.b.c.d.e")
    label = F.concat("p_type", F.lit("."), F.col("p_size").cast("string"), F.lit(".."), "p_brand", F.lit(".sev"), tail)
    return R.split_label(X.table(spark, sf, "part").select("p_partkey", label.alias("label")), "label", FIELDS, RULES).drop("label")


@query("f09_hazard_aliases", "SELECT l_linenumber AS n, CASE WHEN hazard LIKE 'NTxS%' THEN 'NTxS' WHEN hazard = 'PTOT' THEN 'PTOT_' || CASE WHEN flag = 'A' THEN 'L' ELSE 'G' END ELSE hazard END AS alias, count(*) AS rows_ FROM (SELECT l_linenumber, l_returnflag AS flag, CASE l_linenumber % 3 WHEN 0 THEN 'NTxS' || (20 + l_linenumber) WHEN 1 THEN 'PTOT' ELSE 'NDWS' END AS hazard FROM lineitem) GROUP BY ALL")
def _(spark, sf):
    n = F.col("l_linenumber")
    hazard = F.when(n % 3 == 0, F.concat(F.lit("NTxS"), (n + 20).cast("string"))).when(n % 3 == 1, "PTOT").otherwise("NDWS")
    side = F.when(F.col("l_returnflag") == "A", "<").otherwise(">")
    rows = X.table(spark, sf, "lineitem").select(n.alias("n"), R.relabel(F.concat_ws(" ", hazard, side), [(r"^NTxS\d+ .*$", "NTxS"), (r"^PTOT <$", "PTOT_L"), (r"^PTOT >$", "PTOT_G"), (r" .$", "")]).alias("alias"))
    return rows.groupBy("n", "alias").agg(F.count(F.lit(1)).alias("rows_"))


def subset_rows(spark, sf):
    """crop, hazard_vars, severity, scenario, timeframe, value."""
    return X.table(spark, sf, "lineitem").join(X.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("crop"), F.when(F.col("l_linenumber") % 2 == 0, "dry+heat+wet").otherwise("THI").alias("hazard_vars"), F.col("l_returnflag").alias("severity"), F.col("l_linestatus").alias("scenario"), F.year("l_shipdate").cast("string").alias("timeframe"), F.col("l_quantity").alias("value"))


@query("f13_analytic_subset", "SELECT crop, hazard_vars, severity, scenario_x_time, count(*) AS n, sum(value) AS value FROM (SELECT p_brand AS crop, CASE l_linenumber % 2 WHEN 0 THEN 'dry+heat+wet' ELSE 'THI' END AS hazard_vars, l_returnflag AS severity, l_linestatus || '-' || year(l_shipdate) AS scenario_x_time, l_quantity AS value FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE hazard_vars = CASE WHEN crop IN ('Brand#15', 'Brand#25') THEN 'THI' ELSE 'dry+heat+wet' END AND severity IN ('A', 'N') AND scenario_x_time IN ('F-1997', 'O-1998') AND crop <> 'Brand#9' GROUP BY ALL")
def _(spark, sf):
    rows = subset_rows(spark, sf)
    own = R.analytic_subset(rows, "dry+heat+wet", {"Brand#15": "THI", "Brand#25": "THI"}, ["A", "N"], [("F", "1997"), ("O", "1998")], ["Brand#9"])
    return own.groupBy("crop", "hazard_vars", "severity", "scenario_x_time").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))


@query("f14_exposure_subset", "SELECT admin0, admin1, crop, sum(value) AS value FROM (SELECT r_name AS admin0, n_name AS admin1, CASE l_linenumber % 3 WHEN 0 THEN 'cattle' WHEN 1 THEN 'goats' ELSE 'rural-pop' END AS crop, l_quantity AS value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE l_returnflag <> 'A' AND l_suppkey % 2 = 0) WHERE crop <> 'rural-pop' GROUP BY ALL")
def _(spark, sf):
    n, flag = F.col("l_linenumber"), F.col("l_returnflag")
    animal = F.when(n % 3 == 0, "cattle").when(n % 3 == 1, "goats")
    crop = F.coalesce(F.concat(animal, F.when(F.col("l_partkey") % 2 == 0, "-tropical").otherwise("-highland")), F.lit("rural-pop"))
    rows = X.table(spark, sf, "lineitem").join(X.zones(spark, sf), F.col("l_suppkey") == F.col("cell")).select("admin0", "admin1", F.when(F.col("cell") % 2 == 1, F.col("admin2")).alias("admin2"), crop.alias("crop"), F.when(flag == "A", "irrigated").when(flag == "N", "all").alias("tech"), F.col("l_quantity").alias("value"))
    return R.exposure_subset(rows, "pop$")


@query("a48_detrended_cv_gate", "SELECT admin1, n, adj_r2, CASE WHEN n >= 5 AND kinds > 1 AND adj_r2 > 0.1 AND sqrt(r2 * (n - 2) / nullif(1 - r2, 0)) > CASE n - 2 WHEN 3 THEN 3.182446305284263 WHEN 4 THEN 2.7764451051977987 WHEN 5 THEN 2.5705818366147395 WHEN 6 THEN 2.4469118511449692 WHEN 7 THEN 2.3646242515927844 WHEN 8 THEN 2.306004135204166 WHEN 9 THEN 2.2621571627409915 WHEN 10 THEN 2.2281388519649385 END THEN sqrt(syy * (1 - r2) / (n - 1)) / m END AS cv FROM (SELECT admin1, count(*) AS n, count(DISTINCT value) AS kinds, regr_r2(value, year) AS r2, regr_syy(value, year) AS syy, avg(value) AS m, 1 - (1 - regr_r2(value, year)) * (count(*) - 1) / nullif(count(*) - 2, 0) AS adj_r2 FROM natyear GROUP BY admin1)", "natyear")
def _(spark, sf):
    return R.detrended_variation(X.nation_years(spark, sf), ["admin1"], "year", "value", least=5).select("admin1", "n", "adj_r2", "cv")


@query("a66_method_quality", "SELECT * FROM (WITH d AS (SELECT l_returnflag AS method, l_quantity AS x, l_extendedprice AS y FROM lineitem), f AS (SELECT method, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_r2(y, x) AS r2, count(*) AS n FROM d GROUP BY method) SELECT method, avg(y / x) AS ratio, stddev_samp(y / x) AS ratio_sd, stddev_samp(y / x) / avg(y / x) AS ratio_cv, 1 - (1 - any_value(r2)) * (any_value(n) - 1) / (any_value(n) - 2) AS adj_r2, sqrt(avg((y - a - b * x) * (y - a - b * x))) AS rmse, avg(abs(y - a - b * x)) AS mae FROM d JOIN f USING (method) GROUP BY method)")
def _(spark, sf):
    d = X.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("method"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return R.method_quality(d, ["method"], "x", "y")


FLOW = "fl AS (SELECT admin1, year - (SELECT min(year) - 1 FROM natyear) AS t, value AS benefit, 1000000.0 AS cost FROM natyear)"


@query("g36_cash_flow", "SELECT * FROM (WITH " + FLOW + ", z AS (SELECT admin1, t, benefit, cost FROM fl UNION ALL SELECT DISTINCT admin1, 0, 0.0, 1000000.0 FROM fl), s AS (SELECT admin1, t, CASE WHEN t < 4 THEN cost / 4 ELSE 0 END AS cost_t, coalesce(lag(benefit, 2) OVER (PARTITION BY admin1 ORDER BY t), 0) AS benefit_t FROM z) SELECT admin1, CAST(t AS INT) AS t, cost_t, benefit_t, sum(benefit_t / pow(1.05, t)) OVER w / sum(cost_t / pow(1.05, t)) OVER w AS bcr FROM s WINDOW w AS (PARTITION BY admin1 ORDER BY t))", "natyear")
def _(spark, sf):
    y = X.nation_years(spark, sf)
    first = X.table(spark, sf, "orders").agg((F.min(F.year("o_orderdate")) - 1).alias("before"))  # one row
    rows = y.join(F.broadcast(first), F.lit(True)).select("admin1", (F.col("year") - F.col("before")).alias("t"), F.col("value").alias("benefit"), F.lit(1000000.0).alias("cost"))
    return R.cash_flow(rows, ["admin1"], 0.05, 4, 2)


@query("g31_impact_effects", "SELECT * FROM (WITH d AS (SELECT n_name AS admin1, sum(s_acctbal) AS result, CASE WHEN any_value(n_nationkey) % 3 <> 0 THEN (10 + any_value(n_nationkey)) / 100.0 END AS cv FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name), x AS (SELECT *, result * (1 + impact) AS wi FROM d CROSS JOIN (VALUES (CAST(0.1 AS DOUBLE)), (0.2)) i(impact) CROSS JOIN (VALUES (CAST(0 AS DOUBLE)), (0.3), (0.5)) s(service) CROSS JOIN (VALUES (CAST(2 AS DOUBLE)), (4)) b(bcr)), y AS (SELECT admin1, impact, service, bcr, wi - result AS marginal, coalesce(wi * CAST(cv AS DOUBLE) * service / sqrt(2 * pi()), 0) AS marginal_service FROM x) SELECT *, (marginal + marginal_service) * (1 - 1 / bcr) AS benefit FROM y)")
def _(spark, sf):
    s = X.table(spark, sf, "supplier").join(X.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    d = s.groupBy(F.col("n_name").alias("admin1"), "n_nationkey").agg(F.sum("s_acctbal").alias("result")).withColumn("cv", F.when(F.col("n_nationkey") % 3 != 0, (F.col("n_nationkey") + 10) / 100.0))
    return R.impact_effects(d, [0.1, 0.2], [0.0, 0.3, 0.5], [2.0, 4.0]).select("admin1", "impact", "service", "bcr", "marginal", "marginal_service", "benefit")


RATES = "rt AS (SELECT n_name AS iso3, CAST(year(o_orderdate) AS INT) AS year, avg(o_totalprice) / 1000 AS rate, median(o_totalprice) / 1000 AS ppp FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE year(o_orderdate) < 2001 GROUP BY ALL)"


@query("g44_converted", "SELECT * FROM (WITH " + RATES + " SELECT admin1 AS iso3, n.year, n.value, n.value * CASE WHEN admin1 = 'NATION_7' THEN 0.001 ELSE 1 END / nullif(rate, 0) AS usd, n.value * CASE WHEN admin1 = 'NATION_7' THEN 0.001 ELSE 1 END / nullif(ppp, 0) AS intl FROM natyear n LEFT JOIN rt ON rt.iso3 = admin1 AND rt.year = n.year)", "natyear")
def _(spark, sf):
    o = X.table(spark, sf, "orders").where(F.year("o_orderdate") < 2001).join(X.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(X.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rates = o.groupBy(F.col("n_name").alias("iso3"), F.year("o_orderdate").alias("year")).agg((F.avg("o_totalprice") / 1000).alias("rate"), (F.median("o_totalprice") / 1000).alias("ppp"))
    values = X.nation_years(spark, sf).select(F.col("admin1").alias("iso3"), "year", "value")
    return R.converted(values, rates, _frame(spark, [("NATION_7", 0.001)], "iso3 string, factor double"))


RISK = "rk AS (SELECT cell, crop, CAST(hash_ % 7 AS DOUBLE) AS score, value FROM (SELECT cell, crop, value, cell * 31 + CAST(substr(crop, 7) AS INT) AS hash_ FROM exposure)), sh AS (SELECT *, value / sum(value) OVER (PARTITION BY cell) AS share FROM rk)"
for _name, _how, _sql in (
    ("g38_weighted_index", "sum", "SELECT cell, sum(score * share) AS index, max_by(crop, struct_pack(s := share, c := crop)) AS crop FROM sh GROUP BY cell"),
    ("g38_dominant_index", "max", "SELECT cell, avg(score) AS index, string_agg(crop, '+' ORDER BY crop) AS crop FROM (SELECT *, max(share) OVER (PARTITION BY cell) AS top FROM sh) WHERE share = top GROUP BY cell"),
):

    @query(_name, "SELECT * FROM (WITH " + RISK + " " + _sql + ")", "exposure")
    def _(spark, sf, how=_how):
        e = X.exposure(spark, sf)
        risk = e.select("cell", "crop", ((F.col("cell") * 31 + F.substr("crop", F.lit(7)).cast("int")) % 7).cast("double").alias("score"))
        return R.hazard_index(risk, e, how)


@query("c09_props_json", "SELECT event_type, count(*) AS n, sum(CAST(props->>'$.k' AS BIGINT)) AS k_sum, count(*) FILTER (CAST(props->>'$.k' AS BIGINT) > 50) AS n_large FROM events GROUP BY event_type")
def _(spark, sf):
    rows = X.table(spark, sf, "events").select("event_type", F.from_json("props", "k bigint").alias("p"))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("p.k").alias("k_sum"), F.sum(F.when(F.col("p.k") > 50, 1).otherwise(0)).cast("long").alias("n_large"))


@query("c02_text_functions", "SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS title, substr(p_name, 2, 3) AS part_, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, reverse(p_brand) AS back, list_extract(string_split('data/' || p_type || '/' || p_brand || '.tif', '/'), -1) AS base, len(string_split(p_name, 'e')) - 1 AS n_e FROM (SELECT p_partkey, p_size, p_brand, p_type, replace(p_name, ' ', '') AS p_name FROM part)")
def _(spark, sf):
    p = X.table(spark, sf, "part").withColumn("p_name", F.replace("p_name", F.lit(" "), F.lit("")))
    path = F.concat_ws("/", F.lit("data"), "p_type", F.concat("p_brand", F.lit(".tif")))
    return p.select("p_partkey", F.initcap("p_name").alias("title"), F.substring("p_name", 2, 3).alias("part_"), F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"), F.reverse("p_brand").alias("back"), F.element_at(F.split(path, "/"), -1).alias("base"), (F.size(F.split("p_name", "e")) - 1).cast("long").alias("n_e"))


@query("c04_month_days", "SELECT s_suppkey, CAST(count(*) AS BIGINT) AS n_days, CAST(min(d) AS DATE) AS first_day, CAST(max(d) AS DATE) AS last_day FROM (SELECT s_suppkey, unnest(range(DATE '2000-01-01' + to_months(CAST(s_suppkey % 60 AS INT)), DATE '2000-01-01' + to_months(CAST(s_suppkey % 60 + 1 AS INT)), INTERVAL 1 DAY)) AS d FROM supplier) GROUP BY s_suppkey")
def _(spark, sf):
    first = F.add_months(F.lit("2000-01-01").cast("date"), (F.col("s_suppkey") % 60).cast("int"))
    days = X.table(spark, sf, "supplier").select("s_suppkey", F.explode(F.sequence(first, F.last_day(first))).alias("d"))
    return days.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n_days"), F.min("d").alias("first_day"), F.max("d").alias("last_day"))


@query("a31_weighted_mean_value", "SELECT admin1, sum(value * w) / nullif(sum(w), 0) AS mean, min(value) AS low, max(value) AS high FROM (SELECT admin1, e.value AS w, f.p AS value FROM exposure e JOIN freq f USING (cell) JOIN zones USING (cell)) GROUP BY admin1", "exposure", "freq", "zones")
def _(spark, sf):
    from gridrisk.operators.zonal import weighted_mean

    rows = X.exposure(spark, sf).withColumnRenamed("value", "w").join(X.heat_frequency(spark, sf), "cell").join(X.zones(spark, sf).select("cell", "admin1"), "cell")
    return rows.groupBy("admin1").agg(weighted_mean("p", "w").alias("mean"), F.min("p").alias("low"), F.max("p").alias("high"))


@query("a71_share_of_total_row", "SELECT * FROM (WITH x AS (SELECT admin1, crop, sum(value) AS value, CAST(count(*) AS BIGINT) AS area FROM exposure JOIN zones USING (cell) GROUP BY ALL), t AS (SELECT admin1, 'total' AS crop, sum(value) AS value, sum(area) AS area FROM x GROUP BY admin1), u AS (SELECT * FROM x UNION ALL SELECT * FROM t) SELECT admin1, crop, value, CAST(area AS BIGINT) AS area, 100 * value / nullif(max(value) FILTER (crop = 'total') OVER (PARTITION BY admin1), 0) AS pct FROM u)", "exposure", "zones")
def _(spark, sf):
    x = X.exposure(spark, sf).join(X.zones(spark, sf).select("cell", "admin1"), "cell").groupBy("admin1", "crop").agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("area"))
    return Z.share_of_total_row(x, "admin1", "crop")


@query("s03_remote_predicates", "SELECT p_brand AS crop, l_returnflag AS hazard, l_quantity AS value FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand IN ('Brand#1', 'Brand#15') AND l_returnflag IN ('A', 'N') AND CASE WHEN l_suppkey % 3 <> 0 THEN l_suppkey END IS NULL")
def _(spark, sf):
    from gridrisk.sources.tables import where_keys

    rows = X.table(spark, sf, "lineitem").join(X.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("crop"), F.col("l_returnflag").alias("hazard"), F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey")).alias("admin1"), F.col("l_quantity").alias("value"))
    return where_keys(rows, {"crop": ["Brand#1", "Brand#15"], "hazard": ["A", "N"], "admin1": None}, ["crop", "hazard", "value"])
