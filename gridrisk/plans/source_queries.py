"""Queries of sources, sinks, catalogues and guards; files go to the session's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from gridrisk.operators import quality as Q
from gridrisk.operators import season as S
from gridrisk.plans import fixtures as X
from gridrisk.plans.registry import query
from gridrisk.sources import tables as IO


def scratch(spark, name: str) -> str:
    """A new path in the shared folder (one of its own only for a local session without any)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
    return f"{base.rstrip('/')}/gridrisk/{name}-{uuid.uuid4().hex}"


@query("s01_column_read", "SELECT l_suppkey, l_quantity FROM lineitem")
def _(spark, sf):
    return IO.read_parquet(spark, f"{sf}/lineitem.parquet", columns=["l_suppkey", "l_quantity"])


@query("s02_stack_files", "SELECT n_name AS name, n_nationkey AS code, CAST(NULL AS INT) AS region FROM nation UNION ALL SELECT r_name, NULL, r_regionkey FROM region")
def _(spark, sf):
    n, r = X.table(spark, sf, "nation"), X.table(spark, sf, "region")
    return n.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code")).unionByName(r.select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("region")), allowMissingColumns=True)


@query("s04_csv_lookup", "SELECT p_brand AS crop, count(*) AS n, round(avg(p_retailprice), 2) AS price FROM part GROUP BY ALL")
def _(spark, sf):
    p = X.table(spark, sf, "part").groupBy(F.col("p_brand").alias("crop")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p_retailprice"), 2).alias("price"))
    path = scratch(spark, "lookup")
    IO.write_csv(p, path)
    return IO.read_lookup(spark, path, "crop string, n long, price double")


@query("s05_point_grid", "SELECT x, y, CASE k WHEN 'A_h' THEN 'maize' WHEN 'N_h' THEN 'wheat' WHEN 'R_h' THEN 'rice' END AS crop, v AS value FROM (UNPIVOT (SELECT CAST(cell % 10 AS DOUBLE) AS x, CAST(cell // 10 AS DOUBLE) AS y, sum(value) FILTER (hazard = 'A') AS A_h, sum(value) FILTER (hazard = 'N') AS N_h, sum(value) FILTER (hazard = 'R') AS R_h FROM yearly GROUP BY cell, x, y) ON A_h, N_h, R_h INTO NAME k VALUE v)", "yearly")
def _(spark, sf):
    w = X.yearly(spark, sf).groupBy("cell").pivot("hazard", ["A", "N", "R"]).agg(F.sum("value"))
    w = w.select((F.col("cell") % 10).cast("double").alias("x"), F.expr("cast(cell div 10 as double)").alias("y"), F.col("A").alias("A_h"), F.col("N").alias("N_h"), F.col("R").alias("R_h"), F.col("A").alias("A_r"))
    path = scratch(spark, "points")
    IO.write_csv(w, path)
    codes = spark.createDataFrame([("A", "maize"), ("N", "wheat"), ("R", "rice")], "code string, name string")
    return IO.read_points(spark, path, codes, "h").where("value is not null")


@query("s10_file_catalogue", "SELECT scenario, model, count(*) AS n FROM (SELECT DISTINCT split_part(p_type, ' ', 1) AS scenario, nullif(split_part(p_type, ' ', 2), '') AS model, p_name FROM part) GROUP BY ALL")
def _(spark, sf):
    name = F.concat(F.lit("/data/"), F.replace("p_type", F.lit(" "), F.lit("_")), F.lit(".tif"))
    paths = X.table(spark, sf, "part").select(name.alias("path"), "p_name").distinct()
    got = IO.catalogue(paths.select("path"), "path", ["scenario", "model", "variable"])
    return got.groupBy("scenario", "model").agg(F.count(F.lit(1)).alias("n"))


@query("s13_sorted_rounded_write", "SELECT cell, year, hazard, round(value / 3, 2) AS value FROM yearly", "yearly")
def _(spark, sf):
    path = scratch(spark, "sorted")
    IO.write_table(X.yearly(spark, sf).withColumn("value", F.col("value") / 3), path, sort=["hazard", "cell", "year"], digits=2)
    return spark.read.parquet(path)


@query("s14_key_folders", "SELECT cell, year, value, hazard FROM yearly WHERE hazard = 'A'", "yearly")
def _(spark, sf):
    path = scratch(spark, "folders")
    IO.write_table(X.yearly(spark, sf), path, keys=["hazard"])
    return spark.read.parquet(path).where("hazard = 'A'")


@query("s16_sidecar", "SELECT count(*) AS n_rows, list_sort(list(DISTINCT hazard)) AS hazard, list_sort(list(DISTINCT year)) AS year FROM yearly", "yearly")
def _(spark, sf):
    return IO.sidecar(X.yearly(spark, sf), ["hazard", "year"])


@query("s17_skip_existing", "SELECT cell, year, hazard, value FROM yearly", "yearly")
def _(spark, sf):
    path = scratch(spark, "skip")
    IO.write_table(X.yearly(spark, sf), path)
    IO.write_table(X.yearly(spark, sf).limit(0), path, mode="ignore")
    return spark.read.parquet(path)


@query("j12_pairing_guard", "SELECT cell, season_year, value, n_months FROM season", "season")
def _(spark, sf):
    s = S.roll_up(X.monthly(spark, sf), X.calendar(spark, sf), [], "sum")
    Q.same_keys(s, s.withColumn("value", F.lit(0)), ["cell", "season_year"])
    return Q.not_negative(Q.unique_keys(s, ["cell", "season_year"]), "value")


@query("g28_bundle_check", "SELECT cell, hazard, avg(flag) AS frequency FROM flags GROUP BY ALL", "flags")
def _(spark, sf):
    f = X.flags(spark, sf).groupBy("cell", "hazard").agg(F.avg("flag").alias("frequency"))
    wanted = spark.createDataFrame([("dry",), ("wet",), ("heat",)], "hazard string")
    return f.join(Q.all_present(wanted, f, ["hazard"]).select("hazard").distinct().join(wanted, "hazard"), "hazard", "left_semi")


@query("c09_json_attributes", "SELECT event_type, count(*) AS n, sum(length(props)) > 0 AS has FROM events GROUP BY ALL")
def _(spark, sf):
    kind = F.to_json(F.struct("event_type"))
    e = X.table(spark, sf, "events").withColumn("j", F.from_json(kind, "event_type string"))
    return e.groupBy(F.col("j.event_type").alias("event_type")).agg(F.count(F.lit(1)).alias("n"), (F.sum(F.length("props")) > 0).alias("has"))


@query("c02_text_helpers", "SELECT upper(p_brand) AS up, lpad(CAST(p_size AS VARCHAR), 3, '0') AS padded, reverse(p_brand) AS back, len(string_split(p_type, ' ')) - 1 AS blanks, count(*) AS n FROM part GROUP BY ALL")
def _(spark, sf):
    p = X.table(spark, sf, "part")
    return p.groupBy(F.upper("p_brand").alias("up"), F.lpad(F.col("p_size").cast("string"), 3, "0").alias("padded"), F.reverse("p_brand").alias("back"), (F.size(F.split("p_type", " ")) - 1).cast("long").alias("blanks")).agg(F.count(F.lit(1)).alias("n"))


@query("c04_days_in_month", "SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, CAST(day(last_day(o_orderdate)) AS INT) AS days FROM orders")
def _(spark, sf):
    o = X.table(spark, sf, "orders")
    return o.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.day(F.last_day("o_orderdate")).alias("days")).distinct()


@query("c07_combinations", "SELECT a.n_name AS one, b.n_name AS two FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def _(spark, sf):
    n = X.table(spark, sf, "nation")
    a, b = n.select("n_regionkey", F.col("n_nationkey").alias("i"), F.col("n_name").alias("one")), n.select("n_regionkey", F.col("n_nationkey").alias("j"), F.col("n_name").alias("two"))
    return a.join(b, "n_regionkey").where("i < j").select("one", "two")


@query("g22_season_swap", "SELECT cell, CASE WHEN p > 9 THEN NULL ELSE p END AS s1, CASE WHEN p > 9 THEN p ELSE q END AS s2 FROM (SELECT cell, plant AS p, CAST((plant + 5) % 12 + 1 AS INT) AS q FROM calendar)", "calendar")
def _(spark, sf):
    c = X.calendar(spark, sf).withColumn("q", ((F.col("plant") + 5) % 12 + 1).cast("int"))
    late = F.col("plant") > 9
    return c.select("cell", F.when(~late, F.col("plant")).alias("s1"), F.when(late, F.col("plant")).otherwise(F.col("q")).alias("s2"))


@query("g23_multi_season_gain", "SELECT cell, nullif(CASE WHEN span = 4 THEN (m - s) / 2 ELSE m - s END, 0) AS gain FROM (SELECT cell, span, sum(value) AS m, sum(value) FILTER (month BETWEEN plant AND plant + span) AS s FROM monthly JOIN calendar USING (cell) GROUP BY ALL)", "monthly", "calendar")
def _(spark, sf):
    rows = X.monthly(spark, sf).join(X.calendar(spark, sf), "cell")
    g = rows.groupBy("cell", "span").agg(F.sum("value").alias("m"), F.sum(F.when(F.col("month").between(F.col("plant"), F.col("plant") + F.col("span")), F.col("value"))).alias("s"))
    d = F.col("m") - F.col("s")
    return g.select("cell", F.nullif(F.when(F.col("span") == 4, d / 2).otherwise(d), F.lit(0.0)).alias("gain"))


@query("g24_sowing_merge", "SELECT cell, coalesce(median(month) FILTER (hazard = 'A'), avg(month)) AS sowing FROM cells GROUP BY cell", "cells")
def _(spark, sf):
    return X.cells(spark, sf).groupBy("cell").agg(F.coalesce(F.median(F.when(F.col("hazard") == "A", F.col("month"))), F.avg("month")).alias("sowing"))


@query("g26_inherit_thresholds", "SELECT p_brand AS crop, t FROM (SELECT DISTINCT p_brand FROM part) , (VALUES (10), (20)) v(t) UNION ALL SELECT DISTINCT c_mktsegment, 5 FROM customer")
def _(spark, sf):
    crops = X.table(spark, sf, "part").select(F.col("p_brand").alias("crop")).distinct().withColumn("t", F.explode(F.array(F.lit(10), F.lit(20))))
    return crops.unionByName(X.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("crop"), F.lit(5).alias("t")).distinct())


@query("g41_two_digit_class", "SELECT a + 10 * b AS class, count(*) AS n FROM (SELECT CAST(cell % 3 AS INT) AS a, CASE WHEN value > 800 THEN 3 WHEN value > 500 THEN 2 ELSE 1 END AS b FROM yearly) GROUP BY ALL", "yearly")
def _(spark, sf):
    b = F.when(F.col("value") > 800, 3).when(F.col("value") > 500, 2).otherwise(1)
    return X.yearly(spark, sf).groupBy(((F.col("cell") % 3).cast("int") + 10 * b).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("g12_world_price", "SELECT year, sum(value) / nullif(sum(q), 0) AS price, 100 * (sum(value) / nullif(sum(q), 0)) / first_value(sum(value) / nullif(sum(q), 0)) OVER (ORDER BY year) AS deflator FROM (SELECT CAST(year(l_shipdate) AS INT) AS year, l_extendedprice AS value, l_quantity AS q FROM lineitem) GROUP BY year".replace("SELECT year, sum(value)", "SELECT year, p AS price, 100 * p / first_value(p) OVER (ORDER BY year) AS deflator FROM (SELECT year, sum(value)", 1).replace("sum(value) / nullif(sum(q), 0) AS price, 100 * (sum(value) / nullif(sum(q), 0)) / first_value(sum(value) / nullif(sum(q), 0)) OVER (ORDER BY year) AS deflator", "sum(value) / nullif(sum(q), 0) AS p") + ")")
def _(spark, sf):
    from pyspark.sql import Window

    y = X.table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg((F.sum("l_extendedprice") / F.nullif(F.sum("l_quantity"), F.lit(0.0))).alias("price"))
    return y.withColumn("deflator", 100 * F.col("price") / F.first("price").over(Window.orderBy("year")))  # a row per year


@query("g43_unit_value", "SELECT admin1, total / nullif(n, 0) AS unit FROM (SELECT n_name AS admin1, sum(c_acctbal) AS total, count(*) FILTER (c_acctbal > 0) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)")
def _(spark, sf):
    c = X.table(spark, sf, "customer").join(F.broadcast(X.table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows
    return c.groupBy(F.col("n_name").alias("admin1")).agg((F.sum("c_acctbal") / F.nullif(F.count(F.when(F.col("c_acctbal") > 0, 1)), F.lit(0))).alias("unit"))
