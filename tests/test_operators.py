"""The library's own operators: SQL twins on the fixtures, and hand-made frames for null rules, ties and guards."""

import glob
import math
import os

import duckdb
import pytest
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

from gridrisk import plans
from gridrisk.functions import scalars as C
from gridrisk.operators import economics, exposure, grid, hazards, quality, season, trend, zonal
from gridrisk.plans import fixtures
from gridrisk.sources import tables


def tidy(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(tidy, v))
    return float(v) if hasattr(v, "as_tuple") else v


def same(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, float) and isinstance(b, (float, int)) and not isinstance(b, bool):
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-6)
    return a == b


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{SMALL}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    want = con.sql(plans.oracle_sql()[name])
    cols = sorted(want.columns)
    df = plans.queries()[name](spark, SMALL)
    assert sorted(df.columns) == cols
    key = lambda t: tuple((x is None, str(type(x)), f"{x:.4g}" if isinstance(x, float) else str(x)) for x in t)
    exact = lambda t: tuple(x for x in t if not isinstance(x, float))
    got = sorted((tuple(tidy(r[c]) for c in cols) for r in df.collect()), key=lambda t: (str(exact(t)), key(t)))
    ref = sorted((tuple(tidy(r[want.columns.index(c)]) for c in cols) for r in want.fetchall()), key=lambda t: (str(exact(t)), key(t)))
    assert len(got) == len(ref) and all(map(same, got, ref))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_query_count():
    assert len(plans.queries()) >= 200


def test_classify_keeps_nulls_and_is_strict(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "v double")
    got = [tuple(r) for r in df.select(C.classify("v", "G", 1.0), C.classify("v", "l", 2.0)).collect()]
    assert got == [(0, 1), (1, 0), (None, None)]


def test_season_wraps_the_year(spark):
    series = spark.createDataFrame([(1, 1999 + (m // 12), m % 12 + 1, 1.0) for m in range(36)], "cell int, year int, month int, value double")
    cal = season.calendar(spark.createDataFrame([(1, 11, 2)], "cell int, plant int, harvest int"), "plant", "harvest")
    got = {r["season_year"]: (r["value"], r["n_months"]) for r in season.roll_up(series, cal, [], "sum").collect()}
    assert got == {1999: (4.0, 4), 2000: (4.0, 4)}
    assert season.roll_up(series, cal, [], "sum", years=(1999, 2000)).count() == 1
    with pytest.raises(ValueError):
        season.statistic("value", "mode")


def test_ensemble_strictness(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 1.0), ("b", None), ("c", 2.0)], "k string, value double")
    strict = {r["k"]: (r["mean"], r["sd"]) for r in hazards.ensemble(df, ["k"]).collect()}
    loose = {r["k"]: (r["mean"], r["sd"]) for r in hazards.ensemble(df, ["k"], strict=False).collect()}
    assert strict == {"a": (2.0, pytest.approx(math.sqrt(2))), "b": (None, None), "c": (2.0, None)} and loose["b"] == (1.0, None)


def test_compound_code_and_interactions_sum_to_any(spark):
    rows = [(y, h, f) for y, fl in enumerate(((1, 0, 0), (1, 1, 0), (1, 1, 1), (0, 0, 0))) for h, f in zip(("dry", "heat", "wet"), fl, strict=True)] + [(9, "dry", 1)]
    df = spark.createDataFrame([(1, *r) for r in rows], "cell int, year int, hazard string, flag int")
    codes = hazards.compound_code(df, ["cell", "year"])
    assert {r["year"]: r["code"] for r in codes.collect()} == {0: 1, 1: 11, 2: 111, 3: 0, 9: None}
    assert hazards.compound_code(df, ["cell", "year"], skip_missing=True).where("year = 9").first()["code"] == 1
    r = hazards.interactions(codes.where("code is not null"), ["cell"]).first().asDict()
    assert r["any_hazard"] == sum(r[n.replace("+", "_")] for _, n in hazards.COMBOS) == 0.75


def test_exceedance_and_descriptives(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 1.0), ("b", 1.0), ("c", None)], "k string, v double")
    got = {r["k"]: r["e"] for r in df.groupBy("k").agg(hazards.exceedance("v", ">", 2.0).alias("e")).collect()}
    assert got == {"a": 3.0, "b": 0.0, "c": None}


def test_roll_up_keeps_the_total(spark):
    df = spark.createDataFrame([("x", "p", "1", 1.0), ("x", "p", "2", 2.0), ("x", "q", "3", 4.0)], "admin0 string, admin1 string, admin2 string, value double")
    out = zonal.roll_up_admin(df, [])
    assert out.where("admin1 is null").first()["value"] == 7.0 and out.where("admin2 is null and admin1 = 'p'").first()["value"] == 3.0 and out.count() == 6


def test_weighted_quantiles_and_histogram(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (1, 2.0, 1.0), (1, 3.0, 8.0)], "k int, v double, w double")
    assert tuple(zonal.weighted_quantiles(df, ["k"], "v", "w", [0.1, 0.2, 0.5]).first()) == (1, 1.0, 2.0, 3.0)
    assert zonal.histogram(df, ["k"], "v", 1, 1, 2).first()["counts"] == [2, 1]


def test_shares_and_mass(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0)], "k string, value double")
    assert sorted((r["k"], r["share"]) for r in exposure.share_of_total(df, ["k"]).collect() if r["share"] is not None) == [("a", 0.25), ("a", 0.75)]
    g = spark.createDataFrame([(0, 0, 8.0), (1, 0, 4.0)], "x int, y int, value double")
    fine = grid.conserve_mass(g, 2)
    assert fine.agg(F.sum("value")).first()[0] == 12.0 and grid.coarsen(fine, 2, []).where("x = 0").first()["value"] == 8.0


def test_nearby_fill(spark):
    df = spark.createDataFrame([("a", "r", 1.0), ("b", "r", None), ("c", "r", 5.0), ("d", "s", None)], "u string, region string, value double")
    edges = spark.createDataFrame([("b", "c")], "u string, neighbour string")
    got = {r["u"]: (r["filled"], r["source"]) for r in exposure.nearby_fill(df, edges, "u", "region", []).collect()}
    assert got == {"a": (1.0, "own"), "b": (5.0, "neighbours"), "c": (5.0, "own"), "d": (3.0, "all")}
    with pytest.raises(ValueError):
        exposure.nearby_fill(df.withColumn("region", F.lit(None).cast("string")), edges, "u", "region", [])


def test_mann_kendall_and_slope(spark):
    df = spark.createDataFrame([(1, y, 2.0 * y) for y in range(2000, 2008)], "k int, year int, value double")
    r = trend.mann_kendall(df, ["k"]).first()
    assert r["s"] == 28 and r["var"] == pytest.approx(8 * 7 * 21 / 18) and r["p"] == pytest.approx(2 * (1 - 0.5 * (1 + math.erf(r["z"] / math.sqrt(2)))), abs=1e-6)
    s = trend.theil_sen(df, ["k"]).first()
    assert s["slope"] == 2.0 and s["intercept"] == 0.0
    flat = spark.createDataFrame([(1, y, 3.0) for y in range(12)], "k int, year int, value double")
    assert trend.variation(flat, ["k"]).first()["cv"] is None


def test_returns(spark):
    df = spark.createDataFrame([("p", t, f) for t, f in enumerate((-100.0, 60.0, 60.0))], "k string, t int, flow double")
    last = {r["t"]: r for r in economics.irr(df, ["k"]).collect()}
    x = last[2]["irr"]
    assert last[0]["irr"] is None and -100 + 60 / (1 + x) + 60 / (1 + x) ** 2 == pytest.approx(0, abs=1e-6)
    assert {r["t"]: r["mirr"] for r in economics.mirr(df, ["k"], 0.1, 0.1).collect()}[2] == pytest.approx(((60 * 1.1 + 60) / 100) ** 0.5 - 1)
    steps = spark.range(1, 4).select(economics.adoption(F.lit(0.6), 0.2, F.col("id").cast("int"), 3).alias("a")).collect()
    assert [r["a"] for r in steps] == [0.12, 0.216, 0.293]
    assert spark.range(1).select(economics.avoided_loss(F.lit(0.3), F.lit(0.2)), economics.avoided_loss(F.lit(0.3), F.lit(-0.1))).first()[:] == (pytest.approx(0.1 / math.sqrt(2 * math.pi)), None)


def test_normal_tail(spark):
    at = [0.0, 0.3, 1.96, 2.999, 3.0, 5.0, 9.0, 30.0]
    df = spark.createDataFrame([(z,) for z in at], "z double").select("z", C.normal_tail("z").alias("tail"), C.normal_cdf(-F.col("z")).alias("below"), C.normal_cdf("z").alias("cdf"))
    for r in df.collect():
        want = math.erfc(r["z"] / math.sqrt(2)) / 2
        assert r["tail"] == r["below"] == pytest.approx(want, rel=1e-12) and r["cdf"] == pytest.approx(1 - want, rel=1e-14)
    assert spark.sql("SELECT CAST(NULL AS DOUBLE) AS z").select(C.normal_tail("z")).first()[0] is None


def test_guards(spark):
    df = spark.createDataFrame([(1, -1.0), (1, 2.0)], "k int, v double")
    for call in (lambda: quality.unique_keys(df, ["k"]), lambda: quality.not_negative(df, "v"), lambda: quality.no_collision(df, ["v"]), lambda: quality.same_keys(df, df.limit(1), ["k"]), lambda: quality.equal_models(df, ["k"], 3, "v"), lambda: quality.all_present(df, df.where("k = 9"), ["k"]), lambda: tables.require_complete(df, "k")):
        with pytest.raises(ValueError):
            call()


def test_audit_counts_nulls_low_values_and_duplicates(spark):
    rows = [("a", 1, "x", 5.0), ("a", 1, "x", 50.0), ("a", 1, None, None), ("a", 1, None, 10.0), ("a", None, None, 9.0), ("b", 1, "x", None), (None, 1, "x", 1.0), (None, 1, "x", 1.0), (None, 1, "x", 1.0)]
    df = spark.createDataFrame(rows, "g string, k int, l string, v double")
    got = {r["g"]: tuple(r)[1:] for r in quality.audit(df, ["g"], ["g", "k", "l"], "v", 10).select("g", "n_rows", "n_null", "n_low", "n_duplicate").collect()}
    assert got == {"a": (5, 1, 2, 2), "b": (1, 1, 0, 0), None: (3, 0, 3, 2)}


def test_data_quality_query_with_null_keys(spark, tmp_path):
    """A null in a key is a key of its own: such cells are no duplicates."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * REPLACE (nullif(l_suppkey, 3) AS l_suppkey, CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_shipdate END AS l_shipdate, CASE WHEN l_orderkey % 70 = 0 THEN NULL ELSE l_quantity END AS l_quantity) FROM '{SMALL}/lineitem.parquet') TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    cols = ["hazard", "n_rows", "n_null", "n_low", "n_duplicate"]
    got = {tuple(r) for r in plans.queries()["s12_data_quality"](spark, str(tmp_path)).select(*cols).collect()}
    assert got == set(con.sql(f"SELECT {', '.join(cols)} FROM ({plans.oracle_sql()['s12_data_quality']})").fetchall()) and len(got) == 3


def test_cells_of_a_bounded_task(spark):
    """More rows go to more tasks, not to larger ones; the cells are the same."""
    n = fixtures.table(spark, SMALL, "lineitem").count()
    dealt = fixtures.cells(spark, SMALL, 300)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == math.ceil(n / 300) and max(sizes) < 450
    assert dealt.exceptAll(fixtures.cells(spark, SMALL)).isEmpty() and fixtures.cells(spark, SMALL).exceptAll(dealt).isEmpty()


def test_points_in_rings(spark):
    cells = spark.createDataFrame([(1, 1.0, 1.0), (2, 4.0, 1.0), (3, 9.0, 9.0)], "cell int, x double, y double")
    zones = spark.createDataFrame([(7, [(0.0, 0.0), (3.0, 0.0), (0.0, 3.0)]), (8, [(3.5, 0.0), (8.0, 0.0), (8.0, 6.0), (3.5, 6.0)])], "zone_id int, ring array<struct<x:double,y:double>>")
    assert {r["cell"]: r["zone_id"] for r in grid.assign_zones(cells, zones).collect()} == {1: 7, 2: 8}


def test_io_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 1.23456), ("b", 2, 2.0)], "k string, n int, v double")
    tables.write_table(df, str(tmp_path / "t"), keys=["k"], sort=["n"], digits=2)
    assert sorted(r["v"] for r in tables.read_parquet(spark, str(tmp_path / "t"), columns=["v"]).collect()) == [1.23, 2.0]
    tables.write_sidecar(df, ["k", "n"], str(tmp_path / "s"), made_by="test")
    assert tables.read_json(spark, str(tmp_path / "s")).first()["k"] == ["a", "b"]
    back = tables.tagged(spark, [str(tmp_path / "t")], r"k=(\w)", "tag")
    assert {r["tag"] for r in back.collect()} == {"a", "b"}


def test_fixture_medium_has_incomplete_seasons(spark):
    got = plans.queries()["w01_rolling_seasons"](spark, MEDIUM)
    assert not got.where("not complete").isEmpty()


def test_incremental_stream(spark, tmp_path):
    from gridrisk.streaming import incremental

    events = spark.read.parquet(f"{SMALL}/events.parquet").select("ts", "event_type", "value")
    early, late = events.where("day(ts) <= 10"), events.where("day(ts) > 10")
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    for part in (early, late):
        part.coalesce(1).write.mode("append").parquet(src)
        incremental.run_available(incremental.hot_days(incremental.daily_stream(spark, src, "ts timestamp, event_type string, value double"), [30.0], "1 day"), out, ck)
    done = spark.read.parquet(out)
    want = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("value") > 30).cast("long")).alias("above_30"))
    finished = done.agg(F.max("day")).first()[0]
    assert sorted(map(tuple, done.collect())) == sorted(tuple(r) for r in want.where(F.col("day") <= F.lit(finished)).collect())
