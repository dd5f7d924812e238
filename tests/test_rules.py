"""The workflow's rules on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from gridrisk.functions import scalars
from gridrisk.operators import exposure as E
from gridrisk.operators import rules as R
from gridrisk.operators import trend, zonal
from gridrisk.sources import tables


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_selected_exposure(spark):
    freq = spark.createDataFrame([(1, "maize", 0.5), (1, "cattle", 0.25), (1, "generic-crop", 0.1)], "cell long, commodity string, p double")
    ex = spark.createDataFrame([(1, c, v, x) for c, v, x in (("maize", "ha", 10.0), ("maize", "n", 99.0), ("rice", "ha", 6.0), ("cattle", "n", 8.0), ("cattle", "ha", 99.0))], "cell long, commodity string, variable string, value double")
    kinds = spark.createDataFrame([("maize", "crop"), ("rice", "crop"), ("cattle", "livestock")], "commodity string, kind string")
    got = rows(R.selected_exposure(freq, ex, kinds, 1), "commodity", "variable", "at_risk")
    assert got == [("cattle", "n", 2.0), ("generic-crop", "ha", 1.6), ("maize", "ha", 1.0), ("maize", "ha", 5.0), ("rice", "ha", 0.6)]
    with pytest.raises(ValueError, match="sorghum"):
        R.selected_exposure(freq.withColumn("commodity", F.lit("sorghum")), ex, kinds)


def test_national_statistics_are_complete(spark):
    df = spark.createDataFrame([(4, "x", "yield", "t", 2000, 1.0), (4, "y", "yield", "t", 2000, 2.0), (4, "x", "area", "t", 2000, 9.0), (4, "x", "yield", "kg", 2000, 9.0), (99, "x", "yield", "t", 2000, 9.0)], "area int, item string, element string, unit string, year int, value double")
    items, areas = spark.createDataFrame([("x", "maize"), ("y", "maize"), ("z", "rice")], "item string, crop string"), spark.createDataFrame([(4, "AFG"), (8, "ALB")], "area int, iso3 string")
    got = rows(R.national_statistics(df, items, areas, "yield", ["t"], 2000, 2001), "iso3", "crop", "year", "value")
    assert len(got) == 8 and [g for g in got if g[3] is not None] == [("AFG", "maize", 2000, 3.0)]


def test_price_ladder_steps(spark):
    places = spark.createDataFrame([("a", "r1", "c1"), ("b", "r1", "c1"), ("c", "r1", "c1"), ("d", "r2", "c1"), ("e", "r3", "c2"), ("f", "r1", "c1")], "unit string, region string, continent string")
    data = [("a", "k", 2005, 10.0), ("a", "k", 2006, 20.0), ("a", "k", 1990, 99.0), ("a", "k", 2011, 99.0), ("b", "k", 1996, 4.0), ("c", "k", 1990, 6.0), ("a", "milk", 2005, 3.0), ("b", "milk", 1997, 7.0), ("a", "tea", 2005, 500.0), ("b", "tea", 1999, 900.0), ("c", "tea", 2005, 640.0), ("a", "hay", 2005, 2.0)]
    df = spark.createDataFrame(data, "unit string, crop string, year int, price double")
    edges = spark.createDataFrame([("c", "b"), ("c", "a"), ("a", "b"), ("f", "b")], "unit string, neighbour string")
    world = spark.createDataFrame([("k", 2005, 1.0), ("k", 2006, 3.0), ("k", 1999, 50.0), ("milk", 2005, 11.0), ("tea", 2005, 5.0)], "crop string, year int, price double")
    got = {(u, c): (p, s) for u, c, p, s in rows(R.price_ladder(df, places, edges, (2000, 2010), ["milk", "hay"], {"tea": 600.0}, world), "unit", "crop", "price", "step")}
    assert got["a", "k"] == (15.0, "recent") and got["b", "k"] == (4.0, "longer")  # five years before the window, not all
    assert got["c", "k"] == (15.0, "near")  # of the recent prices alone: b's older one doesn't count, and 1990 is too long ago
    assert got["f", "k"] == (15.0, "of_region") and got["d", "k"] == (15.0, "of_continent") and got["e", "k"] == (2.0, "of_all")
    assert {got[u, "milk"] for u in "abcdef"} == {(11.0, "of_all")}  # an own price doesn't count
    assert got["a", "hay"] == (2.0, "of_continent") and got["e", "hay"] == (None, None)  # no world price
    assert got["a", "tea"] == (pytest.approx((500 + 900 + 640) / 3), "of_longer") and got["b", "tea"] == (900.0, "longer") and got["c", "tea"] == (640.0, "recent") and got["e", "tea"] == (680.0, "of_longer")
    of_units = {(u, c): (p, s) for u, c, p, s in rows(R.price_ladder(df, places, edges, (2000, 2010)), "unit", "crop", "price", "step")}
    assert of_units["e", "k"] == (15.0, "of_all") and of_units["a", "milk"] == (3.0, "recent")


def test_hybrid_value_in_five_steps(spark):
    places = spark.createDataFrame([(u, r, c) for u, r, c in (("a", "r1", "c1"), ("b", "r1", "c1"), ("c", "r1", "c1"), ("d", "r2", "c1"), ("e", "r3", "c2"))], "unit string, region string, continent string")
    edges = spark.createDataFrame([("b", "a"), ("c", "b")], "unit string, neighbour string")
    production = spark.createDataFrame([(u, "k", 1000.0 * n) for n, u in enumerate("abcde", 1)] + [("a", "z", None), ("b", "y", 500.0)], "unit string, crop string, production double")
    prices = spark.createDataFrame([("a", "k", 10.4)] + [(u, "k", None) for u in "bcde"] + [("a", "z", 3.0)], "unit string, crop string, price double")
    world = spark.createDataFrame([("k", 60.0, 30.0), ("y", 9.0, 3.0)], "crop string, value double, production double")
    got = {(r["unit"], r["crop"]): r for r in E.hybrid_value(production, prices, world, places, edges).collect()}
    assert {k: (r["value"], r["step"]) for k, r in got.items()} == {("a", "k"): (10.0, "own"), ("b", "k"): (21.0, "near"), ("c", "k"): (31.0, "of_region"), ("d", "k"): (42.0, "of_continent"), ("e", "k"): (10000.0, "of_world"), ("a", "z"): (None, None), ("b", "y"): (1500.0, "of_world")}
    assert got["a", "k"]["of_region"] is None and got["a", "k"]["of_continent"] == 10.0  # the region without itself
    assert got["b", "k"]["value_world"] == 4000.0 and got["e", "k"]["value_nearby"] is None and got["a", "k"]["value_world"] == 10.0


def test_splits_and_siblings(spark):
    df = spark.createDataFrame([("a", "coffee", 10.0), ("b", "coffee", 10.0), ("a", "rice", 1.0)], "unit string, crop string, value double")
    ratios = spark.createDataFrame([("a", "arabica", 3.0), ("a", "robusta", 1.0), ("z", "arabica", 0.0), ("z", "robusta", 4.0)], "unit string, part string, production double")
    assert rows(R.split_by_ratio(df, ratios, "coffee"), "unit", "crop", "value") == [("a", "arabica", 7.5), ("a", "rice", 1.0), ("a", "robusta", 2.5), ("b", "arabica", 3.75), ("b", "robusta", 6.25)]
    more = R.copy_to_siblings(df.withColumnRenamed("value", "price"), spark.createDataFrame([("coffee", "rice"), ("coffee", "tea")], "crop string, sibling string"))
    assert {(r["unit"], r["crop"]) for r in more.collect()} == {("a", "coffee"), ("b", "coffee"), ("a", "rice"), ("b", "rice"), ("a", "tea"), ("b", "tea")} and more.count() == 6


def test_repair_seasons(spark):
    data = [(1, "Angola", 31, 36, 9, None, None, None), (2, "Other", 31, 36, 9, None, None, None), (3, "Other", None, None, None, 6, 6, 4), (4, "Other", 36, 36, 1, 4, 9, 6)]
    got = {r["cell"]: (r["s1"], r["e1"], r["lgp1"], r["s2"], r["e2"], r["lgp2"]) for r in R.repair_seasons(spark.createDataFrame(data, "cell int, admin0 string, s1 int, e1 int, lgp1 int, s2 int, e2 int, lgp2 int"), ["Angola"]).collect()}
    # day 310 after 1 January of a leap year is in November, day 60 is 1 March, day 360 in December; a late lone season becomes the second and then fills the first
    assert got == {1: (11, 12, 3, None, None, None), 2: (11, 12, 3, None, None, None), 3: (3, 4, 2, None, None, None), 4: (12, 1, 1, 2, 3, 2)}


def test_totals_move_with_a_late_season(spark):
    data = [(1, "Angola", 31, 36, 9, None, None, None, 50.0, None), (2, "Other", 31, 36, 9, None, None, None, 60.0, None), (3, "Angola", 30, 36, 9, None, None, None, 70.0, 5.0), (4, "Angola", 31, 36, 9, 4, 9, 6, 80.0, 8.0)]
    df = spark.createDataFrame(data, "cell int, admin0 string, s1 int, e1 int, lgp1 int, s2 int, e2 int, lgp2 int, rain1 double, rain2 double")
    got = R.repair_seasons(df, ["Angola"], totals=[("rain1", "rain2")])
    assert rows(got, "cell", "rain1", "rain2") == [(1, None, 50.0), (2, 60.0, None), (3, 70.0, 5.0), (4, 80.0, 8.0)]
    assert rows(got, "cell", "s1", "s2") == rows(R.repair_seasons(df, ["Angola"]), "cell", "s1", "s2")


def test_merge_claims(spark):
    """Area 100 is claimed by 160 and 161, 110 by 120 and 161: each has a row for either claimant."""
    data = [(100, "SSD", None, None, "x", 10.0), (100, "SDN", None, None, "x", 10.0), (160, "SSD", None, None, "x", 1.0), (161, "SDN", None, None, "x", 2.0), (110, "SDN", None, None, "x", 30.0), (110, "EGY", None, None, "x", 30.0), (120, "EGY", None, None, "x", None)]
    data += [(100, "SSD", "p", None, "x", 5.0), (100, "SSD", "p", "q", "x", 6.0), (7, "KEN", None, None, "x", 8.0), (None, "XXX", None, None, "x", 9.0), (120, "EGY", None, None, "y", None)]
    df = spark.createDataFrame(data, "code int, iso3 string, admin1 string, admin2 string, k string, value double")
    claims = spark.createDataFrame([(100, 160, "SSD"), (100, 161, "SDN"), (110, 120, "EGY"), (110, 161, "SDN")], "disputed int, claimant int, iso3 string")
    counts = spark.createDataFrame([(100, 1), (110, 2), (120, 5), (160, 3), (161, 7)], "code int, n_cells int")
    stay = [d for d in data if d[0] == 7 or d[0] is None or d[2]]
    want = {"sum": (11.0, 42.0, 30.0, 0.0), "mean": ((10 + 3) / 4, (10 + 14 + 60) / 10, 30.0, None), "min": (1.0, 2.0, 30.0, None), "max": (10.0, 30.0, 30.0, None)}
    for how, (ssd, sdn, egy, none) in want.items():
        out = R.merge_claims(df, claims, counts, "code", ["iso3", "k"], how)
        made = [(160, "SSD", None, None, "x", ssd), (161, "SDN", None, None, "x", sdn), (120, "EGY", None, None, "x", egy), (120, "EGY", None, None, "y", none)]
        assert out.columns == df.columns and out.dtypes == df.dtypes and rows(out, *df.columns) == sorted(stay + made, key=str)
    with pytest.raises(ValueError, match="iso3"):
        R.merge_claims(df, claims, counts, "code", ["k"], "sum")


def test_regrid_uses_both_areas(spark):
    df, old = spark.createDataFrame([(1, 100.0)], "cell int, value double"), spark.createDataFrame([(1, 10.0)], "cell int, area double")
    new, pairs = spark.createDataFrame([(1, 4.0), (2, 6.0)], "cell int, area double"), spark.createDataFrame([(1, 1), (2, 1)], "cell int, nearest int")
    assert rows(R.regrid(df, old, new, pairs), "cell", "value") == [(1, 40.0), (2, 60.0)]


def test_touching_cells(spark):
    ring = [(0.2, 0.2), (2.7, 0.2), (2.7, 1.6), (0.2, 1.6)]
    zones = spark.createDataFrame([(7, ring)], "zone_id int, ring array<struct<x:double,y:double>>")
    want = {(x, y) for x in range(3) for y in (0, 1)}
    assert {(r["x"], r["y"]) for r in R.touching_cells(zones, 1.0).collect()} == want
    slope = spark.createDataFrame([(1, [(0.5, 0.5), (3.5, 1.5), (0.5, 1.5)])], "zone_id int, ring array<struct<x:double,y:double>>")
    assert {(r["x"], r["y"]) for r in R.touching_cells(slope, 1.0).collect()} == {(0, 0), (1, 0), (2, 1), (3, 1), (0, 1), (1, 1)}


def test_thresholds_and_catalogue(spark):
    species = spark.createDataFrame([("maize", 20.0, 25.0, 30.2), ("maize", 21.0, 26.0, 31.1)], "crop string, opt double, mid double, abs double")
    assert rows(R.crop_thresholds(species, "NTx", "below"), "severity", "threshold") == [("extreme", 30.65), ("moderate", 20.5), ("severe", 25.5)]
    assert rows(R.crop_thresholds(species, "PTOT_G", "above"), "severity", "threshold") == [("extreme", 30.65), ("moderate", 20.5), ("severe", 25.5)]
    rain = spark.createDataFrame([("maize", 10.25, 15.2, 20.1), ("maize", 10.25, 16.1, 20.1), ("maize", 10.25, 15.0, 20.1)], "crop string, opt double, mid double, abs double")
    assert rows(R.crop_thresholds(rain, "PTOT_G", "above"), "severity", "threshold") == [("extreme", pytest.approx(20.1)), ("moderate", 10.25), ("severe", pytest.approx((16 + 17 + 15) / 3))]
    th = spark.createDataFrame([("maize", h, "severe", 1.0) for h in ("NTx", "NDWL", "NDWS")] + [("rice", "NTx", "severe", 2.0)], "crop string, hazard string, severity string, threshold double")
    combos = spark.createDataFrame([("NTx", "NDWL", "NDWS")], "heat string, wet string, dry string")
    catalogue = R.interaction_catalogue(th, combos)
    assert rows(catalogue, "crop", "heat", "wet", "dry") == [("maize", "NTx", "NDWL", "NDWS")]
    with pytest.raises(ValueError):
        R.interaction_catalogue(th, spark.createDataFrame([("NTx", "NTx", "NDWS")], "heat string, wet string, dry string"))
    assert R.crop_bundle(th, catalogue).count() == 3
    with pytest.raises(ValueError, match="maize/severe/NDWS"):
        R.crop_bundle(th.where("hazard <> 'NDWS'"), catalogue)
    generic = th.where("crop = 'maize'").drop("crop")
    assert rows(R.inherit_thresholds(generic, spark.createDataFrame([("goats",)], "crop string"), ["NTx"]), "crop", "hazard") == [("goats", "NDWL"), ("goats", "NDWS")]


def test_labels(spark):
    df = spark.createDataFrame([("a.b..c",), ("a.b",), ("a.b.c.d",)], "label string")
    got = [tuple(r)[1:] for r in R.split_label(df, "label", ["x", "y", "z"], [(r"\.\.", "."), (r"\.", "_")]).collect()]
    assert got == [("a", "b", "c", 0), ("a", "b", None, 1), (None, None, None, 3)]


def test_student_p_values(spark):
    # two-sided 5 % points of Student's t
    points = [(1, 12.706204736), (2, 4.30265273), (3, 3.182446305), (4, 2.776445105), (7, 2.364624252), (10, 2.228138852), (29, 2.045229642), (30, 2.042272456)]
    got = spark.createDataFrame(points, "n int, t double").select(R.t_p_value("t", "n").alias("p"), R.t_p_value(F.lit(0.0), "n").alias("one"), R.t_p_value("t", F.lit(0)).alias("none")).collect()
    assert all(r["p"] == pytest.approx(0.05, abs=1e-8) and r["one"] == pytest.approx(1.0) and r["none"] is None for r in got)


def test_detrended_variation_gate(spark):
    rise, flat = [(1, i, 10.0 + i + (i % 3)) for i in range(12)], [(2, i, 10.0 + (i * 7) % 5) for i in range(12)]
    short, same = [(3, i, 1.0 * i) for i in range(9)], [(4, i, 5.0) for i in range(12)]
    df = spark.createDataFrame(rise + flat + short + same + [(1, 99, None)], "k int, year int, value double")
    got = {r["k"]: r["cv"] for r in R.detrended_variation(df, ["k"], "year", "value").collect()}
    ys = [v for _, _, v in rise]
    m, x = sum(ys) / 12, [i - 5.5 for i in range(12)]
    b = sum(a * y for a, y in zip(x, ys, strict=True)) / sum(a * a for a in x)
    res = [y - m - b * a for a, y in zip(x, ys, strict=True)]
    assert got[1] == pytest.approx(math.sqrt(sum(e * e for e in res) / 11) / m) and got[2] is None and got[3] is None and got[4] is None


def test_cash_flow(spark):
    df = spark.createDataFrame([("p", t, 10.0 * t, 30.0) for t in (1, 2, 3)], "k string, t int, benefit double, cost double")
    got = rows(R.cash_flow(df, ["k"], 0.0, 3, 1), "t", "cost_t", "benefit_t", "bcr")
    assert got == [(0, 10.0, 0.0, 0.0), (1, 10.0, 0.0, 0.0), (2, 10.0, 10.0, 10 / 30), (3, 0.0, 20.0, 1.0)]


def test_impact_and_currency(spark):
    df = spark.createDataFrame([(100.0, 0.2), (100.0, None)], "result double, cv double")
    got = rows(R.impact_effects(df, [0.1], [0.5], [2.0], 1), "cv", "marginal", "marginal_service", "benefit")
    assert [tuple(round(x, 6) if x is not None else x for x in g) for g in got] == [(0.2, 10.0, 4.4, 7.2), (None, 10.0, 0.0, 5.0)]
    rates, fixes = spark.createDataFrame([("A", 2000, 2.0, 4.0)], "iso3 string, year int, rate double, ppp double"), spark.createDataFrame([("A", 0.5)], "iso3 string, factor double")
    values = spark.createDataFrame([("A", 2000, 8.0), ("B", 2000, 8.0)], "iso3 string, year int, value double")
    assert rows(R.converted(values, rates, fixes), "iso3", "usd", "intl") == [("A", 2.0, 1.0), ("B", None, None)]


def test_weighted_quantiles_of_many_buckets(spark):
    data = [("a", float(i * i % 977), 1.0 + i % 3) for i in range(900)] + [("b", 5.0, 2.0), (None, 1.0, 1.0), (None, 2.0, 3.0), ("c", None, 1.0)]
    got = {r["k"]: (r["q25"], r["q50"]) for r in zonal.weighted_quantiles(spark.createDataFrame(data, "k string, v double, w double"), ["k"], "v", "w", [0.25, 0.5]).collect()}

    def brute(k, p):
        own = sorted((v, w) for n, v, w in data if n == k and v is not None)
        run, whole = 0, sum(w for _, w in own)
        for v, w in own:
            run += w
            if run >= p * whole:
                return v

    assert all(got[k] == (brute(k, 0.25), brute(k, 0.5)) for k in ("a", "b", None))


def test_no_pair_of_years_is_left_out(spark):
    df = spark.createDataFrame([("k", y, float(y)) for y in (1000, 1500, 2000)], "k string, year int, value double")
    assert trend.theil_sen(df, ["k"]).first()["slope"] == 1.0 and trend.mann_kendall(df, ["k"]).first()["s"] == 3


def test_mask_split_keeps_totals(spark):
    df = spark.createDataFrame([(1, "cattle", 10.0), (2, "cattle", 4.0), (3, "goats", 6.0)], "cell int, animal string, value double")
    mask = spark.createDataFrame([(1, 1), (2, 0)], "cell int, inside int")  # cell 3 has no mask
    got = {(r["cell"], r["animal"]): r["value"] for r in R.mask_split(df, mask, "animal").collect()}
    assert got == {(1, "cattle-highland"): 10.0, (1, "cattle-tropical"): 0.0, (2, "cattle-highland"): 0.0, (2, "cattle-tropical"): 4.0, (3, "goats-highland"): 0.0, (3, "goats-tropical"): 6.0}


def test_sowing_of_single_seasons_fills_first(spark):
    rows = [(1, "maize", "first", 3), (1, "maize", "single", 9), (1, "teff", "single", 6), (1, "rice", None, 1), (2, "rice", None, 1)]
    got = {r["cell"]: (r["median"], r["mean"]) for r in R.merged_sowing(spark.createDataFrame(rows, "cell int, crop string, season string, month int")).collect()}
    assert got == {1: (4.5, 4.5), 2: (None, None)}


def test_livestock_loss_by_share_of_heads(spark):
    rows = [("x", "cattle", 3.0, -0.2, 8.0, 4.0), ("x", "goats", 1.0, -0.6, 0.0, 4.0), ("y", "goats", 2.0, -0.1, 1.0, 0.0), ("z", "cattle", 0.0, -0.1, 0.0, 0.0)]
    got = {(r["code"], r["product"]): tuple(r)[2:] for r in R.livestock_loss(spark.createDataFrame(rows, "code string, animal string, heads double, change double, meat double, milk double"), ["code"], "cattle").collect()}
    assert got["x", "meat"] == pytest.approx((-0.3, 8.0, 6.0, 2.0)) and got["x", "milk"] == pytest.approx((-0.3, 8.0, 6.0, 2.0))
    assert got["y", "meat"] == pytest.approx((-0.1, 1.0, 0.0, 1.0)) and got["z", "meat"] == (None, 0.0, None, None)


def test_breaks_and_patched_folder(spark, tmp_path):
    df = spark.createDataFrame([(1.5, 10.5), (0.0, 250.0), (0.02, 0.17), (5.0, 5.0)], "lo double, hi double")
    got = [r[0] for r in df.select(scalars.break_sequence("lo", "hi")).collect()]
    assert got[0] == pytest.approx([1.5 + 0.1 * k for k in range(91)]) and got[1] == [0.0, 100.0, 200.0] and got[2] == pytest.approx([0.01 * k for k in range(21)]) and got[3] is None
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([("F", "R", 1), ("F", "N", 2), ("O", "R", 3)], "scenario string, hazard string, v int"), path, keys=["scenario"])
    before = sorted(p.name for p in (tmp_path / "t" / "scenario=O").iterdir())
    tables.patch_partition(spark, path, "scenario", "F", {"hazard": F.when(F.col("hazard") == "R", "A").otherwise(F.col("hazard"))})
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("scenario", "hazard", "v").collect()) == [("F", "A", 1), ("F", "N", 2), ("O", "R", 3)]
    assert sorted(p.name for p in (tmp_path / "t" / "scenario=O").iterdir()) == before


def test_ecocrop_thresholds(spark):
    """Three species of a crop, one without limits; one of another crop with a null."""
    columns = ["temp_opt_min", "temp_opt_max", "temp_abs_min", "temp_abs_max", "rain_opt_min", "rain_opt_max", "rain_abs_min", "rain_abs_max"]
    species = spark.createDataFrame([("s1", 10.0, 30.0, 5.0, 40.0, 500.0, 900.0, 300.0, 1500.0), ("s2", 12.0, 32.5, 6.0, 43.0, 600.0, 1001.0, 400.0, 1600.0), ("s4", 1.0, 20.0, 0.0, 30.0, None, 800.0, 100.0, 1000.0)], "species string, " + ", ".join(f"{c} double" for c in columns))
    crops = spark.createDataFrame([("maize", "s1; s2;s3;s1"), ("rye", "s4"), ("none", "s9")], "crop string, sci_name string")
    got = {r[:4]: r[4] for r in rows(R.ecocrop_thresholds(crops, species), "crop", "index_name", "direction", "description", "threshold")}
    assert {k[0] for k in got} == {"maize", "rye"} and len(got) == 2 * 21
    m = lambda i, d: tuple(got["maize", i, d, s] for s in ("Moderate", "Severe", "Extreme"))
    assert m("PTOT", "<") == (550.0, (400 + 500) / 2, 350.0) and m("PTOT", ">") == (950.5, (1200 + 1301) / 2, 1550.0)  # 1300.5 is rounded up before the mean
    assert m("TAVG", "<") == (11.0, (7.5 + 9) / 2, 5.5) and m("TAVG", ">") == (31.25, (35 + 37.75) / 2, 41.5)
    assert m("NTxM31", ">") == (7.0, 14.0, 21.0) and m("NTxS37", ">") == (7.0, 14.0, 21.0) and m("NTxE42", ">") == (1.0, 5.0, 10.0)  # (30 + 32) / 2; (35 + 38) / 2 up; (40 + 43) / 2 up
    assert got["rye", "PTOT", "<", "Moderate"] is None and got["rye", "PTOT", "<", "Extreme"] == 100.0 and ("rye", "NTxM20", ">", "Severe") in got


def test_interaction_table(spark):
    classes = [(c, s, h, f"{h}_{c[:3]}_mean.tif") for c in ("maize", "rice", "cattle-tropical") for s in ("Severe", "Extreme") for h in ("NTxS", "PTOT_G", "PTOT_L", "THI_max") if not (c == "rice" and s == "Extreme" and h == "PTOT_L")] + [("beans", "Severe", "NTxS", "NTxS_mai_mean.tif"), ("beans", "Severe", "PTOT_G", "PTOT_G_mai_mean.tif"), ("beans", "Severe", "PTOT_L", "PTOT_L_mai_mean.tif")]
    df = spark.createDataFrame(classes, "crop string, severity string, hazard string, file string")
    both = [R.Interaction("NTxS", "PTOT_G", "PTOT_L"), R.Interaction("THI_max", "PTOT_G", "PTOT_L", kind="animal"), R.Interaction("NTx35", "NDWL0", "NDWS", True, True, True)]
    table = R.interaction_table(df, both, short=["rice", "cattle-tropical"])
    got = rows(table, "crop", "severity", "heat", "code", "in_short")
    assert [g[:2] for g in got] == [("beans", "Severe"), ("cattle-tropical", "Extreme"), ("cattle-tropical", "Severe"), ("maize", "Extreme"), ("maize", "Severe"), ("rice", "Severe")]
    assert got[1][2:] == ("THI-max-cat-mean", "PTOT-L-cat-mean+THI-max-cat-mean+PTOT-G-cat-mean", False) and got[5][4] and not got[3][4]
    combos = R.distinct_combinations(table).collect()
    assert len(combos) == 5 and "crop" not in combos[0].asDict() and [r["code"] for r in combos] == sorted(r["code"] for r in combos)  # beans and maize share one
    with pytest.raises(ValueError, match="PTOT_L"):
        R.interaction_table(df, [*both, R.Interaction("NTx40", "NDWL0", "PTOT_L", True, True, True)])


def test_a_commodity_without_a_kind_is_an_error(spark):
    freq = spark.createDataFrame([(1, "maize", 0.5)], "cell long, commodity string, p double")
    ex = spark.createDataFrame([(1, "maize", "ha", 10.0), (1, "teff", "ha", 1.0)], "cell long, commodity string, variable string, value double")
    with pytest.raises(ValueError, match="teff"):
        R.selected_exposure(freq, ex, spark.createDataFrame([("maize", "crop")], "commodity string, kind string"))


def test_no_name_is_registered_twice():
    from gridrisk.plans import registry

    with pytest.raises(ValueError, match="twice"):
        registry.query("g25_crop_thresholds")(lambda spark, sf: None)


def test_long_series_are_refused(spark):
    df = spark.range(trend.YEARS + 1).select(F.lit("a").alias("k"), F.col("id").cast("int").alias("year"), F.col("id").cast("double").alias("value"))
    with pytest.raises(Exception, match="more than 200 values.*a"):
        trend.theil_sen(df, ["k"]).collect()
    assert trend.theil_sen(df.where("year > 0"), ["k"]).first()["slope"] == 1.0


def test_lookup_lists_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(R, "LISTED", 3)
    df = spark.createDataFrame([("b", 1.5), ("a", None), ("b", 1.5)], "crop string, s double")
    assert spark.range(1).select(F.inline(R.listed(df, "crop", "s"))).collect() == [("a", None), ("b", 1.5)]
    assert spark.range(1).select(F.inline(R.listed(df.limit(0), "crop"))).count() == 0
    with pytest.raises(ValueError, match="more than 3"):
        R.listed(spark.range(4), "id")
