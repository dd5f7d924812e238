"""Covered shares, regridding from two definitions, zones with holes: against plain clipping and plain loops."""

import math
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridrisk import plans
from gridrisk.operators import coverage as K
from gridrisk.operators import grid, rules
from gridrisk.operators.grids import Grid, pairs, regrid

ZONES = "zone_id int, rings array<array<struct<x:double,y:double>>>"


def clipped(ring, x, y):
    """The area of a ring inside of a unit cell, by cutting it with the cell's four sides."""
    pts = list(ring)
    for a, b, c in ((1, 0, -x), (-1, 0, x + 1), (0, 1, -y), (0, -1, y + 1)):
        out = []
        for p, q in zip(pts, pts[1:] + pts[:1], strict=True):
            sp, sq = a * p[0] + b * p[1] + c, a * q[0] + b * q[1] + c
            if (sp >= 0) != (sq >= 0):
                t = sp / (sp - sq)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
            if sq >= 0:
                out.append(q)
        pts = out
        if not pts:
            return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(pts, pts[1:] + pts[:1], strict=True))) / 2


def star(rng, cx, cy, r, n):
    angles = np.sort(rng.uniform(0, 2 * math.pi, n))
    return [(cx + float(d * math.cos(a)), cy + float(d * math.sin(a))) for a, d in zip(angles, r * rng.uniform(0.5, 1, n), strict=True)]


def shares(df):
    return {(r["zone_id"], r["x"], r["y"]): r["fraction"] for r in df.collect()}


def test_shares_by_plain_clipping(spark):
    rng = np.random.default_rng(1)
    outer, hole, part = star(rng, 6, 5, 5, 17), [(5.2, 4.1), (6.9, 4.4), (6.1, 5.8)], [(20.0, -3.0), (24.0, -3.0), (24.0, 1.5), (20.0, 1.5)]
    zones = {1: [outer, hole, part], 2: [list(reversed(outer)), list(reversed(hole))], 3: [[(0.25, 0.25), (0.75, 0.25), (0.75, 0.5)]], 4: [[(2.0, 2.0), (9.0, 2.0), (9.0, 9.0), (2.0, 9.0), (2.0, 2.0)]], 5: [[(0.0, 0.0), (1.0, 1.0)]]}
    got = shares(K.coverage(spark.createDataFrame(list(zones.items()), ZONES)))
    want = {}
    for z, rings in zones.items():
        for x in range(0, 26):
            for y in range(-4, 12):
                a = sum((-1 if i == 1 else 1) * clipped(r, x, y) for i, r in enumerate(rings))
                if a > 1e-9:
                    want[z, x, y] = a
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert {z for z, _, _ in got} == {1, 2, 3, 4} and got[4, 5, 5] == 1.0


def test_shares_of_a_partition_sum_to_one(spark):
    """A quarter-turned mesh of quadrilaterals with moved corners fills the plane: each cell in its middle is shared out whole."""
    rng = np.random.default_rng(2)
    corner = {(i, j): (float(3 * i + 0.7 * j + rng.uniform(-0.5, 0.5)), float(3 * j - 0.7 * i + rng.uniform(-0.5, 0.5))) for i in range(8) for j in range(8)}
    zones = [(10 * i + j, [[corner[i, j], corner[i + 1, j], corner[i + 1, j + 1], corner[i, j + 1]]]) for i in range(7) for j in range(7)]
    total = defaultdict(float)
    for (_, x, y), f in shares(K.coverage(spark.createDataFrame(zones, ZONES))).items():
        total[x, y] += f
    assert all(total[x, y] == pytest.approx(1) for x in range(7, 17) for y in range(4, 14)) and max(total.values()) < 1 + 1e-6


def test_shares_on_another_grid_and_one_ring(spark):
    z = spark.createDataFrame([(1, [(10.0, 20.0), (11.0, 20.0), (11.0, 20.5), (10.0, 20.5)])], "zone_id int, ring array<struct<x:double,y:double>>")
    got = shares(K.coverage(z, 0.25, 9.9, 20.1))
    assert len(got) == 5 * 3 and sum(got.values()) * 0.0625 == pytest.approx(0.5) and got[1, 1, 0] == pytest.approx(1) and got[1, 0, 0] == pytest.approx(0.6) and got[1, 1, -1] == pytest.approx(0.4)


def test_covered_statistics(spark):
    z = spark.createDataFrame([(1, [[(0.5, 0.0), (3.0, 0.0), (3.0, 1.0), (0.5, 1.0)]]), (2, [[(50.0, 50.0), (51.0, 50.0), (51.0, 51.0)]])], ZONES)
    cells = spark.createDataFrame([(0, 0, "a", 10.0), (1, 0, "a", 20.0), (2, 0, "a", None), (0, 0, None, 7.0), (9, 9, "a", 99.0)], "x long, y long, k string, value double")
    got = {(r["zone_id"], r["k"]): r for r in K.covered_statistics(cells, K.coverage(z), ["k"]).collect()}
    assert set(got) == {(1, "a"), (1, None)}
    a = got[1, "a"]
    assert a["mean"] == pytest.approx((10 * 0.5 + 20) / 1.5) and (a["low"], a["high"]) == (10.0, 20.0) and sum(a["counts"]) == 2
    assert a["median"] == pytest.approx(20 * 0.25 + 20 * 0.75)  # 1.5 repeats: t = 1.25, from the first that reaches 1 (20) to that which reaches 1.5 (20)


def test_zones_with_holes_and_order(spark):
    ring = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    zones = spark.createDataFrame([(1, [ring(0.0, 9.0), ring(3.0, 6.0), ring(20.0, 22.0)]), (2, [ring(3.0, 6.0)]), (3, [ring(5.0, 30.0)])], ZONES)
    cells = spark.range(40 * 40).select(F.col("id").alias("cell"), (F.col("id") % 40 + 0.5).alias("x"), (F.floor(F.col("id") / 40) + 0.5).alias("y"))
    inside = lambda x, y, a, b: a < x < b and a < y < b
    for last in (False, True):
        got = {r["cell"]: r["zone_id"] for r in grid.assign_zones(cells, zones, last=last).collect()}
        want = {}
        for c in range(1600):
            x, y = c % 40 + 0.5, c // 40 + 0.5
            own = [z for z, ok in ((1, (inside(x, y, 0, 9) and not inside(x, y, 3, 6)) or inside(x, y, 20, 22)), (2, inside(x, y, 3, 6)), (3, inside(x, y, 5, 30))) if ok]
            if own:
                want[c] = max(own) if last else min(own)
        assert got == want and {1, 2, 3} == set(got.values())
    edge = {(r["zone_id"], r["x"], r["y"]) for r in rules.touching_cells(spark.createDataFrame([(1, [[(0.5, 0.5), (2.5, 0.5), (2.5, 1.5)], [(7.2, 7.2), (7.4, 7.2), (7.4, 7.4)]])], ZONES), 1.0).collect()}
    assert {(1, 0, 0), (1, 1, 0), (1, 2, 0), (1, 2, 1), (1, 7, 7)} <= edge


OLD, NEW = Grid(0.0, 10.0, 1.0, 0.5, 9, 12), Grid(-0.25, 9.9, 1.5, 0.75, 7, 9)


def values(rng, g, gaps=True):
    return {c: float(rng.integers(1, 100)) for c in range(g.nx * g.ny) if not gaps or rng.random() > 0.2}


def plain(data, old, new, how):
    """New cell -> [(old cell, weight)], pair by pair."""
    out = defaultdict(list)
    for n in range(new.nx * new.ny):
        cx, cy = new.x0 + (n % new.nx + 0.5) * new.dx, new.y0 + (n // new.nx + 0.5) * new.dy
        for o in data:
            i, j = o % old.nx, o // old.nx
            w = 1.0
            for c, o0, od, k, on, n0, nd, nk in ((cx, old.x0, old.dx, i, old.nx, new.x0, new.dx, n % new.nx), (cy, old.y0, old.dy, j, old.ny, new.y0, new.dy, n // new.nx)):
                u = (c - o0) / od
                if how == "nearest":
                    w *= k <= u < k + 1
                elif how == "bilinear":
                    w *= max(0.0, 1 - abs(u - 0.5 - k)) if 0 <= u <= on else 0.0
                else:
                    w *= max(0.0, min(o0 + (k + 1) * od, n0 + (nk + 1) * nd) - max(o0 + k * od, n0 + nk * nd)) / od
            if w > 1e-12:
                out[n].append((o, w))
    return out


@pytest.mark.parametrize("how", ["nearest", "bilinear", "area"])
@pytest.mark.parametrize(("old", "new"), [(OLD, NEW), (NEW, OLD), (OLD, Grid(2.0, 11.0, 0.4, 0.2, 11, 13)), (OLD, OLD)])
def test_regrid_by_plain_pairs(spark, how, old, new):
    rng = np.random.default_rng(3)
    data = {"a": values(rng, old), "b": values(rng, old, False)}
    df = spark.createDataFrame([(c, k, v) for k, own in data.items() for c, v in own.items()] + [(0, "c", None), (old.nx * old.ny, "b", 1e9)], "cell long, k string, value double")
    for mass in (False, True):
        got = {(r["k"], r["cell"]): r["value"] for r in regrid(df, old, new, ["k"], how, mass).collect()}
        want = {}
        for k, own in data.items():
            for n, ws in plain(own, old, new, how).items():
                total, w = sum(own[o] * x for o, x in ws), sum(x for _, x in ws)
                want[k, n] = total if how == "area" and mass else total / w * (new.dx * new.dy / (old.dx * old.dy) if mass else 1)
        assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)


@pytest.mark.parametrize("sphere", [False, True])
def test_mass_is_kept_on_a_grid_of_another_ratio_with_an_offset(spark, sphere):
    data = values(np.random.default_rng(4), OLD)
    df = spark.createDataFrame(list(data.items()), "cell long, value double")
    got = regrid(df, OLD, NEW, how="area", mass=True, sphere=sphere).agg(F.sum("value")).first()[0]
    assert got == pytest.approx(sum(data.values()))
    flat = regrid(df.withColumn("value", F.lit(3.0)), OLD, NEW, how="area", sphere=sphere)  # missing cells and edges leave the others' weights
    assert {round(r["value"], 9) for r in flat.collect()} == {3.0}
    areas = spark.range(OLD.nx * OLD.ny).select(OLD.area("id", True).alias("a")).agg(F.sum("a")).first()[0]
    assert areas == pytest.approx(6371.0088**2 * math.radians(9) * (math.sin(math.radians(16)) - math.sin(math.radians(10))))


def test_weights_make_up_the_whole_inside(spark):
    df = spark.range(OLD.nx * OLD.ny).select(F.col("id").alias("cell"))
    for how in ("nearest", "bilinear"):
        sums = Counter()
        for r in pairs(df, OLD, NEW, how).collect():
            sums[r["new_cell"]] += r["weight"]
        assert sums[3 * NEW.nx + 3] == pytest.approx(1) and max(sums.values()) == pytest.approx(1)
    with pytest.raises(ValueError):
        pairs(df, OLD, NEW, "cubic")
    with pytest.raises(ValueError):
        Grid(0, 0, 0, 1, 1, 1)
    got = df.select(OLD.cell_of(OLD.column("cell") + 0.5, OLD.row("cell") * 0.5 + 10.1).alias("c"), "cell").where("c <> cell or c is null")
    assert got.isEmpty() and spark.range(1).select(OLD.cell_of(F.lit(-0.1), F.lit(11.0))).first()[0] is None


@pytest.mark.parametrize(("old", "new"), [(OLD, Grid(-1.4, 8.7, 0.8, 0.3, 15, 30)), (NEW, Grid(-1.0, 9.0, 0.8, 0.3, 18, 40))])
def test_bilinear_beyond_the_edge_by_plain_pairs(spark, old, new):
    data = values(np.random.default_rng(5), old)
    got = {r["cell"]: r["value"] for r in regrid(spark.createDataFrame(list(data.items()), "cell long, value double"), old, new, beyond=True).collect()}
    want = {}
    for n in range(new.nx * new.ny):
        u, v = (new.x0 + (n % new.nx + 0.5) * new.dx - old.x0) / old.dx - 0.5, (new.y0 + (n // new.nx + 0.5) * new.dy - old.y0) / old.dy - 0.5
        ws = [(x, w) for o, x in data.items() if (w := max(0.0, 1 - abs(u - o % old.nx)) * max(0.0, 1 - abs(v - o // old.nx))) > 1e-12]
        if ws:
            want[n] = sum(x * w for x, w in ws) / sum(w for _, w in ws)
    assert got.keys() == want.keys() and all(got[n] == pytest.approx(want[n]) for n in want)
    assert len(want) > len(plain(data, old, new, "bilinear"))
    with pytest.raises(ValueError):
        pairs(spark.range(1).withColumnRenamed("id", "cell"), old, new, "nearest", beyond=True)


def test_bilinear_query_in_the_last_rows_of_the_suppliers_grid(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(s, h, float(rng.integers(1, 50))) for s in range(19950, 20020) for h in "ANR" if rng.random() > 0.2]
    spark.createDataFrame(rows, "l_suppkey long, l_returnflag string, l_quantity double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    got = {(r["cell"], r["hazard"]): r["value"] for r in plans.queries()["r03_bilinear_grids"](spark, str(tmp_path)).collect()}
    want = {(c, h): v for c, h, v in con.sql(f"SELECT cell, hazard, value FROM ({plans.oracle_sql()['r03_bilinear_grids']})").fetchall()}
    assert max(c for c, _ in want) >= 4999 * 25 and got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
