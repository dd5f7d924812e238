"""Running sums, quantiles, patterns and round bins against plain loops, with hot keys."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridrisk.operators import ordered, zonal


def test_buckets_of_a_log_normal_key_are_even(spark):
    """The largest bucket stays near 1 / BUCKETS, where equal ranges would hold nearly all values."""
    rng = np.random.default_rng(1)
    rows = [("hot", float(x)) for x in np.exp(rng.normal(0, 3, 60_000))] + [("b", float(i)) for i in range(5)] + [(None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = ordered.bucketed(df, ["k"], "v").groupBy("k", "_b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    of = defaultdict(list)
    for r in got:
        of[r["k"]].append((r["_b"], r["n"], r["lo"], r["hi"]))
    hot = sorted(of["hot"])
    assert sum(n for _, n, _, _ in hot) == 60_000 and max(n for _, n, _, _ in hot) <= 60_000 * (1 / ordered.BUCKETS + 3 / ordered.ACCURACY)
    assert all(a[3] < b[2] for a, b in zip(hot, hot[1:], strict=False)) and sum(n for _, n, _, _ in of[None]) == 2 and sum(n for _, n, _, _ in of["b"]) == 5


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sums(spark, keys):
    rng = np.random.default_rng(2)
    rows = [(str(k) if k else None, int(i), float(w)) for k, i, w in zip(rng.integers(0, 3, 900), rng.permutation(900), rng.integers(0, 5, 900), strict=True)]
    df = spark.createDataFrame(rows, "k string, o long, w double")
    got = {r["o"]: (r["n"], r["s"], r["n_all"], r["s_all"]) for r in ordered.running(ordered.bucketed(df, keys, "o"), keys, "o", n=F.lit(1), s=F.col("w")).collect()}
    done, whole = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for k, _, w in rows:
        own = whole[k if keys else 0]
        own[0], own[1] = own[0] + 1, own[1] + w
    for k, o, w in sorted(rows, key=lambda r: r[1]):
        own = done[k if keys else 0]
        own[0], own[1] = own[0] + 1, own[1] + w
        assert got[o] == (own[0], own[1], *whole[k if keys else 0])


def interpolated(values, weights, p):
    """The rule as it is stated, on sorted pairs."""
    pairs = sorted(zip(values, weights, strict=True))
    run, total = np.cumsum([w for _, w in pairs]), sum(weights)
    t = 1 + (total - 1) * p
    low = max(math.floor(t), 1)
    part = t - math.floor(t)

    def at(x):
        return next((v for (v, _), r in zip(pairs, run, strict=True) if r >= x), pairs[-1][0])

    return (1 - part) * at(low) + part * at(min(low + 1, total))


def test_interpolated_quantiles(spark):
    rng = np.random.default_rng(3)
    rows = [(k, float(np.round(np.exp(rng.normal(0, 2)), 2)), float(rng.integers(0, 8)) / 4) for k in "abc" for _ in range({"a": 1500, "b": 20, "c": 1}[k])]
    rows += [("a", None, 5.0), ("a", float("nan"), 5.0), ("d", 3.0, 0.25)]  # d: less than one repeat
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    df = spark.createDataFrame(rows, "k string, v double, w double")
    got = {r["k"]: [r[f"q{round(100 * p)}"] for p in probs] for r in ordered.weighted_quantiles(df, ["k"], "v", "w", probs, "interpolated").collect()}
    for k in "abd":
        own = defaultdict(float)
        for key, v, w in rows:
            if key == k and v is not None and not math.isnan(v):
                own[v] += w
        assert got[k] == pytest.approx([interpolated(list(own), list(own.values()), p) for p in probs])
    assert got["d"] == [3.0] * 5
    # whole weights are repeats: the usual interpolated quantile
    whole = spark.createDataFrame([("x", float(v), float(w)) for v, w in ((1, 2), (5, 1), (9, 3))], "k string, v double, w double")
    assert tuple(ordered.weighted_quantiles(whole, [], "v", "w", [0.25, 0.5], "interpolated").first()) == pytest.approx(tuple(np.quantile([1, 1, 5, 9, 9, 9], [0.25, 0.5])))
    with pytest.raises(ValueError):
        ordered.weighted_quantiles(whole, ["k"], "v", "w", [0.5], "nearest")


def plain_groups(values, pattern, incomplete):
    n, hit = len(pattern), [False] * len(values)
    for i in range(len(values) - n + 1):
        if values[i : i + n] == pattern:
            hit[i : i + n] = [True] * n
    out, c, total = [], 0, sum(hit)
    for h in hit:
        c += h
        g = -(-c // n)
        out.append(g if h and (incomplete or g * n <= total) else 0)
    return out


@pytest.mark.parametrize("block", [1 << 16, 4])
def test_patterns_with_repeats_overlaps_and_gaps(spark, monkeypatch, block):
    monkeypatch.setattr(ordered, "BLOCK", block)
    rng = np.random.default_rng(4)
    series = {"a": [12, 1, 2] * 30, "b": [1, 1, 1, 2, 1, 1, 1, 1], "c": [12, 1], "d": rng.integers(1, 4, 700).tolist(), None: [1, None, 1, 1, 2], "e": [2, 1, 12, 1, 2, 3, 12, 1]}
    rows = [(k, 3 * i * i + i, v) for k, own in series.items() for i, v in enumerate(own)]  # gaps in the order don't part neighbours
    df = spark.createDataFrame(rows, "k string, o long, v int").repartition(5)
    for pattern, incomplete in (([12, 1, 2], False), ([1, 1], False), ([1, 1], True), ([1, 2, 1, 3], False)):
        got = defaultdict(list)
        for r in sorted(ordered.pattern_groups(df, ["k"], "o", "v", pattern, incomplete).collect(), key=lambda r: r["o"]):
            got[r["k"]].append(r["group"])
        assert got == {k: plain_groups(own, pattern, incomplete) for k, own in series.items()}
    some = {"x": [12, 1, 2], "y": [1, 1], "z": [2]}
    got = sorted((str(r["k"]), r["o"], r["pattern"], r["group"]) for r in ordered.pattern_matches(df, ["k"], "o", "v", some).collect())
    assert got == sorted((str(k), 3 * i * i + i, n, g) for k, own in series.items() for n, p in some.items() for i, g in enumerate(plain_groups(own, p, False)) if g)
    for bad in ([], [1, None]):
        with pytest.raises(ValueError):
            ordered.pattern_groups(df, ["k"], "o", "v", bad)


def pretty(lo, up, n=10):
    """Round breaks by the stated rule, in plain numbers."""
    span, least = up - lo, n // 3
    if span == 0:
        cell = max(abs(lo), abs(up)) or 1.0
        cell = (9 + cell / 10 if cell > 10 else cell) * 0.75 / max(1, least)
    else:
        cell = span / n
    base = 10.0 ** math.floor(math.log10(cell))
    step = base
    if 2 * base - cell < 1.5 * (cell - step):
        step = 2 * base
        if 5 * base - cell < 2.75 * (cell - step):
            step = 5 * base
            if 10 * base - cell < 1.5 * (cell - step):
                step = 10 * base
    a, b = math.floor(lo / step + 1e-10), math.ceil(up / step - 1e-10)
    k = least - (b - a)
    if k > 0:
        if lo == 0 and a == 0 and up != 0:
            b += k
        elif a >= 0:
            a, b = a - (k // 2 + k % 2), b + k // 2
        else:
            a, b = a - k // 2, b + (k // 2 + k % 2)
    return [i * step for i in range(a, b + 1)]


def test_round_bins(spark):
    assert pretty(0, 97) == [10.0 * i for i in range(11)] and pretty(1, 2)[:3] == pytest.approx([1.0, 1.1, 1.2])
    rng = np.random.default_rng(5)
    series = {"n": rng.normal(50, 20, 800), "l": np.exp(rng.normal(0, 2, 900)), "one": np.array([7.0]), "zero": np.array([0.0, 0.0]), "neg": np.array([-3.0, -3.0, -2.5]), "edge": np.array([0.1, 0.2, 0.3, 0.30000000000000004, 0.6, 1.0]), "big": np.array([1e9, 1e9 + 3])}
    rows = [(k, float(v)) for k, own in series.items() for v in own] + [("n", None), ("n", float("nan")), ("n", float("inf")), ("none", None)]
    got = {r["k"]: (r["breaks"], r["counts"]) for r in zonal.pretty_histogram(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert set(got) == set(series)
    for k, own in series.items():
        breaks = pretty(own.min(), own.max())
        step = breaks[1] - breaks[0]
        want = Counter(max(1, math.ceil(v / step - round(breaks[0] / step) - 1e-7)) for v in own)
        assert got[k][0] == pytest.approx(breaks) and got[k][1] == [want[i] for i in range(1, len(breaks))] and sum(got[k][1]) == len(own)
        assert breaks[0] <= own.min() and own.max() <= breaks[-1]
    assert len({len(c) for _, c in got.values()}) > 2
