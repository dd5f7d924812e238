"""Order within keys of any size: running sums, quantiles and patterns without one task for a key.

Rows of a key are dealt to buckets of nearly equal numbers of values, by splitters from a quantile sketch. A
running sum is the sum within a bucket plus what the buckets before it hold: the latter is one row for each key and bucket, put in front of the
bucket's own rows, so that one shuffle by (key, bucket) serves both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import col
from gridrisk.sources.shared import pinned

#: Buckets of a key (a power of two), and the sketch's accuracy: the largest bucket has about 1 / BUCKETS + 2 / ACCURACY of a key's distinct values.
BUCKETS, ACCURACY = 256, 5120
#: Rows of a series that one task looks at together, besides what overlaps.
BLOCK = 1 << 16


def same_keys(keys: list[str], prefix: str = "_k") -> Column:
    """Null-safe equality of the keys and their copies prefix0, prefix1, ..."""
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"{prefix}{i}"))
    return on


def bucketed(df: DataFrame, keys: list[str], by: str, buckets: int = BUCKETS) -> DataFrame:
    """df with _b, the bucket of `by` (a number that isn't null) within its key; equal values share a bucket, larger values never have a smaller one."""
    cuts = F.percentile_approx(by, F.array(*(F.lit(i / buckets) for i in range(1, buckets))), ACCURACY).alias("_cuts")
    if keys:
        of_key = pinned(df.groupBy(*keys).agg(cuts).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_cuts"))
        rows = df.join(of_key, same_keys(keys))
    else:
        rows = df.withColumn("_cuts", F.lit(df.agg(cuts).first()[0] or [0.0] * (buckets - 1)))  # one array
    steps = F.array(*(F.lit(buckets >> i) for i in range(1, buckets.bit_length())))
    at = F.aggregate(steps, F.lit(0), lambda pos, s: pos + F.when(F.get("_cuts", pos + s - 1) < F.col(by), s).otherwise(0))
    return rows.withColumn("_b", at).drop("_cuts", *(f"_k{i}" for i in range(len(keys))))


def running(rows: DataFrame, keys: list[str], by: str, **sums: Column | str) -> DataFrame:
    """Bucketed rows with each sum over the key's rows up to and with this one, and {name}_all, the sum over all of the key. `by` tells a key's rows apart."""
    own = rows.withColumns({f"_x_{n}": F.coalesce(col(x), F.lit(0)) for n, x in sums.items()})
    heads = own.groupBy(*keys, "_b").agg(*(F.sum(f"_x_{n}").alias(f"_s_{n}") for n in sums))
    before, whole = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)  # BUCKETS rows a key
    first = heads.select(*keys, "_b", F.lit(0).alias("_own"), *(F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_x_{n}") for n in sums), *(F.sum(f"_s_{n}").over(whole).alias(f"{n}_all") for n in sums))
    both = own.withColumn("_own", F.lit(1)).unionByName(first, allowMissingColumns=True)
    bucket = Window.partitionBy(*keys, "_b")
    upto = bucket.orderBy("_own", by).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumns({n: F.sum(f"_x_{n}").over(upto) for n in sums} | {f"{n}_all": F.max(f"{n}_all").over(bucket) for n in sums})
    return out.where("_own = 1").drop("_own", *(f"_x_{n}" for n in sums))


def weighted_quantiles(df: DataFrame, keys: list[str], value: str, weight: str, probs: list[float], rule: str = "share") -> DataFrame:
    """q10, q50, ... by key.

    rule `share`: the first value, in order, at which the running weight reaches that share of the whole.
    rule `interpolated`: weights count as repeats. With W their sum and t = 1 + (W - 1) p, between the first value whose running weight reaches floor(t)
    (1 at least) and that of the next whole number (W at most), in the proportion of t's fraction; where none reaches it, the last value.
    A null value takes no part; a key without weight has nulls (share) or its last value.
    """
    if rule not in ("share", "interpolated"):
        raise ValueError(f"unknown rule {rule}")
    ties = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*keys, F.col(value).alias("_v")).agg(F.sum(weight).alias("_w"))
    run = running(bucketed(pinned(ties), keys, "_v"), keys, "_v", _run=F.col("_w"))

    def reaching(target: Column) -> Column:
        return F.min(F.when(F.col("_run") >= target, F.col("_v")))

    def quantile(p: float) -> Column:
        if rule == "share":
            return reaching(F.lit(p) * F.col("_run_all"))
        t = 1 + (F.col("_run_all") - 1) * p
        low = F.greatest(F.floor(t), F.lit(1))
        high, part = F.least(low + 1, F.col("_run_all")), F.max(t - F.floor(t))
        return (1 - part) * F.coalesce(reaching(low), F.max("_v")) + part * F.coalesce(reaching(high), F.max("_v"))

    return run.groupBy(*keys).agg(*(quantile(p).alias(f"q{round(p * 100)}") for p in probs))


def _covered(df: DataFrame, keys: list[str], order: str, value: str, patterns: dict[str, list]) -> DataFrame:
    """df with _o, _b (order and bucket) and _hits, the names of the patterns of which a match covers the row.

    Rows of a key go to blocks of BLOCK rows, each with the few rows on either side that a match can reach.
    """
    if not patterns or any(not p or any(x is None for x in p) for p in patterns.values()):
        raise ValueError("a pattern has one value at least, and no null")
    reach = max(map(len, patterns.values()))
    at = running(bucketed(pinned(df.withColumn("_o", F.col(order).cast("double"))), keys, "_o"), keys, "_o", _n=F.lit(1)).drop("_n_all")
    block, place = F.floor((F.col("_n") - 1) / BLOCK), (F.col("_n") - 1) % BLOCK
    near = F.array_compact(F.array(block, F.when((place < reach - 1) & (block > 0), block - 1), F.when(place >= BLOCK - (reach - 1), block + 1)))
    dealt = at.withColumns({"_home": block, "_block": F.explode(near)})
    own = Window.partitionBy(*keys, "_block").orderBy("_n")
    around = F.array(*(F.lag(value, -i).over(own) for i in range(1 - reach, reach)))

    def hit(name: str, pattern: list) -> Column:
        n, wanted = len(pattern), F.array(*(F.lit(p) for p in pattern))
        return F.when(F.exists(F.sequence(F.lit(reach - n + 1), F.lit(reach)), lambda i: F.slice("_around", i, F.lit(n)) == wanted), F.lit(name))

    found = dealt.withColumn("_around", around).where("_block = _home")
    return found.withColumn("_hits", F.array_compact(F.array(*(hit(n, p) for n, p in patterns.items())))).drop("_around", "_block", "_home", "_n")


def pattern_groups(df: DataFrame, keys: list[str], order: str, value: str, pattern: list, incomplete: bool = False) -> DataFrame:
    """df with group, the number of the match of `pattern` in the key's values, in order; 0 outside of any.

    Rows that some match covers (matches may overlap) are numbered in order and cut into groups of the pattern's length. A last group that
    overlaps leave short is 0 too, or keeps its number (incomplete). `order` is a number that tells a key's rows apart; adjacent means next in this order, whatever lies
    between. A null value matches nothing.
    """
    found = _covered(df, keys, order, value, {"p": pattern}).withColumn("_hit", F.size("_hits").cast("long"))
    counted = running(found, keys, "_o", _c=F.col("_hit"))
    n, group = len(pattern), F.ceil(F.col("_c") / len(pattern))
    whole = F.lit(True) if incomplete else group * n <= F.col("_c_all")
    return counted.withColumn("group", F.when((F.col("_hit") == 1) & whole, group).otherwise(0).cast("long")).select(*df.columns, "group")


def pattern_matches(df: DataFrame, keys: list[str], order: str, value: str, patterns: dict[str, list]) -> DataFrame:
    """The rows of whole matches of several patterns, found in one pass: df with pattern (its name) and group, numbered as in `pattern_groups`. A row in matches of two patterns comes twice."""
    found = _covered(df, keys, order, value, patterns).withColumn("pattern", F.explode("_hits")).drop("_hits")
    counted = running(found, [*keys, "pattern"], "_o", _c=F.lit(1))
    size = F.create_map(*(F.lit(x) for n, p in patterns.items() for x in (n, len(p))))[F.col("pattern")]
    return counted.withColumn("group", F.ceil(F.col("_c") / size)).where(F.col("group") * size <= F.col("_c_all")).select(*df.columns, "pattern", "group")
