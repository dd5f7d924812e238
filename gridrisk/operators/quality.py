"""Guards: conditions that must hold before a result is used; and an audit that only counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _first(bad: DataFrame, what: str) -> None:
    rows = bad.limit(5).collect()
    if rows:
        raise ValueError(f"{what}: {[r.asDict() for r in rows]}")


def unique_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    _first(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "duplicate keys")
    return df


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> None:
    """Both sides have the same keys: what a positional pairing would silently shift."""
    more = a.select(*keys, F.lit(1).alias("_n")).unionByName(b.select(*keys, F.lit(-1).alias("_n"))).groupBy(*keys).agg(F.sum("_n").alias("more_on_the_left"))
    _first(more.where("more_on_the_left <> 0"), "keys on one side only")


def equal_models(df: DataFrame, keys: list[str], n: int, model: str = "model") -> DataFrame:
    _first(df.groupBy(*keys).agg(F.countDistinct(model).alias("models")).where(F.col("models") != n), f"not {n} models")
    return df


def not_negative(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        _first(df.where(F.col(c) < 0).select(c), f"negative {c}")
    return df


def no_collision(df: DataFrame, new: list[str]) -> DataFrame:
    clash = sorted(set(df.columns) & set(new))
    if clash:
        raise ValueError(f"columns exist already: {clash}")
    return df


def all_present(wanted: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    _first(wanted.join(found, keys, "left_anti"), "missing inputs")
    return found


def audit(df: DataFrame, by: list[str], keys: list[str], value: str, low: float) -> DataFrame:
    """by, n_rows, n_null (no value), n_low (value below low), n_duplicate (rows that follow another of the same by and keys; null is a key like others).

    Counted by whole key first: by has few groups, and a distinct count over them would hold every key once more.
    """
    count, v = F.count(F.lit(1)), F.col(value)
    each = df.groupBy(*by, *(k for k in keys if k not in by)).agg(count.alias("n"), F.count(v).alias("valued"), F.count(F.when(v < low, 1)).alias("low"))
    return each.groupBy(*by).agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - F.col("valued")).alias("n_null"), F.sum("low").alias("n_low"), F.sum(F.col("n") - 1).alias("n_duplicate"))
