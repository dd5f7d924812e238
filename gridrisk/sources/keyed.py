"""Outputs by key: what exists as a table, only the rest computed, and one pass that writes, counts and describes.

Folders key=value are listed as files, never opened. A key counts as there when its folder holds a file.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridrisk.sources.shared import pinned
from gridrisk.sources.tables import catalogue

#: Distinct values that a sidecar lists of a column; beyond it gives the least and largest one.
LISTED = 1000
#: Files of a complete monthly series (one, twenty and forty years).
COMPLETE = (20, 240, 480)


# --------------------------------------------------------------------------- what is there
def files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, length, modificationTime of the files under a folder, at any depth; their content isn't read. No folder: no rows."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        return reader.load(path).select("path", "length", "modificationTime")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")


def folder_key(path: str, key: str):
    """The value of a key folder in a path, as text; null for the folder of nulls."""
    raw = F.regexp_extract(path, f"/{re.escape(key)}=([^/]*)/", 1)
    return F.nullif(F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), F.lit("__HIVE_DEFAULT_PARTITION__"))


def existing_keys(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The keys (as text) whose folders hold a data file."""
    return files(spark, path, "*.parquet").select(*(folder_key("path", k).alias(k) for k in keys)).distinct()


def missing_keys(wanted: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Of the wanted keys those without an output (null equals null), decided before anything else is computed."""
    there = existing_keys(wanted.sparkSession, path, keys).select(*(F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).cast("string").eqNullSafe(F.col(f"_e{i}"))
    return wanted.select(*keys).distinct().join(there, on, "left_anti")


def file_catalogue(spark: SparkSession, path: str, fields: list[str], glob: str | None = None, sep: str = "_") -> DataFrame:
    """path, length and the fields of every file's name."""
    found = files(spark, path, glob)
    return catalogue(found, "path", fields, sep).join(found.select("path", "length"), "path")


def complete_series(found: DataFrame, keys: list[str], allowed: tuple[int, ...] = COMPLETE, by: str | None = None, of: list[str] | None = None) -> DataFrame:
    """Files by keys, one column a value of `by` (those given in `of`) if named: all counts must be allowed ones, else the job fails and names the key.

    The check is part of the plan: nothing is counted before the result is.
    """
    counts = found.groupBy(*keys).pivot(by, of).agg(F.count(F.lit(1))) if by else found.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"))
    names = [c for c in counts.columns if c not in keys]
    counts = counts.withColumns({n: F.coalesce(n, F.lit(0).cast("long")) for n in names})
    told = F.concat_ws("/", *(F.col(k).cast("string") for k in keys))
    checked = {n: F.when(F.col(n).isin(*allowed), F.col(n)).otherwise(F.raise_error(F.concat(F.lit(f"{n}: not {allowed} files of "), told, F.lit(", but "), F.col(n).cast("string"))).cast("long")) for n in names}
    return counts.withColumns(checked)


# --------------------------------------------------------------------------- writing
def rows_of(source: DataFrame, todo: DataFrame, keys: list[str]) -> DataFrame:
    """The source's rows of the keys in todo (null equals null); folders of other keys aren't opened.

    todo is a list of key folders to make, so its distinct values of a column go into the plan as a filter, up to LISTED of them.
    """
    for k in keys:
        values = [r[0] for r in todo.select(k).distinct().limit(LISTED + 1).collect()]
        if len(values) <= LISTED:
            hit = F.col(k).isin(*(v for v in values if v is not None))
            source = source.where(hit | F.col(k).isNull() if None in values else hit)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_t{i}"))
    return source.join(todo.select(*(F.col(k).alias(f"_t{i}") for i, k in enumerate(keys))), on, "left_semi")


def write_missing(wanted: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, keys: list[str], overwrite: bool = False, sort: list[str] | None = None) -> int:
    """Outputs of the wanted keys that aren't there yet, a folder each, in one write; returns how many keys were missing.

    build(todo) gives the rows of the keys in todo; `rows_of` reads a source with key folders for those only. If nothing is missing, build isn't called. overwrite: all
    wanted keys are made again. Folders of other keys stay as they are. A wanted key without rows has no folder, so it's tried again next time.
    """
    todo = pinned(wanted.select(*keys).distinct() if overwrite else missing_keys(wanted, path, keys))
    n = todo.count()
    if n:
        rows = build(todo).repartition(*keys)
        if sort:
            rows = rows.sortWithinPartitions(*keys, *sort)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    return n


def write_described(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None, mode: str = "overwrite", listed: int = LISTED, **provenance: str) -> DataFrame:
    """Writes df and, beside it (path with .meta), a one-row JSON that describes it, and returns that row.

    The row count and, of each key column, an estimate of its distinct values, the least and the largest come from the write itself (an observation), not from a second pass. The
    distinct values are listed for columns of at most `listed`, read from the written columns alone.
    """
    spark, seen = df.sparkSession, Observation()
    made = [F.count(F.lit(1)).alias("n_rows")]
    for k in keys:
        made += [F.approx_count_distinct(k).alias(f"{k}_kinds"), F.min(k).cast("string").alias(f"{k}_least"), F.max(k).cast("string").alias(f"{k}_most")]
    writer = df.observe(seen, *made).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    got = seen.get
    few = [k for k in keys if got[f"{k}_kinds"] <= listed]
    cols = [F.lit(got["n_rows"]).alias("n_rows"), *(F.lit(v).alias(k) for k, v in provenance.items())]
    for k in keys:
        cols += [F.lit(got[f"{k}_kinds"]).alias(f"{k}_kinds"), F.lit(got[f"{k}_least"]).alias(f"{k}_least"), F.lit(got[f"{k}_most"]).alias(f"{k}_most")]
    back = spark.read.parquet(path)
    sets = back.agg(*(F.array_sort(F.collect_set(k)).alias(k) for k in few)) if few else spark.range(1).select()  # `listed` values a column, about
    out = sets.select("*", *(F.lit(None).cast(f"array<{df.schema[k].dataType.simpleString()}>").alias(k) for k in keys if k not in few), *cols)
    out.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}.meta", ignoreNullFields=False)
    return spark.read.schema(out.schema).json(f"{path.rstrip('/')}.meta")


def patch_rows(spark: SparkSession, path: str, key: str, value: str, columns: dict) -> None:
    """One key folder with changed columns: written aside first, then put in its place, so that a failed job loses nothing. The key itself can't be changed."""
    if key in columns:
        raise ValueError(f"{key} is the folder's key: a change of it would overwrite another folder")
    rows = spark.read.parquet(path).where(F.col(key) == value).withColumns(columns)
    aside = f"{path.rstrip('/')}.patch"
    rows.write.mode("overwrite").partitionBy(key).parquet(aside)
    spark.read.schema(rows.schema).parquet(aside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
