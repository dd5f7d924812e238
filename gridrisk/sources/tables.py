"""Sources and sinks: tables, lookups, point grids, layer catalogues, partitioned outputs, sidecars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None, skip_missing: bool = False) -> DataFrame:
    """One frame of all paths, columns filled with null where a file lacks them."""
    reader = spark.read.option("mergeSchema", "true").option("ignoreMissingFiles", str(skip_missing).lower())
    df = reader.parquet(*paths)
    return df.select(*columns) if columns else df


def read_lookup(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-8") -> DataFrame:
    """A CSV with a header and a given schema (national files: encoding ISO-8859-1)."""
    return spark.read.csv(path, schema=schema, header=True, encoding=encoding)


def read_points(spark: SparkSession, path: str, codes: DataFrame, tech: str, id_columns: tuple[str, ...] = ("x", "y")) -> DataFrame:
    """A wide point grid (x, y, one column a crop with a technology suffix) as x, y, crop, value; codes: code, name (a fixed list)."""
    wide = spark.read.csv(path, header=True, inferSchema=False)
    crops = [c for c in wide.columns if c.endswith(f"_{tech}")]
    long = wide.select(*(F.col(c).cast("double").alias(c) for c in [*id_columns, *crops])).unpivot(list(id_columns), crops, "code", "value")
    named = long.withColumn("code", F.regexp_replace("code", f"_{tech}$", "")).join(codes, "code", "left")
    return named.select(*id_columns, F.coalesce("name", "code").alias("crop"), "value")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def tagged(spark: SparkSession, paths: list[str], pattern: str, tag: str, fmt: str = "parquet") -> DataFrame:
    """All files with a column that the file name's first group gives (a country table for each file)."""
    return spark.read.format(fmt).load(paths).withColumn(tag, F.regexp_extract(F.input_file_name(), pattern, 1))


def catalogue(paths: DataFrame, path: str, fields: list[str], sep: str = "_") -> DataFrame:
    """Key columns from file names: base name without extension, split in order."""
    base = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]+$", "")
    parts = F.split(base, sep)
    return paths.select(path, *(F.get(parts, i).alias(f) for i, f in enumerate(fields)))


def require_complete(counts: DataFrame, column: str, allowed: tuple[int, ...] = (20, 240, 480)) -> DataFrame:
    """The counts, or an error that names some keys with another number of files."""
    bad = counts.where(~F.col(column).isin(*allowed)).limit(5).collect()
    if bad:
        raise ValueError(f"{column} not in {allowed}: {[r.asDict() for r in bad]}")
    return counts


def write_table(df: DataFrame, path: str, keys: list[str] | None = None, sort: list[str] | None = None, digits: int | None = None, mode: str = "overwrite") -> None:
    """Parquet, doubles rounded and rows sorted for size, split by key folders; mode 'ignore' leaves an existing output."""
    if digits is not None:
        df = df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})
    if sort:
        df = df.sortWithinPartitions(*sort)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def patch_partition(spark: SparkSession, path: str, key: str, value: str, columns: dict) -> None:
    """Rewrites one key folder of a table with changed columns; the other folders stay as they are."""
    from gridrisk.sources.keyed import patch_rows

    patch_rows(spark, path, key, value, columns)


def sidecar(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: the sorted distinct values of each key column (keys are dimensions: few values) and the row count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *(F.array_sort(F.collect_set(k)).alias(k) for k in keys))


def write_sidecar(df: DataFrame, keys: list[str], path: str, **provenance: str) -> None:
    sidecar(df, keys).withColumns({k: F.lit(v) for k, v in provenance.items()}).coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def where_keys(df: DataFrame, keys: dict[str, list | None], columns: list[str] | None = None) -> DataFrame:
    """Rows whose keys are among the values (None: null), and the columns asked for; filters and columns reach the scan of a local or remote table."""
    for name, values in keys.items():
        df = df.where(F.col(name).isNull() if values is None else F.col(name).isin(*values))
    return df.select(*columns) if columns else df
