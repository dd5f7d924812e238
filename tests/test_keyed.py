"""Outputs by key: second runs, listings of real files, gates, sidecars and patches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from gridrisk.sources import keyed, tables


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


DATA = [("dry+heat", "Severe", "a/b", 1.0), ("dry+heat", "Severe", "a/b", 2.0), ("wet", "Severe", "x y", 3.0), ("wet", None, "100%", 4.0)]
KEYS = ["hazard", "severity", "scenario"]


def test_a_second_run_makes_only_what_is_missing(spark, tmp_path):
    df, path, calls = spark.createDataFrame(DATA, "hazard string, severity string, scenario string, value double"), str(tmp_path / "out"), []

    def build(todo):
        calls.append(rows(todo, *KEYS))
        return keyed.rows_of(df, todo, KEYS)

    assert keyed.existing_keys(spark, path, KEYS).isEmpty()
    assert keyed.write_missing(df.where("hazard = 'wet'"), build, path, KEYS) == 2
    assert rows(keyed.existing_keys(spark, path, KEYS), *KEYS) == rows(df.where("hazard = 'wet'").distinct(), *KEYS)
    before = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert keyed.write_missing(df, build, path, KEYS) == 1 and calls[1] == [("dry+heat", "Severe", "a/b")]
    assert keyed.write_missing(df, build, path, KEYS) == 0 and len(calls) == 2  # nothing was even planned
    after = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert {f: after[f] for f in before} == before and len(after) == 3
    assert rows(spark.read.parquet(path), *KEYS, "value") == sorted(DATA, key=str)
    assert keyed.write_missing(df.where("hazard = 'wet'"), build, path, KEYS, overwrite=True) == 2
    assert rows(spark.read.parquet(path), *KEYS, "value") == sorted(DATA, key=str)


def test_a_partitioned_source_is_read_for_missing_keys_only(spark, tmp_path):
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    spark.range(60).select((F.col("id") % 3).cast("string").alias("k"), "id").write.partitionBy("k").parquet(source)
    read = spark.read.schema("id long, k string").parquet(source)
    wanted = spark.createDataFrame([("0",), ("1",), ("2",)], "k string")
    keyed.write_missing(wanted.where("k < '2'"), lambda todo: keyed.rows_of(read, todo, ["k"]), out, ["k"])
    for k in "01":  # what exists isn't opened any more: its source may be gone
        for d, _, fs in os.walk(os.path.join(source, f"k={k}")):
            for f in fs:
                os.remove(os.path.join(d, f))
    assert keyed.write_missing(wanted, lambda todo: keyed.rows_of(read, todo, ["k"]), out, ["k"]) == 1
    assert spark.read.parquet(out).count() == 60


def test_catalogue_of_files_and_its_gate(spark, tmp_path):
    for s in ("ssp1", "ssp2"):
        for v in ("tmax", "prec"):
            os.makedirs(tmp_path / s / v)
            for m in range(20):
                (tmp_path / s / v / f"{s}_{v}_{2000 + m}.tif").write_bytes(b"x" * (m + 1))
    (tmp_path / "ssp1" / "notes.txt").write_text("no")
    found = keyed.file_catalogue(spark, str(tmp_path), ["scenario", "variable", "year"], "*.tif")
    assert found.count() == 80 and found.agg(F.sum("length")).first()[0] == 4 * 210 and keyed.file_catalogue(spark, str(tmp_path / "none"), ["a"]).isEmpty()
    wide = keyed.complete_series(found, ["scenario"], by="variable", of=["prec", "tmax"])
    assert rows(wide, "scenario", "prec", "tmax") == [("ssp1", 20, 20), ("ssp2", 20, 20)]
    (tmp_path / "ssp2" / "prec" / "ssp2_prec_2003.tif").unlink()
    found = keyed.file_catalogue(spark, str(tmp_path), ["scenario", "variable", "year"], "*.tif")
    with pytest.raises(Exception, match="ssp2.*but 19"):
        keyed.complete_series(found, ["scenario"], by="variable", of=["prec", "tmax"]).collect()
    with pytest.raises(Exception, match="ssp2/prec"):
        keyed.complete_series(found, ["scenario", "variable"]).collect()
    with pytest.raises(Exception, match="but 0"):
        keyed.complete_series(found.where("scenario = 'ssp1'"), ["scenario"], by="variable", of=["prec", "wind"]).collect()


def test_sidecar_comes_with_the_write(spark, tmp_path):
    n = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    df = spark.range(500).selectExpr("id", "concat('h', id % 3) AS hazard", "cast(id % 7 AS int) AS model").mapInArrow(counted, "id long, hazard string, model int")
    path = str(tmp_path / "out")
    meta = keyed.write_described(df, path, ["hazard", "model", "id"], ["hazard"], listed=50, source="test").first()
    assert n.value == 500  # one pass
    assert meta["n_rows"] == 500 and meta["hazard"] == ["h0", "h1", "h2"] and meta["model"] == list(range(7)) and meta["id"] is None and meta["source"] == "test"
    assert (meta["id_least"], meta["id_most"]) == ("0", "499") and abs(meta["id_kinds"] - 500) < 60 and spark.read.parquet(path).count() == 500
    text = [line for f in os.listdir(f"{path}.meta") if f.endswith(".json") for line in open(f"{path}.meta/{f}")]
    assert len(text) == 1 and json.loads(text[0])["model_kinds"] == 7
    empty = keyed.write_described(df.limit(0), str(tmp_path / "none"), ["hazard"]).first()
    assert empty["n_rows"] == 0 and empty["hazard"] == [] and empty["hazard_least"] is None


def test_patch_keeps_other_folders_and_refuses_the_key(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("A", 1), ("B", 2)], "k string, v int").write.partitionBy("k").parquet(path)
    tables.patch_partition(spark, path, "k", "A", {"v": F.col("v") + 10})
    assert rows(spark.read.parquet(path), "k", "v") == [("A", 11), ("B", 2)]
    with pytest.raises(ValueError, match="key"):
        tables.patch_partition(spark, path, "k", "A", {"k": F.lit("B")})
    with pytest.raises(Exception, match="boom"):
        tables.patch_partition(spark, path, "k", "A", {"v": F.raise_error(F.lit("boom")).cast("int")})
    assert rows(spark.read.parquet(path), "k", "v") == [("A", 11), ("B", 2)]
