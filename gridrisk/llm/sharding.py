"""Contiguous shards of nearly equal bytes (law `bytes`).

Documents are range-partitioned and sorted by (doc_id, checksum, size). Each
partition reports its total of bytes and rows; the prefix sums of those totals
(one row per partition) turn every partition's running sums into global ones.
A document goes to the shard that holds its middle byte when all bytes are cut
at equal targets, so shards are contiguous in that order and each differs from
the target by about one document at most.

Defined results: null ids come first; repeated rows are interchangeable and get
different slots, ties of id go by checksum and size; a null text has size 16 and the checksum of the empty text. A very long text goes whole into one shard,
which may then be larger than the target, and neighbours may be empty. Ids may be of any type that Spark sorts. An empty table gives an empty one. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridrisk.llm.textops import stored

EXTRA = 16


def byte_shards(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of docs."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body).cast("long") + EXTRA).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    narrow = stored(narrow, "shard-sizes")
    order = ["doc_id", "text_crc32", "size"]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()), "shard-ranges")
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # one row per partition: the only window over all of them
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(
        "part", F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    own = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("upto", F.sum("size").over(own)).withColumn("row", F.row_number().over(own)).join(prefix, "part")
    middle = F.expr("2 * (bytes_before + upto) - size")
    placed = placed.select(
        "doc_id", "size", "text_crc32", (F.col("rows_before") + F.col("row") - 1).alias("row"),
        F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / (F.col("all_bytes") * 2)).cast("int")).alias("shard"),
    )
    placed = stored(placed, "shard-places")
    starts = placed.groupBy("shard").agg(F.min("row").alias("start"))
    return placed.join(F.broadcast(starts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("start")).alias("slot"))  # a row per shard


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: all documents in 40 shards of nearly equal bytes."""
    got = byte_shards(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 40)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
