"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL-proximal.

Features of a text: its words and word pairs, and the same n-grams of word
shapes (first and last byte kind, all byte kinds in the word, whether the word
before is the same), hashed into 2**BITS places with value sqrt(count / all counts).
Features are made where the documents are. The follow-the-regularised-leader updates are sequential, so they
run in one task over a bounded sample of labelled rows: the MAX_TRAIN rows
with the smallest hash of the id, one text an id (that of the smallest hash). The weights (2**BITS at most) go to all tasks, which score sparse dot products.

Defined results: null, empty and blank texts have the bias and a "no words"
feature alone; very long texts are read whole; without training rows every score is 0.5; an empty table gives an empty one. Ids that carry several labels count with
the smallest; null labels and ids are left out. Repeated rows are scored alike. Columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridrisk.llm.textops import U64, Prints, column_bytes, crc_mod, lower_ascii, mix, passed, slices, words

BITS, MAX_TRAIN, EPOCHS = 18, 8000, 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.01
CUT = 0.7
_KIND = np.full(256, 1 << 5, np.uint16)  # other marks
for _lo, _hi, _bit in ((97, 123, 0), (65, 91, 1), (48, 58, 2), (128, 256, 3)):
    _KIND[_lo:_hi] = 1 << _bit
_KIND[[ord(c) for c in ".,;:'-"]] = 1 << 4
for _n, _c in enumerate("#*$%&|<>!"):
    _KIND[ord(_c)] = 1 << (6 + _n)


def features(col: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, places, values): the sparse features of each text; place 0 is the bias."""
    raw, offs = column_bytes(col)
    starts, ends, first = words(raw, offs)
    n_docs, n = len(offs) - 1, len(starts)
    mask = U64((1 << bits) - 1)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    empty = np.flatnonzero(np.diff(first) == 0)
    places, whose = [np.ones(len(empty), np.int64)], [empty]
    if n:
        word = Prints(lower_ascii(raw)).of(starts, ends)
        kind = _KIND[raw]
        every = np.bitwise_or.reduceat(kind, np.stack([starts, ends], axis=1).ravel()[: -1 if ends[-1] == len(raw) else None])[::2].astype(U64)
        shape = (every << U64(32)) | (kind[starts].astype(U64) << U64(16)) | kind[ends - 1].astype(U64)
        follows = np.zeros(n, bool)
        follows[1:] = doc[1:] == doc[:-1]
        again = np.zeros(n, U64)
        again[1:] = (follows[1:] & (word[1:] == word[:-1])).astype(U64)
        shape = mix(shape | again << U64(60))
        for salt, h in ((1, word), (2, shape)):
            pair = mix(h[1:] * U64(3) + h[:-1] + U64(salt))[follows[1:]]
            places += [(mix(h + U64(salt)) & mask).astype(np.int64), (pair & mask).astype(np.int64)]
            whose += [doc, doc[1:][follows[1:]]]
    key = np.concatenate(whose) * (1 << bits) + np.maximum(np.concatenate(places), 1)
    key, count = np.unique(key, return_counts=True)
    d = key >> bits
    total = np.bincount(d, weights=count, minlength=n_docs)
    # the bias comes first in each document
    rows = np.concatenate([np.arange(n_docs), d])
    at = np.concatenate([np.zeros(n_docs, np.int64), key & ((1 << bits) - 1)])
    val = np.concatenate([np.ones(n_docs), np.sqrt(count / total[d])])
    order = np.argsort(rows, kind="stable")
    return np.searchsorted(rows[order], np.arange(n_docs + 1)), at[order], val[order].astype(np.float32)


def _leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after the per-coordinate FTRL-proximal updates over (places, values, label)."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    for _ in range(epochs):
        for at, x, y in rows:
            w = _leader(z[at], n[at])
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return _leader(z, n)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_train: int = MAX_TRAIN, bits: int = BITS) -> np.ndarray:
    """The weights, learned from the texts of docs whose ids are among the sampled labels."""
    chosen = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).cast("int").alias("_label")).withColumn("_order", F.xxhash64("_id")).orderBy("_order", "_id").limit(max_train)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")  # max_train rows at most
    known = rows.groupBy("_order", "_id", "_label").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            cut, at, val = features(b.column(b.schema.get_field_index("_text")), bits)
            lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x)) for x in (at.astype(np.int32), val)]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in ("_order", "_id", "_label")), *lists], names=["_order", "_id", "_label", "at", "val"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            at, val = b.column(3), b.column(4)
            rows += [(np.asarray(at[i].values).astype(np.int64), np.asarray(val[i].values), y) for i, y in enumerate(b.column(2).to_pylist())]
        w = follow_the_leader(rows, bits)
        hit = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(w[hit])], names=["at", "w"])

    sparse = known.mapInArrow(extract, "_order bigint, _id bigint, _label int, at array<int>, val array<float>")
    got = sparse.repartition(1).sortWithinPartitions("_order", "_id").mapInArrow(fit, "at int, w double").toPandas()
    weights = np.zeros(1 << bits, np.float32)
    weights[got["at"].to_numpy()] = got["w"].to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", cut: float = CUT, bits: int = BITS) -> DataFrame:
    """docs with score and predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            first, at, val = features(b.column(b.schema.get_field_index(text)), bits)
            total = np.add.reduceat(weights[at] * val, first[:-1])
            p = 1 / (1 + np.exp(-np.clip(total.astype(np.float64), -35, 35)))
            yield passed(b, score=p, predicted=(p >= cut).astype(np.int32))

    base = docs.drop("score", "predicted")
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the quality score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_mod("doc_id", 4) != 2)
    weights = train(docs, labels)
    return score(docs.withColumn("held_out", crc_mod("doc_id", 4) == 2), weights).select("doc_id", "held_out", "score", "predicted")
