"""Language ID by hyperdimensional profiles.

Every letter owns a random bipolar vector. A letter trigram is the product
(binding) of its three letter vectors, rolled by two, one and no places, so that
order matters; a document is the sum (bundle) of its trigram vectors, and a
language prototype is the sum of the unit vectors of its training documents,
in fixed point so that the sum doesn't depend on the order of rows. A document
gets the language of the prototype with the largest cosine. Prototypes are a stored table of a row for each language; up to
AT_ONCE of them go to the tasks at a time, more in several passes that carry the best so far.

Defined results: null text, empty text or a text without a letter gives `und` and score 0;
so does everything when there is no training row. Equal cosines: the
alphabetically first language. Ids may be null or repeat, each row is judged by
its text alone, very long ones by the whole of it. An empty table gives an empty one. Input columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridrisk.llm.textops import U64, column_bytes, crc_mod, mix, passed, slices, stored

DIMS = 1024
#: Prototypes that a task holds (AT_ONCE x DIMS numbers).
AT_ONCE = 2000
_FIXED = 1 << 20
_CELLS = 3_000_000


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], dtype=bool)


@lru_cache(maxsize=8192)
def _letter_vector(code: int, dims: int) -> np.ndarray:
    bits = mix(np.arange(dims, dtype=U64) + U64((code + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return np.where(bits & U64(1), 1, -1).astype(np.float32)


def _trigrams(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, trigram number, letters of each trigram number) of a text column."""
    lowered = pc.utf8_lower(pc.fill_null(col, ""))
    raw, _ = column_bytes(lowered)
    codes = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    sizes = np.asarray(pc.utf8_length(lowered)).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    table = _letter_table()
    letter = table[codes]
    codes = np.where(letter, codes, 0)
    if len(codes) < 1:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros((0, 3), np.int64)
    # a blank before and after each document, so that one letter makes a trigram too
    before, after = np.zeros_like(codes), np.zeros_like(codes)
    before[1:] = np.where(doc[1:] == doc[:-1], codes[:-1], 0)
    after[:-1] = np.where(doc[1:] == doc[:-1], codes[1:], 0)
    keep = np.flatnonzero(letter)
    alphabet = np.flatnonzero(np.bincount(codes, minlength=1))
    if not len(alphabet) or alphabet[0] != 0:
        alphabet = np.concatenate([[0], alphabet])
    rank = np.zeros(int(codes.max()) + 1, np.int64)
    rank[alphabet] = np.arange(len(alphabet))
    a = len(alphabet)
    key = (rank[before[keep]] * a + rank[codes[keep]]) * a + rank[after[keep]]
    if a**3 <= 4_000_000:
        there = np.flatnonzero(np.bincount(key, minlength=1))
        number = np.zeros(a**3, np.int64)
        number[there] = np.arange(len(there))
        at = number[key]
    else:
        there, at = np.unique(key, return_inverse=True)
    return doc[keep], at, np.stack([alphabet[there // (a * a)], alphabet[there // a % a], alphabet[there % a]], axis=1)


def _vectors(letters: np.ndarray, dims: int) -> np.ndarray:
    codes, at = np.unique(letters, return_inverse=True)
    at = at.reshape(letters.shape)
    own = np.stack([_letter_vector(int(c), dims) for c in codes])
    return np.roll(own, 2, axis=1)[at[:, 0]] * np.roll(own, 1, axis=1)[at[:, 1]] * own[at[:, 2]]


def profiles(col: pa.Array, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """(unit profile of each text, whether it has a letter)."""
    n = len(col)
    out = np.zeros((n, dims), np.float32)
    doc, at, letters = _trigrams(col)
    if len(doc):
        step = max(1, _CELLS // max(n, dims))
        for lo in range(0, len(letters), step):  # blocks of trigrams bound the memory
            hi = min(len(letters), lo + step)
            own = slice(None) if (lo, hi) == (0, len(letters)) else (at >= lo) & (at < hi)
            counts = np.bincount(doc[own] * (hi - lo) + at[own] - lo, minlength=n * (hi - lo)).reshape(n, hi - lo)
            out += counts.astype(np.float32) @ _vectors(letters[lo:hi], dims)
    norm = np.sqrt(np.einsum("ij,ij->i", out, out, dtype=np.float64))
    has = np.bincount(doc, minlength=n) > 0
    return out / np.maximum(norm, 1e-9)[:, None].astype(np.float32), has


def learn(docs: DataFrame, text: str = "text", label: str = "lang", dims: int = DIMS) -> DataFrame:
    """(lang, v): the prototype of each language, from all rows with a label and a letter."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in slices(batches, "_text"):
            vec, has = profiles(b.column(b.schema.get_field_index("_text")), dims)
            whole = np.rint(vec * _FIXED).astype(np.int64)
            names = np.array(b.column(b.schema.get_field_index("_label")).to_pylist(), dtype=object)
            for name in set(names[has]):
                got = whole[has & (names == name)].sum(axis=0)
                total[name] = total[name] + got if name in total else got
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], names=["_label", "v"])

    part = docs.select(F.col(text).alias("_text"), F.col(label).cast("string").alias("_label")).where("_label is not null and _text is not null")
    rows = part.mapInArrow(sums, "_label string, v array<bigint>").select("_label", F.posexplode("v").alias("i", "x")).groupBy("_label", "i").agg(F.sum("x").alias("x"))
    return stored(rows.groupBy(F.col("_label").alias("lang")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda r: r["x"]).alias("v")), "prototypes")


def _blocks(prototypes: DataFrame, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(languages, unit prototypes), at_once at most, in order."""
    last = None
    while True:
        left = prototypes if last is None else prototypes.where(F.col("lang") > last)
        rows = left.orderBy("lang").limit(at_once).collect()
        if not rows:
            return
        matrix = np.array([r["v"] for r in rows], np.float64)
        last = rows[-1]["lang"]
        yield np.array([r["lang"] for r in rows], dtype=object), (matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        if len(rows) < at_once:
            return


def identify(docs: DataFrame, prototypes: DataFrame, text: str = "text", dims: int = DIMS, at_once: int = AT_ONCE) -> DataFrame:
    """docs with lang_pred and score (the cosine, at least 0)."""
    base = docs.drop("lang_pred", "score")
    fields = T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    none = (np.array([], dtype=object), np.zeros((0, dims), np.float32))
    out = None
    for names, matrix in list(_blocks(prototypes, at_once)) or [none]:

        def score(batches: Iterator[pa.RecordBatch], names: np.ndarray = names, matrix: np.ndarray = matrix, first: bool = out is None) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, text):
                vec, has = profiles(b.column(b.schema.get_field_index(text)), dims)
                pred, top = np.full(len(has), "und", dtype=object), np.where(has, -2.0, 0.0)
                if not first:
                    pred = np.array(b.column(b.schema.get_field_index("lang_pred")).to_pylist(), dtype=object)
                    top = np.asarray(b.column(b.schema.get_field_index("score")))
                if len(names):
                    cos = np.round((vec @ matrix.T).astype(np.float64), 6)
                    better = has & (cos.max(axis=1) > top)  # languages come in order, so an equal later one isn't
                    pred, top = np.where(better, names[cos.argmax(axis=1)], pred), np.where(better, cos.max(axis=1), top)
                yield passed(b, lang_pred=pa.array(pred.tolist(), pa.string()), score=pa.array(top, pa.float64()))

        out = (base if out is None else out).mapInArrow(score, fields)
    return out.withColumn("score", F.greatest("score", F.lit(0.0)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: every document's language, learned from rows whose crc32 remainder by 3 isn't 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", crc_mod("doc_id", 3) == 1)
    prototypes = learn(docs.where("not held_out"))
    return identify(docs.select("doc_id", "held_out", "text"), prototypes).select("doc_id", "held_out", "lang_pred", "score")
