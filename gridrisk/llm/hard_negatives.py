"""Hard negatives of anchors, by a secondary-sort shuffle.

Every anchor is scored against every row. A pair's score is packed into one key (anchor, descending score, same label first,
id) whose bytes sort in that order; `repartitionAndSortWithinPartitions` deals keys by anchor and sorts them, and
an iterator reads each partition once: a row of the anchor's label opens a window, a row of another label goes to every open
window that it fits and that isn't full. An anchor's state is its windows, never its rows.

Scores are made in blocks: at most ANCHOR_BYTES of anchors go to all tasks at once (further anchors in further passes), each task holds them against
its rows, ROWS at a time. Before the shuffle each task keeps what can still count, which is exact: the first rows of the anchor's label (from
which the shuffle gives the anchor's positives), then, with the positives known, the first rows of other labels in each
positive's window. A task sends a few rows for each anchor, however many it has, so a label or a vector that very many rows share doesn't grow a task.

Defined results: rows with a null id, a null label, a null vector or a null or non-finite component take no part. Vectors of unequal length are
compared as if the shorter one had zeros. Rows with the anchor's own id (repeats of it) are never its positives or negatives; each repeat
of an anchor is an anchor by itself, and repeats of other rows count one by one. Ties go by smaller id; equal ids stay beside each other. A label is compared as text. An anchor without
positives, or a positive without negatives, has no rows. An empty table gives an empty one. Other columns, whatever their names, aren't read.
Scores beyond 60 bits are an error. Needs the classic API (RDD), not Spark Connect.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridrisk.llm.textops import discard, stored
from gridrisk.llm.vectors import matrix, numbers, products, scaled, usable, width_of

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 5, 80, 100
#: Bytes of anchor vectors in one pass; rows and anchors that are scored at once; candidates that a task holds before it drops what can't count.
ANCHOR_BYTES, ROWS, ANCHORS, HELD = 1 << 25, 4096, 1024, 1 << 20
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_SIGN = 1 << 63
_KEY = np.dtype([("anchor", ">u8"), ("nth", ">u4"), ("score", ">u8"), ("other", "u1"), ("id", ">u8")])
_UNPACK = struct.Struct(">QIQBQ")


# --------------------------------------------------------------------------- keys
def _unsigned(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)


def packed(anchor: np.ndarray, nth: np.ndarray, score: np.ndarray, other: int, ids: np.ndarray) -> pa.Array:
    """Keys whose bytes sort by (anchor, its number, descending score, rows of its label first, id)."""
    keys = np.empty(len(anchor), _KEY)
    keys["anchor"], keys["nth"], keys["score"], keys["other"], keys["id"] = _unsigned(anchor), nth, _unsigned(-score), other, _unsigned(ids)
    ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * _KEY.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, ends.buffers()[1], pa.py_buffer(keys.tobytes())])


def unpacked(key: bytes) -> tuple[int, int, int, int, int]:
    anchor, nth, score, other, ids = _UNPACK.unpack(key)
    return anchor - _SIGN, nth, _SIGN - score, other, ids - _SIGN


def sorted_keys(keys: DataFrame):
    """The secondary sort: an RDD of (key, None), all keys of an anchor in one partition, in order."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(n, lambda k: zlib.crc32(k[:12]))


def first_of(keys: Iterator[tuple[bytes, None]], count: int) -> Iterator[tuple[bytes]]:
    """The first keys of each anchor."""
    last, n = b"", 0
    for key, _ in keys:
        last, n = key[:12], n + 1 if key[:12] == last else 1
        if n <= count:
            yield (key,)


def emitted(keys: Iterator[tuple[bytes, None]], positives: int, negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Rows of SCHEMA from sorted keys: windows open at rows of the anchor's label and close when they are full or passed."""
    last, windows, opened = b"", [], 0
    for key, _ in keys:
        anchor, _, score, other, row = unpacked(key)
        if key[:12] != last:
            last, windows, opened = key[:12], [], 0
        if not other:
            if opened < positives:
                opened += 1
                windows.append([row, score, 0])
            continue
        for w in windows:
            if low * w[1] <= 100 * score <= high * w[1]:
                w[2] += 1
                yield anchor, w[0], w[2], row, w[1], score
        windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]


# --------------------------------------------------------------------------- what can count
class Anchors:
    """The anchors of one pass: ids, labels as codes, vectors; after the first shuffle the scores of their positives too."""

    def __init__(self, ids: np.ndarray, labels: list[str], vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.names, self.codes = np.unique(np.array(labels, object).astype(str), return_inverse=True)
        self.bounds: list[list[int]] | None = None

    def code(self, labels: pa.Array) -> np.ndarray:
        """Numbers of labels, -1 for those of no anchor."""
        got = np.array(labels.to_pylist(), object).astype(str)
        at = np.minimum(np.searchsorted(self.names, got), len(self.names) - 1)
        return np.where(self.names[at] == got, at, -1)


def _sorted(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(anchor, score, id) in the order of the keys."""
    anchor, score, ids = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.lexsort((ids, -score, anchor))
    return anchor[order], score[order], ids[order]


def leading(found: list[tuple[np.ndarray, ...]], count: int) -> tuple[np.ndarray, ...]:
    """The first rows of each anchor."""
    anchor, score, ids = _sorted(found)
    nth = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
    return anchor[nth < count], score[nth < count], ids[nth < count]


def in_windows(found: list[tuple[np.ndarray, ...]], window: tuple[np.ndarray, np.ndarray], count: int, low: int, high: int) -> tuple[np.ndarray, ...]:
    """The first rows of each anchor's windows; window: (anchor, positive score)."""
    anchor, score, ids = _sorted(found)
    n, m = len(anchor), len(window[0])
    top = high * window[1] // 100  # the largest whole score inside of a window
    order = np.lexsort((np.concatenate([np.ones(n), np.zeros(m)]), -np.concatenate([score, top]), np.concatenate([anchor, window[0]])))
    begins = np.empty(m, np.int64)
    begins[order[order >= n] - n] = np.cumsum(order < n)[order >= n]  # rows before a window's top
    keep = np.zeros(n, bool)
    for k in range(count):
        at = begins + k
        ok = at < n
        at = at[ok]
        keep[at[(anchor[at] == window[0][ok]) & (100 * score[at] >= low * window[1][ok])]] = True
    return anchor[keep], score[keep], ids[keep]


def scores(rows: DataFrame, anchors: Anchors, width: int, scale: int, count: int, low: int, high: int) -> DataFrame:
    """Packed keys (column key) of the pairs that can count, by task: of the anchors' label before their positives are known, else of other labels."""
    bounds = anchors.bounds
    if bounds is not None:
        window = np.repeat(np.arange(len(bounds)), [len(b) for b in bounds]), np.array([x for b in bounds for x in b], np.int64)
        least = np.array([min((-(-low * x // 100) for x in b), default=1) for b in bounds], np.int64)
        most = np.array([max((high * x // 100 for x in b), default=0) for b in bounds], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pruned(found: list) -> list:
            return [leading(found, count) if bounds is None else in_windows(found, window, count, low, high)]

        held, n, worst = [], 0, np.full(len(anchors.ids), -_SIGN, np.int64)
        for b in (batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS)):
            ids, code, x = np.asarray(b.column(0)), anchors.code(b.column(1)), scaled(matrix(b.column(2), width), scale)
            for at in range(0, len(anchors.ids), ANCHORS):
                own = slice(at, at + ANCHORS)
                s = products(anchors.vectors[own], x)
                same = anchors.codes[own][:, None] == code[None, :]
                fits = same & (s >= worst[own][:, None]) if bounds is None else ~same & (s >= least[own][:, None]) & (s <= most[own][:, None])
                fits &= anchors.ids[own][:, None] != ids[None, :]
                a, r = np.nonzero(fits)
                if len(a):
                    held.append((a + at, s[a, r], ids[r]))
                    n += len(a)
                if n > HELD:
                    held = pruned(held)
                    n = len(held[0][0])
                    if bounds is None:  # who has enough rows takes no worse ones
                        full = np.flatnonzero(np.bincount(held[0][0], minlength=len(worst)) >= count)
                        last = np.searchsorted(held[0][0], full, side="right") - 1
                        worst[full] = held[0][1][last]
        if held:
            a, s, ids = pruned(held)[0]
            for at in range(0, len(a), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([packed(anchors.ids[a[part]], a[part], s[part], int(bounds is not None), ids[part])], names=["key"])

    return rows.mapInArrow(run, "key binary")


# --------------------------------------------------------------------------- operator
def hard_negatives(
    df: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels whose score is low to high percent of the positive's (high: 100 at most)."""
    if not 0 <= low <= high <= 100:
        raise ValueError("low and high must lie between 0 and 100")
    spark = df.sparkSession
    kept = df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(vector))
    rows = [F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), numbers(df, vector).alias("vector")]
    width = width_of(kept, vector)
    chosen = stored(kept.where(is_anchor).select(*rows).withColumn("nth", F.monotonically_increasing_id()), "anchors")
    total, most = chosen.count(), max(1, ANCHOR_BYTES // (8 * max(1, width)))
    if not total:
        discard(chosen)
        return spark.createDataFrame([], SCHEMA)
    passes = -(-total // most)
    while passes > 1 and chosen.groupBy(F.pmod(F.xxhash64("nth"), F.lit(passes))).count().agg(F.max("count")).first()[0] > most:
        passes += 1 + passes // 8
    done = []
    for i in range(passes):
        # at most ANCHOR_BYTES of vectors
        own = chosen.where(F.pmod(F.xxhash64("nth"), F.lit(passes)) == i).orderBy("id", "nth").toArrow().combine_chunks()
        if not own.num_rows:
            continue
        anchors = Anchors(np.asarray(own["id"]), own["label"].to_pylist(), scaled(matrix(own["vector"].combine_chunks(), width), scale))
        same = scores(kept.select(*rows), anchors, width, scale, positives, low, high)
        best = stored(spark.createDataFrame(sorted_keys(same).mapPartitions(lambda k: first_of(k, positives)), "key binary", verifySchema=False), "positives")
        anchors.bounds = [[] for _ in anchors.ids]
        for r in best.collect():  # `positives` rows an anchor of the pass
            _, nth, score, _, _ = unpacked(bytes(r[0]))
            anchors.bounds[nth].append(score)
        others = scores(kept.select(*rows), anchors, width, scale, negatives, low, high)
        found = sorted_keys(best.unionByName(others)).mapPartitions(lambda k: emitted(k, positives, negatives, low, high))
        done.append(stored(spark.createDataFrame(found, SCHEMA, verifySchema=False), "hard-negatives"))
        discard(best)
    discard(chosen)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: hard negatives of every hundredth vector, with every seventh label moved on by one."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    df = df.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(df, F.col("vec_id") % 100 == 0)


SQL = """
WITH k AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM k AS a JOIN k AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) <= 5
"""
