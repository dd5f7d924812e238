"""Product codes of vectors: exact Lloyd rounds that mostly skip distances, by norm-of-sum bounds.

A vector is cut into equal parts; each part position has a codebook of entries. A round gives every part to its nearest entry, then moves each
entry to the floored mean of its parts. Each part keeps its entry, an upper bound of the distance to it, a lower bound of the distance to all others, and for either
bound the round in which it was measured (its stamp). All codebooks so far are retained, so in round t a bound of round s
changes by the true net displacement |C_t[k] - C_s[k]| of an entry: the norm of the sum of its moves, which is never more, and for entries that move back and forth much less,
than the sum of the norms of its single moves. While upper bound < lower bound the nearest entry is certain. Else the upper bound
is measured anew, and if that doesn't settle it, all entries are, in exact integers; bounds are rounded outwards, so results are those of plain rounds, ties included.

Rows stay where they are: a round reads the stored state, writes the new one and, in the same pass, one row of sums a task. Spark adds those up; the
driver sees the codebooks and their sums only (parts x entries x width numbers), whatever the number of rows.

Defined results: rows with a null vector or a null or non-finite component are left out. Vectors shorter than the longest one, and a longest one that
can't be cut evenly, are filled up with zeros (an empty vector is all zeros). With fewer kept rows than entries a codebook has as many entries as rows. Starting
rows with equal ids go by their components; a null id is largest. Repeated rows are coded one by one, ties of distance go to the lower index. A null label is a
label of its own. An empty table gives an empty one. Columns named like the results are replaced, others are not carried. Components of any finite size are exact; errors beyond 64 bits raise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridrisk.llm.textops import discard, stored
from gridrisk.llm.vectors import matrix, numbers, scaled, usable, width_of

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows that are measured at once. Whole numbers below SMALL have distances of 63 bits; larger ones go as Python's integers.
ROWS, SMALL = 4096, float(1 << 28)
STATE = "id long, vector {}, label string, entry array<tinyint>, upper array<float>, upper_round array<tinyint>, lower array<float>, lower_round array<tinyint>, error decimal(38,0), totals array<decimal(38,0)>"
#: Relative slack for square roots and sums of doubles.
SLACK = 1e-9


def integers(x: np.ndarray) -> np.ndarray:
    """Whole doubles as exact integers, of 64 bits where distances fit."""
    if float(np.abs(x).max(initial=0)) < SMALL:
        return x.astype(np.int64)
    return np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows (n, width) and entries (k, width)."""
    if x.dtype != object and book.dtype == object and max((abs(int(v)) for v in book.ravel()), default=0) < SMALL:
        book = book.astype(np.int64)
    elif x.dtype == object or book.dtype == object:
        x, book = x.astype(object), book.astype(object)
    gap = x[:, None, :] - book[None, :, :]
    return (gap * gap).sum(axis=2)


class History:
    """The codebooks of all rounds so far (parts, entries, width), and how far each entry has moved since each round."""

    def __init__(self, books: list[np.ndarray]):
        self.now = len(books) - 1
        self.book = books[-1]
        self.net = np.array([self._moved(b, books[-1]) for b in books])  # round, part, entry
        k = self.net.shape[2]
        others = np.broadcast_to(self.net[:, :, None, :], (*self.net.shape, k)).copy()
        others[:, :, np.arange(k), np.arange(k)] = 0
        self.others = others.max(axis=3, initial=0)  # the farthest move of any other entry

    @staticmethod
    def _moved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        gap = (b - a).astype(object)
        return np.sqrt((gap * gap).sum(axis=2).astype(float)) * (1 + SLACK)

    def part(self, x: np.ndarray, j: int, entry: np.ndarray, upper: np.ndarray, upper_round: np.ndarray, lower: np.ndarray, lower_round: np.ndarray) -> tuple[int, int]:
        """Settle part j of rows x, in place; returns how many were measured against one entry, and against all."""
        far = lower.astype(float) - self.others[lower_round, j, entry]
        near = upper.astype(float) + self.net[upper_round, j, entry]
        open_ = np.flatnonzero(near * (1 + SLACK) >= far)
        if not len(open_):
            return 0, 0
        own = self._to_own(x[open_], j, entry[open_])
        upper[open_], upper_round[open_] = self._up(own), self.now
        left = open_[upper[open_].astype(float) * (1 + SLACK) >= far[open_]]
        if len(left):
            d = distances(x[left], self.book[j])
            entry[left] = np.argmin(d, axis=1) if d.dtype != object else [min(range(len(r)), key=r.__getitem__) for r in d.tolist()]
            at = np.arange(len(left))
            upper[left] = self._up(d[at, entry[left]])
            rest = d.astype(float)
            rest[at, entry[left]] = np.inf
            lower[left], lower_round[left] = np.nextafter((np.sqrt(rest.min(axis=1)) * (1 - SLACK)).astype(np.float32), np.float32(-np.inf)), self.now
        return len(open_), len(left)

    @staticmethod
    def _up(squared: np.ndarray) -> np.ndarray:
        return np.nextafter((np.sqrt(squared.astype(float)) * (1 + SLACK)).astype(np.float32), np.float32(np.inf))

    def _to_own(self, x: np.ndarray, j: int, entry: np.ndarray) -> np.ndarray:
        book = self.book[j]
        if x.dtype != object:
            small = max((abs(int(v)) for v in book.ravel()), default=0) < SMALL
            book, x = (book.astype(np.int64), x) if small else (book, x.astype(object))
        gap = x - book[entry]
        return (gap * gap).sum(axis=1)


def assign(batches: Iterator[pa.RecordBatch], history: History, width: int, scale: int, fresh: bool) -> Iterator[pa.RecordBatch]:
    """Rows of STATE with their entries in the newest codebooks, then one row with the sums and counts of each entry and the number of measured parts."""
    parts, entries, w = history.book.shape
    sums, counts, measured = np.zeros((parts, entries, w), object), np.zeros((parts, entries), object), [0, 0]
    names = [c.split(" ")[0] for c in STATE.split(", ")]
    rows, vectors = 0, None
    for b in (batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS)):
        n, vectors = b.num_rows, b.schema.field(1).type
        rows += n
        x = integers(scaled(matrix(b.column(1), width), scale))
        if fresh:
            state = np.zeros((n, parts), np.int8), np.full((n, parts), np.inf, np.float32), np.zeros((n, parts), np.int8), np.zeros((n, parts), np.float32), np.zeros((n, parts), np.int8)
        else:
            state = [np.array(b.column(3 + i).flatten()).reshape(n, parts) for i in range(5)]
        error = np.zeros(n, object)
        for j in range(parts):
            own, mine = x[:, j * w : (j + 1) * w], [np.ascontiguousarray(s[:, j]) for s in state]
            one, all_ = history.part(own, j, *mine)
            measured[0] += one
            measured[1] += all_
            for s, m in zip(state, mine, strict=True):
                s[:, j] = m
            entry = mine[0].astype(np.int64)
            counts[j] += np.bincount(entry, minlength=entries)
            exact = own.dtype != object and float(np.abs(own).max(initial=0)) * n < 1 << 53
            for p in range(w):
                if exact:
                    sums[j, :, p] += np.bincount(entry, weights=own[:, p], minlength=entries).astype(np.int64).astype(object)
                else:
                    np.add.at(sums[j, :, p], entry, own[:, p].astype(object))
            error += history._to_own(own, j, entry).astype(object)
        flat = [pa.array(s.ravel()) for s in state]
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * parts), f) for f in flat]
        kinds = pa.decimal128(38, 0)
        cols = [b.column(0), b.column(1), b.column(2), *lists, pa.array(error.tolist(), kinds), pa.nulls(n, pa.list_(kinds))]
        yield pa.RecordBatch.from_arrays(cols, names=names)
    if rows:
        kinds = [pa.int64(), vectors, pa.string(), pa.list_(pa.int8()), pa.list_(pa.float32()), pa.list_(pa.int8()), pa.list_(pa.float32()), pa.list_(pa.int8()), pa.decimal128(38, 0), pa.list_(pa.decimal128(38, 0))]
        total = [*sums.ravel().tolist(), *counts.ravel().tolist(), *measured]
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, k) for k in kinds[:-1]), pa.array([total], kinds[-1])], names=names)


def _totals(state: DataFrame) -> list[int]:
    """Sums of the tasks' totals, in order."""
    got = state.where("totals IS NOT NULL").select(F.posexplode("totals")).groupBy("pos").agg(F.sum("col").cast("string").alias("total"))
    return [int(r["total"]) for r in sorted(got.collect(), key=lambda r: r["pos"])]


def fitted(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray], list[tuple[int, int]]]:
    """The last state (a stored table of STATE), the codebooks of all rounds, and by round how many parts were measured against their own entry, and against all."""
    if not 0 < entries <= 127 or not 0 <= rounds <= 126 or parts < 1:
        raise ValueError("at most 127 entries and 126 rounds, one part at least")
    kept = df.where(usable(vector)).select(F.col(vec_id).cast("long").alias("id"), numbers(df, vector).alias("vector"), F.col(label).cast("string").alias("label"))
    w = max(1, -(-width_of(kept, "vector") // parts))
    schema = STATE.format(kept.schema["vector"].dataType.simpleString())
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = scaled(matrix(pa.array([r[0] for r in first], pa.list_(pa.float64())), parts * w), scale)
    books = [np.array([[[int(v) for v in row[j * w : (j + 1) * w]] for row in start] for j in range(parts)], object).reshape(parts, len(first), w)]
    state, work = None, []
    columns = ["cast(null AS array<tinyint>) AS entry", "cast(null AS array<float>) AS upper", "cast(null AS array<tinyint>) AS upper_round", "cast(null AS array<float>) AS lower", "cast(null AS array<tinyint>) AS lower_round"]
    source = kept.selectExpr("id", "vector", "label", *columns)
    for t in range(rounds + 1):
        history = History(books)
        fresh = stored(source.mapInArrow(lambda b, h=history, new=t == 0: assign(b, h, parts * w, scale, new), schema), "vector-codes")
        if state is not None:
            discard(state)
        state = fresh
        source = state.where("totals IS NULL").drop("error", "totals")
        total = _totals(state)
        if not total:
            break
        work.append((total[-2], total[-1]))
        if t < rounds:
            n = books[-1].size
            sums, counts = np.array(total[:n], object).reshape(books[-1].shape), np.array(total[n:-2], object).reshape(parts, -1)
            books.append(np.where((counts > 0)[:, :, None], sums // np.maximum(counts, 1)[:, :, None], books[-1]))
    return state, books, work


def codes(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and codebooks_sha256 of every kept row."""
    state, books, _ = fitted(df, vec_id, vector, label, parts, entries, rounds, scale)
    digest = hashlib.sha256(",".join(str(v) for v in books[-1].ravel().tolist()).encode()).hexdigest()
    hexes = F.array_join(F.transform("entry", lambda e: F.lower(F.lpad(F.hex(e.cast("long")), 2, "0"))), "")
    rows = state.where("totals IS NULL").select("id", "label", hexes.alias("code"), "error")
    # one row a label: joined by whichever way its size allows, a label that many rows share is split
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    kind = df.schema[vec_id].dataType
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).select(
        F.col("id").cast(kind).alias(vec_id), "code", F.col("error").cast("long").alias("error"), F.col("label_error").cast("long").alias("label_error"), F.lit(digest).alias("codebooks_sha256")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: codes of all vectors, from codebooks of 16 entries for each of 8 parts."""
    return codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The rounds written out: c{t} the codebooks, a{t} the nearest entries."""
    steps = [
        f"""k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT vec_id, label, j, v[j * (len(v) // {parts}) + 1 : (j + 1) * (len(v) // {parts})] AS p FROM k, range({parts}) AS r(j)
), c0 AS MATERIALIZED (
  SELECT j, (dense_rank() OVER (ORDER BY vec_id) - 1)::INTEGER AS e, p AS c FROM x WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries})
)"""
    ]
    for t in range(rounds + 1):
        steps.append(
            f"""a{t} AS MATERIALIZED (
  SELECT x.vec_id, x.label, x.j, x.p, c.e, list_sum(list_transform(list_zip(x.p, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM x JOIN c{t} AS c ON x.j = c.j QUALIFY row_number() OVER (PARTITION BY x.vec_id, x.j ORDER BY d, c.e) = 1
)"""
        )
        if t < rounds:
            steps.append(
                f"""m{t} AS (
  SELECT j, e, i, (CASE WHEN s < 0 THEN -((n - 1 - s) // n) ELSE s // n END)::BIGINT AS v
  FROM (SELECT j, e, i, sum(p[i])::BIGINT AS s, count(*) AS n FROM a{t}, generate_series(1, len(p)) AS g(i) GROUP BY j, e, i)
), c{t + 1} AS MATERIALIZED (
  SELECT c.j, c.e, coalesce(m.c, c.c) AS c FROM c{t} AS c LEFT JOIN (SELECT j, e, list(v ORDER BY i) AS c FROM m{t} GROUP BY j, e) AS m USING (j, e)
)"""
            )
    return (
        "WITH "
        + ", ".join(steps)
        + f""", r AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY j) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY j, e)) FROM c{rounds}) AS codebooks_sha256
FROM r
"""
    )


SQL = _sql()
