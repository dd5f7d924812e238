"""Vectorised text helpers shared by the training-data operators.

Everything here works on one Arrow record batch inside a task. Texts are looked
at as one byte buffer with document offsets, so that a whole slice of documents
is tokenised and hashed by a few numpy passes instead of a loop over words.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one slice of a batch holds (a longer document is a slice by itself).
SLICE_BYTES = 1 << 20
U64 = np.uint64


# --------------------------------------------------------------------------- tables
def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir. Only a local session without it (tests) gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile

        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: With it, a written frame's shuffle files go when the write ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING = {"lock": threading.Lock(), "n": 0, "before": "false"}


@contextmanager
def _cleanup(spark: SparkSession) -> Iterator[None]:
    """The setting is on while any write of this process runs, so that writes side by side don't undo each other's."""
    with _WRITING["lock"]:
        if not _WRITING["n"]:
            _WRITING["before"] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _WRITING["n"] += 1
    try:
        yield
    finally:
        with _WRITING["lock"]:
            _WRITING["n"] -= 1
            if not _WRITING["n"]:
                spark.conf.set(_CLEANUP, _WRITING["before"])


def _folder(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, survives lost executors. The table goes with the application, or by `discard`. Needs the classic API, not Spark Connect."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-tables/{name}-{uuid.uuid4().hex}"
    with _cleanup(spark):
        df.write.options(**options).parquet(path)
    files, at = _folder(spark, path)
    files.deleteOnExit(at)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        files, at = _folder(df.sparkSession, df._stored_at)
        files.delete(at, True)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores after it as long as df has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# --------------------------------------------------------------------------- slices
def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about `limit` bytes of the text column at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        size = np.asarray(pc.fill_null(pc.binary_length(col), 0).cast(pa.int64()))
        total = np.cumsum(size)
        at, n = 0, batch.num_rows
        while at < n:
            base = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


#: Blanks, ASCII marks and control characters.
MARKS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def words(raw: np.ndarray, offs: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the words [^\\x20\\x09-\\x0D]+ (or what lies between other bytes); words first[d]:first[d+1] are those of document d."""
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    ink = ~between[raw]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offs] = True
    left = ink.copy()
    left[1:] &= ~ink[:-1] | cut[1:n]
    right = ink.copy()
    right[:-1] &= ~ink[1:] | cut[1:n]
    starts, ends = np.flatnonzero(left), np.flatnonzero(right) + 1
    return starts, ends, np.searchsorted(starts, offs)


# --------------------------------------------------------------------------- hashing
def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public MurmurHash3 constants)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
_POW = {"n": 0, "p": np.zeros(0, U64), "q": np.zeros(0, U64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POW["n"] < n:
        size = max(n, SLICE_BYTES + 1)
        for key, base in (("p", _BASE), ("q", _INV)):
            x = np.full(size, base, dtype=U64)
            x[0] = 1
            _POW[key] = np.cumprod(x)
        _POW["n"] = size
    return _POW["p"], _POW["q"]


class Prints:
    """64-bit fingerprints of any byte range of a buffer, from prefix sums of a polynomial."""

    def __init__(self, raw: np.ndarray):
        p, self.q = _powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, dtype=U64)
        np.cumsum(_CODE[raw] * p[: len(raw)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.q[starts]
        return mix(h + (ends - starts).astype(U64) * U64(0xA24BAED4963EE407))

    def windows(self, k: int) -> np.ndarray:
        """Of every range [i, i+k)."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.q[:n]) if n > 0 else np.zeros(0, U64)


_STEP = mix(np.arange(101, 133, dtype=U64)) | U64(1)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the k-word windows; a document with 1 to k-1 words has one, its whole sequence."""
    n_docs, n = len(first) - 1, len(hashes)
    count = np.diff(first)
    out = np.zeros(max(0, n - k + 1), dtype=U64)
    for j in range(k):
        out += hashes[j : n - k + 1 + j] * _STEP[j] if n >= k else U64(0)
    doc = np.repeat(np.arange(n_docs), count)
    ok = np.zeros(0, bool) if n < k else doc[: n - k + 1] == doc[k - 1 :]
    got, whose = mix(out[ok]), doc[: max(0, n - k + 1)][ok]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.zeros(len(short), dtype=U64)
        for j in range(k - 1):
            has = count[short] > j
            extra[has] += hashes[first[short[has]] + j] * _STEP[j]
        extra = mix(extra + count[short].astype(U64) * U64(0x9FB21C651E98DF25))
        got, whose = np.concatenate([got, extra]), np.concatenate([whose, short])
        order = np.argsort(whose, kind="stable")
        got, whose = got[order], whose[order]
    return got, whose


def per_doc(values: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Sum of values by document."""
    return np.bincount(doc, weights=values, minlength=n_docs)


def passed(batch: pa.RecordBatch, **new: pa.Array | np.ndarray) -> pa.RecordBatch:
    """The batch's columns with those given added or replaced."""
    cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    cols |= {k: v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v) for k, v in new.items()}
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def crc_mod(column: str, m: int):
    """crc32 of the id as text, modulo m (a null id counts as the empty text)."""
    from pyspark.sql import functions as F

    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % m
