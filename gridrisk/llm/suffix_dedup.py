"""Repeated substrings across documents: names of short windows, then two steps of growing length on what they leave open.

A byte goes if a string of LENGTH bytes that covers it also starts in a document
with a smaller id. Prefix doubling sorts positions by the pair (rank of the
first h bytes, rank of what follows them) and goes on with longer prefixes for positions
whose rank isn't unique yet, until unique or past the threshold. Here:

* Round 1 rules most positions out. Ranks of the first h = GRAM bytes are named by 64-bit fingerprints inside a task. Only minimizers
  enter: the least name in every LENGTH-byte window (equal windows have equal minimizers), about 1 position in
  16. A run of windows with the same minimizer is one row. Runs are sorted by (name, fingerprint of the whole run). A name within one
  document only is unique and drops out. If the whole run occurs in a smaller id, all of its windows are settled at once.
* The runs left are open: at the ends of repeats, or a short string that other documents have among other words. Each carries its own bytes.
* Round 2 goes half of the way on: a window holds its first minimizer and either the (LENGTH - GRAM) / 2 bytes before it or as many after it.
  Neighbouring windows with the same such stretch are one row; stretches of one document only drop out with their windows.
* Round 3: every window left is ranked by the pair (name of its first half, name of the half that starts LENGTH / 2 further on), which is
  the doubling step that ends at LENGTH. The smallest id of each pair is found by a grouping that combines before its shuffle, and joined
  back (round 2 does the same): only equal windows meet.
  (All rounds h = 20, 40, 50 with rank pairs joined by position need the tables of 40 positions a run, beyond the disk budget: figures in the README.)
* A name in very many documents (a common line) would put all its runs into one task of round 1. Such names are found on one document in
  SAMPLE, at most HOT_NAMES of them, and go another way: least and largest id by grouping, joined back. The result is the same by either way.

What goes is always decided by pairs of 64-bit fingerprints; single ones only tell what may drop out.

Defined results: null and empty texts have no bytes and lose none; very long texts are read whole; a row without id (or with one that isn't a number)
neither loses bytes nor takes them from others; rows with equal ids don't take
bytes from each other, and each repeated row is reported (rows of one id with different texts are
told apart by 16 bits of a text hash). An empty table gives an empty one. Columns named like the results are
replaced. Cuts can split a UTF-8 character: `kept` is binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridrisk.llm.textops import U64, Prints, column_bytes, discard, free_name, passed, slices, stored

LENGTH, GRAM = 50, 20
#: A name is hot with HOT_LEAST runs in the documents looked at; the HOT_NAMES commonest of them count.
SAMPLE, HOT_NAMES, HOT_LEAST = 64, 1 << 15, 64
#: Windows of a run at most; a longer one is several (its size takes 16 bits of a row). That is the most for LENGTH too.
MOST = 1 << 15
RESULTS = ("n_bytes", "n_removed", "n_spans", "kept")


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every window of the width, by doubling."""
    done = 1
    while done * 2 <= width:
        x = op(x[:-done], x[done:])
        done *= 2
    return op(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def runs(raw: np.ndarray, offs: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of windows with the same minimizer in a buffer of documents: doc, name, whole (the fingerprint), lo and size (bytes, from the document's start)."""
    n = len(raw)
    if n < length:
        return {k: np.zeros(0, U64 if k in ("name", "whole") else np.int64) for k in ("doc", "name", "whole", "lo", "size")}
    prints = Prints(raw)
    least = _sliding(prints.windows(gram), length - gram + 1, np.minimum)
    m = len(least)
    valid = np.ones(m, bool)  # windows inside of a document
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, np.maximum(offs[1:] - length + 1, offs[:-1]), 1)
    np.add.at(edge, offs[1:], -1)
    valid &= np.cumsum(edge)[:m] == 0
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    starts_doc = offs[:-1][offs[:-1] < m]
    first[starts_doc] = valid[starts_doc]
    last = valid.copy()
    last[:-1] &= ~valid[1:] | first[1:]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    long = hi - lo >= MOST
    if long.any():
        cuts = np.concatenate([np.arange(a, b + 1, MOST)[1:] for a, b in zip(lo[long], hi[long], strict=True)])
        lo, hi = np.sort(np.concatenate([lo, cuts])), np.sort(np.concatenate([hi, cuts - 1]))
    hi += length
    doc = np.searchsorted(offs, lo, side="right") - 1
    return {"doc": doc, "name": least[lo], "whole": prints.of(lo, hi), "lo": lo - offs[doc], "size": hi - lo}


def _tag(text: str) -> Column:
    return F.pmod(F.hash(F.coalesce(F.col(text), F.lit(""))), F.lit(1 << 16))


def _texts(docs: DataFrame, doc_id: str, text: str, length: int) -> DataFrame:
    return docs.where(F.col(doc_id).try_cast("long").isNotNull()).select(F.col(doc_id).try_cast("long").alias("_id"), _tag(text).alias("_tag"), F.col(text).alias("_text")).where(F.octet_length("_text") >= length)


#: tag and start of a range in one number, which takes less room in a shuffle
_TAG, _LO = "cast(at >> 40 AS int)", "cast(at & ((1L << 40) - 1) AS int)"
#: start, size and tag of a run in one number; what the rows of a document share (id, tag) comes side by side, so that it compresses
_RUN = ("cast(run & 65535 AS int) AS _tag", "cast(run >> 32 AS int) AS lo", "cast((run >> 32) + (run >> 16 & 65535) AS int) AS hi")


def _runs(docs: DataFrame, length: int, gram: int, hot: np.ndarray | None = None, wanted: bool = False) -> DataFrame:
    """_id, run (see _RUN), name, whole of all runs of _texts, but those of hot names (wanted: of hot names only)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            got = runs(*column_bytes(b.column(2)), length, gram)
            if hot is not None:
                own = np.isin(got["name"].view(np.int64), hot) == wanted
                got = {k: v[own] for k, v in got.items()}
            if len(got["doc"]):
                ids, tags = np.asarray(b.column(0)), np.asarray(b.column(1)).astype(np.int64)
                cols = ids[got["doc"]], got["lo"] << 32 | got["size"] << 16 | tags[got["doc"]], got["name"].view(np.int64), got["whole"].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["_id", "run", "name", "whole"])

    return docs.mapInArrow(find, "_id bigint, run bigint, name bigint, whole bigint")


def _hot_names(texts: DataFrame, length: int, gram: int) -> np.ndarray:
    """Names whose runs one task shouldn't hold; which ones doesn't change the result."""
    some = texts.where(F.pmod(F.xxhash64("_id", "_tag"), F.lit(SAMPLE)) == 0)
    rows = _runs(some, length, gram).groupBy("name").count().where(F.col("count") >= HOT_LEAST).orderBy(F.desc("count"), "name").limit(HOT_NAMES).select("name").collect()
    return np.array([r["name"] for r in rows], np.int64)


def _round1(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Stored: runs whose name occurs in several documents, settled or open to the next rounds."""
    hot = _hot_names(texts, length, gram)
    cold = _runs(texts, length, gram, hot) if len(hot) else _runs(texts, length, gram)
    name, whole = Window.partitionBy("name"), Window.partitionBy("name", "whole")
    shared = cold.withColumns({"first": F.min("_id").over(name), "last": F.max("_id").over(name), "one": F.min("whole").over(name) == F.max("whole").over(name)}).where("first < last")
    found = shared.withColumn("settled", F.min("_id").over(whole) < F.col("_id")).where("settled or not one")
    kept = ["_id", *_RUN, "settled"]
    out, used = found.selectExpr(*kept), []
    if len(hot):
        common = stored(_runs(texts, length, gram, hot, True), "suffix-hot")
        by_name = common.groupBy("name").agg(F.min("_id").alias("first"), F.max("_id").alias("last"), (F.min("whole") == F.max("whole")).alias("one")).where("first < last")
        by_whole = stored(common.groupBy("name", "whole").agg(F.min("_id").alias("owner")), "suffix-hot-owners")
        found = common.join(F.broadcast(by_name), "name").join(by_whole.hint("merge"), ["name", "whole"])  # HOT_NAMES rows at most
        out = out.unionByName(found.withColumn("settled", F.col("owner") < F.col("_id")).where("settled or not one").selectExpr(*kept))
        used = [common, by_whole]
    out = stored(out, "suffix-round1")
    discard(*used)
    return out


def _parts(texts: DataFrame, open_: DataFrame) -> DataFrame:
    """(_id, at, part): the bytes of the open runs."""

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            raw, offs = column_bytes(b.column(2))
            runs_, count = b.column(3).flatten(), np.asarray(b.column(3).value_lengths())
            lo, hi = np.asarray(runs_.field("lo")).astype(np.int64), np.asarray(runs_.field("hi")).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), count)
            ids, tags, blob = np.asarray(b.column(0)), np.asarray(b.column(1)).astype(np.int64), raw.tobytes()
            part = [blob[x:y] for x, y in zip((offs[row] + lo).tolist(), (offs[row] + hi).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(tags[row] << 40 | lo), pa.array(part, pa.binary())], names=["_id", "at", "part"])

    lists = open_.groupBy("_id", "_tag").agg(F.collect_list(F.struct("lo", "hi")).alias("_at"))
    return texts.join(lists, ["_id", "_tag"]).select("_id", "_tag", "_text", "_at").mapInArrow(carry, "_id bigint, at bigint, part binary")


def _places(offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in the row) of every window of parts that lie one after the other."""
    n = np.diff(offs) - length + 1
    return np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _stretches(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(_id, at, stretch, part): open runs cut where the stretch changes, which is the first minimizer with half of the rest of a window, on the left if the window has that much there."""
    more = (length - gram) // 2
    for b in slices(batches, "part", 1 << 18):
        if not b.num_rows:
            continue
        raw, offs = column_bytes(b.column(2))
        row, nth = _places(offs, length)
        start, prints = offs[row] + nth, Prints(raw)
        names = prints.windows(gram)
        least = _sliding(names, length - gram + 1, np.minimum)[offs[:-1]]  # the same for all windows of a run
        is_least = names == np.repeat(least, np.diff(offs))[: len(names)]
        minimizer = np.minimum.accumulate(np.where(is_least, np.arange(len(names)), len(names))[::-1])[::-1][start]
        begin = np.where(minimizer - start >= more, minimizer - more, minimizer)
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (begin[1:] != begin[:-1])
        lo = np.flatnonzero(first)
        hi = np.append(lo[1:], len(row)) - 1
        blob, own = raw.tobytes(), row[lo]
        part = [blob[x:y] for x, y in zip(start[lo].tolist(), (start[hi] + length).tolist(), strict=True)]
        ids, at = (np.asarray(b.column(i)) for i in range(2))
        cols = ids[own], at[own] + nth[lo], prints.windows(gram + more)[begin[lo]].view(np.int64), pa.array(part, pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["_id", "at", "stretch", "part"])


def _round2(parts: DataFrame, length: int, gram: int) -> DataFrame:
    """(_id, at, part), stored: what of the open runs has a stretch that occurs in several documents."""
    stretches = parts.mapInArrow(lambda x: _stretches(x, length, gram), "_id bigint, at bigint, stretch bigint, part binary")
    several = stored(stretches.groupBy("stretch").agg(F.min("_id").alias("first"), F.max("_id").alias("last")).where("first < last").select("stretch"), "suffix-stretches")
    out = stored(stretches.join(several.hint("merge"), "stretch").select("_id", "at", "part"), "suffix-round2")
    discard(several, parts)
    return out


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(_id, at, front, back) of every window of open runs: the names of its halves."""
    half = length // 2
    for b in slices(batches, "part", 1 << 18):
        raw, offs = column_bytes(b.column(2))
        row, nth = _places(offs, length)
        prints, start = Prints(raw), offs[row] + nth
        front, back = prints.windows(half)[start], prints.windows(length - half)[start + half]
        ids, at = (np.asarray(b.column(i)) for i in range(2))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[row], at[row] + nth, front.view(np.int64), back.view(np.int64))], names=["_id", "at", "front", "back"])


def _round3(parts: DataFrame, length: int) -> DataFrame:
    """(_id, _tag, lo, hi), stored: ranges of windows of open runs that start in a smaller id too."""
    windows = parts.mapInArrow(lambda x: _windows(x, length), "_id bigint, at bigint, front bigint, back bigint")
    owners = windows.groupBy("front", "back").agg(F.min("_id").alias("first"), F.max("_id").alias("last")).where("first < last").select("front", "back", "first")
    owners = stored(owners, "suffix-owners")
    gone = windows.join(owners.hint("merge"), ["front", "back"]).where("_id > first").select("_id", "at")
    cells = gone.groupBy("_id", F.expr("at >> 5").alias("cell")).agg(F.expr("bit_or(1L << cast(at & 31 AS int))").alias("mask"))
    ranges = cells.mapInArrow(lambda x: _cell_ranges(x, length), "_id bigint, at bigint, size int").selectExpr("_id", f"{_TAG} AS _tag", f"{_LO} AS lo", f"{_LO} + size AS hi")
    out = stored(ranges, "suffix-ranges")
    discard(owners, parts)
    return out


def _cell_ranges(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Ranges of windows from cells: bit i of the mask is the window that starts at 32 cell + i."""
    for b in batches:
        if not b.num_rows:
            continue
        gone = (np.asarray(b.column(2))[:, None] >> np.arange(32)) & 1 == 1
        edge = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (row, lo), hi = np.nonzero(edge == 1), np.nonzero(edge == -1)[1]
        at = (np.asarray(b.column(1))[row] << 5) + lo
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.asarray(b.column(0))[row], at, (hi - lo - 1 + length).astype(np.int32))], names=["_id", "at", "size"])


def repeated_ranges(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """_id, _tag (of the text), lo, hi: byte ranges that repeat a smaller id's bytes; they may overlap."""
    if not 0 < gram <= length <= MOST:
        raise ValueError(f"gram must not be longer than length, nor length than {MOST}")
    texts = _texts(docs, doc_id, text, length)
    round1 = _round1(texts, length, gram)
    parts = stored(_parts(texts, round1.where("not settled")), "suffix-parts")
    ranges = _round3(_round2(parts, length, gram), length)
    return round1.where("settled").select("_id", "_tag", "lo", "hi").unionByName(ranges)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, returns: tuple[str, ...] = RESULTS) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans and kept (what is left, binary); returns may name `kept_sha256` (lowercase hex) and `kept_text` (what is left, without parts of cut characters; null stays null) too."""
    base = docs.drop(*returns)
    names = base.columns
    own_id, own_tag, own_at = (free_name(docs, x) for x in ("_suffix_id", "_suffix_tag", "_suffix_at"))
    ranges = repeated_ranges(docs, doc_id, text, length).groupBy(F.col("_id").alias(own_id), F.col("_tag").alias(own_tag)).agg(F.collect_list(F.struct("lo", "hi")).alias(own_at))
    joined = base.withColumns({own_id: F.col(doc_id).try_cast("long"), own_tag: _tag(text)}).join(ranges, [own_id, own_tag], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            raw, offs = column_bytes(b.column(b.schema.get_field_index(text)))
            lists = b.column(b.schema.get_field_index(own_at))
            flat, count = lists.flatten(), np.asarray(lists.value_lengths().fill_null(0))
            start = np.repeat(offs[:-1], count)
            edge = np.zeros(len(raw) + 1, np.int32)
            np.add.at(edge, start + np.asarray(flat.field("lo")), 1)
            np.add.at(edge, start + np.asarray(flat.field("hi")), -1)
            gone = np.cumsum(edge)[: len(raw)] > 0
            upto = np.concatenate([[0], np.cumsum(gone, dtype=np.int64)])
            fresh = gone.copy()
            fresh[1:] &= ~gone[:-1]
            inside = offs[:-1][np.diff(offs) > 0]
            fresh[inside] = gone[inside]  # a run starts anew in each document
            spans = np.concatenate([[0], np.cumsum(fresh, dtype=np.int64)])
            left = raw[~gone].tobytes()
            cuts = offs - upto[offs]
            kept = [left[cuts[i] : cuts[i + 1]] for i in range(len(offs) - 1)]
            new = {"n_bytes": np.diff(offs), "n_removed": np.diff(upto[offs]), "n_spans": np.diff(spans[offs]), "kept": pa.array(kept, pa.binary())}
            if "kept_sha256" in returns:
                new["kept_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
            if "kept_text" in returns:
                null = b.column(b.schema.get_field_index(text)).is_null().to_pylist()
                new["kept_text"] = pa.array([None if n else x.decode("utf-8", "ignore") for n, x in zip(null, kept, strict=True)], pa.string())
            out = passed(b.drop_columns([own_at]), **{k: v for k, v in new.items() if k in returns})
            yield out.select([*names, *returns])

    kinds = {"kept": T.BinaryType(), "kept_sha256": T.StringType(), "kept_text": T.StringType()}
    return joined.select(*names, own_at).mapInArrow(cut, T.StructType([*base.schema.fields, *(T.StructField(c, kinds.get(c, T.LongType())) for c in returns)]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every document's bytes that repeat a smaller id's, by strings of 50 bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, returns=("n_bytes", "n_removed", "n_spans", "kept_sha256")).drop("text")
