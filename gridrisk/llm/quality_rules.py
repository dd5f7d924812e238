"""Quality rules: base counts and zstandard compression bands.

A text is compressed as a whole and in fixed chunks of CHUNK bytes, the last one as long as it is, so that every
byte of a text longer than one chunk is judged twice. The ratio
(bytes before / after, frame overhead left out) must lie in a band that depends on the length:
repetitive text compresses too well, random text hardly at all. A text fails when one full chunk lies outside of its band (a page of
random letters or of one repeated line spoils a text, however long it is), or when more than BAD_CHUNKS of all its chunks, the short last one included, do. The
floor of full chunks is above the ratio of text that is drawn from 64 letters, 8 / 6, as encoded binary data is; full chunks of prose labelled good
have ratios of 2.0 to 2.3. (A text of one chunk is its own chunk and has the band of whole texts alone.)

Defined results: a null, empty or blank text has no words and fails the base
rule. Very long texts are read whole, a slice by themselves. Repeated rows are judged alike, ids aren't looked at. An empty table
gives an empty one. Columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridrisk.llm.textops import Prints, column_bytes, passed, per_doc, shingles, slices, words

LEVEL, CHUNK, BAD_CHUNKS = 3, 4096, 0.25
#: (length in bytes from which the band holds, least ratio, largest ratio)
BANDS = ((0, 0.0, 3.2), (256, 1.05, 3.2), (1024, 1.2, 3.6), (4096, 1.35, 4.2), (16384, 1.5, 5.5), (65536, 1.5, 6.5))
#: The same for chunks; under 256 bytes the frame's tables weigh too much to tell random text.
CHUNK_BANDS = ((0, 0.0, 3.2), (256, 1.1, 3.6), (1024, 1.3, 4.0), (4096, 1.4, 4.5))
_OVERHEAD = 12
_SYMBOLS = np.zeros(256, np.uint8)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = 1
FIELDS = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("base_failed", "boolean"), ("ratio", "double"), ("n_bad_chunks", "long"), ("kept", "boolean"))
_INK = re.compile(rb"[^\x20\x09-\x0d]")


def ratio(size: int, packed: int) -> float:
    return size / max(1, packed - _OVERHEAD)


def band(size: int, bands=BANDS) -> tuple[float, float]:
    return next((lo, hi) for at, lo, hi in reversed(bands) if size >= at)


def _repeats(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words of each document in three-word windows that occur twice or more in it."""
    n_docs = len(first) - 1
    count = np.diff(first)
    out = np.zeros(n_docs, np.int64)
    if not len(hashes):
        return out
    got, whose = shingles(hashes, first, 3)
    real = count[whose] >= 3
    got, whose = got[real], whose[real]
    nth = np.arange(len(got)) - np.searchsorted(whose, whose)  # the window's place in its document
    order = np.lexsort((got, whose))
    g, w = got[order], whose[order]
    same = (g[1:] == g[:-1]) & (w[1:] == w[:-1])
    twice = np.zeros(len(g), bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = first[whose[order[twice]]] + nth[order[twice]]
    hit = np.zeros(len(hashes) + 2, bool)
    for j in range(3):
        hit[at + j] = True
    doc = np.repeat(np.arange(n_docs), count)
    return np.bincount(doc[hit[: len(doc)]], minlength=n_docs)


def _dup_lines(raw: np.ndarray, offs: np.ndarray, blob: bytes) -> np.ndarray:
    out = np.zeros(len(offs) - 1, np.int64)
    for d in range(len(offs) - 1):
        lines = blob[offs[d] : offs[d + 1]].split(b"\n")
        if len(lines) > 1:
            inked = [x for x in lines if x and _INK.search(x)]
            out[d] = len(inked) - len(set(inked))
    return out


def measure(col: pa.Array, bands=BANDS, chunk: int = CHUNK, chunk_bands=CHUNK_BANDS, bad_chunks: float = BAD_CHUNKS) -> dict[str, np.ndarray]:
    raw, offs = column_bytes(col)
    n_docs, blob = len(offs) - 1, raw.tobytes()
    starts, ends, first = words(raw, offs)
    n_words = np.diff(first).astype(np.int64)
    doc = np.repeat(np.arange(n_docs), n_words)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[raw], dtype=np.int64)])
    word_chars = per_doc(chars[ends] - chars[starts], doc, n_docs).astype(np.int64)
    repeats = _repeats(Prints(raw).of(starts, ends), first)
    base_failed = (n_words < 50) | (100 * repeats > 50 * n_words)
    press = zstandard.ZstdCompressor(level=LEVEL)
    whole, bad, kept = np.zeros(n_docs), np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    for d in range(n_docs):
        text = blob[offs[d] : offs[d + 1]]
        if not text:
            continue
        whole[d] = ratio(len(text), len(press.compress(text)))
        n_chunks, spoilt = -(-len(text) // chunk), False
        if n_chunks > 1:
            for i in range(0, len(text), chunk):
                part = text[i : i + chunk]
                lo, hi = band(len(part), chunk_bands)
                out = not lo <= ratio(len(part), len(press.compress(part))) <= hi
                bad[d] += out
                spoilt |= out and len(part) == chunk
        lo, hi = band(len(text), bands)
        kept[d] = not base_failed[d] and lo <= whole[d] <= hi and not spoilt and bad[d] <= bad_chunks * n_chunks
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": symbols[offs[1:]] - symbols[offs[:-1]], "n_dup_lines": _dup_lines(raw, offs, blob), "n_repeat_words": repeats.astype(np.int64), "base_failed": base_failed, "ratio": whole, "n_bad_chunks": bad, "kept": kept}


def quality_rules(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """docs with the base counts, the ratios and the verdict `kept`."""
    base = docs.drop(*(n for n, _ in FIELDS if n != text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            yield passed(b, **measure(b.column(b.schema.get_field_index(text)), **limits))

    kinds = {"long": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType()}
    return base.mapInArrow(run, T.StructType([*base.schema.fields, *(T.StructField(n, kinds[k]) for n, k in FIELDS)]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: base counts and the verdict of the compression bands for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", *(n for n, _ in FIELDS))
