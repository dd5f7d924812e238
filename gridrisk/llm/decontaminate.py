"""Benchmark decontamination: BM25 with block-max bounds over an inverted index of test items.

Words are runs of anything but blanks, ASCII marks and control characters, A-Z lower-cased. The index
holds the test items: a list of (item, weight) for each term, in blocks of BLOCK
items, with the largest weight of the list and of each block. A weight is the BM25 weight divided by the
item's score against itself, so a passage that holds the whole item scores 1.
Every document is read in passages of 2 L words at every L-th word (L: the longest
item), so each item's copy lies inside of one. All passages of a slice
are queried at once, with the bounds of block-max WAND: a passage goes on only if its list maxima reach the
threshold, then a block only if its block maxima do, and what is left is scored in full. (Moving a pivot through the lists passage by
passage gives the same hits, see the tests; the README has its cost.)
A hit is confirmed on five-word shingles: OVERLAP of the item's, and PART_OVERLAP each of its question and its
answer, must be in the document. The answer is what follows the last sentence end that leaves
WORDS words on either side, the question what comes before it; without such an end they are cut in the middle, and an
item of under 2 * WORDS words is both.

The benchmark is the query set: it is cut into blocks of about ITEMS items or ITEM_BYTES bytes, each an index (postings, and a maximum for each term and block of
items that has it) that all tasks read. Documents are read once, however many indexes there are: a task opens one at a time for GROUP_BYTES of its texts. Item count, document frequencies, mean length and L are those of the whole benchmark in every block.

Defined results: documents and items without words (null and empty texts too) match nothing; items of under five words match
documents of these words only; very long texts are read whole, a slice by themselves; several items of equal score are all reported;
repeated rows give repeated hits; an empty table gives no hits. Ids may be null and are cast to long (what isn't a number: null).
Columns of docs named like the results don't matter to `contaminated` and stay as they are in `without_contaminated`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridrisk.llm.textops import MARKS, U64, Prints, column_bytes, lower_ascii, shingles, slices, stored, words

ITEMS, ITEM_BYTES, BLOCK, THRESHOLD, OVERLAP, PART_OVERLAP, WORDS = 4000, 4 << 20, 8, 0.6, 0.8, 0.5, 5
#: (passage, term) rows that are scored at once; bytes of text for which the indexes are opened once.
ROWS, GROUP_BYTES = 100_000, 16 << 20
K1, B = 1.2, 0.75
SCHEMA = "doc_id bigint, item_id bigint, score double, n_item bigint, n_shared bigint, n_question bigint, question_shared bigint, n_answer bigint, answer_shared bigint"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def _hashed(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = lower_ascii(raw)
    starts, ends, first = words(raw, offs, MARKS)
    return Prints(raw).of(starts, ends), first, ends


_SENTENCE_END = re.compile(r"[.?!]+[ \t\n\v\f\r]+")


def split_at(text: str, total: int, least: int = WORDS) -> int:
    """Words of the item's question, of total words; total if question and answer are one."""
    if total < 2 * least:
        return total
    parts = _SENTENCE_END.split(text)
    _, first, _ = _hashed(*column_bytes(pa.array(parts)))
    fit = first[(first >= least) & (first <= total - least)]
    return int(fit.max()) if len(fit) else total // 2


@dataclass
class Index:
    ids: list
    terms: np.ndarray  # sorted hashes
    first: np.ndarray  # postings of term t: first[t]:first[t+1]
    items: np.ndarray
    weights: np.ndarray
    list_max: np.ndarray
    block_first: np.ndarray  # block maxima of term t: block_first[t]:block_first[t+1], for the blocks that have it
    block_no: np.ndarray
    block_top: np.ndarray
    seen: np.ndarray  # which of 65,536 hash prefixes have a term
    span: int  # words of the longest item
    grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # of each item: all, question, answer

    @property
    def block_max(self) -> np.ndarray:
        """The block maxima as a terms x blocks matrix, to look at a small index."""
        out = np.zeros((len(self.terms), -(-len(self.ids) // BLOCK)), np.float32)
        out[np.repeat(np.arange(len(self.terms)), np.diff(self.block_first)), self.block_no] = self.block_top
        return out


@dataclass
class Whole:
    """Of all items, when an index has a block of them only; df has at least the block's terms, sorted."""

    n_items: int
    mean: float
    span: int
    terms: np.ndarray
    df: np.ndarray


def build_index(ids: list, texts: list[str], whole: Whole | None = None) -> Index:
    h, first, _ = _hashed(*column_bytes(pa.array([t or "" for t in texts], pa.string())))
    def grams(own: np.ndarray) -> np.ndarray:
        return np.unique(shingles(own, np.array([0, len(own)]), WORDS)[0])

    all_grams = []
    for i, t in enumerate(texts):
        own = h[first[i] : first[i + 1]]
        cut = split_at(t or "", len(own))
        all_grams.append((grams(own), grams(own[:cut]), grams(own[cut:] if cut < len(own) else own)))
    length = np.diff(first)
    item = np.repeat(np.arange(len(texts)), length)
    terms, term = np.unique(h, return_inverse=True)
    key, tf = np.unique(term * max(len(texts), 1) + item, return_counts=True)
    term, item = key // max(len(texts), 1), key % max(len(texts), 1)
    if whole is None:
        whole = Whole(len(texts), length.mean() if len(length) else 0.0, int(length.max(initial=1)), terms, np.bincount(term, minlength=len(terms)))
    df = whole.df[np.searchsorted(whole.terms, terms)]
    idf = np.log1p((whole.n_items - df + 0.5) / (df + 0.5))
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / max(whole.mean, 1e-9))) if len(key) else np.zeros(0)
    own = np.bincount(item, weights=weight, minlength=len(texts))
    weight = weight / own[item]
    blocks = max(1, -(-len(texts) // BLOCK))
    cell = term * blocks + item // BLOCK  # sorted, as postings are
    head = np.flatnonzero(np.diff(cell, prepend=-1))
    block_top = np.maximum.reduceat(weight, head).astype(np.float32) if len(head) else np.zeros(0, np.float32)
    block_term, block_no = cell[head] // blocks, (cell[head] % blocks).astype(np.int32)
    block_first = np.searchsorted(block_term, np.arange(len(terms) + 1))
    list_max = np.maximum.reduceat(block_top, block_first[:-1]) if len(terms) else np.zeros(0, np.float32)  # each term has a posting
    seen = np.zeros(1 << 16, bool)
    seen[(terms >> U64(48)).astype(np.int64)] = True
    return Index(list(ids), terms, np.searchsorted(term, np.arange(len(terms) + 1)), item.astype(np.int32), weight, list_max, block_first, block_no, block_top, seen, whole.span, all_grams)


def _ragged(starts: np.ndarray, count: np.ndarray) -> np.ndarray:
    total = np.cumsum(count)
    return np.repeat(starts - (total - count), count) + np.arange(total[-1] if len(total) else 0)


def _blocks(where: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cuts of the sorted passages into blocks of whole ones: up to limit rows each, or one larger passage."""
    a = 0
    while a < len(where):
        b = len(where)
        if b - a > limit:
            b = int(np.searchsorted(where, where[a + limit]))
            if b == a:
                b = int(np.searchsorted(where, where[a], side="right"))
        yield a, b
        a = b


def search(index: Index, raw: np.ndarray, offs: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int, float]]:
    """(document, item, best passage's score) of all hits at or above the threshold."""
    h, first, _ = _hashed(raw, offs)
    return _search(index, h, first, threshold)


def _search(index: Index, h: np.ndarray, first: np.ndarray, threshold: float) -> list[tuple[int, int, float]]:
    n_docs, span = len(first) - 1, index.span
    hit = np.flatnonzero(index.seen[(h >> U64(48)).astype(np.int64)])
    term = np.searchsorted(index.terms, h[hit])
    same = index.terms[np.minimum(term, len(index.terms) - 1)] == h[hit] if len(index.terms) else np.zeros(0, bool)
    hit, term = hit[same], term[same]
    if not len(hit):
        return []
    doc = np.repeat(np.arange(n_docs), np.diff(first))[hit]
    n_pass = np.maximum(1, -(-np.diff(first) // span))
    base = np.concatenate([[0], np.cumsum(n_pass)])
    at = (hit - first[doc]) // span  # a word is in the passage that starts there and in the one before
    two = at > 0
    n_terms = len(index.terms)
    key = np.unique(np.concatenate([(base[doc] + at) * n_terms + term, (base[doc] + at - 1)[two] * n_terms + term[two]]))
    where, term = key // n_terms, key % n_terms
    slack = 1e-6
    bound = np.bincount(where, weights=index.list_max[term], minlength=base[-1])  # list maxima
    keep = bound[where] >= threshold - slack
    where, term = where[keep], term[keep]
    best: dict[tuple[int, int], float] = {}
    for a, b in _blocks(where, ROWS):
        w, t = where[a:b], term[a:b]
        head = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        blocks, passage_no = max(1, -(-len(index.ids) // BLOCK)), np.repeat(np.arange(len(head)), np.diff(np.append(head, len(w))))
        count = index.block_first[t + 1] - index.block_first[t]
        top = _ragged(index.block_first[t], count)
        block_bound = np.bincount(np.repeat(passage_no, count) * blocks + index.block_no[top], weights=index.block_top[top], minlength=len(head) * blocks).reshape(len(head), blocks)  # block maxima
        passage, block = np.nonzero(block_bound >= threshold - slack)
        alive = np.unique(passage)
        if not len(alive):
            continue
        size = np.diff(np.append(head, len(w)))
        rows = _ragged(head[alive], size[alive])
        count = index.first[t[rows] + 1] - index.first[t[rows]]
        post = _ragged(index.first[t[rows]], count)
        own = np.repeat(np.repeat(alive, size[alive]), count)
        ok = block_bound[own, index.items[post] // BLOCK] >= threshold - slack
        pair, inv = np.unique(own[ok] * len(index.ids) + index.items[post[ok]], return_inverse=True)
        total = np.bincount(inv, weights=index.weights[post[ok]])
        for p, s in zip(pair[total >= threshold - slack].tolist(), total[total >= threshold - slack].tolist(), strict=True):
            d = int(np.searchsorted(base, w[head[p // len(index.ids)]], side="right") - 1)
            i = p % len(index.ids)
            best[d, i] = max(s, best.get((d, i), 0.0))
    return [(d, i, s) for (d, i), s in sorted(best.items())]


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "t"):
        _, first, _ = _hashed(*column_bytes(b.column(1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.diff(first))], names=["words"])


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, term): the distinct terms of each item."""
    for b in slices(batches, "t"):
        h, first, _ = _hashed(*column_bytes(b.column(1)))
        item = np.repeat(np.arange(b.num_rows), np.diff(first))
        order = np.lexsort((h, item))
        h, item = h[order], item[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (item[1:] != item[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.asarray(b.column(2))[item[new]]), pa.array(h[new].view(np.int64))], names=["block", "term"])


def _indexes(items: DataFrame, item_id: str, item_text: str, items_at_once: int) -> Iterator[Index]:
    """Indexes of all items, about items_at_once at a time, with the statistics of all."""
    items = items.select(F.col(item_id).try_cast("long").alias("i"), F.col(item_text).alias("t"))
    n_items, n_bytes = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    blocks = max(1, -(-n_items // items_at_once), -(-n_bytes // ITEM_BYTES))
    items = items.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)).cast("int"))
    if blocks > 1:
        words_, longest = items.mapInArrow(_lengths, "words bigint").agg(F.sum("words"), F.max("words")).first()
        own = items.mapInArrow(_terms, "block int, term bigint").groupBy("term", "block").agg(F.count(F.lit(1)).alias("n"))
        own = stored(own, "bm25-terms")
        terms = stored(own.join(own.groupBy("term").agg(F.sum("n").alias("df")), "term").select("block", "term", "df"), "bm25-df")
    for block in range(blocks):
        got = items.where(F.col("block") == block).orderBy("i", "t").collect()
        whole = None
        if blocks > 1:
            known = terms.where(F.col("block") == block).select("term", "df").toArrow()
            term, df = known["term"].to_numpy().view(U64), known["df"].to_numpy()
            order = np.argsort(term)
            whole = Whole(n_items, words_ / n_items, max(int(longest), 1), term[order], df[order])
        yield build_index([r["i"] for r in got], [r["t"] for r in got], whole)


def confirmed(index: Index, col: pa.Array, threshold: float = THRESHOLD) -> list[tuple]:
    """(row, item's place, score, then size and shared shingles of the item, its question and its answer) of all confirmed hits."""
    return _confirmed(index, *_hashed(*column_bytes(col))[:2], threshold)


def _confirmed(index: Index, h: np.ndarray, first: np.ndarray, threshold: float) -> list[tuple]:
    rows = []
    for d, i, s in _search(index, h, first, threshold):
        grams, _ = shingles(h[first[d] : first[d + 1]], np.array([0, first[d + 1] - first[d]]), WORDS)
        size = [len(g) for g in index.grams[i]]
        shared = [int(np.isin(g, grams).sum()) for g in index.grams[i]]
        parts = all(k >= PART_OVERLAP * n for k, n in zip(shared[1:], size[1:], strict=True))
        if shared[0] >= OVERLAP * size[0] and parts:
            rows.append((d, i, s, *(x for pair in zip(size, shared, strict=True) for x in pair)))
    return rows


def _grouped(pieces: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Pieces of about `limit` bytes of the column together."""
    group, size = [], 0
    for b in pieces:
        group.append(b)
        size += column_bytes(b.column(b.schema.get_field_index(column)))[0].size
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def _hits(batches: Iterator[pa.RecordBatch], column: str, indexes: list, threshold: float) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """Each piece of the batches with its confirmed hits (row, item id, ...) in all indexes, which are opened one after the other for GROUP_BYTES of text."""
    for group in _grouped(slices(batches, column), column, GROUP_BYTES if len(indexes) > 1 else 0):
        hashed = [_hashed(*column_bytes(b.column(b.schema.get_field_index(column))))[:2] for b in group]
        found: list[list[tuple]] = [[] for _ in group]
        for held in indexes:
            index = held.value
            if len(indexes) > 1:
                held.__dict__.pop("_value", None)  # a worker would keep it; the next group reads its file again
            for n, (h, first) in enumerate(hashed):
                found[n] += [(d, index.ids[i], *rest) for d, i, *rest in _confirmed(index, h, first, threshold)]
            del index
        yield from zip(group, found, strict=True)


def _held(items: DataFrame, item_id: str, item_text: str, items_at_once: int) -> list:
    """The indexes of all items as broadcasts, made and sent one by one: none stays on the driver, a worker opens one at a time."""
    return [items.sparkSession.sparkContext.broadcast(x) for x in _indexes(items, item_id, item_text, items_at_once)]


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, items_at_once: int = ITEMS) -> DataFrame:
    """A row for each document and test item that it holds, with the passage score and the shared shingles."""
    own = docs.select(F.col(doc_id).try_cast("long").alias("doc_id"), F.col(text).alias("_text"))
    indexes = _held(items, item_id, item_text, items_at_once)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, hits in _hits(batches, "_text", indexes, threshold):
            ids = b.column(0).to_pylist()
            if hits:
                cols = zip(*((ids[d], *rest) for d, *rest in hits), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64() if n == 2 else pa.int64()) for n, x in enumerate(cols)], names=NAMES)

    return own.mapInArrow(run, SCHEMA)


def without_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, items_at_once: int = ITEMS) -> DataFrame:
    """docs without the rows that hold a test item."""
    indexes = _held(items, item_id, item_text, items_at_once)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, hits in _hits(batches, text, indexes, threshold):
            keep = np.ones(b.num_rows, bool)
            keep[[x[0] for x in hits]] = False
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document and test item that it holds."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs.select("doc_id", "text"), items).select(*(n for n in NAMES if n != "score"))


_WORDS = "list_filter(string_split_regex(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
_GRAMS = "list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END)"
#: Words of the question: the largest sum of words of leading sentences that leaves five on either side.
_ENDS = f"list_transform(regexp_split_to_array(text, '[.?!]+[ \\t\\n\\v\\f\\r]+'), lambda p: len({_WORDS.format('p')}))"
SQL = f"""
WITH i0 AS (SELECT item_id, {_WORDS.format("text")} AS w, {_ENDS} AS e FROM benchmark),
i1 AS (SELECT item_id, w, len(w) AS n, list_filter(list_transform(range(1, len(e) + 1), lambda k: CAST(list_sum(e[1:k]) AS BIGINT)), lambda c: c >= 5 AND c <= len(w) - 5) AS fit FROM i0),
i2 AS (SELECT item_id, w, CASE WHEN n < 10 THEN n WHEN len(fit) > 0 THEN list_max(fit) ELSE n // 2 END AS cut FROM i1),
i3 AS (SELECT item_id, 'g' AS part, w FROM i2 UNION ALL SELECT item_id, 'q', w[1:cut] FROM i2 UNION ALL SELECT item_id, 'a', CASE WHEN cut < len(w) THEN w[cut + 1:] ELSE w END FROM i2),
i4 AS (SELECT item_id, part, {_GRAMS} AS g FROM i3),
i AS (SELECT item_id, any_value(g) FILTER (part = 'g') AS g, any_value(g) FILTER (part = 'q') AS q, any_value(g) FILTER (part = 'a') AS a FROM i4 GROUP BY item_id),
d AS (SELECT doc_id, {_GRAMS} AS g FROM (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents)),
ix AS (SELECT item_id, len(g) AS n_item, len(q) AS n_question, len(a) AS n_answer, unnest(list_transform(g, lambda x: {{'s': x, 'q': list_contains(q, x), 'a': list_contains(a, x)}}), recursive := true) FROM i), dx AS (SELECT doc_id, unnest(g) AS s FROM d),
hit AS (SELECT doc_id, item_id, n_item, count(*) AS n_shared, n_question, count(*) FILTER (ix.q) AS question_shared, n_answer, count(*) FILTER (ix.a) AS answer_shared
FROM dx JOIN ix USING (s) GROUP BY doc_id, item_id, n_item, n_question, n_answer)
SELECT doc_id, item_id, CAST(n_item AS BIGINT) AS n_item, n_shared, CAST(n_question AS BIGINT) AS n_question, question_shared, CAST(n_answer AS BIGINT) AS n_answer, answer_shared
FROM hit WHERE n_shared >= 0.8 * n_item AND question_shared >= 0.5 * n_question AND answer_shared >= 0.5 * n_answer
"""
