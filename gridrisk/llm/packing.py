"""Packing documents into sequences of a fixed number of tokens: best-fit decreasing, certified by lower bounds, repacked where a bound isn't met.

Documents become token ids and an end token; longer ones are cut into full sequences and a rest. Full pieces are sequences by themselves. The other
pieces are dealt over units of about UNIT pieces by a hash of their row; each unit is packed by best-fit decreasing in one task and compared with a lower bound
of its number of sequences, the largest one over two families of dual feasible functions (sizes near a whole sequence round up
and small ones vanish, for every threshold; sizes step down to multiples of 1 / k). A unit that needs no more sequences than its bound is certified. A unit with a gap gives all pieces of its
sequences that aren't full, a certified one those of its emptiest sequence, and what is given is dealt over fewer, new units and packed anew, as long
as that saves sequences. Texts are never shuffled, only a narrow row for each piece.

Token ids are the library's: its words never cross white space, so each distinct chunk of a slice is encoded once, and the ids equal those of whole texts (tested).

Defined results: a null or empty text, or one of white space only, is the end token alone; very long texts are read whole; repeated rows are pieces of their own;
a null id is carried through; an empty table gives an empty one; ties in size go by the row's number in the stored table. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

import itertools
import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridrisk.llm.textops import Prints, column_bytes, discard, lower_ascii, slices, stored, words

SIZE, END, VOCABULARY = 4096, 1, "word_bpe_49k.json"
#: Pieces in a unit; rounds of exchange at most; functions of the stepping family.
UNIT, EXCHANGES, STEPS = 1 << 15, 8, 40
PIECE = "doc_id {}, piece int, start long, length long, ids_crc32 long"
#: Distinct chunks that a worker remembers.
REMEMBERED = 1 << 18


# --------------------------------------------------------------------------- tokens
#: Marks that may end a chunk of letters, and the steps before the merges of a vocabulary whose words never cross white space.
TAIL = np.isin(np.arange(256), list(b".,;:!?\"')]"))
NORMALIZER = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Second bytes of the letters U+00C0 to U+00FF (the first is C3), and their lower case.
_LATIN = np.isin(np.arange(256), [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])
_LATIN_LOWER = np.where(np.isin(np.arange(256), [b for b in range(0x80, 0x9F) if b != 0x97]), np.arange(256) + 0x20, np.arange(256)).astype(np.uint8)
_ALNUM = np.array([i < 128 and chr(i).isalnum() for i in range(256)])
_SMALL = np.isin(np.arange(256), np.arange(97, 123))


def _byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary writes bytes: printable ones of Latin-1 as they are, the others, in order, from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(plain))}


class Ids:
    """Token ids of texts by the tokenizers library. vocabulary: a path, or a name that public_tokenizers knows.

    With a vocabulary of words (by its own description: the normalizer and the pattern above) each distinct chunk between white space is encoded once a slice, marks at
    its end apart; a chunk of small letters is one word, which goes to the merges directly. Other vocabularies encode whole texts.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        from tokenizers import Tokenizer

        if not os.path.exists(vocabulary):
            import public_tokenizers

            vocabulary = public_tokenizers.path(vocabulary)
        self.model, self.known, self.letters = Tokenizer.from_file(vocabulary), {}, _byte_letters()
        self.merges = self.model.model
        way = json.loads(self.model.to_str())
        steps, first = (way["normalizer"] or {}).get("normalizers", []), (way["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.of_words = [n["type"] for n in steps] == NORMALIZER and [x["type"] for x in first] == ["Split", "ByteLevel"] and first[0]["pattern"] == {"Regex": PATTERN} and not first[1]["add_prefix_space"] and all(t["content"].startswith("<|") and not t["normalized"] for t in way["added_tokens"])

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def of(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): ids[ends[d]:ends[d + 1]] are those of row d."""
        raw, offs = column_bytes(col)
        special = b"<|" in raw.tobytes()  # perhaps an added token, which is told by its case and its marks
        if not special:
            raw = lower_ascii(raw)
            after = np.flatnonzero(raw[:-1] == 0xC3) + 1
            raw[after] = _LATIN_LOWER[raw[after]]
        starts, ends, first = words(raw, offs)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(col) + 1, np.int64)
        if not special:
            starts, ends, first = self._without_tails(raw, starts, ends, offs)
        _, rep, which = np.unique(Prints(raw).of(starts, ends), return_index=True, return_inverse=True)
        if not self.of_words or not self._same(raw, starts, ends - starts, rep[which]):  # or two chunks with one fingerprint
            got = [np.array(x, np.uint32) for x in self.plain([t or "" for t in col.to_pylist()])]
            return np.concatenate(got), np.concatenate([[0], np.cumsum([len(x) for x in got])])
        ids = self._chunks(raw, starts[rep], ends[rep])
        count = np.array([len(x) for x in ids])
        flat, at = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(count.sum())), np.cumsum(count) - count
        n = count[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        return flat[np.repeat(at[which] - upto[:-1], n) + np.arange(upto[-1])], upto[first]

    def _chunks(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
        latin = raw == 0xC3
        latin[:-1] &= _LATIN[raw[1:]] & (raw[1:] >= 0x9F)  # small ones
        latin[-1:] = False
        letter = _SMALL[raw] | latin
        letter[1:] |= latin[:-1]
        upto = np.concatenate([[0], np.cumsum(letter)])
        word = upto[ends] - upto[starts] == ends - starts
        blob, known, table, merge = raw.tobytes(), self.known, str.maketrans({chr(b): c for b, c in self.letters.items()}), self.merges.tokenize
        chunks = [blob[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        if len(known) > REMEMBERED:
            known.clear()
        rest = []
        for c, w in zip(chunks, word.tolist(), strict=True):
            if c not in known:
                if w:
                    known[c] = [t.id for t in merge(c.decode("ascii") if c.isascii() else c.decode("latin-1").translate(table))]
                else:
                    rest.append(c)
        known.update(zip(rest, self.plain([c.decode("utf-8", "replace") for c in rest]), strict=True))
        return [known[c] for c in chunks]

    @staticmethod
    def _without_tails(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The marks after a chunk's last letter or digit as chunks of their own: no word of the pattern lies on both sides."""
        last = np.maximum.accumulate(np.where(TAIL[raw], -1, np.arange(len(raw))))
        cut = last[ends - 1] + 1
        before = raw[cut - 1]
        ok = (cut > starts) & (cut < ends)
        ok &= _ALNUM[before] | ((raw[np.maximum(cut - 2, 0)] == 0xC3) & _LATIN[before] & (cut - 2 >= starts))
        starts, ends = np.sort(np.concatenate([starts, cut[ok]])), np.sort(np.concatenate([ends, cut[ok]]))
        return starts, ends, np.searchsorted(starts, offs)

    @staticmethod
    def _same(raw: np.ndarray, starts: np.ndarray, size: np.ndarray, rep: np.ndarray) -> bool:
        """Whether every chunk has the bytes of its representative."""
        if (size != size[rep]).any():
            return False
        before = np.cumsum(size) - size
        at = np.arange(int(size.sum()))
        return bool((raw[np.repeat(starts - before, size) + at] == raw[np.repeat(starts[rep] - before, size) + at]).all())


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """A row for each piece of a document: doc_id, piece, start, length, ids_crc32 (and ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Ids(vocabulary)
        for b in slices(batches, "text"):
            ids, ends = of.of(b.column(1))
            rows: list[tuple] = []
            for d, (lo, hi) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                own = np.append(ids[lo:hi], np.uint32(end)).astype("<u4")
                for k, at in enumerate(range(0, len(own), size)):
                    part = own[at : at + size]
                    rows.append((d, k, at, len(part), zlib.crc32(part.tobytes()), part))
            whose, k, at, n, crc, part = zip(*rows, strict=True)
            cols = [b.column(0).take(pa.array(whose)), pa.array(k, pa.int32()), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.array([p.astype(np.int32) for p in part], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    schema = PIECE.format(docs.schema[doc_id].dataType.simpleString()) + ", ids array<int>" * with_ids
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


# --------------------------------------------------------------------------- packing
def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece: in descending order, each into the fullest sequence that has room."""
    room: list[list[int]] = [[] for _ in range(size + 1)]
    left, n, bins, offsets = 0, 0, np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)  # left: bit r is set if a sequence has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = left >> need
        if fits:
            r = need + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                left ^= 1 << r
        else:
            b, r, n = n, size, n + 1
        bins[i], offsets[i] = b, size - r
        if r > need:
            room[r - need].append(b)
            left |= 1 << (r - need)
    return bins, offsets


def least_sequences(lengths: np.ndarray, size: int) -> int:
    """A lower bound of the sequences that pieces of 1 to size tokens need: the largest over dual feasible functions."""
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    n, total = np.cumsum(count), np.cumsum(count * np.arange(size + 1))
    low = np.arange(1, size // 2 + 1)  # over size - low: a sequence by itself; under low: nothing
    best = int((-(-((n[-1] - n[size - low]) * size + total[size - low] - total[low - 1]) // size)).max(initial=0))
    at = np.arange(size + 1, dtype=np.int64)
    for k in range(1, STEPS + 1):
        step = np.where((k + 1) * at % size == 0, at * k, (k + 1) * at // size * size)  # in units of 1 / (k * size)
        best = max(best, -(-int((step * count).sum()) // (k * size)))
    return best


def _packer(size: int, alone: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Of one unit: its pieces with sequence, offset, whether they stay, the unit's sequences and their bound."""

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        bins, offsets = best_fit(lengths, size)
        fill = np.bincount(bins, weights=lengths)
        bound = least_sequences(lengths, size)
        given = fill < size if len(fill) > bound else np.zeros(len(fill), bool)
        if not alone:
            given[np.argmin(fill)] = True
        return rows.assign(bin=bins, offset=offsets, stays=~given[bins], sequences=len(fill), bound=bound)

    return packed


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """The rows of `pieces` with sequence_id and offset."""
    rows = stored(pieces(docs, doc_id, text, size, end, vocabulary, with_ids).withColumn("row", F.monotonically_increasing_id()), "pieces")
    names = [*[c for c in rows.columns if c not in ("row", "ids")], "sequence_id", "offset"]
    key = "row bigint, length bigint, unit bigint, bin bigint, offset bigint, stays boolean, sequences bigint, bound bigint"
    places, rest, earlier = [], rows.where(F.col("length") < size).select("row", "length"), None
    waiting = rest.count()
    for turn in range(EXCHANGES + 1):
        if not waiting:
            break
        units = -(-waiting // UNIT)
        dealt = rest.withColumn("unit", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(units)))
        now = stored(dealt.groupBy("unit").applyInPandas(_packer(size, units == 1), key), "packed")
        used = now.select("unit", "sequences").distinct().agg(F.sum("sequences")).first()[0]
        if earlier is not None and used >= earlier[1]:  # the exchange saved nothing: what was given stays where it was
            discard(now)
            break
        if earlier is not None:
            places[-1] = places[-1].where("stays")
        places.append(_numbered(now, turn))
        given = now.where("not stays")
        got = given.agg(F.count(F.lit(1)), F.count_distinct("unit", "bin")).first()
        waiting, earlier, rest = (got[0] if turn < EXCHANGES and (units > 1 or turn == 0) else 0), (now, got[1]), given.select("row", "length")
    full = rows.where(F.col("length") == size).withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")})
    out = full.select(*names, *["ids"] * with_ids)
    if places:
        where = places[0].drop("stays")
        for p in places[1:]:
            where = where.unionByName(p.drop("stays"))
        out = out.unionByName(rows.join(where, "row").select(*names, *["ids"] * with_ids))
    return out.withColumnRenamed("doc_id", doc_id) if doc_id != "doc_id" else out


def _numbered(packed: DataFrame, turn: int) -> DataFrame:
    """row, stays, sequence_id (turn, unit and sequence in one number) and offset."""
    return packed.select("row", "stays", (F.shiftleft(F.lit(turn).cast("long"), 56) + F.shiftleft("unit", 28) + F.col("bin")).alias("sequence_id"), "offset")


def sequences(packed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """From pack(with_ids=True), the sequences themselves: sequence_id, ids, and for each piece its doc_id, start, offset and length."""
    placed = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", F.col(doc_id).alias("doc_id"), "start", "length", "ids"))).alias("p"))  # `size` tokens at most
    return placed.select("sequence_id", F.flatten("p.ids").alias("ids"), F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["offset"].alias("offset"), x["length"].alias("length"))).alias("pieces"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: all documents in sequences of 4096 tokens at most."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
