"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

The agenda of a text holds every pair of adjacent symbols whose concatenation is
a piece; the best-scored pair (then the leftmost) is merged next. With dropout, a
candidate is skipped when a keyed hash of (seed, document, place of the chunk in the text, places of the two symbols)
falls below the rate, so that each occurrence of a word has its own draws. The hash belongs to the candidate, so skipping it when it
is popped is the same as never queueing it: that is how many chunks are merged
at once, one agenda step for all per pass. No merge crosses from a letter to a blank or a
character without piece, so texts are cut there; without dropout each distinct chunk of a
document is merged once. Long chunks use a heap. Rate 0 gives the library's own encoding.

Characters without a piece become byte tokens, and so does U+2581, which a piece can't tell from a
blank; so every text decodes to itself.

Defined results: a null text has null ids and decodes to null, an empty one has none and decodes
to the empty text. Very long texts are encoded whole. Repeated rows (same id and text) are encoded alike, as are those of null ids. An empty table
gives an empty one. Columns named like the results are replaced.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridrisk.llm.textops import U64, _powers, column_bytes, free_name, mix, passed, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RATE, SEED = 0.1, 17
_BLANK, _NONE = 0x2581, np.int32(1 << 30)
#: Chunks of up to so many characters are merged side by side; longer ones one by one.
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 40)
_HASH = U64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Pieces:
    """The vocabulary, as it goes to the tasks (its size is the model's, some 1 MB)."""

    text: list[str]
    order: np.ndarray  # of each piece as a merge result: best first
    byte: np.ndarray  # id of each byte token

    @staticmethod
    def load(path: str = MODEL) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
        text = [model.id_to_piece(i) if plain[i] else "" for i in range(n)]
        rank = np.empty(n, np.int32)
        # equal scores share a rank; the leftmost of them goes first
        _, rank[:] = np.unique([-model.get_score(i) for i in range(n)], return_inverse=True)
        return Pieces(text, rank, np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32))


class Merger:
    """Tables of a vocabulary and the agenda."""

    def __init__(self, pieces: Pieces):
        self.pieces, ids = pieces, {p: i for i, p in enumerate(pieces.text) if p}
        self.rank = pieces.order
        left, right, out = [], [], []
        for p, i in ids.items():
            for cut in range(1, len(p)):
                a, b = ids.get(p[:cut]), ids.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    out.append(i)
        keys = np.array(left, U64) << U64(20) | np.array(right, U64)
        self.bits = 19
        self.keys, self.made = np.full(1 << self.bits, 0xFFFFFFFFFFFFFFFF, U64), np.full(1 << self.bits, -1, np.int32)
        at = (keys * _HASH >> U64(64 - self.bits)).astype(np.int64)
        for k, slot, i in zip(keys.tolist(), at.tolist(), out, strict=True):
            while self.made[slot] >= 0:
                slot = (slot + 1) % (1 << self.bits)
            self.keys[slot], self.made[slot] = k, i
        self.single = np.full(0x110001, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.single[ord(p)] = i
        self.single[0x20], self.single[_BLANK] = self.single[_BLANK], -1
        self.blank = int(self.single[0x20])
        self.bytes = [p.replace("▁", " ").encode() for p in pieces.text]
        for b, i in enumerate(pieces.byte):
            self.bytes[i] = bytes([b])

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, or -1."""
        key = a.astype(U64) << U64(20) | b.astype(U64)
        slot = (key * _HASH >> U64(64 - self.bits)).astype(np.int64)
        out = np.where(self.keys[slot] == key, self.made[slot], np.int32(-1))
        todo = np.flatnonzero((out < 0) & (self.made[slot] >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            hit = self.keys[slot[todo]] == key[todo]
            out[todo[hit]] = self.made[slot[todo[hit]]]
            todo = todo[~hit & (self.made[slot[todo]] >= 0)]
        return out

    @staticmethod
    def dropped(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, limit: int) -> np.ndarray:
        """Whether the keyed hash skips the candidate [start, middle) + [middle, end) of a chunk."""
        place = (start.astype(U64) << U64(42)) ^ (middle.astype(U64) << U64(21)) ^ end.astype(U64)
        return (mix(key ^ mix(place + U64(1))) >> U64(32)) < U64(limit)

    def together(self, sym: np.ndarray, size: np.ndarray, key: np.ndarray, limit: int) -> np.ndarray:
        """Symbols (chunk x place, -1: no symbol starts here) after all merges."""
        n, width = sym.shape
        sym, final = sym.copy(), np.full((n, width), -1, np.int32)
        after = np.minimum(np.arange(1, width + 1, dtype=np.int16), size[:, None].astype(np.int16))
        before = np.tile(np.arange(-1, width - 1, dtype=np.int16), (n, 1))
        made = np.full((n, width), -1, np.int32)
        row, col = np.nonzero((np.arange(width) + 1 < size[:, None]))
        made[row, col] = self._candidates(sym[row, col], sym[row, col + 1], key[row], col, col + 1, col + 2, limit)
        rank = np.where(made >= 0, self.rank[made], _NONE)
        live = np.arange(n)
        while len(live):
            j = rank.argmin(axis=1)
            r = np.arange(len(live))
            going = rank[r, j] < _NONE
            if not going.all():
                if going.sum() < 0.7 * len(live) or not going.any():
                    final[live[~going]] = sym[~going]
                    live, sym, after, before, made, rank, size, key = (x[going] for x in (live, sym, after, before, made, rank, size, key))
                    j, r = j[going], np.arange(len(live))
                else:
                    r, j = r[going], j[going]
            if not len(r):
                continue
            k = after[r, j].astype(np.int64)
            end = after[r, k].astype(np.int64)
            sym[r, j] = made[r, j]
            sym[r, k] = -1
            rank[r, k] = _NONE
            rank[r, j] = _NONE
            after[r, j] = end
            # the new symbol's pairs with what follows and what precedes
            has = np.flatnonzero(end < size[r])
            rr, jj, ee = r[has], j[has], end[has]
            before[rr, ee] = jj
            got = self._candidates(sym[rr, jj], sym[rr, ee], key[rr], jj, ee, after[rr, ee], limit)
            made[rr, jj] = got
            rank[rr, jj] = np.where(got >= 0, self.rank[got], _NONE)
            prev = before[r, j].astype(np.int64)
            has = np.flatnonzero(prev >= 0)
            rr, jj, pp = r[has], j[has], prev[has]
            got = self._candidates(sym[rr, pp], sym[rr, jj], key[rr], pp, jj, after[rr, jj], limit)
            made[rr, pp] = got
            rank[rr, pp] = np.where(got >= 0, self.rank[got], _NONE)
        return final

    def _candidates(self, a, b, key, start, middle, end, limit: int) -> np.ndarray:
        got = self.pair(a, b)
        if limit:
            at = np.flatnonzero(got >= 0)
            gone = self.dropped(key[at], start[at], middle[at], end[at], limit)
            got[at[gone]] = -1
        return got

    def alone(self, sym: np.ndarray, key: np.uint64, limit: int) -> np.ndarray:
        """The same for one long chunk, with a heap."""
        n = len(sym)
        sym, after, before = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []
        keys = np.array([key], U64)

        def offer(start, middle, end):
            got = self._candidates(*(np.array(x) for x in ([sym[i] for i in start], [sym[i] for i in middle])), np.repeat(keys, len(start)), np.array(start), np.array(middle), np.array(end), limit)
            return [(int(self.rank[g]), s, m, e, int(g)) for g, s, m, e in zip(got.tolist(), start, middle, end, strict=True) if g >= 0]

        heap = offer([*range(n - 1)], [*range(1, n)], [*range(2, n + 1)])
        heapq.heapify(heap)
        while heap:
            _, s, m, e, g = heapq.heappop(heap)
            if sym[s] < 0 or sym[m] < 0 or after[s] != m or after[m] != e:
                continue  # a symbol has changed since
            sym[s], sym[m], after[s] = g, -1, e
            near = [(s, e, after[e])] if e < n else []
            if e < n:
                before[e] = s
            if before[s] >= 0:
                near.append((before[s], s, e))
            if near:
                for x in offer(*map(list, zip(*near, strict=True))):
                    heapq.heappush(heap, x)
        return np.array(sym, np.int32)

    def encode(self, col: pa.Array, doc_keys: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, offsets) of a text column."""
        raw, _ = column_bytes(col)
        codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        chars = np.asarray(pc.fill_null(pc.utf8_length(col), 0)).astype(np.int64)
        n_docs = len(chars)
        # a blank before each text
        lead = (chars > 0).astype(np.int64)
        doc = np.repeat(np.arange(n_docs), chars + lead)
        full = np.full(len(doc), 0x20, np.int64)
        begin = np.cumsum(chars + lead) - (chars + lead)
        body = np.ones(len(doc), bool)
        body[begin[lead > 0]] = False
        full[body] = codes
        if not len(full):
            return np.zeros(0, np.int32), np.zeros(n_docs + 1, np.int64)
        sym = self.single[full]
        odd, blank = sym < 0, full == 0x20
        cut = np.ones(len(full), bool)
        cut[1:] = (doc[1:] != doc[:-1]) | odd[1:] | odd[:-1] | (blank[1:] & ~blank[:-1])
        starts = np.flatnonzero(cut)
        size = np.diff(np.append(starts, len(full)))
        limit = int(rate * (1 << 32))
        if limit:  # each occurrence by itself
            key = mix(mix((starts - begin[doc[starts]]).astype(U64) + U64(3)) ^ doc_keys[doc[starts]])
            one = which = np.arange(len(starts))
        else:  # distinct chunks
            p, q = _powers(len(full) + 1)
            sums = np.zeros(len(full) + 1, U64)
            np.cumsum(mix(full.astype(U64) + U64(7)) * p[: len(full)], out=sums[1:])
            key = mix((sums[starts + size] - sums[starts]) * q[starts] + size.astype(U64) * _HASH)
            _, one, which = np.unique(key, return_index=True, return_inverse=True)
        s, z, k, odd_chunk = starts[one], size[one], key[one], odd[starts[one]]
        count, parts, row_of = np.zeros(len(one), np.int64), [], np.zeros(len(one), np.int64)
        filled = 0
        low = 0
        for width in WIDTHS:
            rows = np.flatnonzero((z > low) & (z <= width) & ~odd_chunk)
            low = width
            for lo in range(0, len(rows), 40_000):
                own = rows[lo : lo + 40_000]
                at = s[own, None] + np.arange(width)
                got = self.together(np.where(np.arange(width) < z[own, None], sym[np.minimum(at, len(sym) - 1)], -1), z[own], k[own], limit)
                count[own] = (got >= 0).sum(axis=1)
                row_of[own] = filled + np.cumsum(count[own]) - count[own]
                parts.append(got[got >= 0])
                filled += len(parts[-1])
        for i in np.flatnonzero((z > low) | odd_chunk):
            if odd_chunk[i]:
                got = self.pieces.byte[list(chr(int(full[s[i]])).encode())]
            else:
                got = self.alone(sym[s[i] : s[i] + z[i]], k[i], limit)
                got = got[got >= 0]
            count[i], row_of[i] = len(got), filled
            parts.append(got)
            filled += len(got)
        flat, n_of = np.concatenate(parts), count[which]
        total = np.cumsum(n_of)
        ids = flat[np.repeat(row_of[which] - (total - n_of), n_of) + np.arange(total[-1])]
        upto = np.concatenate([[0], total])
        return ids, upto[np.searchsorted(starts, np.append(begin, len(full)))]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a document's ids, without the blank put before it."""
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))[1:]


_MERGERS: dict[int, Merger] = {}


def _merger(pieces: Pieces) -> Merger:
    key = hash((len(pieces.text), zlib.crc32("\n".join(pieces.text).encode())))
    if key not in _MERGERS:
        _MERGERS[key] = Merger(pieces)
    return _MERGERS[key]


def encode(docs: DataFrame, pieces: Pieces, doc_id: str = "doc_id", text: str = "text", rate: float = RATE, seed: int = SEED, digest: bool = False) -> DataFrame:
    """docs with `ids` (array<int>); digest: n_tokens, n_byte_tokens, ids_crc32, text_crc32, lossless instead, after decoding the ids again."""
    fields = [T.StructField(n, t) for n, t in (("n_tokens", T.LongType()), ("n_byte_tokens", T.LongType()), ("ids_crc32", T.LongType()), ("text_crc32", T.LongType()), ("lossless", T.BooleanType()))] if digest else [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    base = docs.drop(*(f.name for f in fields))
    own_key = free_name(base, "_bpe_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(pieces)
        is_byte = np.zeros(len(pieces.text), np.int64)
        is_byte[pieces.byte] = 1
        for b in slices(batches, text):
            col = b.column(b.schema.get_field_index(text))
            keys = np.asarray(b.column(b.schema.get_field_index(own_key))).view(U64)
            ids, cut = merger.encode(col, keys, rate)
            b = b.drop_columns([own_key])
            if digest:
                raw, offs = column_bytes(col)
                blob, n = raw.tobytes(), b.num_rows
                back = [merger.decode(ids[cut[i] : cut[i + 1]]) for i in range(n)]
                upto = np.concatenate([[0], np.cumsum(is_byte[ids])])
                crc = [zlib.crc32(ids[cut[i] : cut[i + 1]].astype("<i4").tobytes()) for i in range(n)]
                yield passed(b, n_tokens=np.diff(cut), n_byte_tokens=upto[cut[1:]] - upto[cut[:-1]], ids_crc32=np.array(crc, np.int64), text_crc32=np.array([zlib.crc32(x) for x in back], np.int64), lossless=np.array([x == blob[offs[i] : offs[i + 1]] for i, x in enumerate(back)], bool))
            else:
                lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=pc.is_null(col))
                yield passed(b, ids=lists)

    keyed = base.withColumn(own_key, F.xxhash64(F.lit(seed), F.col(doc_id)))
    return keyed.mapInArrow(run, T.StructType([*base.schema.fields, *fields]))


def decode(docs: DataFrame, pieces: Pieces, ids: str = "ids", text: str = "text") -> DataFrame:
    """docs with the text of their ids; bytes that aren't UTF-8 are replaced."""
    base = docs.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(pieces)
        for b in batches:
            lists = b.column(b.schema.get_field_index(ids)).to_pylist()
            yield passed(b, **{text: pa.array([None if x is None else merger.decode(np.array(x, np.int64)).decode("utf-8", "replace") for x in lists], pa.string())})

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(text, T.StringType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every document encoded with dropout and decoded again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, Pieces.load(), digest=True).drop("text")
