"""Language-model scoring by a hidden Markov model with Baum-Welch training.

Tokens are the lower-cased words and one end. Every token has a class, a hash of
its last bytes (of the whole word if short); the end has class 0. The model:
a hidden state chain emits classes, a class emits the token:

    P(text) = sum over state paths of prod A[s, s'] * B[s', class] * (c + 1) / (N_class + V_class + 1)

c is the token's training count, N_class and V_class the class's training tokens and
types, and the 1 keeps room for unknown tokens, so that a class's emissions sum to 1.

* Word counts: each task counts its words, Spark sums by word; counts are joined back to the words of each chunk and summed by document. All
  of this follows the vocabulary, nothing of it reaches the driver but a row per class. Counts of words that make up
  more than one token in HOT_WORDS (so there are fewer than HOT_WORDS) are broadcast, so no frequent word is a join key.
* Baum-Welch: forward-backward over the whole class sequences of all training documents gives expected counts per partition; Spark sums
  them; ITERATIONS rounds over all data. Sequences over SPAN tokens are worked through in pieces side by side: the product of a piece's
  step matrices carries alpha into the next piece and beta into the one before, so counts don't depend on SPAN.
* The start of the emissions also comes from all training documents: a state's class counts are those of the documents on one side of
  keyed random planes through the mean class profile, then (REGROUPED passes) those of the documents that it makes likeliest.
* Scoring: the scaled forward recursion over each whole sequence, exact.

Defined results: null and empty texts are the end token alone; very long texts are read whole. Repeated rows are each
scored; they all count in training. Ids may be null (such rows are told apart by 64 bits of a text hash) and are cast to long (what isn't
a number: null). Without training rows all counts are 0. An empty table gives an empty one. Other columns than id, text and held_out don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridrisk.llm.textops import U64, Prints, column_bytes, crc_mod, lower_ascii, mix, slices, stored, words

CLASSES, STATES, ITERATIONS, SPAN = 4096, 8, 4, 1024
#: Tokens that forward-backward works on at once.
BATCH = 400_000
HOT_WORDS = 1 << 16
#: Passes that move each document to the starting state that makes it likeliest.
REGROUPED = 3
#: Tokens that a chunk holds before its words are counted and put out.
CHUNK = 2_500_000
END = 0x1B873593CC9E2D51
_FIX = 10**9


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, class, document) of each text's tokens, the end included."""
    raw, offs = column_bytes(col)
    raw = lower_ascii(raw)
    starts, ends, first = words(raw, offs)
    prints = Prints(raw)
    long_ = ends - starts > 5
    tail = prints.of(np.where(long_, ends - 3, starts), ends) ^ long_.astype(U64)
    n_docs = len(offs) - 1
    count = np.diff(first) + 1
    doc = np.repeat(np.arange(n_docs), count)
    close = np.cumsum(count) - 1
    is_word = np.ones(len(doc), bool)
    is_word[close] = False
    hashes, classes = np.full(len(doc), END, U64), np.zeros(len(doc), np.int16)
    hashes[is_word] = prints.of(starts, ends)
    classes[is_word] = (mix(tail) % U64(CLASSES - 1) + U64(1)).astype(np.int16)
    return hashes, classes, doc


# --------------------------------------------------------------------------- counts
def _chunk_rows(chunk: int, hashes: np.ndarray, classes: np.ndarray, doc: np.ndarray, train: np.ndarray, ids: list, tags: list) -> pa.RecordBatch:
    order = np.lexsort((doc, hashes))
    h, d, c = hashes[order], doc[order], classes[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    h, d, c = h[at], d[at], c[at]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    offs = pa.array(np.append(first, len(h)).astype(np.int32))
    n_train = np.add.reduceat(tf * train[d], first)
    end = h[first] == U64(END)
    where = pa.array([ids if x else None for x in end], pa.list_(pa.int64())), pa.array([tags if x else None for x in end], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(h[first].view(np.int64)), pa.array(c[first]), pa.array(n_train), pa.array(np.full(len(first), chunk, np.int64)), pa.ListArray.from_arrays(offs, pa.array(d.astype(np.int32))), pa.ListArray.from_arrays(offs, pa.array(tf.astype(np.int32))), *where],
        names=["word", "cls", "n", "chunk", "docs", "tfs", "ids", "tags"],
    )


def _chunked(docs: DataFrame) -> DataFrame:
    """A row for each word and chunk: its training count there and the documents that hold it (the end's row names the chunk's documents)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held, ids, tags = TaskContext.get().partitionId(), 0, [], [], []
        held_n = 0

        def out() -> pa.RecordBatch:
            return _chunk_rows(part * (1 << 24) + nth, *(np.concatenate(x) for x in zip(*[t[:4] for t in held], strict=True)), ids, tags)

        for b in slices(batches, "_text"):
            h, c, d = tokens(b.column(b.schema.get_field_index("_text")))
            train = ~np.asarray(b.column(b.schema.get_field_index("_held")))
            held.append((h, c, d + len(ids), train.astype(np.int64)))
            ids += b.column(b.schema.get_field_index("_id")).to_pylist()
            tags += b.column(b.schema.get_field_index("_tag")).to_pylist()
            held_n += len(h)
            if held_n >= CHUNK:
                yield out()
                nth, held, ids, tags, held_n = nth + 1, [], [], [], 0
        if held:
            yield out()

    return docs.mapInArrow(run, "word bigint, cls smallint, n bigint, chunk bigint, docs array<int>, tfs array<int>, ids array<bigint>, tags array<bigint>")


def _sums(docs: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(by document: sum of log10(c + 1) in fixed point, tokens known), and by class N and V."""
    rows = stored(_chunked(docs), "lm-words")
    counts = stored(rows.groupBy("word", "cls").agg(F.sum("n").alias("c")).where("c > 0"), "lm-counts")
    n, v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counts.groupBy("cls").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():  # a row per class
        n[r["cls"]], v[r["cls"]] = r["n"], r["v"]
    held, known = rows.select("word", "chunk", "docs", "tfs"), counts.select("word", "c")
    hot = F.broadcast(known.where(F.col("c") * HOT_WORDS > int(n.sum())))  # fewer than HOT_WORDS rows
    rare = known.where(F.col("c") * HOT_WORDS <= int(n.sum()))
    seen = held.join(hot, "word").unionByName(held.join(hot, "word", "left_anti").join(rare.hint("merge"), "word"))
    each = seen.select("chunk", F.round(F.log10(F.col("c") + 1) * _FIX).cast("long").alias("gain"), F.explode(F.arrays_zip("docs", "tfs")).alias("x"))
    sums = each.groupBy("chunk", F.col("x.docs").alias("doc")).agg(F.sum(F.col("gain") * F.col("x.tfs")).alias("gain"), F.sum("x.tfs").alias("n_known"))
    names = rows.where(F.col("word") == np.array([END], U64).view(np.int64)[0].item()).select("chunk", F.posexplode(F.arrays_zip("ids", "tags")).alias("doc", "x")).select("chunk", "doc", F.col("x.ids").alias("_id"), F.col("x.tags").alias("_tag"))
    return names.join(sums, ["chunk", "doc"], "left").select("_id", "_tag", F.coalesce("gain", F.lit(0)).alias("gain"), F.coalesce("n_known", F.lit(0)).alias("n_known")), n, v


# --------------------------------------------------------------------------- Baum-Welch
def _pieces(seqs: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of up to size tokens, longest first: (tokens by time and piece, pieces that have a token at each time, sequence, place in it)."""
    cut = [(s[i : i + size], q, i // size) for q, s in enumerate(seqs) for i in range(0, len(s), size)]
    length = np.array([len(x) for x, _, _ in cut])
    order = np.argsort(-length, kind="stable")
    length = length[order]
    live = len(cut) - np.searchsorted(length[::-1], np.arange(length.max(initial=0)), side="right")
    tokens_ = np.concatenate([cut[i][0] for i in order]) if len(cut) else np.zeros(0, np.int16)
    time = np.arange(len(tokens_)) - np.repeat(np.cumsum(length) - length, length)
    return tokens_[np.argsort(time, kind="stable")], live, *(np.array([cut[i][j] for i in order], np.int64) for j in (1, 2))


def _borders(start: np.ndarray, a: np.ndarray, table: np.ndarray, obs: np.ndarray, live: np.ndarray, seq: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(alpha at the end of the piece before, beta at the own end; scaled so that alpha * beta sums to 1 there) of each piece."""
    n, k = len(seq), len(start)
    before, after = np.full((n, k), 1 / k, np.float32), np.ones((n, k), np.float32)
    many = np.flatnonzero(np.bincount(seq, minlength=1)[seq] > 1)
    if not len(many):
        return before, after
    # products of the step matrices of these pieces: row i goes in with state i (a sequence's first piece goes in with any)
    at, upto = np.concatenate([[0], np.cumsum(live)]), np.searchsorted(many, live)
    scaled = table / table.max(axis=1, keepdims=True)
    first = scaled[obs[many]][:, None, :]
    through = np.where((nth[many] == 0)[:, None, None], start, a) * first
    for t in range(1, len(live)):
        m = upto[t]
        if not m:
            break
        x = (through[:m].reshape(-1, k) @ a).reshape(m, k, k) * scaled[obs[at[t] + many[:m]]][:, None, :]
        through[:m] = x / x.sum(axis=(1, 2), keepdims=True) if t % 8 == 0 else x
    through /= through.sum(axis=(1, 2), keepdims=True)
    row = np.lexsort((nth[many], seq[many]))  # places among `many`, sequence by sequence
    of = nth[many][row]
    for j in range(1, of.max() + 1):
        now = np.flatnonzero(of == j)
        x = np.einsum("pi,pij->pj", before[many[row[now - 1]]], through[row[now - 1]])
        before[many[row[now]]] = x / x.sum(axis=1, keepdims=True)
    for j in range(of.max(), 0, -1):
        now = np.flatnonzero(of == j)
        x = np.einsum("pij,pj->pi", through[row[now]], after[many[row[now]]])
        after[many[row[now - 1]]] = x / (x * before[many[row[now]]]).sum(axis=1, keepdims=True)
    return before, after


def expected_counts(start: np.ndarray, move: np.ndarray, emit: np.ndarray, obs: np.ndarray, live: np.ndarray, seq: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions (states x classes) of whole sequences in pieces, by scaled forward-backward."""
    k, steps = len(start), len(live)
    table = np.ascontiguousarray(emit.T.astype(np.float32))
    a, first, ones = move.astype(np.float32), start.astype(np.float32), np.ones(k, np.float32)
    before, beta = _borders(first, a, table, obs, live, seq, nth)
    at, fresh = np.concatenate([[0], np.cumsum(live)]).astype(np.int64), nth == 0
    alpha, scale = np.zeros((len(obs), k), np.float32), np.ones(len(obs), np.float32)
    for t in range(steps):
        lo, hi = at[t], at[t + 1]
        x = table[obs[lo:hi]] * (np.where(fresh[:, None], first, before @ a) if t == 0 else alpha[at[t - 1] : at[t - 1] + hi - lo] @ a)
        scale[lo:hi] = x @ ones
        alpha[lo:hi] = x / scale[lo:hi, None]
    moves = np.zeros((k, k))
    for t in range(steps - 1, -1, -1):  # alpha turns into gamma
        lo, hi = at[t], at[t + 1]
        m = hi - lo
        gamma = alpha[lo:hi] * beta[:m]
        ahead = table[obs[lo:hi]] * beta[:m] / scale[lo:hi, None]
        came = alpha[at[t - 1] : at[t - 1] + m] if t else np.where(fresh[:, None], np.float32(0), before)
        moves += (came.T @ ahead) * a
        beta[:m] = ahead @ a.T
        alpha[lo:hi] = gamma
    emits = np.stack([np.bincount(obs, weights=alpha[:, i], minlength=emit.shape[1]) for i in range(k)])
    begins = alpha[: at[1]][fresh].sum(axis=0).astype(np.float64) if steps else np.zeros(k)
    return begins, moves, emits


def _step(seqs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One Baum-Welch round: counts by partition, summed by Spark in fixed point."""
    k = STATES
    width = 1 + k + CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width))
        for b in batches:
            for parts in _some(b.column(0)):
                begins, moves, emits = expected_counts(*model, *_pieces(parts, SPAN))
                total += np.concatenate([begins[:, None], moves, emits], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array([np.rint(x * 1e6).astype(np.int64) for x in total], pa.list_(pa.int64()))], names=["state", "x"])

    total = _summed(seqs.select("seq").mapInArrow(run, "state int, x array<bigint>"), k, width) / 1e6
    return total[:, 0], total[:, 1 : 1 + k], total[:, 1 + k :]


def _some(col: pa.Array) -> Iterator[list[np.ndarray]]:
    """Sequences of a column, some BATCH tokens at a time (a longer one by itself)."""
    held, n = [], 0
    for x in col.to_pylist():
        held.append(np.frombuffer(x, np.int16))
        n += len(held[-1])
        if n >= BATCH:
            yield held
            held, n = [], 0
    if held:
        yield held


def _summed(rows: DataFrame, k: int, width: int) -> np.ndarray:
    """Sums of (state, x array) rows: k x width numbers at most."""
    got = rows.select("state", F.posexplode("x").alias("i", "x")).where("x > 0").groupBy("state", "i").agg(F.sum("x").alias("x")).toPandas()
    total = np.zeros((k, width))
    total[got["state"].to_numpy(), got["i"].to_numpy()] = got["x"].to_numpy()
    return total


def _guess(seqs: DataFrame) -> np.ndarray:
    """Emissions to start from: class counts of the documents in each of STATES cells between keyed planes through the mean profile."""

    def run(side: Callable[[np.ndarray, np.ndarray], np.ndarray], k: int) -> np.ndarray:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, CLASSES), np.int64)
            for b in batches:
                for parts in _some(b.column(0)):
                    flat, size = np.concatenate(parts).astype(np.int64), np.array([len(x) for x in parts])
                    cell = side(flat, np.cumsum(size) - size) if k > 1 else np.zeros(len(parts), np.int64)
                    total += np.bincount(np.repeat(cell, size) * CLASSES + flat, minlength=k * CLASSES).reshape(k, CLASSES)
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(total), pa.list_(pa.int64()))], names=["state", "x"])

        return _summed(seqs.select("seq").mapInArrow(count, "state int, x array<bigint>"), k, CLASSES)

    mean = run(lambda flat, first: flat, 1)[0]
    mean = (mean + 0.5) / (mean.sum() + 0.5 * CLASSES)
    planes = max(1, int(np.ceil(np.log2(STATES))))
    keyed = mix(np.arange(planes * CLASSES, dtype=U64) + U64(0x51ED270B)).reshape(planes, CLASSES) >> U64(63)
    weight = np.where(keyed == 1, 1.0, -1.0) / np.sqrt(mean)
    weight -= (weight @ mean)[:, None]

    def cells(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
        above = np.add.reduceat(weight[:, flat], first, axis=1) > 0
        return (above.T @ (1 << np.arange(planes))) % STATES

    counts = run(cells, STATES)
    for _ in range(REGROUPED):
        likely = np.log(_smoothed(counts, mean))
        counts = run(lambda flat, first, likely=likely: np.add.reduceat(likely[:, flat], first, axis=1).argmax(axis=0), STATES)
    return _smoothed(counts, mean)


def _smoothed(counts: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return (counts + 20 * mean) / (counts.sum(axis=1, keepdims=True) + 20)


def baum_welch(seqs: DataFrame, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, move, emit) from the class sequences of all training rows."""
    start, move, emit = np.full(STATES, 1 / STATES), np.full((STATES, STATES), 0.1 / STATES) + np.eye(STATES) * 0.9, _guess(seqs)
    for _ in range(iterations):
        begins, moves, emits = _step(seqs, (start, move, emit))
        start = (begins + 0.1) / (begins + 0.1).sum()
        move = (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True)
        share = (emits.sum(axis=0) + 0.01) / (emits.sum() + 0.01 * CLASSES)
        emit = emits + 20 * share
        emit /= emit.sum(axis=1, keepdims=True)
    return start, move, emit


def forward(start: np.ndarray, move: np.ndarray, emit: np.ndarray, seqs: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each whole sequence, by the scaled forward recursion over all of them at once."""
    length = np.array([len(s) for s in seqs])
    order = np.argsort(-length, kind="stable")
    flat = np.concatenate([seqs[i] for i in order]) if len(seqs) else np.zeros(0, np.int16)
    at = np.concatenate([[0], np.cumsum(length[order])])[:-1]
    table, a = np.ascontiguousarray(emit.T), move
    out, ones = np.zeros(len(seqs)), np.ones(len(start))
    alpha = None
    live = len(seqs) - np.searchsorted(length[order][::-1], np.arange(length.max(initial=0)), side="right")
    for t, m in enumerate(live):
        x = table[flat[at[:m] + t]] * (start if t == 0 else alpha[:m] @ a)
        scale = x @ ones
        alpha = x / scale[:, None]
        out[:m] += np.log10(scale)
    back = np.zeros(len(seqs))
    back[order] = out
    return back


# --------------------------------------------------------------------------- operator
def _sequences(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            _, c, d = tokens(b.column(b.schema.get_field_index("_text")))
            cut = np.searchsorted(d, np.arange(b.num_rows + 1))
            cols = [b.column(b.schema.get_field_index(x)) for x in ("_id", "_tag", "_held")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([c[cut[i] : cut[i + 1]].tobytes() for i in range(b.num_rows)], pa.binary())], names=["_id", "_tag", "_held", "seq"])

    return docs.mapInArrow(run, "_id bigint, _tag bigint, _held boolean, seq binary")


def score(docs: DataFrame, held_out: str, doc_id: str = "doc_id", text: str = "text", iterations: int = ITERATIONS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; rows with held_out aren't learned from."""
    own = docs.select(F.col(doc_id).try_cast("long").alias("_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_tag"), F.coalesce(F.col(held_out), F.lit(False)).alias("_held"), F.col(text).alias("_text"))
    seqs = stored(_sequences(own), "lm-sequences", compression="zstd")
    start, move, emit = baum_welch(seqs.where("not _held"), iterations)
    sums, n, v = _sums(own)
    room = np.log10(n + v + 1.0)
    n_all, v_all = int(n.sum()), int(v.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [np.frombuffer(x, np.int16) for x in b.column(3).to_pylist()]
            if not parts:
                continue
            flat = np.concatenate(parts)
            size = np.array([len(x) for x in parts])
            less = np.add.reduceat(room[flat], np.concatenate([[0], np.cumsum(size)])[:-1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(size), pa.array(forward(start, move, emit, parts) - less)], names=["_id", "_tag", "_held", "n_tokens", "chain"])

    chains = seqs.mapInArrow(run, "_id bigint, _tag bigint, _held boolean, n_tokens bigint, chain double").dropDuplicates(["_id", "_tag"])
    both = sums.alias("s").join(chains.alias("c"), F.expr("s._id <=> c._id and s._tag = c._tag"))
    gain = F.col("gain") / F.lit(float(_FIX))
    return both.select(
        F.col("s._id").alias("doc_id"), F.col("_held").alias("held_out"), "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
        (gain - F.col("n_tokens") * float(np.log10(n_all + v_all + 1.0))).alias("base_score"), (gain + F.col("chain")).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: unigram base and hidden Markov score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").withColumn("held_out", crc_mod("doc_id", 7) == 2)
    return score(docs, "held_out")
