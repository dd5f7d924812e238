"""Hard negatives, vector codes and packing against plain loops and SQL, with odd rows."""

import hashlib
import itertools
import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_llm_operators import odd
from tokenizers import Tokenizer

from gridrisk.llm import hard_negatives, packing, vector_codes, vectors

NAN, INF = float("nan"), float("inf")


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def odd_vectors(spark, n=160, width=10):
    """Ties, repeats, nulls, values that aren't finite, unequal and empty vectors, hot labels, and columns that clash."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 0.4, width), 1)], int(i % 3 > 0) if i % 9 else 4) for i in range(n)]
    rows += [(i, rows[0][1], 1) for i in range(200, 230)]  # one vector very often
    rows += [(100, rows[100][1], rows[100][2]), (100, rows[101][1], 7), (21, rows[21][1], rows[21][2]), (None, rows[3][1], 1), (300, None, 1), (301, [0.5, None], 1), (302, [NAN] * width, 0), (303, [INF, 1.0], 0)]
    rows += [(304, rows[5][1], None), (305, [], 1), (306, [0.25, -0.5], 0), (-100, rows[7][1], 1), (400, [-x for x in rows[0][1]], 0), (307, [-1e-9] * width, 4)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS id", "2 AS score", "'k' AS key", "3 AS vector", "4 AS nth", "5 AS entry", "6 AS error", "7 AS code", "8 AS rank")


# --------------------------------------------------------------------------- hard negatives
def plain_negatives(rows, step):
    kept = [(i, [math.floor(256 * x) for x in v], str(t)) for i, v, t in rows if i is not None and t is not None and usable(v)]
    out = []
    for a, v, t in kept:
        if a % step:
            continue
        scored = sorted((-sum(x * y for x, y in itertools.zip_longest(v, w, fillvalue=0)), i, u) for i, w, u in kept if i != a)
        for s, p, _ in [x for x in scored if x[2] == t][:5]:
            fit = [x for x in scored if x[2] != t and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, p, k + 1, i, -s, -x) for k, (x, i, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_by_plain_sorts(spark, monkeypatch, small):
    if small:  # several passes, blocks and prunings
        for name, value in (("ANCHOR_BYTES", 500), ("ROWS", 7), ("ANCHORS", 2), ("HELD", 20)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows, df = odd_vectors(spark)
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(df.repartition(5), F.col("vec_id") % 7 == 0).collect())
    want = plain_negatives(rows, 7)
    assert got == want and len(want) > 200 and len([r for r in want if r[0] == 21]) > len({r for r in want if r[0] == 21})  # 21 is there twice


def test_hard_negatives_empty(spark):
    _, df = odd_vectors(spark)
    assert hard_negatives.hard_negatives(df.limit(0), F.lit(True)).isEmpty()
    assert hard_negatives.hard_negatives(df.where("vec_id in (300, 301, 302, 303, 304)"), F.lit(True)).isEmpty()
    assert hard_negatives.hard_negatives(df.where("label = 1"), F.lit(True)).isEmpty()  # no other label
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(df, F.lit(True), low=90, high=101)


def test_keys_sort_as_bytes_and_large_scores_are_exact():
    rng = np.random.default_rng(3)
    rows = [tuple(int(x) for x in rng.integers(-3, 4, 3)) for _ in range(200)]
    anchor, score, ids = (np.array(c, np.int64) * (1 << 40) for c in zip(*rows, strict=True))
    keys = [k for o in (0, 1) for k in hard_negatives.packed(anchor, np.zeros(200, np.int64), score, o, ids).to_pylist()]
    back = [hard_negatives.unpacked(k) for k in sorted(keys)]
    assert back == sorted(back, key=lambda r: (r[0], r[1], -r[2], r[3], r[4])) and len(back) == 400
    a, b = np.array([[1e8 + 1, -3.0]]), np.array([[1e8 + 3, 5.0]])
    assert vectors.products(a, b)[0, 0] == (10**8 + 1) * (10**8 + 3) - 15
    with pytest.raises(ValueError):
        vectors.products(np.array([[1e15]]), np.array([[1e15]]))


# --------------------------------------------------------------------------- vector codes
def plain_codes(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v], t) for i, v, t in rows if usable(v)]
    w = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (parts * w - len(v)), t) for i, v, t in kept]
    raw = {id(r): r for r in kept}
    first = sorted(raw.values(), key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][j * w : (j + 1) * w] for r in first] for j in range(parts)]

    def nearest(p, book):
        return min((sum((x - y) ** 2 for x, y in zip(p, c, strict=True)), e) for e, c in enumerate(book))

    for turn in range(rounds + 1):
        got = [[nearest(v[j * w : (j + 1) * w], books[j]) for j in range(parts)] for _, v, _ in kept]
        for j in range(parts) if turn < rounds else ():
            for e in range(len(books[j])):
                own = [v[j * w : (j + 1) * w] for (_, v, _), g in zip(kept, got, strict=True) if g[j][1] == e]
                if own:
                    books[j][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    total = defaultdict(int)
    for (_, _, t), g in zip(kept, got, strict=True):
        total[t] += sum(d for d, _ in g)
    return sorted(((i, "".join(f"{e:02x}" for _, e in g), sum(d for d, _ in g), total[t], digest) for (i, _, t), g in zip(kept, got, strict=True)), key=str)


@pytest.mark.parametrize(("parts", "entries", "rounds", "scale"), [(8, 16, 6, 4096), (3, 5, 9, 64), (1, 1, 2, 7), (4, 100, 3, 4096), (2, 6, 4, 1 << 50)])
def test_vector_codes_by_plain_rounds(spark, parts, entries, rounds, scale):
    rows, df = odd_vectors(spark)
    got = vector_codes.codes(df.repartition(3), parts=parts, entries=entries, rounds=rounds, scale=scale) if scale < 1 << 50 else None
    if got is None:  # distances of over 64 bits: codes are exact, their sum raises or is null, so it is read as it is stored
        state, books, _ = vector_codes.fitted(df, parts=parts, entries=entries, rounds=rounds, scale=scale)
        code = {(r["id"], "".join(f"{e:02x}" for e in r["entry"]), int(r["error"])) for r in state.where("totals IS NULL").collect()}
        assert code == {r[:3] for r in plain_codes(rows, parts, entries, rounds, scale)}
        return
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_codes(rows, parts, entries, rounds, scale)


def test_vector_codes_empty_and_few(spark):
    _, df = odd_vectors(spark)
    assert vector_codes.codes(df.limit(0)).isEmpty() and vector_codes.codes(df.where("vec_id in (300, 301, 302)")).isEmpty()
    assert [r["code"] for r in vector_codes.codes(df.where("vec_id = 305")).collect()] == ["00" * 8]


def test_bounds_skip_most_distances_and_net_moves_are_tighter(spark):
    """On the given vectors few parts are measured again in late rounds; a bound by summed moves would measure more."""
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    state, books, work = vector_codes.fitted(df, rounds=12)
    n = state.where("totals IS NULL").count() * vector_codes.PARTS
    assert work[0] == (n, n) and work[-1][1] < 0.4 * n and all(b <= a for a, b in work)
    net = vector_codes.History(books).net
    summed = sum(vector_codes.History._moved(a, b) for a, b in itertools.pairwise(books))
    assert (net[0] <= summed * (1 + 1e-6)).all() and net[0].sum() < 0.9 * summed.sum()


# --------------------------------------------------------------------------- packing
def plain_pieces(texts, size=4096):
    model, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for d, t in texts:
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out += [(d, k, at, len(ids[at : at + size]), zlib.crc32(ids[at : at + size].tobytes())) for k, at in enumerate(range(0, len(ids), size))]
    return sorted(out, key=str)


def placed(rows, size):
    """Checks offsets, gives the number of sequences."""
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= size
    return len(by)


def test_packing_of_the_given_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = packing.query(spark, SMALL).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == plain_pieces([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()])
    assert placed(got, 4096) == packing.least_sequences(np.array([r["length"] for r in got]), 4096)


def test_packing_odd_rows(spark):
    docs = odd(spark).withColumns({"row": F.lit(1), "unit": F.lit(2), "offset": F.lit(3), "piece": F.lit(4), "sequence_id": F.lit(5), "stays": F.lit(6)})
    got = packing.pack(docs, size=64)
    rows = got.collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == plain_pieces([(r["doc_id"], r["text"]) for r in docs.collect()], 64)
    placed(rows, 64)
    assert {(r["doc_id"], r["length"]) for r in rows if r["doc_id"] in (2, 3, 4, 11)} == {(2, 1), (3, 1), (4, 1), (11, 1)}
    assert packing.pack(docs.limit(0)).isEmpty() and packing.pack(docs.limit(0)).columns == got.columns


def test_ids_of_chunks_equal_those_of_whole_texts(monkeypatch):
    rng = np.random.default_rng(8)
    alphabet = ["a", "B", "é", "é", "́", " ", "\n", "\t", " ", " ", "　", "\x1c", "\x85", "'s", "'LL", "İ", "Σ", "ς", "ß", "中", "한", "가", "12", "!?", "🙂", "\x00", "‍", ".", ",", '"', ")", "'", "t", "É", "ÿ", "×", "÷", "À", "—", "ª", "z9", "e"]
    marked = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|start", "oftext|>", "|>"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 40))) for _ in range(1500)] + ["", None, " ", "ΑΣ ΑΣ Σ", "Don't, 'll I've't. É, é. ×, A×. ñ! e\u0301, \u0301."]
    of = packing.Ids("word_bpe_49k.json")
    assert of.of_words and not packing.Ids("byte_bpe_50k.json").of_words
    for more in ([], ["".join(rng.choice(alphabet + marked, rng.integers(0, 40))) for _ in range(600)]):
        texts = texts + more
        ids, ends = of.of(pa.array(texts, pa.string()))
        want = [of.model.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(ends.tolist())] == want
    other = packing.Ids("byte_bpe_50k.json")
    ids, ends = other.of(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(ends.tolist())] == [other.model.encode(t or "", add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(packing.Ids, "_same", staticmethod(lambda *_: False))  # as if two chunks shared a fingerprint
    ids, ends = of.of(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(ends.tolist())] == want


def test_packing_long_text(spark):
    rng = np.random.default_rng(2)
    long = " ".join(f"w{x}" for x in rng.integers(0, 10**6, 250_000))
    docs = spark.createDataFrame([(1, long), (2, "short"), (3, "y" * 1_500_000)], "doc_id long, text string")
    got = packing.pack(docs).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == plain_pieces([(r[0], r[1]) for r in docs.collect()])
    placed(got, 4096)


def optimum(lengths, size):
    """The least number of sequences, by search."""
    best = [len(lengths)]

    def place(i, room):
        if len(room) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(room)
            return
        for r in sorted({x for x in room if x >= lengths[i]}):
            rest = list(room)
            rest[rest.index(r)] -= lengths[i]
            place(i + 1, rest)
        place(i + 1, [*room, size - lengths[i]])

    place(0, [])
    return best[0]


def test_bounds_and_best_fit_against_search():
    rng = np.random.default_rng(4)
    tight = 0
    for turn in range(120):
        size = int(rng.integers(6, 40))
        lengths = np.sort(rng.integers(1, size + 1, rng.integers(1, 9)))[::-1]
        least, best = packing.least_sequences(lengths, size), optimum(lengths.tolist(), size)
        bins, offsets = packing.best_fit(lengths, size)
        assert least <= best <= bins.max() + 1
        for b in range(bins.max() + 1):
            own = sorted(zip(offsets[bins == b].tolist(), lengths[bins == b].tolist(), strict=True))
            assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= size
        tight += least == best
    assert tight > 100
    assert packing.least_sequences(np.array([34] * 5), 100) == 3  # two at most in one, by the step at a third
    assert packing.least_sequences(np.array([60, 60, 60]), 100) == 3 and packing.least_sequences(np.zeros(0, np.int64), 100) == 0


def test_units_with_gaps_exchange(spark, monkeypatch):
    """Many small units: exchange saves sequences, loses no piece and never costs one."""
    rng = np.random.default_rng(6)
    texts = [(i, " ".join(["a"] * int(n))) for i, n in enumerate(rng.choice([9, 19, 24, 29, 39, 49, 59], 400))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    used = {}
    monkeypatch.setattr(packing, "UNIT", 8)
    for exchanges in (0, 8):
        monkeypatch.setattr(packing, "EXCHANGES", exchanges)
        got = packing.pack(docs, size=100).collect()
        assert sorted(r["doc_id"] for r in got) == list(range(400))
        used[exchanges] = placed(got, 100)
    least = packing.least_sequences(np.array([len(t.split()) + 1 for _, t in texts]), 100)
    assert least <= used[8] < used[0] and used[8] <= least + 8


def test_sequences_hold_the_ids(spark):
    docs = odd(spark)
    packed = packing.pack(docs, size=64, with_ids=True)
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    whole = defaultdict(list)
    for r in docs.collect():
        whole[r["doc_id"]].append([*model.encode(r["text"] or "", add_special_tokens=False).ids, 1])
    for r in packing.sequences(packed).collect():
        assert len(r["ids"]) == sum(p["length"] for p in r["pieces"]) <= 64
        for p in r["pieces"]:
            part = r["ids"][p["offset"] : p["offset"] + p["length"]]
            assert any(part == ids[p["start"] : p["start"] + p["length"]] for ids in whole[p["doc_id"]])
