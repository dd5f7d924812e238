"""The training-data operators against brute force, SQL, the tokenizer library and held-out labels."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from gridrisk.llm import decontaminate, graph, hmm, language_id, licenses, near_dedup, quality_classifier, quality_rules, registry, sentencepiece_bpe, sharding, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


def odd(spark):
    """Nulls, empty and blank texts, ties, a repeated row, a long text, a shared id, and columns that clash."""
    base = "The quick brown fox jumps over the lazy dog and runs far away from the old farm house today. "
    rows = [(0, base), (1, base), (1, base), (2, None), (3, ""), (4, " \n\t "), (None, base), (5, "x"), (5, base + "!"), (6, base * 300), (7, "é☃\x00 12"), (8, "a" * 5000), (9, "one two three four"), (10, "One two three four"), (11, "  ")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS long) AS n_chars", "1 AS score", "'k' AS kept", "2 AS n_words", "'i' AS ids", "7 AS size", "'u' AS lang_pred", "0 AS predicted", "1 AS _at", "2 AS _id", "3 AS _text", "4 AS _key", "5 AS _tag")


def brute_sets(texts):
    out = {}
    for d, t in texts.items():
        w = WORD.findall((t or "").translate(LOWER))
        out[d] = set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    return out


def brute_components(sets, percent=85):
    at, parent = defaultdict(list), {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d in sets:
        for s in sets[d]:
            at[s].append(d)
    for d in sets:
        shared = Counter(e for s in sets[d] for e in at[s] if e < d)
        for e, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: find(d) for d in sets}


def test_suffix_dedup(spark, texts):
    first, want = {}, {}
    blobs = {d: (t or "").encode() for d, t in sorted(texts.items())}
    for d, b in blobs.items():
        for i in range(len(b) - 49):
            first.setdefault(b[i : i + 50], d)
    for d, b in blobs.items():
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        want[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.query(spark, SMALL).collect()}
    assert got == want and sum(w[1] for w in want.values())


def test_suffix_dedup_periodic(spark):
    docs = spark.createDataFrame([(1, "ab" * 60), (2, "x" + "ab" * 30 + "y"), (3, "a" * 49), (4, "a" * 70), (5, "b" + "a" * 50)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == {1: 0, 2: 60, 3: 0, 4: 0, 5: 50}


def test_suffix_dedup_common_line(spark, monkeypatch):
    rng = np.random.default_rng(6)

    def noise(n):
        return "".join(map(chr, rng.integers(97, 123, n)))

    rows = [(i, noise(60) + "0123456789 a common line 0123456789"[: 20 + i % 16] + noise(60)) for i in range(120)]
    rows += [(200 + i, noise(i) + rows[i][1][30 + i % 7 : 110 + i % 5] + noise(40)) for i in range(40)] + [(300, "a" * 200 + noise(60)), (301, "b" + "a" * 90)]
    plans, write = {}, suffix_dedup.stored

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(suffix_dedup, "stored", seen)
    got = {r["doc_id"]: r["kept"] for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first, want = {}, {}
    for d, t in rows:
        for i in range(len(t) - 49):
            first.setdefault(t[i : i + 50], d)
    for d, t in rows:
        gone = {j for i in range(len(t) - 49) if first[t[i : i + 50]] < d for j in range(i, i + 50)}
        want[d] = "".join(c for i, c in enumerate(t) if i not in gone).encode()
    assert {d: bytes(k) for d, k in got.items()} == want and sum(len(t) for _, t in rows) > sum(map(len, want.values()))
    # no task of round 2 holds all windows of one name
    assert not [n for n, p in plans.items() if n != "suffix-round1" and re.search(r"hashpartitioning\(name#\d+L?, \d+\)", p)]


def test_quality_classifier(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = quality_classifier.query(spark, "/root/testdata/sf0.01").collect()
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert len(held) > 40 and sum(p == q for p, q in held) / len(held) > 0.93


def test_hmm_base_and_likelihood(spark, texts):
    toks = {d: [*WORD.findall((t or "").translate(LOWER)), None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in toks}
    c = Counter(t for d in toks if not held[d] for t in toks[d])
    n, v, gain = sum(c.values()), len(c), 0.0
    for r in hmm.query(spark, SMALL).collect():
        own = toks[r["doc_id"]]
        base = sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(own), sum(c[t] > 0 for t in own), n)
        assert r["base_score"] == pytest.approx(base, abs=1e-5)
        gain += (r["score"] - base) * held[r["doc_id"]]
    assert gain > 0


def test_forward_and_counts_against_all_paths():
    rng = np.random.default_rng(5)
    k, c = 3, 4
    start, move, emit = (x / x.sum(axis=-1, keepdims=True) for x in (rng.random(k), rng.random((k, k)), rng.random((k, c))))
    seqs = [np.array(x, np.int16) for x in ([0], [1, 2, 3], [3, 3, 0, 1])]

    def paths(seq):
        import itertools

        for p in itertools.product(range(k), repeat=len(seq)):
            w = start[p[0]] * emit[p[0], seq[0]]
            for i in range(1, len(seq)):
                w *= move[p[i - 1], p[i]] * emit[p[i], seq[i]]
            yield p, w

    assert hmm.forward(start, move, emit, seqs) == pytest.approx([math.log10(sum(w for _, w in paths(s))) for s in seqs])
    begins, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((k, c))
    for s in seqs:
        total = sum(w for _, w in paths(s))
        for p, w in paths(s):
            begins[p[0]] += w / total
            for i in range(len(s)):
                emits[p[i], s[i]] += w / total
                if i:
                    moves[p[i - 1], p[i]] += w / total
    got = hmm.expected_counts(start, move, emit, *hmm._pieces(seqs, 64))
    for a, b in zip(got, (begins, moves, emits), strict=True):
        assert np.allclose(a, b, atol=1e-4)


def test_quality_rules_base(spark, texts):
    for r in quality_rules.query(spark, SMALL).collect():
        t = texts[r["doc_id"]] or ""
        w = WORD.findall(t)
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))
        assert tuple(r)[1:6] == want
        assert r["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and not (r["base_failed"] and r["kept"])


def test_compression_bands():
    prose = " ".join(hashlib.sha256(str(i).encode()).hexdigest()[: 3 + i % 5].translate(str.maketrans("0123456789", "etaoinshrd")) for i in range(900))
    same, noise = "again and again " * 400, "".join(chr(33 + b % 90) for i in range(200) for b in hashlib.sha512(str(i).encode()).digest())
    got = quality_rules.measure(pa.array([prose, same, noise, "", None]))
    assert got["kept"].tolist() == [True, False, False, False, False]
    assert got["ratio"][1] > 20 and got["ratio"][2] < 1.35


def test_one_full_chunk_spoils_a_text():
    """12 KB of prose with 4 KB of random characters, 28 KB with 8 KB, a chunk of 64 random letters, a chunk of one line: none is kept; prose alone is, of any length."""
    word = lambda i: hashlib.sha256(str(i % 1500).encode()).hexdigest()[: 3 + i * i % 5].translate(str.maketrans("0123456789", "etaoinshrd"))
    prose = lambda n, seed: " ".join(word(int(x)) for x in np.random.default_rng(seed).integers(0, 1500, n))[:n]
    random = lambda n, letters: "".join(letters[b % len(letters)] for i in range(n // 64 + 1) for b in hashlib.sha512(str(i).encode()).digest())[:n]
    printable, base64 = [chr(33 + i) for i in range(90)], [chr(48 + i) for i in range(10)] + [chr(65 + i) for i in range(26)] + [chr(97 + i) for i in range(26)] + ["+", "/"]
    spoilt = [prose(12288, 1) + random(4096, printable), prose(28672, 2) + random(8192, printable), prose(40960, 3) + random(4096, base64) + prose(8192, 4), prose(61440, 5) + ("the same line again\n" * 250)[:4096] + prose(4096, 6)]
    got = quality_rules.measure(pa.array([*spoilt, *(prose(n, 7) for n in (3000, 5000, 16384, 70000))]))
    assert not got["base_failed"].any() and got["kept"].tolist() == [False] * 4 + [True] * 4
    assert all(n >= 1 for n in got["n_bad_chunks"][:4].tolist()) and not got["n_bad_chunks"][4:].any()


def test_sharding(spark, texts):
    rows = sorted((r["doc_id"], r["shard"], r["slot"], r["size"], r["text_crc32"]) for r in sharding.query(spark, SMALL).collect())
    assert [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in sorted(texts.items())] == [(d, s, c) for d, _, _, s, c in rows]
    assert [r[1] for r in rows] == sorted(r[1] for r in rows)  # contiguous
    total, before, slots = sum(r[3] for r in rows), 0, Counter()
    for _, shard, slot, size, _ in rows:
        assert shard == min(39, (2 * before + size) * 40 // (2 * total)) and slot == slots[shard]
        slots[shard] += 1
        before += size


def test_near_dedup(spark, texts):
    sets = brute_sets(texts)
    want = brute_components(sets)
    got = {r["doc_id"]: r for r in near_dedup.query(spark, SMALL).collect()}
    assert {d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in got.items()} == {d: (len(sets[d]), want[d], want[d] == d) for d in sets}


def test_near_dedup_recall_and_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows, d = [], 0
    for _ in range(60):  # copies at and just above the threshold
        words = [f"w{x}" for x in rng.integers(0, 10**9, 205)]
        rows.append((d, " ".join(words)))
        for cut in (16, 17, 8):
            d += 1
            rows.append((d, " ".join([*words[cut:], *(f"n{x}" for x in rng.integers(0, 10**9, cut if cut == 8 else 0))])))
        d += 1
    want = brute_components(brute_sets(dict(rows)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == want
    monkeypatch.setattr(near_dedup, "LEAF", 2)
    monkeypatch.setattr(near_dedup, "MAX_DEPTH", 2)
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == want


def test_near_dedup_heavy_clusters(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 10**9, 300)]
    rows = [(d, " ".join([*base[d % 9 :], *(f"n{x}" for x in rng.integers(0, 10**9, d % 4))])) for d in range(40)]
    rows += [(100 + d, " ".join(f"z{d}x{i % 50}" for i in range(3000))) for d in range(3)]
    want = brute_components(brute_sets(dict(rows)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 900)  # three of these texts
    for block in (near_dedup.BLOCK, 7):  # sides of a large node inside of heavy clusters as well
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()} == want


def test_near_dedup_follows_percent(spark, texts):
    paths = near_dedup.mix(np.arange(1, 20_001, dtype=np.uint64))
    sig = np.zeros((1, near_dedup.PLACES), np.uint32)
    for percent in (80, 85, 95):  # 100 / percent children on average
        row, _ = near_dedup._children(paths, sig, np.zeros(len(paths), np.int64), percent)
        assert len(row) / len(paths) == pytest.approx(100 / percent, abs=0.015)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute_components(brute_sets(texts), 80)
    assert want != brute_components(brute_sets(texts), 85)
    assert {r["doc_id"] for r in near_dedup.one_of_each(docs, percent=80).collect()} == {d for d, c in want.items() if c == d}


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(i, i + 1) for i in range(300, 340)]
    parent = {x: x for p in pairs for x in p}
    for _ in range(400):
        for a, b in pairs:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: c for x, c in parent.items() if any(x in p and p[0] != p[1] for p in pairs)}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, SMALL).select(*want.columns).collect()
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in got)


def test_license_bands_alone_find_all(spark):
    rows = [(i, f"some words {i} before here {body} and {i} words that follow it") for i, (_, body) in enumerate(licenses.NOTICES)]
    rows += [(100, "Nothing of this kind is said here at all, under no license."), (101, None)]
    got = {(r["doc_id"], r["license"]) for r in licenses.license_matches(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*licenses.NOTICES], "license string, text string")).collect()}
    assert got == {(i, n) for i, (n, _) in enumerate(licenses.NOTICES)}


def test_block_max_bounds_lose_nothing():
    rng = np.random.default_rng(2)
    vocab = [f"t{i}" for i in range(300)]
    items = [" ".join(rng.choice(vocab, rng.integers(6, 20))) for _ in range(60)]
    docs = [" ".join([*rng.choice(vocab, 30), items[i % 60] if i % 3 else "", *rng.choice(vocab, 40)]) for i in range(80)]
    index = decontaminate.build_index(list(range(60)), items)
    raw, offs = __import__("gridrisk.llm.textops", fromlist=["x"]).column_bytes(pa.array(docs))
    got = {(d, i): s for d, i, s in decontaminate.search(index, raw, offs, 0.5)}
    weight = {}
    by_hash = {int(h): t for t, h in enumerate(index.terms)}
    for t in range(len(index.terms)):
        for p in range(index.first[t], index.first[t + 1]):
            weight[t, int(index.items[p])] = index.weights[p]
    want = {}
    h, first, _ = decontaminate._hashed(raw, offs)
    for d in range(80):
        w = [by_hash.get(int(x), -1) for x in h[first[d] : first[d + 1]]]
        for lo in range(0, max(len(w), 1), index.span):
            terms = set(w[lo : lo + 2 * index.span]) - {-1}
            for i in range(60):
                s = sum(weight.get((t, i), 0) for t in terms)
                if s >= 0.5:
                    want[d, i] = max(s, want.get((d, i), 0))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert all((d, d % 60) in got for d in range(80) if d % 3)


@pytest.mark.parametrize("rows", [1, 4, 37])
def test_small_blocks_lose_no_passage(monkeypatch, rows):
    rng = np.random.default_rng(4)
    vocab = [f"t{i}" for i in range(200)]
    items = [" ".join(rng.choice(vocab, rng.integers(6, 20))) for _ in range(40)]
    docs = [" ".join([*rng.choice(vocab, 5 * (i % 4)), items[i], *rng.choice(vocab, 25)]) for i in range(40)]
    index = decontaminate.build_index(list(range(40)), items)
    raw, offs = decontaminate.column_bytes(pa.array(docs))
    h, first, _ = decontaminate._hashed(raw, offs)
    term = np.repeat(np.arange(len(index.terms)), np.diff(index.first))
    weight = {(int(index.terms[t]), int(i)): w for t, i, w in zip(term, index.items, index.weights, strict=True)}
    want = {}
    for d in range(40):
        own = h[first[d] : first[d + 1]].tolist()
        for lo in range(0, len(own), index.span):
            for i in range(40):
                s = sum(weight.get((t, i), 0) for t in set(own[lo : lo + 2 * index.span]))
                if s >= 0.5:
                    want[d, i] = max(s, want.get((d, i), 0))
    monkeypatch.setattr(decontaminate, "ROWS", rows)
    got = {(d, i): s for d, i, s in decontaminate.search(index, raw, offs, 0.5)}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert all((d, d) in got for d in range(40))
    assert list(decontaminate._blocks(np.array([0, 0, 1, 1, 1, 2]), 4)) == [(0, 2), (2, 6)]


def test_blocks_of_items_change_no_score(spark):
    rng = np.random.default_rng(8)
    vocab = [f"t{i}" for i in range(150)]
    items = [(i, " ".join(rng.choice(vocab, rng.integers(6, 30)))) for i in range(50)] + [(50, None), (51, "")]
    docs = [(i, " ".join([*rng.choice(vocab, 10), items[i % 50][1], *rng.choice(vocab, 25)])) for i in range(80)]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole, parts = ({(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.contaminated(docs, items, items_at_once=n).collect()} for n in (100, 9))
    assert len(whole) >= 80 and whole.keys() == parts.keys() and all(parts[k] == pytest.approx(whole[k], abs=1e-12) for k in whole)
    one, few = (list(decontaminate._indexes(items, "item_id", "text", n)) for n in (100, 9))
    assert len(few) == 6 and {x.span for x in few} == {one[0].span}
    weight = [{(x.ids[i], int(x.terms[t])): w for x in xs for t in range(len(x.terms)) for i, w in zip(x.items[x.first[t] : x.first[t + 1]], x.weights[x.first[t] : x.first[t + 1]], strict=True)} for xs in (one, few)]
    assert weight[0].keys() == weight[1].keys() and all(weight[1][k] == pytest.approx(w, abs=1e-12) for k, w in weight[0].items())


def test_language_id(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    rows = language_id.query(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97


def test_profiles_against_plain_sums():
    vec = {}

    def own(c):
        return vec.setdefault(c, language_id._letter_vector(c, language_id.DIMS).astype(float))

    text = "Ab é-b1"
    want, low = np.zeros(language_id.DIMS), [0, *(ord(c) if c.isalpha() else 0 for c in text.lower()), 0]
    for a, b, c in zip(low, low[1:], low[2:], strict=False):
        if b:
            want += np.roll(own(a), 2) * np.roll(own(b), 1) * own(c)
    got, has = language_id.profiles(pa.array([text, "12", "", None, "zz"]))
    assert np.allclose(got[0], want / np.linalg.norm(want), atol=1e-5) and has.tolist() == [True, False, False, False, True]


def test_sentencepiece(texts, monkeypatch):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.MODEL)
    merger = sentencepiece_bpe.Merger(sentencepiece_bpe.Pieces.load())
    own = [t or "" for t in list(texts.values())[:60]] + ["", "  lead", " x ", "é☃ \x00 <s> ", "a　b", "ﬁ ½\n\n\tzz", "a" * 300, "the quick" * 60, "   ", "aaaa bbbb" * 3]
    keys = np.arange(len(own)).astype(np.uint64)
    ids, cut = merger.encode(pa.array(own), keys, 0.0)
    assert [ids[cut[i] : cut[i + 1]].tolist() for i in range(len(own))] == model.encode(own)
    own.append("a ▁ b")
    keys = np.arange(len(own)).astype(np.uint64)
    ids, cut = merger.encode(pa.array(own), keys, 0.2)
    assert [merger.decode(ids[cut[i] : cut[i + 1]]).decode() for i in range(len(own))] == own
    again, _ = merger.encode(pa.array(own), keys, 0.2)
    other, _ = merger.encode(pa.array(own), keys + np.uint64(1000), 0.2)
    assert (again == ids).all() and (len(other) != len(ids) or (other != ids).any())
    monkeypatch.setattr(sentencepiece_bpe, "WIDTHS", ())  # the heap and the side-by-side agenda agree
    heap, _ = merger.encode(pa.array(own[:20]), keys[:20], 0.2)
    assert (heap == ids[: cut[20]]).all()


def test_odd_rows(spark):
    docs = odd(spark)
    n = docs.count()
    one = suffix_dedup.remove_repeats(docs)
    got = {(r["doc_id"], r["text"]): r["n_removed"] for r in one.collect()}
    base = docs.where("doc_id = 0").first()["text"]
    assert one.count() == n and got[1, base] == len(base) and got[None, base] == 0 and got[2, None] == 0 and got[5, base + "!"] >= len(base)
    labels = spark.createDataFrame([(0, 1), (4, 0), (8, None), (None, 1), (0, 1)], "doc_id long, quality int")
    assert quality_classifier.score(docs, quality_classifier.train(docs, labels)).count() == n
    lm = hmm.score(docs.withColumn("held_out", F.col("doc_id") == 6), "held_out", iterations=1)
    assert lm.count() == n and lm.where("n_tokens = 1").count() == 4 and lm.where("base_score is null or score is null").isEmpty()
    rules = quality_rules.quality_rules(docs)
    assert rules.count() == n and rules.where("doc_id in (2, 3, 4) and (kept or not base_failed)").isEmpty()
    shards = sharding.byte_shards(docs, 4).collect()
    assert sorted(Counter(r["shard"] for r in shards).values()) and len(shards) == n and {r["size"] for r in shards if r["doc_id"] in (2, 3)} == {16}
    near = near_dedup.near_duplicates(docs).collect()
    comp = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in near}
    assert len(near) == n and comp[10, 1] == 9 and comp[2, 0] == 2 and comp[3, 0] == 3 and {r["component_id"] for r in near if r["doc_id"] == 1} == {0}
    assert [r["component_id"] for r in near if r["doc_id"] is None] == [None]
    assert near_dedup.one_of_each(docs).where("doc_id = 1").isEmpty()
    ids = language_id.identify(docs, language_id.learn(docs)).collect()
    assert len(ids) == n and {r["lang_pred"] for r in ids if r["doc_id"] in (2, 3, 4, 11)} == {"und"}
    pieces = sentencepiece_bpe.Pieces.load()
    both = sentencepiece_bpe.encode(docs.withColumn("was", F.col("text")), pieces)
    back = sentencepiece_bpe.decode(both, pieces)
    assert back.count() == n and back.where("not (text <=> was)").isEmpty()
    items = spark.createDataFrame([(1, docs.where("doc_id = 0").first()["text"]), (2, None), (3, ""), (4, "one two three four"), (1, "x")], "item_id long, text string")
    hits = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert hits == {(0, 1), (1, 1), (None, 1), (5, 1), (6, 1), (9, 4), (10, 4), (5, 1)} | ({(5, 1)})
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items, items_at_once=1).collect()} >= {(0, 1)}
    assert licenses.license_matches(docs, spark.createDataFrame([*licenses.NOTICES], "license string, text string")).count() == 0


def test_empty_tables(spark):
    docs, labels = odd(spark).limit(0), spark.createDataFrame([], "doc_id long, quality int")
    items, notices = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([], "license string, text string")
    assert suffix_dedup.remove_repeats(docs).isEmpty()
    assert quality_classifier.score(odd(spark), quality_classifier.train(docs, labels)).where("score <> 0.5").isEmpty()
    assert hmm.score(docs.withColumn("h", F.lit(False)), "h", iterations=1).isEmpty()
    assert hmm.score(odd(spark).withColumn("h", F.lit(True)), "h", iterations=1).where("n_known > 0 or train_tokens > 0").isEmpty()
    assert quality_rules.quality_rules(docs).isEmpty() and sharding.byte_shards(docs).isEmpty() and near_dedup.near_duplicates(docs).isEmpty()
    assert {r["lang_pred"] for r in language_id.identify(odd(spark), language_id.learn(docs)).collect()} == {"und"}
    assert sentencepiece_bpe.encode(docs, sentencepiece_bpe.Pieces.load()).isEmpty()
    assert decontaminate.contaminated(odd(spark), items).isEmpty() and decontaminate.contaminated(docs, items).isEmpty()
    assert licenses.license_matches(odd(spark), notices).isEmpty() and licenses.license_matches(docs, notices).isEmpty()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, now = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = corpus_pipeline.stored(stage(spark, now, SMALL), "t")
        kept[name] = {r["doc_id"] for r in now.select("doc_id").collect()}
        if name != "sentencepiece":
            assert now.columns == columns
        if name == "near_dedup":
            comp = brute_components(brute_sets({r["doc_id"]: r["text"] for r in before.collect()}), corpus_pipeline.NEAR_PERCENT)
            assert kept[name] == {d for d, c in comp.items() if c == d}
    assert kept["sentencepiece"] == kept["decontamination"] < kept["near_dedup"]
    assert kept["suffix_dedup"] == kept["near_dedup"]


def test_pipeline_odd_rows(spark):
    now = odd(spark)
    for _, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.stored(stage(spark, now, SMALL), "t")
    got = {r["doc_id"] for r in now.collect()}
    assert {0, 9, None} <= got and not got & {1, 2, 3, 4, 10, 11}


def test_suffix_dedup_hot_names_and_lengths(spark, monkeypatch):
    rng = np.random.default_rng(9)
    line = "the same line is in very many of these documents, word by word. "
    rows = [(i, "".join(map(chr, rng.integers(97, 123, 40 + i % 9))) + line[i % 5 :] * (1 + i % 2) + "".join(map(chr, rng.integers(97, 123, 30)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def brute(length):
        first, want = {}, {}
        for d, t in rows:
            for i in range(len(t) - length + 1):
                first.setdefault(t[i : i + length], d)
        for d, t in rows:
            gone = {j for i in range(len(t) - length + 1) if first[t[i : i + length]] < d for j in range(i, i + length)}
            want[d] = "".join(c for i, c in enumerate(t) if i not in gone).encode()
        return want

    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 5)
    assert len(suffix_dedup._hot_names(suffix_dedup._texts(docs, "doc_id", "text", 50), 50, 20))
    for length in (20, 33, 50, 90):  # one round or several of the doubling
        got = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(docs, length=length).collect()}
        assert got == brute(length)
