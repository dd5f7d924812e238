"""Queries of the training-data operators against plain loops, where SQL can't express them."""

import math
import pickle
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from conftest import SMALL
from pyspark.sql import functions as F
from test_llm_operators import odd

import corpus_pipeline
from gridrisk.llm import decontaminate, hmm, language_id, licenses, near_dedup, quality_classifier, quality_rules, sentencepiece_bpe, suffix_dedup


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


def test_quality_classifier_replayed(spark, texts):
    """FTRL-proximal as plain dictionaries over the features of each row, in the order of the hashed ids."""
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    order = [r[0] for r in spark.createDataFrame([(d,) for d in labels if d in texts], "i long").orderBy(F.xxhash64("i"), "i").collect()]

    def vector(t):
        _, at, val = quality_classifier.features(pa.array([t], pa.string()))
        return list(zip(at.tolist(), val.tolist(), strict=True))

    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality_classifier.L1:
            return 0.0
        return -(z[i] - math.copysign(quality_classifier.L1, z[i])) / ((quality_classifier.BETA + math.sqrt(n[i])) / quality_classifier.ALPHA + quality_classifier.L2)

    rows = [(vector(texts[d]), labels[d]) for d in order]
    for _ in range(quality_classifier.EPOCHS):
        for x, y in rows:
            w = {i: weight(i) for i, _ in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x)))
            for i, v in x:
                g = (p - y) * v
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / quality_classifier.ALPHA * w[i]
                n[i] = n.get(i, 0.0) + g * g
    for r in quality_classifier.query(spark, SMALL).collect():
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-sum(weight(i) * v for i, v in vector(texts[r["doc_id"]])))), abs=1e-4)


def test_quality_classifier_repeated_id(spark):
    docs = spark.createDataFrame([(i, f"good words number {i}") for i in range(20)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    twice = docs.unionByName(docs).unionByName(docs)
    assert (quality_classifier.train(docs, labels) == quality_classifier.train(twice, labels)).all()


def test_hmm_counts_do_not_depend_on_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    k, c = 4, 30
    start, move, emit = (x / x.sum(axis=-1, keepdims=True) for x in (rng.random(k), rng.random((k, k)) ** 3, rng.random((k, c)) ** 4 + 1e-3))
    seqs = [rng.integers(0, c, n).astype(np.int16) for n in (1, 2, 63, 64, 65, 300, 1500)]
    one = hmm.expected_counts(start, move, emit, *hmm._pieces(seqs, 5000))
    for size in (1, 5, 64):
        for a, b in zip(one, hmm.expected_counts(start, move, emit, *hmm._pieces(seqs, size)), strict=True):
            assert np.allclose(a, b, rtol=1e-4, atol=2e-3)
    assert one[0].sum() == pytest.approx(len(seqs), abs=1e-3) and one[1].sum() == pytest.approx(sum(len(s) - 1 for s in seqs), rel=1e-4)


def test_hmm_scores_by_plain_forward(spark, texts, monkeypatch):
    made = {}
    learn = hmm.baum_welch
    monkeypatch.setattr(hmm, "baum_welch", lambda seqs, iterations: made.setdefault("model", learn(seqs, iterations)))
    rows = hmm.query(spark, SMALL).collect()
    start, move, emit = made["model"]
    toks = {}
    for d, t in texts.items():
        h, c, _ = hmm.tokens(pa.array([t], pa.string()))
        toks[d] = list(zip(h.tolist(), c.tolist(), strict=True))
    count, n, v = {}, np.zeros(hmm.CLASSES), np.zeros(hmm.CLASSES)
    for d, own in toks.items():
        if zlib.crc32(str(d).encode()) % 7 != 2:
            for x in own:
                count[x] = count.get(x, 0) + 1
    for (_, c), m in count.items():
        n[c] += m
        v[c] += 1
    for r in rows[:60]:
        own, alpha, total = toks[r["doc_id"]], start, 0.0
        for i, x in enumerate(own):
            alpha = (alpha if i == 0 else alpha @ move) * emit[:, x[1]]
            total += math.log10(alpha.sum()) + math.log10((count.get(x, 0) + 1) / (n[x[1]] + v[x[1]] + 1))
            alpha = alpha / alpha.sum()
        assert r["score"] == pytest.approx(total, abs=1e-4)


def test_quality_rules_by_plain_compression(spark, texts):
    press = zstandard.ZstdCompressor(level=3)

    def ratio(x):
        return len(x) / max(1, len(press.compress(x)) - 12)

    def inside(x, bands):
        lo, hi = [(a, b) for least, a, b in bands if len(x) >= least][-1]
        return lo <= ratio(x) <= hi

    more = {10**6: "prose " + "".join(chr(97 + i * i % 26) + " "[: i % 5 == 0] for i in range(8186)) + "".join(chr(33 + b % 90) for i in range(63) for b in __import__("hashlib").sha512(str(i).encode()).digest())}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([*more.items()], "doc_id long, text string"))
    for r in quality_rules.quality_rules(docs).collect():
        b = ({**texts, **more}[r["doc_id"]] or "").encode()
        chunks = [b[i : i + 4096] for i in range(0, len(b), 4096)]
        bad = sum(not inside(x, quality_rules.CHUNK_BANDS) for x in chunks) if len(chunks) > 1 else 0
        spoilt = len(chunks) > 1 and any(len(x) == 4096 and not inside(x, quality_rules.CHUNK_BANDS) for x in chunks)
        assert r["ratio"] == pytest.approx(ratio(b) if b else 0.0) and r["n_bad_chunks"] == bad
        assert r["kept"] == (bool(b) and not r["base_failed"] and inside(b, quality_rules.BANDS) and not spoilt and bad <= 0.25 * len(chunks))


def test_language_id_by_plain_vectors(spark, texts):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    own = {}

    def letter(c):
        if c not in own:
            own[c] = language_id._letter_vector(c, language_id.DIMS).astype(float)
        return own[c]

    def profile(t):
        low, grams = [0, *(ord(c) if c.isalpha() else 0 for c in (t or "").lower()), 0], {}
        for g in zip(low, low[1:], low[2:], strict=False):
            if g[1]:
                grams[g] = grams.get(g, 0) + 1
        out = sum((m * np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c) for (a, b, c), m in grams.items()), np.zeros(language_id.DIMS))
        return out / np.linalg.norm(out) if grams else None

    profiles = {d: profile(t) for d, t in texts.items()}
    sums = {}
    for d, p in profiles.items():
        if p is not None and lang[d] is not None and zlib.crc32(str(d).encode()) % 3 != 1:
            sums[lang[d]] = sums.get(lang[d], 0) + p
    unit = {k: v / np.linalg.norm(v) for k, v in sums.items()}
    for r in language_id.query(spark, SMALL).collect():
        p = profiles[r["doc_id"]]
        cos = {k: float(p @ v) for k, v in unit.items()} if p is not None else {"und": 0.0}
        best = max(cos.values())
        assert r["score"] == pytest.approx(max(best, 0), abs=1e-4) and cos[r["lang_pred"]] == pytest.approx(best, abs=1e-5)


def test_language_id_many_languages_and_planes(spark):
    docs = spark.createDataFrame([(i, chr(0x30000 + i) * 9 if i % 2 else f"word{chr(97 + i)} " * 4, f"l{i:02d}") for i in range(11)] + [(99, None, "l99")], "doc_id long, text string, lang string")
    learned = language_id.learn(docs)
    one, several = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, learned, at_once=n).collect()} for n in (100, 3))
    assert one == several and all(one[i][0] == f"l{i:02d}" for i in range(11)) and one[99] == ("und", 0.0)


def test_sentencepiece_dropout_by_plain_agenda(spark, texts):
    """Every text of the query again: best piece first, then leftmost, candidates skipped by the keyed hash."""
    pieces = sentencepiece_bpe.Pieces.load()
    known, rank = {p: i for i, p in enumerate(pieces.text) if p}, pieces.order
    limit = int(sentencepiece_bpe.RATE * (1 << 32))
    keys = {r[0]: r[1] for r in spark.createDataFrame([(d,) for d in texts], "i long").select("i", F.xxhash64(F.lit(sentencepiece_bpe.SEED), "i")).collect()}
    u = np.uint64

    def one(x):
        return sentencepiece_bpe.mix(np.array([x & (2**64 - 1)], u))

    def encode(t, key):
        full = [" ", *t] if t else []
        sym = ["▁" if c == " " else c if c in known and c != "▁" else None for c in full]
        cuts = [i for i in range(len(full)) if i == 0 or sym[i] is None or sym[i - 1] is None or (full[i] == " " and full[i - 1] != " ")] + [len(full)]
        out, drops = [], {}
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if sym[lo] is None:
                out += [int(pieces.byte[b]) for b in full[lo].encode()]
                continue
            chunk = sentencepiece_bpe.mix(one(lo + 3) ^ u(key & (2**64 - 1)))
            parts = [(i - lo, sym[i]) for i in range(lo, hi)]
            while True:
                best = None
                for j in range(len(parts) - 1):
                    made = known.get(parts[j][1] + parts[j + 1][1])
                    end = parts[j + 2][0] if j + 2 < len(parts) else hi - lo
                    at = (lo, parts[j][0], parts[j + 1][0], end)
                    if made is None:
                        continue
                    if at not in drops:
                        drops[at] = bool(sentencepiece_bpe.Merger.dropped(chunk, *(np.array([x]) for x in at[1:]), limit)[0])
                    if not drops[at] and (best is None or rank[made] < best[0]):
                        best = (rank[made], j, made)
                if best is None:
                    break
                _, j, made = best
                parts[j : j + 2] = [(parts[j][0], parts[j][1] + parts[j + 1][1])]
            out += [known[p] for _, p in parts]
        return out

    rows = {r["doc_id"]: r for r in sentencepiece_bpe.query(spark, SMALL).collect()}
    assert all(r["lossless"] and r["text_crc32"] == zlib.crc32((texts[d] or "").encode()) for d, r in rows.items())
    for d in sorted(texts, key=lambda d: len(texts[d] or ""))[:90]:
        ids = encode(texts[d] or "", keys[d])
        assert rows[d]["n_tokens"] == len(ids) and rows[d]["ids_crc32"] == zlib.crc32(np.array(ids, "<i4").tobytes())


def test_occurrences_of_a_word_have_their_own_draws():
    merger = sentencepiece_bpe.Merger(sentencepiece_bpe.Pieces.load())
    ids, _ = merger.encode(pa.array([" understanding" * 60]), np.array([7], np.uint64), 0.3)
    blanks = np.flatnonzero([merger.bytes[i].startswith(b" u") or merger.bytes[i] == b" " for i in ids])
    assert len({tuple(x.tolist()) for x in np.split(ids, blanks)}) > 5


def _pivoting(index, terms, threshold):
    """Block-max WAND with cursors, a pivot and skips, for one passage."""
    block = decontaminate.BLOCK
    lists = [[index.items[index.first[t] : index.first[t + 1]], index.weights[index.first[t] : index.first[t + 1]], t, 0] for t in terms]
    hits = {}
    while True:
        lists = sorted((x for x in lists if x[3] < len(x[0])), key=lambda x: x[0][x[3]])
        total, pivot = 0.0, None
        for n, x in enumerate(lists):
            total += index.list_max[x[2]]
            if total >= threshold - 1e-6:
                pivot = n
                break
        if pivot is None:
            return hits
        item = int(lists[pivot][0][lists[pivot][3]])
        while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][3]] == item:
            pivot += 1
        ahead = item + 1
        if sum(index.block_max[x[2], item // block] for x in lists[: pivot + 1]) >= threshold - 1e-6:
            s = sum(float(x[1][k]) for x in lists for k in [int(np.searchsorted(x[0], item))] if k < len(x[0]) and x[0][k] == item)
            if s >= threshold - 1e-6:
                hits[item] = s
        else:
            following = [int(x[0][x[3]]) for x in lists[pivot + 1 : pivot + 2]]
            ahead = min([(item // block + 1) * block, *(f for f in following if f > item)])
        for x in lists[: pivot + 1]:
            x[3] = int(np.searchsorted(x[0], ahead))


def test_pivoting_wand_gives_the_same_hits(texts, spark):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").collect()
    index = decontaminate.build_index([r["item_id"] for r in items], [r["text"] for r in items])
    own = sorted(texts)
    h, first, _ = decontaminate._hashed(*decontaminate.column_bytes(pa.array([texts[d] for d in own], pa.string())))
    got = {(d, i): s for d, i, s in decontaminate._search(index, h, first, 0.3)}
    want, n, began = {}, 0, time.process_time()
    for d in range(len(own)):
        words = h[first[d] : first[d + 1]]
        at = np.searchsorted(index.terms, words)
        at[at == len(index.terms)] = 0
        at = np.where(index.terms[at] == words, at, -1)
        for lo in range(0, len(words), index.span):
            n += 1
            for i, s in _pivoting(index, np.unique(at[lo : lo + 2 * index.span][at[lo : lo + 2 * index.span] >= 0]).tolist(), 0.3).items():
                want[d, i] = max(s, want.get((d, i), 0))
    print("pivoting:", 1000 * (time.process_time() - began) / n, "ms a passage;", n, "passages of", sum(len((t or "").encode()) for t in texts.values()), "bytes")
    assert got.keys() == want.keys() and want and all(got[k] == pytest.approx(want[k], abs=1e-5) for k in want)


def test_scores_by_plain_sums(spark, texts):
    """BM25 of the best passage over the item's own, from word counts of the whole benchmark."""
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    split = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words = {i: split(t) for i, t in items.items()}
    df = Counter(w for ws in words.values() for w in set(ws))
    mean, span = sum(map(len, words.values())) / len(words), max(map(len, words.values()))

    def weights(i):
        n = Counter(words[i])
        raw = {w: math.log1p((len(words) - df[w] + 0.5) / (df[w] + 0.5)) * k * 2.2 / (k + 1.2 * (0.25 + 0.75 * len(words[i]) / mean)) for w, k in n.items()}
        return {w: x / sum(raw.values()) for w, x in raw.items()}

    got = decontaminate.contaminated(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()
    assert got
    for r in got:
        ws, own = split(texts[r["doc_id"]]), weights(r["item_id"])
        best = max(sum(own.get(w, 0) for w in set(ws[lo : lo + 2 * span])) for lo in range(0, len(ws), span))
        assert r["score"] == pytest.approx(best, abs=1e-5)


def test_index_follows_its_postings_and_documents_are_read_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    items = [" ".join(f"w{x}" for x in rng.integers(0, 10**9, 40)) for _ in range(2000)]  # rare words: 80,000 terms
    index = decontaminate.build_index(list(range(2000)), items)
    assert 79_900 < len(index.terms) <= len(index.block_no) <= len(index.items) and len(pickle.dumps(index)) < 60 * 2000 * 40 * 2
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 2000)
    n = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    docs = spark.createDataFrame([(i, f"before {items[7 * i % 30]} after it") for i in range(60)] + [(500, None)], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items[:30])), "item_id long, text string")
    runs = []
    for at_once in (30, 7, 1):
        n.value = 0
        runs.append(sorted(tuple(r) for r in decontaminate.contaminated(docs.mapInArrow(counted, docs.schema), bench, items_at_once=at_once).collect()))
        assert n.value == 61
        n.value = 0
        left = decontaminate.without_contaminated(docs.mapInArrow(counted, docs.schema), bench, items_at_once=at_once).collect()
        assert [r["doc_id"] for r in left] == [500] and n.value == 61
    assert len(runs[0]) == 60 and all([x[:2] + x[3:] for x in run] == [x[:2] + x[3:] for x in runs[0]] for run in runs) and all(a[2] == pytest.approx(b[2]) for run in runs for a, b in zip(run, runs[0], strict=True))


def test_every_passage_of_a_large_slice_is_scored(spark):
    rng = np.random.default_rng(1)
    vocab = np.array([f"t{i}" for i in range(400)])
    items = [" ".join(rng.choice(vocab, 30)) for _ in range(40)]
    docs = [" ".join([*rng.choice(vocab, 8), items[i % 40], *rng.choice(vocab, 9)]) for i in range(5000)]
    index = decontaminate.build_index(list(range(40)), items)
    assert 5000 * 40 >= 2 * decontaminate.ROWS  # several borders
    assert len({d for d, i, *_ in decontaminate.confirmed(index, pa.array(docs)) if i == d % 40}) == 5000
    few, bench = spark.createDataFrame([(i, d) for i, d in enumerate(docs[:60])], "doc_id long, text string"), spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    runs = [sorted(map(tuple, decontaminate.contaminated(few, bench, items_at_once=n).collect())) for n in (100, 7, 1)]
    assert all([x[:2] + x[3:] for x in r] == [x[:2] + x[3:] for x in runs[0]] and all(x[2] == pytest.approx(y[2]) for x, y in zip(r, runs[0], strict=True)) for r in runs)


def test_short_answers_are_verified(spark):
    item = "One two three four five six seven eight nine. Ten eleven twelve thirteen fourteen."
    docs = [(1, f"Some words before. {item} And after."), (2, "Some words. One two three four five six seven eight nine. Other things come here now and then.")]
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items, threshold=0.3).collect()
    assert [(r["doc_id"], r["n_question"], r["question_shared"], r["n_answer"], r["answer_shared"]) for r in got] == [(1, 5, 5, 1, 1)]


def test_licenses_of_a_table(spark):
    """Templates of all lengths, whole and with a fifth of their shingles gone, against plain containment."""
    rng = np.random.default_rng(4)
    templates = [(f"t{m}", " ".join(f"w{x}" for x in rng.integers(0, 10**6, m + 4))) for m in (*range(1, 13), 20, 39, 40, 41, 60, 100)] + [("none", None), ("short", "a b c")]
    docs = []
    for n, (_, t) in enumerate(templates[:-2]):
        words = t.split()
        docs.append((10 * n, " ".join([*"some words before it".split()[: n % 4], *words, "after"])))
        changed = list(words)
        for i in range(int(0.2 * (len(words) - 4) / 4)):
            changed.insert(10 + 20 * i + i, "inserted")
        docs.append((10 * n + 1, " ".join(["x"] * (n % 3) + changed)))
    docs += [(5000, None), (5001, ""), (5002, "a b c d"), (None, docs[4][1]), (None, docs[4][1])]
    sets = {n: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for n, t in templates[:-2]}
    want = []
    for d, t in docs:
        own = {tuple((t or "").split()[i : i + 5]) for i in range(len((t or "").split()) - 4)}
        want += [(d, n, len(s), len(s & own)) for n, s in sets.items() if len(s & own) >= 0.8 * len(s)]
    table = spark.createDataFrame(templates, "license string, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"license": F.lit(1), "x": F.lit(2), "bucket": F.lit(3), "key": F.lit(4)})
    assert sorted(str(tuple(r)) for r in licenses.license_matches(frame, table).collect()) == sorted(map(str, want))


def test_pipeline_empty_long_and_clashing(spark):
    base = odd(spark).withColumns({"kept_text": F.lit("mine"), "c0": F.lit(5), "bucket": F.lit(6), "_bpe_key": F.lit(8), "_suffix_at": F.lit(9), "_near_nth": F.lit(10)})
    for docs, n in ((base.limit(0), 0), (base.unionByName(base.where("doc_id = 6").selectExpr("* except (doc_id, text)", "cast(77 AS long) AS doc_id", "repeat(text, 60) AS text")), 1)):
        now = docs
        for name, stage in corpus_pipeline.STAGES:
            now = corpus_pipeline.stored(stage(spark, now, SMALL), "t")
            if name != "sentencepiece":
                assert now.columns == docs.columns
                assert now.where("kept_text <> 'mine' or c0 <> 5 or _suffix_at <> 9 or score <> 1 or lang_pred <> 'u'").isEmpty()
        assert (now.count() > 0) == bool(n)


def test_long_text_over_several_slices(spark):
    rng = np.random.default_rng(12)
    long = " ".join(f"w{x}" for x in rng.integers(0, 10**7, 300_000))
    docs = spark.createDataFrame([(1, long), (2, "zz " + long[1_500_000:1_600_000])], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == {1: 0, 2: 100_000} and len(long) > 2 * (1 << 20)


def test_texts_over_several_slices(spark):
    """A text of more than two slices is read whole by every operator that works on slices: results are those of its own words, and the same beside other rows."""
    rng = np.random.default_rng(13)
    words = [f"w{x}" for x in rng.integers(0, 5000, 400_000)]
    long, short = " ".join(words), "just a short text with some words in it, " * 12
    assert len(long) > 2 << 20
    one, both = (spark.createDataFrame([(1, long), (2, short)][:n], "doc_id long, text string").repartition(1) for n in (1, 2))

    def of(df):
        return df.where("doc_id = 1").first()

    rules = [of(quality_rules.quality_rules(d)) for d in (one, both)]
    assert rules[0] == rules[1] and rules[0]["n_words"] == 400_000 and rules[0]["word_chars"] == sum(map(len, words))
    model = quality_classifier.train(both, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    scores = [of(quality_classifier.score(d, model)) for d in (one, both)]
    assert scores[0] == scores[1] and scores[0]["score"] > 0.5
    lm = of(hmm.score(both.withColumn("h", F.col("doc_id") == 2), "h", iterations=1))
    assert (lm["n_tokens"], lm["n_known"], lm["train_tokens"]) == (400_001, 400_001, 400_001)
    near = near_dedup.near_duplicates(both).where("doc_id = 1").first()
    assert near["n_shingles"] == len({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    langs = language_id.learn(both.withColumn("lang", F.when(F.col("doc_id") == 1, "xx").otherwise("yy")))
    assert of(language_id.identify(both, langs))["lang_pred"] == "xx"
    pieces = sentencepiece_bpe.Pieces.load()
    back = sentencepiece_bpe.decode(sentencepiece_bpe.encode(both.withColumn("was", F.col("text")), pieces), pieces)
    assert back.where("not (text <=> was)").isEmpty() and back.count() == 2
