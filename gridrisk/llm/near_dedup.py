"""MinHash near-duplicates by a chosen-path set similarity join.

A document's set holds its distinct 5-word shingles (A-Z lower-cased; fewer words: the whole
sequence as one shingle). Two documents are linked when 100 * |intersection| >= 85 * |union|;
the result is the connected components of all links found.

1. Equal sets are one class from the start, with its smallest id. A class has a signature of 64 minwise tokens.
2. Chosen path: in each of TREES independent trees, a node (a path of chosen
   tokens) picks one or two signature places (1 / 0.85 on average, 100 / percent in general), and its
   classes go on to the children named by the tokens that they have there.
   Nodes of LEAF classes or fewer, and those at MAX_DEPTH, are compared
   exhaustively on signatures; what is similar there, directly or by others, is a candidate cluster.
3. Each distinct candidate cluster gets its whole texts, and all
   pairs in it that aren't connected yet are confirmed on full sets.

Larger nodes than BLOCK classes are dealt out as pairs of blocks, and so are clusters of more than
BLOCK_SHINGLES shingles in all (long texts count by their length), so that a task holds two blocks at a time; no pair is left out. A pair of similarity 0.85
meets in one of the trees with probability above 0.999 (measured in the tests).

Defined results: no words or null text: n_shingles 0, own component, kept. Null id: component null, kept.
Rows that share an id count as one document, which has the links of each. Ids are cast to long (what isn't a number: null).
Very long texts are read whole. An empty table gives an empty one. Of equal ids and texts any row may be the one that stays.
`near_duplicates` returns its four columns alone, `one_of_each` those of docs, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridrisk.llm.graph import components
from gridrisk.llm.textops import U64, Prints, column_bytes, discard, free_name, lower_ascii, mix, shingles, slices, stored, words

WORDS, PERCENT, PLACES, TREES, LEAF, MAX_DEPTH, BLOCK = 5, 85, 64, 10, 4096, 4, 4096
#: Shingles of the texts that a task holds as one block of a cluster.
BLOCK_SHINGLES = 1 << 21
#: Candidate ids are told to the scan of the texts as hashes of so many values: that is the bound of what is broadcast.
ID_HASHES = 1 << 20
_MUL = mix(np.arange(1, PLACES + 1, dtype=U64)) | U64(1)
_ADD = mix(np.arange(1001, PLACES + 1001, dtype=U64))


def shingle_sets(col: pa.Array, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes of all documents one after the other, their offsets)."""
    raw, offs = column_bytes(col)
    raw = lower_ascii(raw)
    starts, ends, first = words(raw, offs)
    got, whose = shingles(Prints(raw).of(starts, ends), first, k)
    order = np.lexsort((got, whose))
    got, whose = got[order], whose[order]
    new = np.ones(len(got), bool)
    new[1:] = (got[1:] != got[:-1]) | (whose[1:] != whose[:-1])
    got, whose = got[new], whose[new]
    return got, np.searchsorted(whose, np.arange(len(offs)))


def signatures(sets: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """PLACES minwise tokens of each nonempty set."""
    has = np.flatnonzero(np.diff(offs) > 0)
    out = np.zeros((len(offs) - 1, PLACES), np.uint32)
    if len(has):
        for i in range(PLACES):
            out[has, i] = np.minimum.reduceat(((sets * _MUL[i] + _ADD[i]) >> U64(32)).astype(np.uint32), offs[has])
    return out


def _sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    upto = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
    return (upto[offs[1:]] - upto[offs[:-1]]).view(np.int64)


def sketches(docs: DataFrame, doc_id: str, text: str, k: int = WORDS) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            sets, offs = shingle_sets(b.column(1), k)
            sig = signatures(sets, offs).tobytes()
            rows = [sig[i * 4 * PLACES : (i + 1) * 4 * PLACES] for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in (np.diff(offs), _sums(mix(sets), offs), _sums(mix(sets ^ U64(0x5851F42D4C957F2D)), offs))), pa.array(rows, pa.binary())], names=["doc_id", "n_shingles", "f1", "f2", "sig"])

    own = docs.select(F.col(doc_id).try_cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return own.mapInArrow(run, "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, sig binary")


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(-1, PLACES)


def _children(paths: np.ndarray, sig: np.ndarray, row: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of nodes' rows: the places that a node picks depend on its path alone."""
    pick = mix(paths + U64(0x2545F4914F6CDD1D))
    at = (pick % U64(PLACES)).astype(np.int64)
    more = np.flatnonzero((pick >> U64(32)) % U64(percent) < U64(100 - percent))
    also = (at[more] + 1 + ((pick[more] >> U64(16)) % U64(PLACES - 1)).astype(np.int64)) % PLACES
    who, place = np.concatenate([np.arange(len(paths)), more]), np.concatenate([at, also])
    return row[who], mix(paths[who] * U64(0x9E3779B97F4A7C15) + mix(sig[row[who], place].astype(U64) * U64(PLACES) + place.astype(U64)))


def _spanning(sig: np.ndarray, side: np.ndarray, least: int, confirm: Callable[[int, int], bool] | None, root: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all members that similar signatures (and confirm) connect; root gets the component of each. Sides 0 and 1: pairs across only; -1: all pairs."""
    out = []
    middle = np.sort(sig, axis=0)[len(sig) // 2]
    order = np.argsort(-(sig == middle).sum(axis=1), kind="stable")  # likely hubs first
    for nth, i in enumerate(order[:-1]):
        rest = order[nth + 1 :]
        rest = rest[(root[rest] != root[i]) & ((side[i] < 0) | (side[rest] != side[i]))]
        near = rest[(sig[rest] == sig[i]).sum(axis=1) >= least]
        if confirm is None:  # all of them join at once
            if len(near):
                joined = np.isin(root, root[np.append(near, i)])
                root[joined] = root[joined].min()
            continue
        for j in near:
            if root[j] != root[i] and confirm(i, j):
                root[root == max(root[i], root[j])] = min(root[i], root[j])
                out.append((i, j))
    return out


def _groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Rows of a partition sorted by the key column, group by group."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        keys = np.asarray(b.column(key))
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            if held and held[-1].column(key)[0].as_py() != keys[lo]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _in_blocks(rows: DataFrame, group: str, size: DataFrame, *columns: str) -> DataFrame:
    """Rows with `unit` (long) and `side`: a group of up to BLOCK rows is one unit, a larger one a unit for each pair of its blocks."""
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks").cast("long")).cast("int")
    dealt = rows.join(size, group).withColumn("blocks", n).withColumn("block", mine)
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64(group, F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
        F.when(F.col("block") == F.col("other"), -1).otherwise((F.col("block") > F.col("other")).cast("int")).cast("int").alias("side"), "rep", *columns,
    )


def _clusters(reps: DataFrame, trees: int, least: int, percent: int) -> DataFrame:
    """(cluster, side, rep, weight): the classes that meet in a node and have similar signatures, with their shingles."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sig, ids = _matrix(b.column(1)), np.asarray(b.column(0))
                row, path = _children(np.repeat(mix(np.arange(1, trees + 1, dtype=U64)), len(ids)), sig, np.tile(np.arange(len(ids)), trees), percent)
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(path.view(np.int64))], names=["rep", "path"])

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sig, ids = _matrix(b.column(2)), np.asarray(b.column(0))
                row, path = _children(np.asarray(b.column(1)).view(U64), sig, np.arange(len(ids)), percent)
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(path.view(np.int64))], names=["rep", "path"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            g = g.combine_chunks()
            ids, side, weight = (np.asarray(g[c]) for c in ("rep", "side", "n_shingles"))
            root = np.arange(len(ids))
            _spanning(_matrix(g["sig"]), side, least, None, root)
            for r in np.flatnonzero(np.bincount(root, minlength=len(ids)) > 1):
                own = np.flatnonzero(root == r)
                # by the members: the same cluster of another tree is the same group
                member = ids[own].astype(U64) ^ (side[own].astype(U64) << U64(60))
                name = mix(mix(member).sum(keepdims=True) + mix(mix(member) ^ U64(99)).sum(keepdims=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(name, len(own)).view(np.int64)), pa.array(side[own]), pa.array(ids[own]), pa.array(weight[own])], names=["cluster", "side", "rep", "weight"])

    level = stored(reps.select("rep", "sig").mapInArrow(plant, "rep bigint, path bigint"), "paths")
    out = None
    for depth in range(1, MAX_DEPTH + 1):
        nodes = stored(level.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "nodes")
        last = depth == MAX_DEPTH
        leaves = _in_blocks(level, "path", nodes if last else nodes.where(F.col("size") <= LEAF)).join(reps.select("rep", "sig", "n_shingles"), "rep").select("unit", "side", "rep", "sig", "n_shingles")
        links = stored(leaves.repartition("unit").sortWithinPartitions("unit").mapInArrow(compare, "cluster bigint, side int, rep bigint, weight bigint").distinct(), "clusters")
        out = links if out is None else out.unionByName(links)
        large = nodes.where(F.col("size") > LEAF)
        done = last or large.isEmpty()
        used = [level, nodes]
        if not done:
            again = level.join(large.select("path"), "path").join(reps.select("rep", "sig"), "rep").select("rep", "path", "sig")
            level = stored(again.mapInArrow(branch, "rep bigint, path bigint"), "paths")
        discard(*used)
        if done:
            return out
    return out


def _by_weight(clusters: DataFrame) -> DataFrame:
    """(unit, side, rep): a cluster of up to BLOCK_SHINGLES is one unit with its own sides, a heavier one a unit for each pair of its blocks."""
    heavy = clusters.groupBy("cluster").agg(F.ceil(F.sum("weight") / BLOCK_SHINGLES).cast("int").alias("blocks")).where("blocks > 1")
    dealt = clusters.join(heavy, "cluster", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks").cast("long")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    across = F.when(F.col("block") == F.col("other"), -1).otherwise((F.col("block") > F.col("other")).cast("int"))
    unit = F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other"))
    return dealt.select(unit.alias("unit"), F.when(F.col("blocks") == 1, F.col("side")).otherwise(across).cast("int").alias("side"), "rep")


def _confirmed(docs: DataFrame, clusters: DataFrame, doc_id: str, text: str, k: int, percent: int, least: int) -> DataFrame:
    """(a, b): links on full sets that connect what all such links of a cluster connect."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            ids, side = np.asarray(g["rep"]), np.asarray(g["side"])
            chunks = [shingle_sets(c, k) for c in g["_text"].chunks]
            sets = [s[o[i] : o[i + 1]] for s, o in chunks for i in range(len(o) - 1)]
            sig = np.concatenate([signatures(s, o) for s, o in chunks])

            def linked(i: int, j: int) -> bool:
                x, y = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
                if 100 * len(x) < percent * len(y):
                    return False
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                return 100 * common >= percent * (len(x) + len(y) - common)

            got = _spanning(sig, side, least, linked, np.arange(len(ids)))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(ids[[i for i, _ in got]]), pa.array(ids[[j for _, j in got]])], names=["a", "b"])

    own = docs.select(F.col(doc_id).try_cast("long").alias("rep"), F.col(text).alias("_text"))
    bucket = F.pmod(F.xxhash64("rep"), F.lit(ID_HASHES)).alias("bucket")
    wanted = F.broadcast(clusters.select(bucket).distinct())  # ID_HASHES rows at most
    own = own.withColumn("bucket", bucket).join(wanted, "bucket", "left_semi").select("rep", "_text")
    rows = _by_weight(clusters).join(own.hint("merge"), "rep").select("unit", "side", "rep", "_text")
    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(compare, "a bigint, b bigint").where("a <> b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT, trees: int = TREES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    drawn = stored(sketches(docs, doc_id, text, k), "sketches")
    same = ["n_shingles", "f1", "f2"]
    has_class = "n_shingles > 0 and doc_id is not null"
    alive = drawn.where(has_class)
    classes = stored(alive.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig")), "classes")
    p = percent / 100
    least = int(PLACES * p - 5 * (PLACES * p * (1 - p)) ** 0.5)  # five standard deviations below the threshold
    found = components(_confirmed(docs, _clusters(classes, trees, least, percent), doc_id, text, k, percent, least))
    of_class = classes.select(*same, "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(*same, F.coalesce("component", "rep").alias("reach"))
    # rows without a class (empty texts, which may be many, and null ids) stay out of the join
    alone = drawn.where(f"not ({has_class})").select("doc_id", "n_shingles", F.col("doc_id").alias("reach"))
    reach = alive.join(of_class, same).select("doc_id", "n_shingles", "reach").unionByName(alone)
    return reach.select("doc_id", "n_shingles", F.col("reach").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("reach"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """docs with one row for each component (the smallest id's first row) and all rows without id."""
    key, nth = free_name(docs, "_near_gone"), free_name(docs, "_near_nth")
    gone = near_duplicates(docs, doc_id, text, **settings).where("not kept").select(F.col("doc_id").alias(key)).distinct()
    left = docs.join(gone, F.col(doc_id).try_cast("long") == F.col(key), "left_anti")
    order = F.row_number().over(Window.partitionBy(doc_id).orderBy(F.xxhash64(text)))
    named = left.where(F.col(doc_id).isNotNull()).withColumn(nth, order).where(F.col(nth) == 1).drop(nth)
    return named.unionByName(left.where(F.col(doc_id).isNull()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: near-duplicate components of all documents at similarity 0.85."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
