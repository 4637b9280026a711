"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of word n-grams. Equal sets are one node, however many documents have it. MinHash bands propose
pairs; their MinHash values are compared a few at a time, and a pair is dropped once the posterior probability of
reaching the threshold falls below a tolerance. What survives ties nodes into candidate groups; inside a group all
pairs go through the same comparison, and those that are left are verified exactly from the sets. Large buckets and
groups are dealt out as pairs of blocks, each a task of bounded size that yields counts and a spanning forest of its
links, not the links; so no pair list grows with the square of a group.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, cut_lineage, in_slices, join_small, read, text_of

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6  # a pair at the threshold shares no band with probability 6e-5
HASHES = BANDS * ROWS
STEP = 32  # MinHash values compared at a time
TOLERANCE = 1e-6
SMALL = 32  # buckets of up to so many nodes have their pairs listed
BLOCK = 768

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MULTIPLIERS = np.random.default_rng(20).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---------------------------------------------------------------- sets and signatures


class Shingler:
    """Sets of 64-bit n-gram hashes; remembers words' hashes."""

    def __init__(self):
        self.memory: dict[str, int] = {}

    def words(self, text: str) -> np.ndarray:
        memory = self.memory
        if len(memory) > 100_000:
            memory.clear()
        out = []
        for w in _WORD.findall(text):
            h = memory.get(w)
            if h is None:
                h = memory[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))
            out.append(h)
        return np.array(out, np.uint64)

    def shingles(self, text: str, n: int = WORDS) -> np.ndarray:
        """Sorted distinct hashes of the n-grams; of all words, where there are fewer than n; none without a word."""
        h = self.words(text)
        if not len(h):
            return h
        width = min(n, len(h))
        total = np.full(len(h) - width + 1, np.uint64(width))
        for i in range(width):
            total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i])
        return np.unique(total)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES MinHash values, each as 16 bits of its minimum."""
    low = np.full(HASHES, np.uint64(2**64 - 1))
    for a in range(0, len(shingles), 2048):
        low = np.minimum(low, (shingles[None, a : a + 2048] * _MULTIPLIERS[:, None]).min(1))
    return (_mix(low) >> np.uint64(48)).astype(np.uint16)


def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(compared, fewest matches to go on): with m of n values equal and an even prior, the similarity is Beta(m + 1,
    n - m + 1), which reaches the threshold t with the probability that at most m of n + 1 draws of chance t succeed."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def surviving(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature matrices survive the pruning."""
    live = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    begin = 0
    for n, least in steps:
        matches = matches + (a[live, begin:n] == b[live, begin:n]).sum(1)
        keep = matches >= least
        live, matches, begin = live[keep], matches[keep], n
    out = np.zeros(len(a), bool)
    out[live] = True
    return out


def surviving_pairs(left: np.ndarray, right: np.ndarray, steps, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs between two blocks of signatures that survive; in one block only i < j."""
    rows, cols = [], []
    for a in range(0, len(left), 64):
        part = left[a : a + 64]
        n, least = steps[0]
        hits = np.zeros((len(part), len(right)), np.int16)
        for k in range(n):
            hits += part[:, k][:, None] == right[:, k][None, :]
        i, j = np.nonzero(hits >= least)
        i = i + a
        if same:
            i, j = i[i < j], j[i < j]
        for c in range(0, len(i), 65536):
            ii, jj = i[c : c + 65536], j[c : c + 65536]
            ok = surviving(left[ii], right[jj], steps)
            rows.append(ii[ok])
            cols.append(jj[ok])
    none = np.empty(0, np.int64)
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (none, none)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a graph on 0..n-1."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs of sets reach the threshold exactly."""
    sizes_l, sizes_r = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    out = np.zeros(len(i), bool)
    if not len(i):  # two blocks of a sparse group
        return out
    order = np.argsort(i, kind="stable")
    cuts = np.flatnonzero(np.diff(i[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        own = order[a:b]
        mine, others = left[i[own[0]]], j[own]
        many = np.concatenate([right[k] for k in others])
        at = np.minimum(np.searchsorted(mine, many), len(mine) - 1)
        starts = np.concatenate([[0], np.cumsum(sizes_r[others])[:-1]])
        common = np.add.reduceat((mine[at] == many).astype(np.int64), starts)
        out[own] = common >= threshold * (sizes_l[i[own]] + sizes_r[others] - common) - 1e-9
    return out


# ---------------------------------------------------------------- jobs


def row_hashes(docs: DataFrame) -> list:
    return [F.xxhash64(F.lit(40 + k), *[F.col(f"`{c}`") for c in docs.columns]).alias(n) for k, n in enumerate(("h", "h2"))]


def _nodes_of(docs: DataFrame) -> DataFrame:
    """A written row per document: doc_id (text), h and h2 (hashes of the row), node (digest of its set; null without
    a word), sig."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            sets = (shingler.shingles(t) for texts in in_slices(batch.column("text")) for t in texts)
            found = [(hashlib.md5(s.tobytes()).digest(), signature(s).tobytes()) if len(s) else (None, None) for s in sets]
            kept = [batch.column(c) for c in ("doc_id", "h", "h2")]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array([f[k] for f in found], pa.binary()) for k in (0, 1))], names=["doc_id", "h", "h2", "node", "sig"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), *row_hashes(docs), text_of().alias("text"))
    return cut_lineage(rows.mapInArrow(measure, "doc_id string, h long, h2 long, node binary, sig binary"))


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) for the wanted (node, h, h2): the sets of one document of each."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            found = [shingler.shingles(t).tobytes() for texts in in_slices(batch.column("text")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], names=["node", "shingles"])

    rows = docs.select(*row_hashes(docs), text_of().alias("text"))
    wanted = join_small(rows, nodes.select("node", "h", "h2"), ["h", "h2"], max_rows=300_000)
    return wanted.select("node", "text").mapInArrow(sets, "node binary, shingles binary").dropDuplicates(["node"])


def _blocks(members: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Deal members of groups (``keys``, of ``size`` members) out to pairs of blocks i <= j: a row for each pair that a
    member's block is in, with the pair and the side."""
    n = F.ceil(F.col(size) / BLOCK).cast("int")
    rows = members.withColumn("_n", n).withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_n")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return rows.select("*", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), (F.col("_own") <= F.col("_other")).alias("left"),
                       (F.col("_own") == F.col("_other")).alias("both")).drop("_n", "_own", "_other")


def _sides(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    pdf = pdf.sort_values("node", kind="stable")
    if pdf["both"].all():
        return pdf, pdf, True
    return pdf[pdf["left"]], pdf[~pdf["left"]], False


def _signatures(pdf: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), HASHES) if len(pdf) else np.empty((0, HASHES), np.uint16)


def _edges_in_block(steps):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, same = _sides(pdf)
        i, j = surviving_pairs(_signatures(left), _signatures(right), steps, same)
        a, b = list(left["node"]), list(right["node"])
        shift = 0 if same else len(a)
        found = forest(len(a) + (0 if same else len(b)), i, j + shift)
        return pd.DataFrame([(a[x], b[y - shift]) for x, y in found], columns=["a", "b"])

    return run


def _links_in_block(threshold: float, steps):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, same = _sides(pdf)
        i, j = surviving_pairs(_signatures(left), _signatures(right), steps, same)
        sets_l = [np.frombuffer(x, np.uint64) for x in left["shingles"]]
        sets_r = sets_l if same else [np.frombuffer(x, np.uint64) for x in right["shingles"]]
        ok = linked(sets_l, sets_r, i, j, threshold)
        i, j = i[ok], j[ok]
        a, b = list(left["node"]), list(right["node"])
        copies_a, copies_b = left["copies"].to_numpy(), right["copies"].to_numpy()
        n_a, n_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        np.add.at(n_a, i, copies_b[j])
        np.add.at(n_a if same else n_b, j, copies_a[i])
        rows = [(x, None, int(n)) for x, n in zip(a, n_a, strict=True) if n]
        if not same:
            rows += [(x, None, int(n)) for x, n in zip(b, n_b, strict=True) if n]
        shift = 0 if same else len(a)
        rows += [(a[x], b[y - shift], 0) for x, y in forest(len(a) + (0 if same else len(b)), i, j + shift)]
        return pd.DataFrame(rows, columns=["a", "b", "n"])

    return run


def _grouped(df: DataFrame, keys: list[str], run, schema: str) -> DataFrame:
    def typed(pdf: pd.DataFrame) -> pd.DataFrame:
        return run(pdf)

    return df.groupBy(*keys).applyInPandas(typed, schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes that ``edges`` (a, b) join with others: root is the smallest node of the component.

    Each round sends a node to the smallest of its neighbours and itself, and on to where that one goes, and keeps the
    edges whose ends came to different nodes. So the edges shrink by more than half a round where the order of nodes
    has nothing to do with the edges (they are digests). Rounds are written tables; their steps are put together from
    the last, smallest one.
    """
    ends = lambda a, b: [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]
    left = cut_lineage(edges.where("a <> b").select(*ends("a", "b")).distinct())
    roots, steps = left.select(F.col("a").alias("node"), F.col("b").alias("root")), []
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
        up = near.select(F.col("node").alias("root"), F.col("root").alias("next"))
        steps.append(cut_lineage(near.join(up, "root").select("node", F.col("next").alias("root"))))
        moved = left.join(steps[-1].toDF("a", "to_a"), "a").join(steps[-1].toDF("b", "to_b"), "b")
        left = cut_lineage(moved.where("to_a <> to_b").select(*ends("to_a", "to_b")).distinct())
    if steps:
        roots = steps.pop()
    while steps:
        on = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        roots = cut_lineage(steps.pop().join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
    return roots


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id (text), h, h2 (hashes of the row), node, class_id (text: the
    class's smallest doc_id as a number, or null if none has one), first (whether the row is the one to keep), n_links.

    Documents link when the Jaccard similarity of their sets of five-word n-grams is at least ``threshold``; classes
    are the components of the links, n_links counts the other documents a document links with, copies included. A text
    of fewer words is one n-gram of all of them; without a word it links with nothing. Nulls are read as empty texts.
    Rows that repeat a document are copies of it. Empty input: empty result.
    """
    bound_batches(docs.sparkSession)
    steps = least_matches(threshold, TOLERANCE)
    rows = _nodes_of(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), "h", "h2")
    nodes = cut_lineage(rows.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min(order).alias("least"), F.first("sig").alias("sig")))
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    bands = nodes.select("node", F.posexplode(keys).alias("band", "key"))
    buckets = cut_lineage(bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = cut_lineage(join_small(bands, buckets, ["band", "key"], max_rows=300_000))

    small = members.where(F.col("n") <= SMALL).select("band", "key", "node")
    a, b = small.withColumnRenamed("node", "a"), small.withColumnRenamed("node", "b")
    pairs = a.join(b, ["band", "key"]).where("a < b").select("a", "b").distinct()
    sigs = nodes.select("node", "sig")
    compared = (pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b"))

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                matrix = lambda c, pdf=pdf: np.frombuffer(b"".join(pdf[c]), np.uint16).reshape(len(pdf), HASHES)
                yield pdf.loc[surviving(matrix("sig_a"), matrix("sig_b"), steps), ["a", "b"]]

    listed = compared.mapInPandas(prune, "a binary, b binary")
    large = members.where(F.col("n") > SMALL).join(sigs, "node")
    dealt = _blocks(large, ["band", "key"], "n")
    blocked = _grouped(dealt, ["band", "key", "i", "j"], _edges_in_block(steps), "a binary, b binary")
    groups = components(listed.unionAll(blocked))

    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    own = groups.join(sizes, "root").join(nodes, "node").select("node", "root", "n", "copies", "sig", F.col("least.h").alias("h"), F.col("least.h2").alias("h2"))
    own = cut_lineage(own)
    with_sets = own.drop("h", "h2").join(_sets_of(docs, own), "node")
    # small groups share a task by hash, so that a task has many
    verified = cut_lineage(_grouped(_blocks(with_sets, ["root"], "n"), ["root", "i", "j"], _links_in_block(threshold, steps), "a binary, b binary, n long"))
    counts = verified.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    classes = components(verified.where("b is not null"))
    tied = nodes.select("node", "copies", "least").join(classes, "node", "left").join(counts, "node", "left")
    tied = tied.select("node", "copies", F.coalesce("root", "node").alias("root"), "least", F.coalesce("links", F.lit(0)).alias("links"))
    firsts = tied.groupBy("root").agg(F.min("least").alias("least"))
    answer = cut_lineage(tied.drop("least").join(firsts, "root").select("node", (F.col("copies") - 1 + F.col("links")).alias("n_links"), "least"))
    out = rows.drop("sig").join(answer, "node", "left")
    alone = F.col("least").isNull()
    first = alone | ((F.col("h") == F.col("least.h")) & (F.col("h2") == F.col("least.h2")))
    return out.select("doc_id", "h", "h2", "node", F.when(alone, F.col("doc_id")).otherwise(F.col("least.id").cast("string")).alias("class_id"),
                      first.alias("first"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, of which each class keeps the one with the smallest doc_id. Rows equal in every
    column are one document and one row stays; rows without a word all stay but for such repeats."""
    kept = near_duplicates(docs).where("first").select("h", "h2").distinct()
    rows = docs.select(F.struct("*").alias("doc"), *row_hashes(docs)).join(kept, ["h", "h2"], "left_semi")
    copy = F.row_number().over(Window.partitionBy("h", "h2").orderBy("h"))
    return rows.withColumn("copy", copy).where("copy = 1").select("doc.*")


def op8_bayes_jaccard(spark, sf_dir):
    out = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("doc_id").cast("long"), F.col("class_id").cast("long"), "n_links")
