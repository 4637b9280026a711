"""Hard-negative mining by slot-decomposed selection.

An anchor's positives set overlapping windows of scores: each wants the best negatives at or below its own score. The
positives' scores, as upper limits, cut the scores into disjoint slots, so that a window is a run of slots from its own
downwards. Combiners in the tasks keep the first k candidates of each slot; merged over the tasks, the suffixes of an
anchor's descending slots answer all its windows.

The rows are read in blocks against slices of anchors, each of bounded size and broadcast by itself: once for the
positives, once for the slots.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, read
from tessera.llm.vectors import is_finite_vector, matrix

SLICE_BYTES = 8 << 20  # vectors of the anchors of one slice
BLOCK = 1 << 21  # scores computed at once
_LAST = np.iinfo(np.int64).max  # where null ids stand

_PARTIAL = "anchor int, slot int, score long, id long, n long"


class Best:
    """The first k candidates of each (anchor, slot): higher scores first, then smaller ids. A candidate is a row of
    ``n`` equal rows of the input and counts as so many."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k, self.slots = k, slots
        self.held = np.empty((0, 5), np.int64)  # anchor, slot, score, id, n
        self.new: list[np.ndarray] = []
        self.waiting = 0
        self.least = np.full((anchors, slots), np.iinfo(np.int64).min)  # score and id of the k-th
        self.least_id = np.full((anchors, slots), _LAST)

    def add(self, anchor, slot, score, id_, n) -> None:
        least = self.least[anchor, slot]
        fits = (n > 0) & ((score > least) | ((score == least) & (id_ < self.least_id[anchor, slot])))
        if fits.any():
            self.new.append(np.stack([anchor[fits], slot[fits], score[fits], id_[fits], n[fits]], 1))
            self.waiting += len(self.new[-1])
            if self.waiting > 4 * self.least.size + 100_000:
                self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate([self.held, *self.new])
        rows = rows[np.lexsort((rows[:, 3], -rows[:, 2], rows[:, 1], rows[:, 0]))]
        group = rows[:, 0] * self.slots + rows[:, 1]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(rows) else np.empty(0, np.int64)
        n = np.minimum(rows[:, 4], self.k)
        ends = np.cumsum(n)
        before = ends - n
        before -= np.repeat(before[first], np.diff([*first, len(rows)]))
        wanted = before < self.k
        closing = wanted & (before + n >= self.k)  # the row that holds the k-th of its group
        a, s = rows[closing, 0], rows[closing, 1]
        self.least[a, s], self.least_id[a, s] = rows[closing, 2], rows[closing, 3]
        self.held, self.new, self.waiting = rows[wanted], [], 0
        return self.held

    def floor(self) -> np.ndarray:
        """The least score that may still matter in the last slot of each anchor."""
        return self.least[:, -1]


class Anchors:
    """One slice of anchors, with the limits that their positives set, in descending order."""

    def __init__(self, table: pa.Table, width: int, kind: str):
        self.kind = kind
        self.width = width
        self.ids = table["vec_id"].to_numpy().astype(np.int64)
        self.labels = table["label"].to_numpy().astype(np.int64)
        self.n = table["n"].to_numpy().astype(np.int64)
        self.x = matrix(table["x"].combine_chunks(), width).astype(kind)
        self.limits = np.empty((len(self.ids), 0), np.int64)

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        size = max(1, BLOCK // max(1, len(self.ids)))
        for batch in batches:
            x = matrix(batch.column("x"), self.width).astype(self.kind)
            ids = batch.column("vec_id").fill_null(_LAST).to_numpy(zero_copy_only=False)
            labels, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("label", "n"))
            for i in range(0, len(x), size):
                yield x[i : i + size], ids[i : i + size], labels[i : i + size], n[i : i + size]

    def positives(self, batches: Iterator[pa.RecordBatch], k: int) -> np.ndarray:
        """The first k other rows of each anchor's label."""
        best = Best(len(self.ids), 1, k)
        mine = {label: np.flatnonzero(self.labels == label) for label in np.unique(self.labels).tolist()}
        for x, ids, labels, n in self.blocks(batches):
            for label in np.unique(labels).tolist():
                if label not in mine:
                    continue
                a, r = mine[label], np.flatnonzero(labels == label)
                scores = x[r] @ self.x[a].T
                at, to = np.nonzero(scores >= best.floor()[a].astype(scores.dtype))
                score, at, to = scores[at, to].astype(np.int64), r[at], a[to]
                copies = n[at].copy()
                itself = np.flatnonzero(ids[at] == self.ids[to])
                itself = itself[np.all(x[at[itself]] == self.x[to[itself]], axis=1)]
                copies[itself] -= 1
                best.add(to, np.zeros_like(to), score, ids[at], copies)
            if best.waiting:
                best.settle()
        return best.settle()

    def negatives(self, batches: Iterator[pa.RecordBatch], k: int, low: tuple[int, int]) -> np.ndarray:
        """The first k rows of other labels in each slot: slot c holds the scores above limit c + 1 and up to limit c,
        as far down as the window of limit c goes."""
        slots = self.limits.shape[1]
        lows = -(-low[0] * self.limits // low[1])  # the least whole score of each window
        best = Best(len(self.ids), slots, k)
        top, least = self.limits[:, 0], lows.min(axis=1)
        for x, ids, labels, n in self.blocks(batches):
            scores = x @ self.x.T
            floor = np.maximum(least, best.floor())
            wanted = (scores <= top.astype(scores.dtype)) & (scores >= floor.astype(scores.dtype)) & (labels[:, None] != self.labels)
            at, to = np.nonzero(wanted)
            score = scores[at, to].astype(np.int64)
            slot = np.sum(self.limits[to] >= score[:, None], axis=1) - 1
            inside = score >= lows[to, slot]
            at, to, score, slot = at[inside], to[inside], score[inside], slot[inside]
            best.add(to, slot, score, ids[at], n[at])
            if best.waiting:
                best.settle()
        return best.settle()


def _partial(rows: np.ndarray) -> pa.RecordBatch:
    ids = pa.array(rows[:, 3], mask=rows[:, 3] == _LAST)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, 0].astype(np.int32)), pa.array(rows[:, 1].astype(np.int32)), pa.array(rows[:, 2]), ids, pa.array(rows[:, 4])],
                                      names=["anchor", "slot", "score", "id", "n"])


def _first(partial: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Merge the tasks' candidates: the first k of each key, one row for each copy, with their place from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    rows = partial.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("copy", "n")


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id``, ``label``, the whole-number vector ``x`` and ``n``, how many equal rows it stands for. Rows with a
    null label, a null vector or an entry that is null or not finite take no part."""
    valid = rows.where(F.col("label").isNotNull() & is_finite_vector(F.col("embedding")))
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return valid.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x")).groupBy("vec_id", "label", "x").agg(F.count(F.lit(1)).alias("n"))


def _kind(most: int, width: int) -> str:
    """The narrowest numbers in which all inner products are exact."""
    bound = most * most * max(1, width)
    if bound >= 1 << 63:
        raise ValueError("inner products of these vectors do not fit a long")
    return "float32" if bound < 1 << 24 else "float64" if bound < 1 << 53 else "int64"


def hard_negatives(rows: DataFrame, is_anchor: Column, k_positives: int = 5, k: int = 5, low: tuple[int, int] = (80, 100),
                   slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``: for
    each anchor and each of its first ``k_positives`` other rows of the same label the first ``k`` rows of other labels
    that score at most as high as the positive and at least low[0] / low[1] of it.

    ``rows`` holds vec_id, label and x (integer_vectors), ``is_anchor`` says which rows are anchors. Higher inner
    products come first, ties by smaller vec_id; rows without an id come last among ties and are no anchors where
    ``is_anchor`` is null. Rows equal in id, label and vector stand side by side as separate rows: a copy of an anchor
    is an anchor too and the other's positive. Shorter vectors are filled up with zeros. A window that holds no
    negative gives no row, and an empty input an empty result. Inner products beyond a long raise ValueError.
    """
    spark = rows.sparkSession
    table = cut_lineage(rows.select("vec_id", "label", "x", "n"))
    shape = table.agg(F.max(F.size("x")).alias("width"), F.max(F.array_max(F.transform("x", lambda c: F.abs(c)))).alias("most"),
                      F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    width = shape["width"] or 0
    kind = _kind(shape["most"] or 0, width)
    n_slices = math.ceil(shape["anchors"] * max(1, width) * 8 * 2 / slice_bytes)  # half full, as hashes do not deal evenly
    slices = table.where(is_anchor).withColumn("slice", F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(max(1, n_slices))))
    slices = cut_lineage(slices)
    parts = []
    for s in range(n_slices):
        anchors = Anchors(slices.where(F.col("slice") == s).toArrow(), width, kind)
        if not len(anchors.ids):
            continue
        shared = spark.sparkContext.broadcast(anchors)

        def positives(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            yield _partial(shared.value.positives(batches, k_positives))

        chosen = cut_lineage(_first(table.mapInArrow(positives, _PARTIAL), ["anchor"], k_positives))
        found = chosen.select("anchor", "place", "score").toArrow()  # at most k_positives for each anchor of the slice
        if not found.num_rows:
            continue
        at, place, score = (found[c].to_numpy().astype(np.int64) for c in ("anchor", "place", "score"))
        limits = np.full((len(anchors.ids), k_positives), _LAST)
        limits[at, place - 1] = score
        limits = np.minimum.accumulate(limits, axis=1)  # an anchor with fewer positives repeats its last limit
        has = np.unique(at)
        anchors.limits = limits
        for name in ("ids", "labels", "n", "x", "limits"):
            setattr(anchors, name, getattr(anchors, name)[has])
        bounds = spark.sparkContext.broadcast(anchors)

        def negatives(batches: Iterator[pa.RecordBatch], bounds=bounds) -> Iterator[pa.RecordBatch]:
            yield _partial(bounds.value.negatives(batches, k, low))

        held = _first(table.mapInArrow(negatives, _PARTIAL), ["anchor", "slot"], k)
        best_first = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("id").isNull().alias("last"), "id")))
        slots = held.groupBy("anchor").agg(best_first.alias("slots"))  # at most k for each of the k_positives slots
        names = spark.createDataFrame(pa.table({"anchor": pa.array(np.arange(len(has), dtype=np.int32)), "old": pa.array(has.astype(np.int32)),
                                                "anchor_id": anchors.ids, "copies": anchors.n}))
        wanted = chosen.withColumnRenamed("anchor", "old").join(names, "old").join(slots, "anchor")
        parts.append(cut_lineage(_windows(wanted, k, low)))
        shared.destroy()
        bounds.destroy()
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _windows(wanted: DataFrame, k: int, low: tuple[int, int]) -> DataFrame:
    """From an anchor's slots, best first, each positive's window: the suffix from its own slot on, its first k, and of
    these the ones that are not below the window."""
    score = F.col("score")
    suffix = F.slice(F.filter("slots", lambda c: -c["minus"] <= score), 1, k)
    window = F.filter(suffix, lambda c: low[0] * score <= -low[1] * c["minus"])
    rows = wanted.select("anchor_id", F.col("id").alias("positive_id"), score.alias("positive_score"), "copies", F.posexplode(window).alias("at", "c"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("c.id").alias("negative_id"), "positive_score",
                       (-F.col("c.minus")).alias("negative_score"))


def op12_slot_negatives(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(integer_vectors(rows.withColumn("label", label)), F.col("vec_id") % 100 == 0)


SQL = """
WITH vec AS (
  SELECT row_number() OVER () AS row_no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
scored AS (
  SELECT a.row_no AS anchor_no, a.vec_id AS anchor_id, r.row_no, r.vec_id, r.label = a.label AS same,
         CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
  FROM vec AS a JOIN vec AS r ON a.row_no <> r.row_no WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_no ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_no, p.row_no ORDER BY n.score DESC, n.vec_id NULLS LAST) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive AS p
JOIN scored AS n ON n.anchor_no = p.anchor_no AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
