"""Hard negatives against brute force."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives as H

LAST = float("inf")


def brute(rows, anchor, label_of=lambda i, label: label, k=5):
    valid = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            valid.append((i, label_of(i, label), [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, (i, label, x) in enumerate(valid):
        if i is None or not anchor(i):
            continue
        scored = [(-sum(p * q for p, q in zip(x, y, strict=False)), LAST if j is None else j, other) for b, (j, other, y) in enumerate(valid) if b != a]
        positives = sorted(s for s in scored if s[2] == label)[:k]
        negatives = sorted(s for s in scored if s[2] != label)
        for ps, p, _ in positives:
            window = [(n, s) for s, n, _ in negatives if 80 * -ps <= 100 * -s <= 100 * -ps][:k]
            out += [(i, None if p == LAST else p, r, None if n == LAST else n, -ps, -s) for r, (n, s) in enumerate(window, 1)]
    return collections.Counter(out)


def relabelled(i, label):
    return (label + 1) % 10 if i is not None and i % 7 == 0 else label


def columns(df):
    return collections.Counter(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_query_equals_brute_force(spark, messy_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{messy_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got, want = columns(H.op12_slot_negatives(spark, messy_dir)), brute(rows, lambda i: i % 100 == 0, relabelled)
    assert got == want
    assert len(want) > 80 and max(want.values()) > 1


@pytest.mark.parametrize("slice_bytes, block", [(200, 64), (1 << 20, 1 << 20)])
def test_slices_and_blocks_give_the_same(spark, messy_dir, monkeypatch, slice_bytes, block):
    monkeypatch.setattr(H, "BLOCK", block)
    table = spark.read.parquet(f"{messy_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    got = H.hard_negatives(H.integer_vectors(table), F.col("vec_id") % 20 == 0, slice_bytes=slice_bytes)
    assert columns(got) == brute([tuple(r) for r in table.collect()], lambda i: i % 20 == 0)


@pytest.mark.parametrize("scale", [1.0, 300.0, 3e5])
def test_all_number_kinds_are_exact(spark, scale):
    rng = random.Random(3)
    rows = [(i, [float(np.float32(scale * rng.gauss(0, 1))) for _ in range(5)], i % 3) for i in range(150)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert columns(H.hard_negatives(H.integer_vectors(table), F.col("vec_id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)


def test_scores_beyond_a_long_are_refused(spark):
    table = spark.createDataFrame([(0, [1e30, 1.0], 1), (1, [1e30, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError):
        H.hard_negatives(H.integer_vectors(table), F.col("vec_id") == 0)


def test_combiner_keeps_the_first_of_each_slot():
    rng = np.random.default_rng(2)
    anchor, slot, score, ids = (rng.integers(0, m, 20_000) for m in (6, 3, 40, 900))
    n = rng.integers(0, 4, 20_000)
    best = H.Best(6, 3, 5)
    for i in range(0, 20_000, 700):
        best.add(anchor[i : i + 700], slot[i : i + 700], score[i : i + 700], ids[i : i + 700], n[i : i + 700])
        best.settle()
    held = collections.defaultdict(list)
    for a, s, sc, i, c in best.settle().tolist():
        held[a, s] += [(-sc, i)] * c
    for key in {(a, s) for a in range(6) for s in range(3)}:
        mine = (anchor == key[0]) & (slot == key[1])
        want = sorted(x for sc, i, c in zip(score[mine], ids[mine], n[mine], strict=True) for x in [(-sc, i)] * c)[:5]
        assert held[key][:5] == want


def test_no_anchor_and_no_positive(spark):
    table = spark.createDataFrame([(100, [1.0], 1), (3, [1.0], 2), (4, [1.0], None)], "vec_id long, embedding array<float>, label int")
    rows = H.integer_vectors(table)
    assert H.hard_negatives(rows, F.col("vec_id") == 100).count() == 0  # no other row of its label
    assert H.hard_negatives(rows, F.col("vec_id") == 7).count() == 0
