"""Benchmark decontamination against brute force."""

import collections
import hashlib
import re

import pytest

from tessera.llm import decontaminate as D
from tessera.llm.common import LOWER, UPPER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))


def brute(docs, items):
    """(doc_id, n_words, n_hit, items) of each document."""
    grams = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i : i + n])].add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[tuple(w[i : i + n])]
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return out


@pytest.fixture(scope="module")
def tables(spark, messy_dir):
    docs, bench = (spark.read.parquet(f"{messy_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return docs, bench, brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])


def test_query_equals_brute_force(spark, messy_dir, tables):
    got = collections.Counter(map(tuple, D.op11_benchmark_ngrams(spark, messy_dir).collect()))
    want = collections.Counter((i, n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), h > 0) for i, n, h, f in tables[2])
    assert got == want
    assert sum(k[5] for k in want) > 20 and sum(not k[5] for k in want) > 30


def test_slices_find_the_same(tables):
    docs, bench, _ = tables
    of = lambda df: sorted(map(str, df.select("doc.doc_id", "n_words", "hits", "spans", "items").collect()))
    whole, sliced = D.find_windows(docs, bench), D.find_windows(docs, bench, max_bytes=900)
    assert len(D.test_pieces(bench, 900).select("slice").distinct().collect()) > 4
    assert of(whole) == of(sliced)
    assert whole.schema == sliced.schema and whole.select("doc.*").columns == docs.columns


def test_long_items_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(D, "PIECE", 7)
    text = " ".join(f"w{i}" for i in range(95))
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = spark.createDataFrame([(0, "a " + text + " b"), (1, " ".join(f"w{i}" for i in range(84, 94))), (2, " ".join(f"w{i}" for i in range(85, 94)))], "doc_id long, text string")
    hit = {r["d"]: r["h"] for r in D.find_windows(docs, bench).selectExpr("doc.doc_id d", "hits h").collect()}
    assert [tuple(x) for x in hit[0]] == [(1, 96)] and [tuple(x) for x in hit[1]] == [(0, 10)] and hit[2] == []


def test_spans_and_documents_are_removed(spark):
    item = "What is the airspeed velocity of an unladen swallow in May?"
    rows = [(1, f"Über: 😀 {item.upper()} -- tail", "k"), (2, "clean text", "k"), (3, None, "k"), (4, f"{item} {item}", "k"), (5, "unladen swallow in May", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept = D.decontaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r[0] for r in kept.collect()) == [2, 3, 5]
    cut = {r["doc_id"]: r["text"] for r in D.decontaminated(docs, bench, "spans").collect()}
    assert cut == {1: "Über: 😀 ? -- tail", 2: "clean text", 3: None, 4: "?", 5: "unladen swallow in May"}
    with pytest.raises(ValueError):
        D.decontaminated(docs, bench, "lines")


def test_empty_test_set_hits_nothing(spark, messy_dir):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = spark.read.parquet(f"{messy_dir}/documents.parquet")
    found = D.find_windows(docs, bench)
    assert found.count() == docs.count() and found.where("size(hits) + size(items) > 0").isEmpty()


def test_different_windows_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(D.Windows, "hashes", lambda self, grams: (grams.sum(axis=1) % 3).astype(D.np.uint64))
    with pytest.raises(ValueError):
        D.TestSet([("1", [f"w{i}" for i in range(40)])])
    # three windows at most, each with a hash of its own; what a text has of the same hash is verified
    tests = D.TestSet([("1", [f"w{i}" for i in range(11)])])
    tests.windows[0].known[:] = True
    assert tests.scan([b"w1 w0 w2 w3 w4 w5 w6 w7 w8 w9", b"w0 w1 w2 w3 w4 w5 w6 w7 w8 w9"], [[], []])[0][1] == []
