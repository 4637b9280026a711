"""Benchmark decontamination by a broadcast hash set of test n-grams.

The windows of ten consecutive words of every test item (all words, where an item has fewer) are normalised, hashed and
broadcast. One pass over the training documents rolls the same hash over their words; a window whose hash is in the set
is verified word by word against the windows that have it. The words inside verified windows are hit: they can be cut
out as spans, or their documents dropped.

The broadcast is bounded: a test set of more than ``max_bytes`` is dealt out in slices of that size, each broadcast by
itself, and the documents pass one slice after another with what they have been found to hold. No document is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import LOWER, UPPER, ascii_lower, cut_lineage, read, running_offsets, text_of

WINDOW = 10
MAX_BYTES = 32 << 20  # words of one slice of the test set, with 16 bytes for each word
PIECE = 100_000  # windows of an item that go to a slice together
CHUNK = 1 << 20  # bytes of text whose words are looked up at once
NGRAM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after A-Z are lower-cased
_WORD_IN_TEXT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_BASE = np.uint64(0xD1342543DE82EF95)

FOUND = "n_words long, hits array<struct<first:int,stop:int>>, spans array<struct<start:int,stop:int>>, items array<string>"


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Windows:
    """The distinct windows of one length: their word numbers, hashes in ascending order, and the items of each."""

    def __init__(self, length: int, grams: np.ndarray, owners: np.ndarray):
        self.length = length
        self.grams, which = np.unique(grams, axis=0, return_inverse=True)
        for self.seed in range(1, 100):
            hashes = self.hashes(self.grams)
            order = np.argsort(hashes)
            if len(order) < 2 or np.all(np.diff(hashes[order])):
                break
        else:
            raise ValueError("no seed gives the windows different hashes")
        self.sorted, self.grams = hashes[order], self.grams[order]
        self.shift = np.uint64(64 - min(26, max(10, int(len(order) * 16).bit_length())))
        self.known = np.zeros(1 << (64 - int(self.shift)), bool)
        self.known[self.sorted >> self.shift] = True
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pairs = np.unique(np.stack([place[which.ravel()], owners], 1), axis=0)
        self.owners = pairs[:, 1]
        self.bounds = np.searchsorted(pairs[:, 0], np.arange(len(order) + 1))

    def hashes(self, grams: np.ndarray) -> np.ndarray:
        h = np.zeros(len(grams), np.uint64)
        for column in grams.T:
            h = h * _BASE + _mix(column.astype(np.uint64) + np.uint64(self.seed << 32))
        return h

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``ids`` (unknown words are negative) windows of the set begin, and which ones."""
        n = len(ids) - self.length + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        at = np.flatnonzero(unknown[self.length :] == unknown[:n])
        mixed = _mix(ids.astype(np.uint64) + np.uint64(self.seed << 32))
        h = np.zeros(len(at), np.uint64)
        for k in range(self.length):
            h = h * _BASE + mixed[at + k]
        likely = self.known[h >> self.shift]
        at, h = at[likely], h[likely]
        which = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        same = self.sorted[which] == h
        at, which = at[same], which[same]
        same = np.all(ids[at[:, None] + np.arange(self.length)] == self.grams[which], axis=1)  # the verification
        return at[same], which[same]


class TestSet:
    """The windows of one slice of the test set, with a number for each of its words."""

    __test__ = False  # not a test case of pytest

    def __init__(self, pieces: list[tuple[str, list[str]]]):
        self.numbers: dict[bytes, int] = {}
        self.items = sorted({item for item, _ in pieces})
        owner = {item: k for k, item in enumerate(self.items)}
        grams: dict[int, list] = {}
        for item, words in pieces:
            ids = np.array([self.numbers.setdefault(w.encode(), len(self.numbers)) for w in words], np.int64)
            length = min(WINDOW, len(ids))
            found = np.lib.stride_tricks.sliding_window_view(ids, length)
            grams.setdefault(length, []).append((found, np.full(len(found), owner[item], np.int64)))
        self.windows = [Windows(n, np.concatenate([g for g, _ in parts]), np.concatenate([o for _, o in parts]))
                        for n, parts in sorted(grams.items())]

    def scan(self, texts: list[bytes], before: list[list[dict]]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """Per text its number of words, the ranges of words hit here or ``before``, and the items found here."""
        number = self.numbers.get
        words = [words_of(t) for t in texts]
        starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])  # an unknown word ends each text
        ids = np.full(starts[-1], -1, np.int64)
        for start, w in zip(starts.tolist(), words, strict=False):
            ids[start : start + len(w)] = np.fromiter((number(x, -1) for x in w), np.int64, len(w))
        edge = np.zeros(len(ids) + 1, np.int64)
        held: dict[int, set[int]] = {}
        for windows in self.windows:
            at, which = windows.find(ids)
            if not len(at):
                continue
            np.add.at(edge, at, 1)
            np.add.at(edge, at + windows.length, -1)
            pairs = np.unique(np.stack([np.searchsorted(starts, at, side="right") - 1, which], 1), axis=0)
            for doc, w in pairs.tolist():
                held.setdefault(doc, set()).update(windows.owners[windows.bounds[w] : windows.bounds[w + 1]].tolist())
        for start, old in zip(starts.tolist(), before, strict=False):
            for r in old or ():
                edge[start + r["first"]] += 1
                edge[start + r["stop"]] -= 1
        hit = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
        turns = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)  # word ranges; none crosses the end of a text
        first = np.searchsorted(turns[:, 0], starts[:-1])
        ranges = turns.tolist()
        bounds = [*first.tolist(), len(ranges)]
        return [(len(w), [(a - s, b - s) for a, b in ranges[bounds[k] : bounds[k + 1]]], [self.items[i] for i in sorted(held.get(k, ()))])
                for k, (w, s) in enumerate(zip(words, starts.tolist(), strict=False))]


def in_text(data: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as code points of the text."""
    if not ranges:
        return []
    words = [m.span() for m in _WORD_IN_TEXT.finditer(data.decode())]
    return [(words[a][0], words[b - 1][1]) for a, b in ranges]


def test_pieces(bench: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The words of every item in pieces of at most PIECE windows, with the number of the slice that each is in."""
    rows = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                        F.regexp_extract_all(ascii_lower(text_of()), F.lit(NGRAM_WORD), F.lit(0)).alias("words"))
    last = F.greatest(F.size("words") - WINDOW, F.lit(0))
    pieces = rows.where(F.size("words") > 0).select("item", "words", F.explode(F.sequence(F.lit(0), last, F.lit(PIECE))).alias("start"))
    pieces = pieces.select("item", F.slice("words", F.col("start") + 1, F.lit(PIECE + WINDOW - 1)).alias("words"))
    pieces = pieces.withColumn("n", (F.octet_length(F.array_join("words", "")) + 16 * F.size("words")).cast("long"))
    pieces = cut_lineage(pieces.withColumn("part", F.monotonically_increasing_id()))
    placed = running_offsets(pieces, [], "part", "n", "before")
    return cut_lineage(placed.select("item", "words", F.floor(F.col("before") / max_bytes).cast("long").alias("slice")))


def find_windows(docs: DataFrame, bench: DataFrame, text: str = "text", keep: list[str] | None = None, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc`` (the columns ``keep`` of the row, or all), ``n_words`` long, ``hits`` (ranges of word
    numbers, stop exclusive), ``spans`` (the same stretches in code points of the text) and ``items`` (ids of the test
    items found, as ascending strings, each once).

    ``bench`` holds item_id and text. Null texts have no words, and items without words no windows; a null item_id is
    the empty string, and rows that repeat an item_id are one item. Texts are scanned whole, of any length; equal rows
    give equal results. An empty test set hits nothing; empty ``docs`` give an empty result. Columns of any name may
    stand beside the text.
    """
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    pieces = test_pieces(bench, max_bytes)
    slices = sorted(r[0] for r in pieces.select("slice").distinct().collect()) or [None]
    everything = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.lit(None).cast("array<struct<first:int,stop:int>>").alias("hits"),
                             F.lit(None).cast("array<string>").alias("items"))
    for k, number in enumerate(slices):
        kept = keep if k == len(slices) - 1 else docs.columns
        rows = [] if number is None else pieces.where(F.col("slice") == number).select("item", "words").toArrow().to_pylist()
        shared = spark.sparkContext.broadcast(TestSet([(r["item"], r["words"]) for r in rows]))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, kept=kept) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            for batch in batches:
                doc = batch.column("doc")
                data = [x or b"" for x in doc.field(text).cast(pa.binary()).to_pylist()]
                old = batch.column("hits").to_pylist()
                found, start, size = [], 0, 0
                for i, x in enumerate(data, 1):
                    size += len(x)
                    if size >= CHUNK or i == len(data):
                        found += tests.scan(data[start:i], old[start:i])
                        start, size = i, 0
                items = [sorted({*(a or ()), *f[2]}) for a, f in zip(batch.column("items").to_pylist(), found, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.StructArray.from_arrays([doc.field(c) for c in kept], kept), pa.array([f[0] for f in found], pa.int64()),
                    pa.array([[{"first": a, "stop": b} for a, b in f[1]] for f in found], _ranges("first")),
                    pa.array([[{"start": a, "stop": b} for a, b in in_text(x, f[1])] for x, f in zip(data, found, strict=True)], _ranges("start")),
                    pa.array(items, pa.list_(pa.string()))], names=["doc", "n_words", "hits", "spans", "items"])

        kind = T.StructType([T.StructField("doc", T.StructType([docs.schema[c] for c in kept])), *T.StructType.fromDDL(FOUND).fields])
        everything = everything.select("doc", "hits", "items").mapInArrow(scan, kind)
        if k < len(slices) - 1:
            everything = cut_lineage(everything)
    return everything


def _ranges(first: str) -> pa.DataType:
    return pa.list_(pa.struct([(first, pa.int32()), ("stop", pa.int32())]))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the given stretches, which ascend and do not overlap."""
    begin = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.struct(
        F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["stop"]).alias("a"), F.coalesce(F.get(spans, i)["start"], F.length(text)).alias("b")))
    return F.array_join(F.transform(begin, lambda r: F.substring(text, r["a"] + 1, r["b"] - r["a"])), "")


def decontaminated(docs: DataFrame, bench: DataFrame, mode: str = "documents", text: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows of ``docs`` without the documents that hold a test window, or (``mode`` "spans") with the words of such
    windows and what stands between them cut out of their texts. A null text stays null."""
    found = find_windows(docs, bench, text, max_bytes=max_bytes)
    if mode == "documents":
        return found.where(F.size("hits") == 0).select("doc.*")
    if mode != "spans":
        raise ValueError(f"mode is 'documents' or 'spans', not {mode!r}")
    whole = F.col("doc").getField(text)
    cut = F.when(F.size("spans") > 0, without_spans(whole, F.col("spans"))).otherwise(whole)
    return found.select(*[(cut if c == text else F.col("doc").getField(c)).alias(c) for c in docs.columns])


def op11_benchmark_ngrams(spark, sf_dir):
    found = find_windows(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, r: total + r["stop"] - r["first"])
    return found.select("doc.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{NGRAM_WORD}')"
SQL = f"""
WITH item AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), {WINDOW}) AS n FROM item WHERE len(w) > 0),
item_window AS (
  SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
doc AS (SELECT row_number() OVER () AS row_no, doc_id, {_WORDS} AS w FROM documents),
doc_window AS (
  SELECT row_no, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc JOIN (SELECT DISTINCT n FROM sized) AS sizes ON len(w) >= n)),
hit AS (SELECT row_no, i, n, item FROM doc_window JOIN item_window USING (n, gram)),
hit_word AS (SELECT row_no, count(DISTINCT p) AS n_hit FROM (SELECT row_no, unnest(range(i, i + n)) AS p FROM hit) GROUP BY row_no),
hit_item AS (
  SELECT row_no, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT row_no, item FROM hit) GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit_word USING (row_no) LEFT JOIN hit_item USING (row_no)
"""
