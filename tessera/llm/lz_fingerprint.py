"""Document fingerprints from Lempel-Ziv phrases.

A document's UTF-8 bytes are parsed into dictionary phrases: each phrase is the longest one seen before plus one byte.
The phrases are hashed, and the smallest hashes of the set are the fingerprint. The share of common phrases, estimated
from two fingerprints, is a likeness as compression sees it: documents are alike where one's dictionary serves the
other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, join_small, read, text_of

SIZE = 128  # hashes in a fingerprint
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NULL = -(1 << 63)  # stands for a null doc_id where a bucket is looked up
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def parse(data: bytes, trie: dict[int, int], node: int = 0, start: int = 0) -> tuple[list[int], int]:
    """Continue a parse with ``data`` from ``node`` of ``trie``: the ends of the phrases completed, counted from
    ``start``, and the node reached. A node is a number; its child by byte b is at key node * 256 + b."""
    ends = []
    find = trie.get
    size = len(trie)
    for i, b in enumerate(data, start + 1):
        key = node << 8 | b
        child = find(key)
        if child is None:
            size += 1
            trie[key] = size
            ends.append(i)
            node = 0
        else:
            node = child
    return ends, node


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse, as far as a text has needed them."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            grow = lambda b: np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, b, np.uint64))])
            self.up, self.down = grow(_BASE), grow(_INVERSE)
        return self.up, self.down


def signature(data: bytes, ends: list[int], powers: _Powers) -> np.ndarray:
    """The SIZE smallest 32-bit hashes of the phrases that end at ``ends``; what is left at the end is a phrase too."""
    if not data:
        return np.empty(0, np.uint32)
    stops = np.asarray(ends if ends and ends[-1] == len(data) else [*ends, len(data)], np.int64)
    starts = np.concatenate([[0], stops[:-1]])
    up, down = powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    # the hash of a stretch does not depend on where it lies
    hashes = _mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32))[:SIZE]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of common members of two sets, from their smallest hashes."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:SIZE]
    return float(np.count_nonzero(np.isin(union, a, assume_unique=True) & np.isin(union, b, assume_unique=True)) / len(union))


def fingerprint(text: str) -> np.ndarray:
    data = text.encode()
    return signature(data, parse(data, {})[0], _Powers())


def as_hex(x: np.ndarray) -> str:
    return x.astype(">u4").tobytes().hex()


class _Document:
    """A text with the parse of its first part, from which the parses of the text and of its edited form go on."""

    def __init__(self, doc_id, text: str, powers: _Powers):
        self.doc_id, self.text, self.powers = doc_id, text, powers
        self.half = len(text) // 2
        self.head = text[: len(text) - self.half].encode()
        self.trie: dict[int, int] = {}
        self.ends, self.node = parse(self.head, self.trie)
        self.print = self._with(text[len(text) - self.half :].encode())

    def _with(self, tail: bytes) -> np.ndarray:
        more, _ = parse(tail, dict(self.trie), self.node, len(self.head))
        return signature(self.head + tail, self.ends + more, self.powers)

    def edited(self, following: str) -> tuple[str, np.ndarray]:
        tail = following[: self.half]
        return self.text[: len(self.text) - self.half] + tail, self._with(tail.encode())


NAMES = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows arrive by bucket, in descending order; a bucket ends with a guest, the first row of the next."""
    powers, last = _Powers(), None
    for pdf in batches:
        rows = []
        for key, text, guest in zip(pdf["key"], pdf["text"], pdf["guest"], strict=True):
            now = _Document(None if pd.isna(key) else int(key), text, powers)
            if last is not None:
                edited, print_ = last.edited(now.text)
                rows.append((last.doc_id, len(last.text), edited, as_hex(last.print), as_hex(print_),
                             likeness(last.print, print_), likeness(last.print, now.print)))
            last = None if guest else now
        out = pd.DataFrame(rows, columns=NAMES)
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def compare_with_next(docs: DataFrame, bucket_rows: int = 4000) -> DataFrame:
    """Fingerprints of each row of ``docs`` (doc_id, text) and of its edited text, and their likeness.

    The next document is the one with the next smaller doc_id (after the last, the first); a null doc_id is smaller
    than any, and rows that repeat one are in the order of their texts' hashes. A document alone is its own next. Null
    text is read as empty; two empty texts have likeness 1, an empty and another 0. Empty input: empty result.

    Ranges of doc_id are the buckets, so each text is shuffled once, with the first document of the bucket after as a
    guest at the end of each. A bucket is read as a stream, so its length costs no memory.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    edges = _edges(rows.select("doc_id"), bucket_rows)

    def number(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # the bucket of the largest ids is 0; null ids have a bucket of their own, the last
        for ids in batches:
            below = np.searchsorted(edges, ids.to_numpy(np.int64), side="left")
            yield pd.Series(np.where(ids == _NULL, len(edges) + 1, len(edges) - below))

    rows = rows.withColumn("bucket", F.pandas_udf(number, "long")(F.coalesce("doc_id", F.lit(_NULL))))
    order = [F.desc_nulls_last("doc_id"), F.asc("h")]
    firsts = cut_lineage(rows.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")))
    ring = firsts.select("bucket", "doc_id", F.lag("bucket").over(Window.orderBy("bucket")).alias("host"))
    ring = ring.withColumn("host", F.coalesce("host", F.lit(None if firsts.isEmpty() else firsts.agg(F.max("bucket")).first()[0])))
    heads = join_small(rows, ring.withColumnRenamed("bucket", "_b").withColumnRenamed("doc_id", "_d"),
                       (F.col("bucket") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    guests = heads.groupBy("host").agg(F.min(F.struct("h", "text")).alias("x")).select(
        F.lit(None).cast("long").alias("doc_id"), F.col("x.text").alias("text"), F.col("x.h").alias("h"), F.col("host").alias("bucket"), F.lit(True).alias("guest"))
    dealt = rows.withColumn("guest", F.lit(False)).unionByName(guests).repartition(len(edges) + 2, "bucket")
    sorted_rows = dealt.sortWithinPartitions("bucket", "guest", *order).select(F.col("doc_id").cast("string").alias("key"), "text", "guest")
    return sorted_rows.mapInPandas(_compared, SCHEMA)


def _edges(ids: DataFrame, bucket_rows: int) -> np.ndarray:
    """Every ``bucket_rows``-th id or so: 8 bytes for each of these many documents."""
    def every(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = 0
        for pdf in batches:
            yield pdf.iloc[bucket_rows - 1 - seen % bucket_rows :: bucket_rows]
            seen += len(pdf)

    ordered = ids.where("doc_id is not null").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return np.unique(np.array([r[0] for r in ordered.mapInPandas(every, "doc_id long").collect()], np.int64))


def op9_lz_phrases(spark, sf_dir):
    out = compare_with_next(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumn("edited", F.sha2("edited", 256)).withColumnRenamed("edited", "edited_sha256")
