"""Line dedup: lines that many documents share stay in one document only.

Method: explode normalised lines, hash them, count distinct documents per hash, drop the lines over the threshold and
put the rest together again by position. Only hashes and ids are shuffled for the counts; each document's text is
shuffled once, to meet the list of its own dropped lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, SPACES, UPPER, ascii_lower, bound_batches, in_slices, text_of

_TO_LOWER = str.maketrans(UPPER, LOWER)


def _exploded(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, h): the hashes of a document's distinct long lines."""
    keys = F.transform(F.split(text_of(), "\n", -1), lambda x: ascii_lower(F.btrim(x, F.lit(SPACES))))
    long_keys = F.filter(keys, lambda k: F.length(k) >= min_chars)
    hashes = F.array_distinct(F.transform(long_keys, lambda k: F.unhex(F.md5(k.cast("binary")))))
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), F.explode(hashes).alias("h"))


def _reassembler(min_chars: int):
    def keep(text: str, drops) -> tuple[int, int, str]:
        lines = text.split("\n")
        if drops is None or not len(drops):
            return len(lines), 0, text
        gone = {bytes(d) for d in drops}
        kept = []
        for line in lines:
            key = line.strip(SPACES).translate(_TO_LOWER)
            if len(key) < min_chars or hashlib.md5(key.encode()).digest() not in gone:
                kept.append(line)
        return len(lines), len(lines) - len(kept), "\n".join(kept)

    def reassemble(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, drops in batches:
            parts = []
            for some, gone in zip(in_slices(texts), in_slices(drops), strict=True):
                rows = [keep(t, d) for t, d in zip(some, gone, strict=True)]
                parts.append(pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                                         pa.array([r[2] for r in rows], pa.string())], ["n_lines", "n_dropped", "text"]))
            yield pa.concat_arrays(parts)

    return F.arrow_udf(reassemble, "n_lines long, n_dropped long, text string")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per row of ``docs``: ``doc`` (the row as a struct), ``kept`` (n_lines, n_dropped, text).

    A line's key is the line stripped of white space and with A-Z lower-cased. Keys of at least ``min_chars`` code
    points found in at least ``min_docs`` documents lose all their lines except in the largest doc_id holding it.
    Null text: one empty line. A row without doc_id can't be counted as a document; it keeps all its lines. Rows that
    repeat a doc_id are one document to the count, and each is reassembled. Empty input: empty result. Further
    columns of any name stay inside ``doc``.
    """
    bound_batches(docs.sparkSession)
    lines = _exploded(docs, min_chars)
    shared = (lines.groupBy("h").agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper"))
              .where(F.col("n") >= min_docs).select("h", "keeper"))
    drops = (lines.join(shared, "h").where(F.col("id") < F.col("keeper"))
             .groupBy("id").agg(F.collect_set("h").alias("drops")))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"))
    return (rows.join(drops, "id", "left")
            .select("doc", _reassembler(min_chars)(text_of(F.col("doc.text")), F.col("drops")).alias("kept")))


def op4_line_dedup(spark, sf_dir):
    from tessera.llm.common import read

    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc.doc_id", "kept.n_lines", "kept.n_dropped", F.sha2("kept.text", 256).alias("kept_sha256"))


SQL = """
WITH lines AS (
  SELECT d.doc_id, u.pos, u.line, translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM documents d, LATERAL (
    SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line,
           unnest(range(1, len(string_split(coalesce(d.text, ''), chr(10))) + 1)) AS pos) u
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.pos, l.line, (s.key IS NOT NULL AND l.doc_id <> s.keeper) AS gone
  FROM lines l LEFT JOIN shared s ON l.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
