"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets that fit in memory, by a seeded hash of the whole record. Pass
two shuffles each bucket with Fisher-Yates and writes it. Read bucket after bucket, the written records are one uniform
permutation of the input; dealing its positions out to the shards in turn gives shard sizes at most one row apart.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, join_small, read, running_offsets, text_of

LAW = "rows"
WORKER_BYTES = 32 << 20  # what a bucket may take of a task's Python worker
COPIES = 8  # of a bucket that a worker may hold: as received, joined, permuted and sent, with room for uneven buckets
BUCKET_BYTES = WORKER_BYTES // COPIES


def fisher_yates(n: int, rng: np.random.Generator) -> list[int]:
    """A uniform permutation of range(n)."""
    perm = list(range(n))
    picks = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64).tolist()
    for i in range(n - 1, 0, -1):
        j = picks[i]
        perm[i], perm[j] = perm[j], perm[i]
    return perm


def external_shuffle(df: DataFrame, text: str, n_shards: int, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row of ``df``: ``record`` (the row as a struct), ``shard`` int, ``slot`` long (gapless from 0).

    ``text`` names the column that makes up a record's bytes. The number of buckets follows the bytes of the input, so
    that each holds about ``bucket_bytes`` (a record longer than that is in a bucket by itself or with others). A
    bucket's records are put in the order of their hashes first, so reruns agree however the rows arrive. Rows equal
    in every column share a hash; those that together exceed four buckets are scattered by their place in the input
    instead, so no bucket outgrows memory (they are interchangeable). Empty input: empty result. Nulls hash as any
    other value. Columns of any name are kept inside ``record``.
    """
    names = df.columns
    rows = df.toDF(*[f"c{i}" for i in range(len(names))])
    size = F.coalesce(F.octet_length(f"c{names.index(text)}"), F.lit(0)).cast("long") + 16
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), *[F.col(c) for c in rows.columns]))
    weights = cut_lineage(rows.select("h", size.alias("size")).groupBy("h")
                          .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")))
    total = weights.agg(F.sum("size")).first()[0] or 0
    n_buckets = max(1, math.ceil(total / bucket_bytes))
    # at most total / (4 * bucket_bytes) hashes: less than a millionth of the input's bytes
    hot = weights.where((F.col("n") > 1) & (F.col("size") > 4 * bucket_bytes)).select("h", F.lit(True).alias("hot"))
    salt = F.lit(0).cast("long")
    if not hot.isEmpty():
        rows = rows.withColumn("place", F.monotonically_increasing_id())
        rows = join_small(rows, hot, "h", "left", max_rows=1_000_000)
        salt = F.when(F.col("hot"), F.col("place")).otherwise(0)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "h", salt), F.lit(n_buckets)))
    data = [f"c{i}" for i in range(len(names))]

    def shuffle(bucket: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        order = pc.sort_indices(rows["h"]).to_numpy()
        perm = fisher_yates(len(order), np.random.Generator(np.random.PCG64([seed, bucket[0].as_py()])))
        out = rows.select([*data, "bucket"]).take(pa.array(order[perm]))
        return out.append_column("rank", pa.array(np.arange(len(order))))

    schema = rows.select(*data, "bucket").withColumn("rank", F.lit(0).cast("long")).schema
    written = cut_lineage(rows.select(*data, "h", "bucket").groupBy("bucket").applyInArrow(shuffle, schema))
    counts = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = cut_lineage(running_offsets(counts, [], "bucket", "n", "base").select("bucket", "base"))
    position = F.col("base") + F.col("rank")
    record = F.struct(*[F.col(c).alias(n) for c, n in zip(data, names, strict=True)])
    return join_small(written, offsets, "bucket").select(
        record.alias("record"), F.pmod(position, F.lit(n_shards)).cast("int").alias("shard"),
        F.floor(position / n_shards).cast("long").alias("slot"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """The shards as folders of Parquet files, each file in the order of its slots."""
    (shuffled.select("record.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
     .repartition("_shard").sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path))


def op2_external_shuffle(spark, sf_dir, n_shards: int = 40):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = text_of(F.col("record.text"))
    return external_shuffle(docs, "text", n_shards).select(
        "record.doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
