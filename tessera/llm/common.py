"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage, ensure_checkpoint_dir

__all__ = ["WORD", "SPACES", "UPPER", "LOWER", "ascii_lower", "bound_batches", "in_slices", "read", "text_of", "join_small", "running_offsets",
           "cut_lineage", "ensure_checkpoint_dir"]

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


BATCH = "4m"


def bound_batches(spark: SparkSession) -> None:
    """Send texts to Python workers BATCH at a time. Spark's default bound of 64 MB counts several times over in a
    worker, and as much in the JVM beside it; a bound that the session sets otherwise stays. Results are the same."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("64m", "67108864b"):
        spark.conf.set(key, BATCH)


def in_slices(column: pa.Array, rows: int = 256) -> Iterator[list]:
    """The values of an Arrow column as Python objects, few at a time: a whole batch of texts as strings takes several
    times its size, and a worker that once held it does not give all of that back."""
    for i in range(0, len(column), rows):
        yield column.slice(i, rows).to_pylist()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(col: Column | str = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = 20_000) -> DataFrame:
    """Join with a table expected to be small: broadcast only if its counted size is within ``max_rows``,
    else a shuffle join that AQE may still re-plan. ``small`` should be a written table, as it is counted."""
    fits = small.limit(max_rows + 1).count() <= max_rows
    return big.join(F.broadcast(small) if fits else small, on, how)


def running_offsets(sizes: DataFrame, keys: list[str], order: str, value: str, out: str, chunk: int = 1024) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the smaller ``order`` (a non-negative long, unique per key).

    Two levels, so no task holds a key's rows: sums per run of ``chunk`` orders, a running sum over those, and a
    running sum inside each run.
    """
    part = sizes.withColumn("_ro_run", F.floor(F.col(order) / chunk).cast("long"))
    runs = part.groupBy(*keys, "_ro_run").agg(F.sum(value).alias("_ro_sum"))
    ahead = Window.partitionBy(*keys).orderBy("_ro_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*keys, "_ro_run", F.coalesce(F.sum("_ro_sum").over(ahead), F.lit(0)).alias("_ro_base"))
    inside = Window.partitionBy(*keys, "_ro_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (part.join(runs, [*keys, "_ro_run"])
            .withColumn(out, F.col("_ro_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_ro_run", "_ro_base"))
