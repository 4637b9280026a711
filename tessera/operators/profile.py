"""Profiling operators (the reference's inspection notebooks as distributed queries)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.operators.ordered import previous_in_order
from tessera.sources.normalize import any_populated


def daily_populated_rows(df: DataFrame, ts: Column, fields: Sequence[str]) -> DataFrame:
    """AGG-17: per date, the number of rows with any populated field."""
    return df.groupBy(ts.cast("date").alias("date")).agg(F.count_if(any_populated(fields)).alias("daily_rows_with_values"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-16: key values occurring more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def large_gaps(df: DataFrame, ts: str, threshold_seconds: int = 7200, partition_by: Sequence[str] = ()) -> DataFrame:
    """WIN-13: rows whose time since the previous row (per partition) exceeds the threshold.

    Uses the range-partitioned previous-row operator, so a single station
    (or no partition at all) never lands in one task.
    """
    base = df.select(*partition_by, F.col(ts).alias("dt"))
    prev = previous_in_order(base, "dt", ["dt"], list(partition_by), "prev_dt")
    from tessera.functions.calendar import ntz_micros

    delta = F.floor((ntz_micros("dt") - ntz_micros("prev_dt")) / F.lit(1_000_000)).cast("bigint")
    return prev.select(*partition_by, "dt", "prev_dt", delta.alias("delta_seconds")).where(
        F.col("delta_seconds") > threshold_seconds)


def column_population(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """AGG-18: non-empty / empty counts and percent populated per text column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(f) != "").alias(f"{f}__ne") for f in fields],
                    *[F.count_if(F.col(f) == "").alias(f"{f}__e") for f in fields])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"{f}__ne").alias("non_empty"), F.col(f"{f}__e").alias("empty"))
        for f in fields])).alias("s")).select("s.*")
    pct = F.try_divide(F.col("non_empty").cast("double"), (F.col("non_empty") + F.col("empty")).cast("double")) * 100
    return stacked.withColumn("pct_populated", pct)


def example_values(df: DataFrame, fields: Sequence[str], n: int = 5) -> DataFrame:
    """SRT-03: up to ``n`` non-empty example values per column (smallest values, deterministic).

    The rank filter lets Spark keep a per-partition top-n before the shuffle.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value"))
                                         for f in fields])).alias("s")).select("s.*").where(F.col("value") != "")
    long = long.distinct()
    w = W.partitionBy("field").orderBy("value")
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """SRT-02: distributed top-k (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def decade_histogram(df: DataFrame, date_text: Column) -> DataFrame:
    """AGG-19: count per decade of the year in the first four characters."""
    y = F.substring(date_text, 1, 4).try_cast("int")
    return df.groupBy((F.floor(y / 10) * 10).cast("int").alias("decade")).agg(F.count(F.lit(1)).alias("station_count"))


def quality_summary(daily: DataFrame, dupes: DataFrame, gaps: DataFrame) -> DataFrame:
    """AGG-20: the four counters as one row (one job, four partial aggregates)."""
    z = daily.agg(F.count_if(F.col("daily_rows_with_values") == 0).alias("days_with_zero_daily_rows"),
                  F.count_if(F.col("daily_rows_with_values") > 1).alias("days_with_multiple_daily_rows"))
    d = dupes.agg(F.count(F.lit(1)).alias("duplicate_timestamps"))
    g = gaps.agg(F.count(F.lit(1)).alias("large_gaps"))
    k = F.lit(1)
    return z.withColumn("_k", k).join(d.withColumn("_k", k), "_k").join(g.withColumn("_k", k), "_k").drop("_k")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG-21: row count per table (metadata-only scans where the format allows)."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out
