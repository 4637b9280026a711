"""Order-dependent row operators that stay distributed, and write no copy of their input.

A window over a *global* order (no partition key, or one hot key) makes Spark move all those rows into one task. The
operators here cut the order into ranges instead. The range bounds are taken once, from a sample, as a literal array;
a row's range is then a deterministic expression of its keys, so any stage may compute it again and get the same.
Rows equal in all columns travel as one counted row, so a value that a third of the rows share takes no more room than
any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

RANGE_ROWS = 1_000_000  # rows of a range, about
MAX_RANGES = 20_000
SAMPLES = 20  # sampled rows for each bound
CELLS = 1 << 16  # cells of one refinement of a quantile
HOT_ROWS = 100_000  # rows of a key that are not brought together
MAX_HOT = 100_000  # such keys


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the keys of ``left`` stay."""
    other = right.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [left[k].eqNullSafe(other[f"_key_{k}"]) for k in keys]
    return left.join(other, on, how).drop(*[f"_key_{k}" for k in keys])


# --- ranges ----------------------------------------------------------------

def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def range_bounds(df: DataFrame, keys: Sequence[str], num_ranges: int | None = None) -> list[tuple]:
    """Ascending rows of ``keys`` (as strings, NULLs last) that cut ``df`` into ranges of about RANGE_ROWS rows, and
    into ``num_ranges`` at least.

    At most MAX_RANGES * SAMPLES sampled keys come to the driver. The bounds decide only how even the ranges are.
    """
    n = df.count()
    num_ranges = max(num_ranges or 1, min(MAX_RANGES, -(-n // RANGE_ROWS)))
    if num_ranges <= 1 or not n:
        return []
    share = min(1.0, SAMPLES * num_ranges / n)
    sample = df.select(*keys) if share == 1.0 else df.select(*keys).where(F.rand(7) < share)
    rows = sample.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).select(*[F.col(k).cast("string") for k in keys]).collect()
    picked = [tuple(rows[len(rows) * i // num_ranges]) for i in range(1, num_ranges)] if rows else []
    return [b for i, b in enumerate(picked) if i == 0 or b != picked[i - 1]]


def range_of(df: DataFrame, keys: Sequence[str], bounds: list[tuple]) -> Column:
    """The number of a row's range: how many ``bounds`` its keys reach, by binary search over a literal array.

    The array is made of foldable expressions alone, so it is built once and not for each row.
    """
    if not bounds:
        return F.lit(0)
    kinds = [df.schema[k].dataType.simpleString() for k in keys]
    row = lambda b: "named_struct(" + ", ".join(
        f"'n{i}', {'true' if t is None else 'false'}, 'k{i}', CAST({_quoted(t)} AS {kind})" for i, (t, kind) in enumerate(zip(b, kinds, strict=True))) + ")"
    literal = F.expr(f"array({', '.join(map(row, bounds))})")
    key = F.struct(*[c for i, k in enumerate(keys) for c in (F.col(k).isNull().alias(f"n{i}"), F.col(k).alias(f"k{i}"))])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    # a step is taken where the bound at its end is reached; behind the last bound there is NULL
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(literal, at + step - 1) <= key, step).otherwise(0))


def _nulls_last(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in keys]


# --- previous row ----------------------------------------------------------

def previous_in_order(
    df: DataFrame,
    value_col: str,
    order_cols: list[str],
    group_cols: list[str] | None = None,
    out_col: str = "value_field_lag",
    num_ranges: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = value of ``value_col`` on the previous row in ``order_cols`` order (per group).

    Equivalent to ``lag(value) over (partition by group order by order_cols)``, but no task has to hold a whole group:
    rows are sorted by range, and the first row of a range takes the last row of its group in an earlier range. Rows
    that tie in ``order_cols`` come in the order of their other columns; NULLs sort last, and rows with a NULL group
    column form a group. Equal rows are one counted row until the end. Columns must be groupable.

    Only the group of a bound can have rows on both its sides. Where each bound has a group of its own, the groups are
    small, and the last rows are taken of the bounds' groups alone.
    """
    g = list(group_cols or [])
    keys = list(dict.fromkeys([*g, *order_cols, value_col, *df.columns]))
    bounds = range_bounds(df, keys, num_ranges)
    inside = W.partitionBy("_rng", *g).orderBy(*_nulls_last([k for k in keys if k not in g]))

    def placed(part: DataFrame) -> DataFrame:
        counted = part.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        ranged = counted.withColumn("_rng", range_of(df, keys, bounds))
        # the next row's count, and not a constant: so all who read the rows need the same columns of one exchange
        return ranged.select("*", F.lag(value_col).over(inside).alias("_before"), F.row_number().over(inside).alias("_pos"),
                             F.lead("_n").over(inside).alias("_more"))

    rows = placed(df)
    if not bounds:
        return _copies(rows, df.columns, value_col, F.col("_before"), out_col)
    groups = sorted({b[: len(g)] for b in bounds}, key=str)
    ends = rows
    if g and len(groups) == len(bounds):
        names = [f"g{i}" for i in range(len(g))]
        of_bounds = df.sparkSession.createDataFrame(groups, ", ".join(f"{c} string" for c in names))
        of_bounds = of_bounds.select(*[F.col(c).cast(df.schema[k].dataType).alias(k) for c, k in zip(names, g, strict=True)])
        ends = placed(_null_safe_join(df, F.broadcast(of_bounds), g, "left_semi"))
    last = ends.where(F.col("_more").isNull()).select("_rng", *g, F.col(value_col).alias("_last"))
    ahead = W.partitionBy(*g).orderBy("_rng")
    # groups lie side by side in the ranges, so at most one goes on from a range into the next: a row for each bound
    carry = last.select("_rng", *g, F.lag("_last").over(ahead).alias("_carry"), F.lag("_rng").over(ahead).alias("_from"))
    carry = F.broadcast(carry.where(F.col("_from").isNotNull()).drop("_from"))
    joined = _null_safe_join(rows, carry, ["_rng", *g], "left")
    before = F.when(F.col("_pos") == 1, F.col("_carry")).otherwise(F.col("_before"))
    return _copies(joined, df.columns, value_col, before, out_col)


def _copies(rows: DataFrame, columns: list[str], value_col: str, before: Column, out_col: str) -> DataFrame:
    """The counted rows as often as they are; behind its first copy a row follows itself."""
    copies = rows.select(*columns, before.alias("_first"), F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
    return copies.select(*columns, F.when(F.col("_copy") > 1, F.col(value_col)).otherwise(F.col("_first")).alias(out_col))


# --- exact quantile --------------------------------------------------------

def _cell_by_size(v: Column) -> Column:
    """A cell of a double by its sign and sixteenths of its binary logarithm; larger values have no smaller cells."""
    log = F.floor(F.log2(F.abs(v)) * 16) + 20_000
    return (F.when(F.isnan(v), 99_999).when(v == float("inf"), 99_998).when(v == float("-inf"), -99_998)
            .when(v == 0, 0).when(v > 0, log).otherwise(-log)).cast("int")


def _cell_between(v: Column, low: Column, high: Column) -> Column:
    return F.when(low == high, 0).otherwise(F.floor((v - low) / (high - low) * (CELLS - 1))).cast("int")


def _holding(rows: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Of each key the cell that holds the row at ``rank`` (from 0), with the rank inside it and its extreme values."""
    cells = rows.groupBy(*keys, rank, "_w", "_cell").agg(F.sum("_c").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    through = F.sum("_c").over(W.partitionBy(*keys).orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow))
    found = cells.withColumn("_through", through).where((F.col("_through") > F.col(rank)) & (F.col("_through") - F.col("_c") <= F.col(rank)))
    return found.select(*keys, "_w", "_cell", (F.col(rank) - F.col("_through") + F.col("_c")).alias("_rank"), "_low", "_high")


def group_quantile(
    df: DataFrame,
    value_col: str,
    quantile: float,
    group_cols: list[str] | None = None,
    out_col: str = "quantile",
) -> DataFrame:
    """Exact ``percentile_cont(quantile)`` of ``value_col`` per group, without holding a group in one task.

    Selection by refining histograms: equal values become one counted row (combined before the shuffle), the counts per
    cell of a coarse scale show which cell holds each of the two ranks around ``quantile * (n - 1)``, and that cell is
    cut again, twice into CELLS cells between its least and greatest value. A cell of the first scale spans a sixteenth
    of a power of two, 2**48 doubles; so after the cuts at most about 2**16 distinct values are left to be sorted for
    a rank, whatever the input. The two values are interpolated as ``percentile_cont`` does. NULL values are ignored, a
    group with no values is absent, and rows with a NULL group column form a group. NaN is greater than any number.
    """
    if not 0.0 <= quantile <= 1.0:
        raise ValueError("quantile must be in [0, 1]")
    g = list(group_cols or [])
    values = df.select(*g, F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counted = values.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_cell", _cell_by_size(F.col("_v")))
    cells = counted.groupBy(*g, "_cell").agg(F.sum("_c").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    group = W.partitionBy(*g)
    place = F.lit(float(quantile)) * (F.sum("_c").over(group) - 1).cast("double")
    cells = cells.select("*", F.sum("_c").over(group.orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow)).alias("_through"), place.alias("_place"))
    sides = F.array(F.struct(F.lit(0).alias("side"), F.floor("_place").alias("rank")), F.struct(F.lit(1).alias("side"), F.ceil("_place").alias("rank")))
    found = cells.select("*", F.explode(sides).alias("s")).where((F.col("_through") > F.col("s.rank")) & (F.col("_through") - F.col("_c") <= F.col("s.rank")))
    weight = F.when(F.col("s.side") == 0, F.lit(1.0) - (F.col("_place") - F.floor("_place"))).otherwise(F.col("_place") - F.floor("_place"))
    found = found.select(*g, F.col("s.side").alias("_side"), weight.alias("_w"), "_cell", (F.col("s.rank") - F.col("_through") + F.col("_c")).alias("_rank"), "_low", "_high")
    keys = [*g, "_side"]
    rows = _null_safe_join(counted, found, [*g, "_cell"], "inner").withColumn("_cell", _cell_between(F.col("_v"), F.col("_low"), F.col("_high")))
    for _ in range(2):
        found = _holding(rows, keys, "_rank")
        rows = _null_safe_join(rows.drop("_rank", "_w", "_low", "_high"), found, [*keys, "_cell"], "inner")
        rows = rows.withColumn("_cell", _cell_between(F.col("_v"), F.col("_low"), F.col("_high")))
    through = F.sum("_c").over(W.partitionBy(*keys).orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow))
    picked = rows.withColumn("_through", through).where((F.col("_through") > F.col("_rank")) & (F.col("_through") - F.col("_c") <= F.col("_rank")))
    return picked.groupBy(*g).agg(F.sum(F.when(F.col("_w") > 0, F.col("_v") * F.col("_w")).otherwise(0.0)).alias(out_col))


# --- running total ---------------------------------------------------------

def running_total(df: DataFrame, value_col: str, partition_cols: Sequence[str], order_col: str, descending: bool = False,
                  out_col: str = "running_total", num_ranges: int | None = None) -> DataFrame:
    """WIN-14: running sum with SQL's default frame (RANGE … CURRENT ROW, so ties share a total), per partition or, with
    no ``partition_cols``, over the whole table.

    Two levels of prefix sums: rows that tie become one row with their sum, sums per range of the order are added up
    (one row for each range and partition), and inside a range a window adds the rest. NULL order keys come last
    (first, if descending), NULL values add nothing, and a total over NULLs only is NULL. The totals of keys with more
    than HOT_ROWS rows (and of MAX_HOT keys at most) are broadcast, so no task holds the rows of such a key.
    """
    p = list(partition_cols)
    keys = [*p, order_col]
    ties = df.groupBy(*keys).agg(F.sum(value_col).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    ranged = ties.withColumn("_rng", range_of(df, keys, range_bounds(df, keys, num_ranges)))
    turn = (lambda c: F.col(c).desc_nulls_first()) if descending else (lambda c: F.col(c).asc_nulls_last())
    sums = ranged.groupBy(*p, "_rng").agg(F.sum("_sum").alias("_all"))
    ahead = W.partitionBy(*p).orderBy(F.col("_rng").desc() if descending else F.col("_rng").asc()).rowsBetween(W.unboundedPreceding, -1)
    base = sums.select(*p, "_rng", F.sum("_all").over(ahead).alias("_base"))
    inside = F.sum("_sum").over(W.partitionBy(*p, "_rng").orderBy(turn(order_col)).rowsBetween(W.unboundedPreceding, W.currentRow))
    totals = _null_safe_join(ranged.withColumn("_inside", inside), base, [*p, "_rng"], "left")
    total = F.when(F.col("_base").isNull(), F.col("_inside")).otherwise(F.col("_base") + F.coalesce("_inside", F.lit(0)))
    found = totals.select(*keys, "_rows", total.alias(out_col))
    is_hot = F.col("_rows") > max(HOT_ROWS, df.count() // MAX_HOT)
    hot, cold = found.where(is_hot).drop("_rows"), found.where(~is_hot).drop("_rows")
    of_hot = _null_safe_join(df, F.broadcast(hot), keys, "inner")
    others = _null_safe_join(df, F.broadcast(hot.select(*keys)), keys, "left_anti")
    return of_hot.unionByName(_null_safe_join(others, cold, keys, "left"))
