"""Data-quality expectations: each check returns its failing rows (empty = pass).

Expressions and conditions may be SQL strings (as in a YAML test declaration)
or ``Column`` objects. Output shapes follow the reference's checks: row checks
return the evaluated ``expression`` (or ``value_field``), grouped checks
return ``col_1..col_n`` plus the aggregate, comparisons return both sides and
their difference. Every check is one Spark plan; set and schema checks
never bring data to the driver.

NULL rules (kept from the reference): ``expression_is_true`` descendants pass
NULL (the predicate is ``not(expr = true)``); ``*_to_be_in_set`` fails NULL;
compound uniqueness skips rows per ``ignore_row_if``.
"""

from __future__ import annotations

import datetime as _dt
import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordered import group_quantile, previous_in_order



def _e(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.expr(x)
    return F.lit(x)


def _filter(df: DataFrame, row_condition) -> DataFrame:
    return df if row_condition is None else df.where(_e(row_condition))


def _and(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols)


def _or(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def _empty_if(df: DataFrame, keep: bool) -> DataFrame:
    return df if keep else df.limit(0)


# ---------------------------------------------------------------------------
# generalized cores
# ---------------------------------------------------------------------------


def expression_is_true(df: DataFrame, expression, group_by: Sequence[str] | None = None, row_condition=None,
                       test_condition: str = "= true") -> DataFrame:
    """EXP-01: rows (or groups) where ``not(expression <test_condition>)``.

    Without ``group_by`` an aggregate expression yields one global row.
    """
    src = _filter(df, row_condition)
    if group_by:
        out = src.groupBy(*[F.col(g).alias(f"col_{i}") for i, g in enumerate(group_by, 1)]).agg(
            _e(expression).alias("expression")
        )
    else:
        out = src.select(_e(expression).alias("expression"))
    return out.where(F.expr(f"not(expression {test_condition})"))


def between_predicate(expression, min_value=None, max_value=None, strictly: bool = False) -> Column:
    if min_value is None and max_value is None:
        raise ValueError("no bound given: set min_value, max_value or both")
    e = _e(expression)
    parts = [F.lit(True)]
    if min_value is not None:
        parts.append(e > _e(min_value) if strictly else e >= _e(min_value))
    if max_value is not None:
        parts.append(e < _e(max_value) if strictly else e <= _e(max_value))
    return _and(parts)


def expression_between(df: DataFrame, expression, min_value=None, max_value=None, group_by=None, row_condition=None,
                       strictly: bool = False) -> DataFrame:
    """EXP-02."""
    return expression_is_true(df, between_predicate(expression, min_value, max_value, strictly), group_by, row_condition)


def _side(df: DataFrame, expression, row_condition, group_by) -> DataFrame:
    src = _filter(df, row_condition)
    if group_by:
        return src.groupBy(*[F.col(g).alias(f"col_{i}") for i, g in enumerate(group_by, 1)]).agg(
            _e(expression).alias("expression")
        )
    return src.agg(_e(expression).alias("expression"))


def equal_expression(df: DataFrame, expression, compare_df: DataFrame | None = None, compare_expression=None,
                     group_by=None, compare_group_by=None, row_condition=None, compare_row_condition=None,
                     tolerance: float = 0.0, tolerance_percent: float | None = None) -> DataFrame:
    """EXP-03: compare an aggregate with another (table's) aggregate, per group.

    Groups are matched with a full outer join (NULL keys never match); a
    missing side counts as 0. Without groups both sides are single-row global
    aggregates, joined on a constant key.
    """
    compare_df = df if compare_df is None else compare_df
    compare_expression = expression if compare_expression is None else compare_expression
    compare_row_condition = row_condition if compare_row_condition is None else compare_row_condition
    compare_group_by = group_by if compare_group_by is None else compare_group_by
    n = len(group_by) if group_by else 0
    a = _side(df, expression, row_condition, group_by).alias("a")
    b = _side(compare_df, compare_expression, compare_row_condition, compare_group_by).withColumnRenamed(
        "expression", "compare_expression"
    ).alias("b")
    if n:
        cond = _and([F.col(f"a.col_{i}") == F.col(f"b.col_{i}") for i in range(1, n + 1)])
        j = a.join(b, cond, "full_outer")
        keys = [F.coalesce(F.col(f"a.col_{i}"), F.col(f"b.col_{i}")).alias(f"col_{i}") for i in range(1, n + 1)]
    else:
        j = a.withColumn("_k", F.lit(1)).join(b.withColumn("_k", F.lit(1)), "_k", "inner")
        keys = []
    diff = F.abs(F.coalesce(F.col("expression"), F.lit(0)) - F.coalesce(F.col("compare_expression"), F.lit(0)))
    pct = diff / F.nullif(F.col("expression") * F.lit(1.0), F.lit(0))
    out = j.select(*keys, "expression", "compare_expression", diff.alias("expression_difference"),
                   pct.cast("double").alias("expression_difference_percent"))
    if tolerance_percent:
        return out.where(F.col("expression_difference_percent") > F.lit(tolerance_percent))
    return out.where(F.col("expression_difference") > F.lit(tolerance))


def ignore_row_if_expression(ignore_row_if: str, columns: Sequence[str]) -> Column:
    """FLT-05: keep-row predicate for multi-column checks."""
    if ignore_row_if not in ("all_values_are_missing", "any_value_is_missing"):
        raise ValueError(f"ignore_row_if is all_values_are_missing or any_value_is_missing, not {ignore_row_if!r}")
    nulls = [F.col(c).isNull() for c in columns]
    return ~(_and(nulls) if ignore_row_if == "all_values_are_missing" else _or(nulls))


# ---------------------------------------------------------------------------
# column values
# ---------------------------------------------------------------------------


def column_values_to_be_between(df, column, min_value=None, max_value=None, row_condition=None, strictly=False):
    return expression_between(df, F.col(column), min_value, max_value, None, row_condition, strictly)


def column_values_to_not_be_null(df, column, row_condition=None):
    return expression_is_true(df, F.col(column).isNotNull(), None, row_condition)


def column_values_to_be_null(df, column, row_condition=None):
    return expression_is_true(df, F.col(column).isNull(), None, row_condition)


def column_values_to_be_unique(df, column, row_condition=None):
    return compound_columns_to_be_unique(df, [column], row_condition=row_condition)


def _set_frame(df: DataFrame, values: Sequence, name: str = "value_field") -> DataFrame:
    """The value set as a small DataFrame (a declared parameter, size known up front)."""
    spark = df.sparkSession
    return spark.createDataFrame([(v,) for v in values], [name]) if values else spark.createDataFrame([], f"{name} string")


def _set_col(values: Sequence, quote_values: bool, dtype) -> Column:
    vals = [str(v) if quote_values else v for v in values]
    return F.array(*[F.lit(v) for v in vals])


def column_values_to_be_in_set(df, column, value_set, quote_values=True, row_condition=None):
    """EXP-08: values not in the set; NULL fails. The set is a declared literal list (bounded), checked as an array."""
    src = _filter(df, row_condition).select(F.col(column).alias("value_field"))
    v = F.col("value_field").cast("string") if quote_values else F.col("value_field")
    hit = F.array_contains(_set_col(value_set, quote_values, None), v)
    return src.where(~F.coalesce(hit, F.lit(False)))


def column_values_to_not_be_in_set(df, column, value_set, quote_values=True, row_condition=None):
    """EXP-09: values in the set, one row per matching set entry (duplicates repeat)."""
    src = _filter(df, row_condition).select(F.col(column).alias("value_field"))
    vals = [str(x) if quote_values else x for x in value_set]
    v = F.col("value_field").cast("string") if quote_values else F.col("value_field")
    arr = F.array(*[F.lit(x) for x in vals])
    # number of equal entries in the declared set (repeats rows like an inner join would)
    cnt = F.size(F.filter(arr, lambda s: s == v))
    return src.select("value_field", F.explode(F.array_repeat(F.lit(1), cnt)).alias("_r")).drop("_r")


def _monotone(df, column, sort_column, strictly, row_condition, group_by, increasing: bool):
    sort_column = sort_column or column
    g = list(group_by or [])
    src = _filter(df, row_condition).select(
        F.col(sort_column).alias("sort_column"), *[F.col(c) for c in g], F.col(column).alias("value_field")
    )
    lagged = previous_in_order(src, "value_field", ["sort_column", "value_field"], g, "value_field_lag")
    v, lag = F.col("value_field"), F.col("value_field_lag")
    if increasing:
        ok = v > lag if strictly else v >= lag
    else:
        ok = v < lag if strictly else v <= lag
    cols = ["sort_column", *g, "value_field", "value_field_lag"] if increasing else ["sort_column", "value_field", "value_field_lag"]
    return lagged.where(lag.isNotNull() & ~ok).select(*cols)


def column_values_to_be_increasing(df, column, sort_column=None, strictly=True, row_condition=None, group_by=None):
    """EXP-10 (distributed global lag; ties in the sort key are ordered by value)."""
    return _monotone(df, column, sort_column, strictly, row_condition, group_by, True)


def column_values_to_be_decreasing(df, column, sort_column=None, strictly=True, row_condition=None, group_by=None):
    """EXP-11 (group columns are not returned, as in the reference)."""
    return _monotone(df, column, sort_column, strictly, row_condition, group_by, False)


def _schema_rows(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def column_values_to_be_of_type(df, column, column_type):
    """EXP-12: one row when the declared type differs (case-insensitive)."""
    actual = df.schema[column].dataType.simpleString()
    bad = actual.lower() != str(column_type).lower()
    return _schema_rows(df, [(column, actual, str(column_type))] if bad else [],
                        "column_name string, column_type string, expected_type string")


def column_values_to_be_in_type_list(df, column, column_type_list):
    """EXP-13."""
    actual = df.schema[column].dataType.simpleString()
    bad = actual.lower() not in [str(t).lower() for t in column_type_list]
    return _schema_rows(df, [(column, actual)] if bad else [], "column_name string, column_type string")


def column_values_to_have_consistent_casing(df, column, display_inconsistent_columns=False):
    """EXP-14."""
    d = df.select(F.col(column).alias("distinct_values")).distinct()
    if display_inconsistent_columns:
        return (
            d.groupBy(F.lower("distinct_values").alias("inconsistent_columns"))
            .agg(F.count("distinct_values").alias("set_count_case_insensitive"))
            .where(F.col("set_count_case_insensitive") > 1)
        )
    s = d.agg(F.count(F.lit(1)).alias("set_count"),
              F.count_distinct(F.lower("distinct_values")).alias("set_count_case_insensitive"))
    return s.where(F.col("set_count") != F.col("set_count_case_insensitive"))


# ---------------------------------------------------------------------------
# aggregate functions
# ---------------------------------------------------------------------------


def column_distinct_count_to_equal(df, column, value, group_by=None, row_condition=None):
    return expression_is_true(df, F.count_distinct(F.col(column)) == F.lit(value), group_by, row_condition)


def column_distinct_count_to_be_greater_than(df, column, value, group_by=None, row_condition=None):
    return expression_is_true(df, F.count_distinct(F.col(column)) > F.lit(value), group_by, row_condition)


def column_distinct_count_to_be_less_than(df, column, value, group_by=None, row_condition=None):
    return expression_is_true(df, F.count_distinct(F.col(column)) < F.lit(value), group_by, row_condition)


def column_distinct_count_to_equal_other_table(df, column, compare_df, compare_column=None, row_condition=None,
                                               compare_row_condition=None):
    return equal_expression(df, F.count_distinct(F.col(column)), compare_df,
                            F.count_distinct(F.col(compare_column or column)),
                            row_condition=row_condition, compare_row_condition=compare_row_condition)


def column_distinct_values_to_be_in_set(df, column, value_set, quote_values=True, row_condition=None):
    """EXP-19: distinct values outside the set (NULL fails)."""
    d = _filter(df, row_condition).select(F.col(column).alias("value_field")).distinct()
    v = F.col("value_field").cast("string") if quote_values else F.col("value_field")
    return d.where(~F.coalesce(F.array_contains(_set_col(value_set, quote_values, None), v), F.lit(False)))


def column_distinct_values_to_contain_set(df, column, value_set, quote_values=True, row_condition=None):
    """EXP-20: declared set members absent from the data (anti join against the distinct values)."""
    vals = sorted({str(x) if quote_values else x for x in value_set}, key=str)
    s = _set_frame(df, vals)
    d = _filter(df, row_condition).select(
        (F.col(column).cast("string") if quote_values else F.col(column)).alias("value_field")
    ).distinct()
    return s.join(d, "value_field", "left_anti")


def column_distinct_values_to_equal_set(df, column, value_set, quote_values=True, row_condition=None):
    """EXP-21: symmetric difference between distinct values and the set."""
    vals = sorted({str(x) if quote_values else x for x in value_set}, key=str)
    s = _set_frame(df, vals).alias("s")
    d = _filter(df, row_condition).select(
        (F.col(column).cast("string") if quote_values else F.col(column)).alias("column_value")
    ).distinct().alias("v")
    j = d.join(s, F.col("v.column_value") == F.col("s.value_field"), "full_outer")
    return j.where(F.col("v.column_value").isNull() | F.col("s.value_field").isNull()).select("column_value", "value_field")


def column_max_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False):
    return expression_between(df, F.max(column), min_value, max_value, group_by, row_condition, strictly)


def column_min_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False):
    return expression_between(df, F.min(column), min_value, max_value, group_by, row_condition, strictly)


def column_mean_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False):
    return expression_between(df, F.avg(column), min_value, max_value, group_by, row_condition, strictly)


def _quantile_between(df, column, quantile, min_value, max_value, group_by, row_condition, strictly):
    """Exact quantile per group via the distributed rank operator, then the between predicate.

    Output matches ``expression_between``: ``col_1..col_n`` and ``expression``.
    """
    g = list(group_by or [])
    src = _filter(df, row_condition)
    qd = group_quantile(src, column, quantile, g, out_col="_q")
    if not g:  # a global aggregate always yields one row, NULL when there are no values
        qd = src.agg(F.lit(1).alias("_k")).join(qd.withColumn("_k", F.lit(1)), "_k", "left").drop("_k")
    pred = between_predicate(F.col("_q"), min_value, max_value, strictly)
    out = qd.select(*[F.col(c).alias(f"col_{i}") for i, c in enumerate(g, 1)], pred.alias("expression"))
    return out.where(F.expr("not(expression = true)"))


def column_median_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False):
    """EXP-25: exact interpolated median (``percentile_cont(0.5)``), distributed (no group held in one task)."""
    return _quantile_between(df, column, 0.5, min_value, max_value, group_by, row_condition, strictly)


def column_quantile_values_to_be_between(df, column, quantile, min_value=None, max_value=None, group_by=None,
                                         row_condition=None, strictly=False):
    """EXP-26: exact ``percentile_cont(quantile)``, distributed."""
    return _quantile_between(df, column, quantile, min_value, max_value, group_by, row_condition, strictly)


def column_stdev_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False):
    return expression_between(df, F.stddev_samp(column), min_value, max_value, group_by, row_condition, strictly)


def column_sum_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False):
    return expression_between(df, F.sum(column), min_value, max_value, group_by, row_condition, strictly)


def column_unique_value_count_to_be_between(df, column, min_value=None, max_value=None, group_by=None,
                                            row_condition=None, strictly=False):
    return expression_between(df, F.count_distinct(F.col(column)), min_value, max_value, group_by, row_condition, strictly)


def column_proportion_of_unique_values_to_be_between(df, column, min_value=None, max_value=None, group_by=None,
                                                     row_condition=None, strictly=False):
    prop = F.try_divide(F.count_distinct(F.col(column)).cast("double"), F.count(F.col(column)))
    return expression_between(df, prop, min_value, max_value, group_by, row_condition, strictly)


def column_most_common_value_to_be_in_set(df, column, value_set, top_n, quote_values=True, data_type="decimal",
                                          row_condition=None):
    """EXP-31: the value ranked exactly ``top_n`` by frequency, if it is not in the set.

    Ranking uses a distributed top-k (``orderBy(...).limit(top_n)``) over the
    per-value counts instead of a global window; equal counts are ordered by
    value so the pick is deterministic.
    """
    v = F.col(column) if quote_values else F.col(column).cast(data_type)
    counts = _filter(df, row_condition).groupBy(v.alias("value_field")).agg(F.count(F.lit(1)).alias("value_count"))
    top = counts.orderBy(F.desc("value_count"), F.asc_nulls_first("value_field")).limit(int(top_n))
    from pyspark.sql import Window as W

    ranked = top.withColumn("value_count_rank", F.row_number().over(
        W.orderBy(F.desc("value_count"), F.asc_nulls_first("value_field"))))
    nth = ranked.where(F.col("value_count_rank") == int(top_n)).select("value_field")
    vals = [str(x) if quote_values else x for x in value_set]
    arr = F.array(*[F.lit(x) if quote_values else F.lit(x).cast(data_type) for x in vals])
    # NOT IN semantics: NULL value (or NULL in the set) never fails
    probe = F.col("value_field").cast("string") if quote_values else F.col("value_field")
    return nth.where(F.col("value_field").isNotNull() & ~F.array_contains(arr, probe))


# ---------------------------------------------------------------------------
# string matching
# ---------------------------------------------------------------------------


def _regex(pattern: str, is_raw: bool = False, flags: str = "") -> str:
    inline = inline_flags(flags)
    return (f"(?{inline})" if inline else "") + pattern


def inline_flags(flags: str) -> str:
    """FUN-05: the Java inline options for ``flags``; an unknown flag is left out with a warning.

    i, m, s, u, x and d are Java's own. c matches case and p keeps the dot off line ends, both Java's defaults: of c
    and i, and of p and s, the last given counts. e (submatch) and U (ungreedy) never change whether a text matches.
    """
    out = ""
    for ch in flags or "":
        if ch not in "imsuxdUcep":
            warnings.warn(f"regex flag {ch!r} is not known and left out", stacklevel=2)
        elif ch in "cp":
            out = out.replace("i" if ch == "c" else "s", "")
        elif ch not in "eU" and ch not in out:
            out += ch
    return out


def column_values_to_match_regex(df, column, regex, row_condition=None, is_raw=False, flags=""):
    return expression_is_true(df, F.col(column).rlike(_regex(regex, is_raw, flags)), None, row_condition)


def column_values_to_not_match_regex(df, column, regex, row_condition=None, is_raw=False, flags=""):
    return expression_is_true(df, ~F.col(column).rlike(_regex(regex, is_raw, flags)), None, row_condition)


def column_values_to_match_regex_list(df, column, regex_list, match_on="any", row_condition=None, is_raw=False, flags=""):
    hits = [F.col(column).rlike(_regex(r, is_raw, flags)) for r in regex_list]
    return expression_is_true(df, _and(hits) if match_on == "all" else _or(hits), None, row_condition)


def column_values_to_not_match_regex_list(df, column, regex_list, match_on="any", row_condition=None, is_raw=False, flags=""):
    misses = [~F.col(column).rlike(_regex(r, is_raw, flags)) for r in regex_list]
    return expression_is_true(df, _and(misses) if match_on == "all" else _or(misses), None, row_condition)


def _like(pattern: str) -> str:
    """LIKE without an escape character: a backslash stands for itself."""
    return pattern.replace("\\", "\\\\")


def column_values_to_match_like_pattern(df, column, like_pattern, row_condition=None):
    return expression_is_true(df, F.col(column).like(_like(like_pattern)), None, row_condition)


def column_values_to_not_match_like_pattern(df, column, like_pattern, row_condition=None):
    return expression_is_true(df, ~F.col(column).like(_like(like_pattern)), None, row_condition)


def column_values_to_match_like_pattern_list(df, column, like_pattern_list, match_on="any", row_condition=None):
    hits = [F.col(column).like(_like(p)) for p in like_pattern_list]
    return expression_is_true(df, _and(hits) if match_on == "all" else _or(hits), None, row_condition)


def column_values_to_not_match_like_pattern_list(df, column, like_pattern_list, match_on="any", row_condition=None):
    misses = [~F.col(column).like(_like(p)) for p in like_pattern_list]
    return expression_is_true(df, _and(misses) if match_on == "all" else _or(misses), None, row_condition)


def column_value_lengths_to_equal(df, column, value, row_condition=None):
    return expression_is_true(df, F.length(column) == F.lit(value), None, row_condition)


def column_value_lengths_to_be_between(df, column, min_value=None, max_value=None, row_condition=None, strictly=False):
    return expression_between(df, F.length(column), min_value, max_value, None, row_condition, strictly)


# ---------------------------------------------------------------------------
# table shape (schema checks need no job)
# ---------------------------------------------------------------------------


def _transform(name: str, transform: str) -> str:
    return name.upper() if transform == "upper" else name.lower() if transform == "lower" else name


def column_to_exist(df, column, column_index=None, transform="upper"):
    name = _transform(column, transform)
    cols = [_transform(c, transform) for c in df.columns]
    idx = cols.index(name) if name in cols else -1
    index_ok = True if not column_index else idx == (column_index - 1 if column_index > 0 else 0)
    bad = not (idx >= 0 and index_ok)
    return _schema_rows(df, [(name, idx, index_ok)] if bad else [],
                        "column_name string, matching_column_index int, column_index_matches boolean")


def table_column_count_to_equal(df, value):
    n = len(df.columns)
    return _schema_rows(df, [(n, value)] if n != value else [], "number_actual_columns int, value int")


def table_column_count_to_be_between(df, min_value=None, max_value=None):
    if min_value is None and max_value is None:
        raise ValueError("no bound given: set min_value, max_value or both")
    n = len(df.columns)
    ok = (not min_value or n >= min_value) and (not max_value or n <= max_value)
    return _schema_rows(df, [] if ok else [(n, min_value or 0, max_value or 0)],
                        "number_actual_columns int, min_value int, max_value int")


def table_column_count_to_equal_other_table(df, compare_df):
    a, b = len(df.columns), len(compare_df.columns)
    return _schema_rows(df, [(a, b)] if a != b else [], "number_columns int, compare_number_columns int")


def table_columns_to_contain_set(df, column_list, transform="upper"):
    have = {_transform(c, transform) for c in df.columns}
    miss = [_transform(c, transform) for c in column_list if _transform(c, transform) not in have]
    return _schema_rows(df, [(m, None) for m in miss], "input_column string, relation_column string")


def table_columns_to_not_contain_set(df, column_list, transform="upper"):
    have = {_transform(c, transform) for c in df.columns}
    hit = [_transform(c, transform) for c in column_list if _transform(c, transform) in have]
    return _schema_rows(df, [(h, h) for h in hit], "input_column string, relation_column string")


def table_columns_to_match_set(df, column_list, transform="upper"):
    have = [_transform(c, transform) for c in df.columns]
    want = [_transform(c, transform) for c in column_list]
    rows = [(h, None) for h in have if h not in want] + [(None, w) for w in want if w not in have]
    return _schema_rows(df, rows, "relation_column string, input_column string")


def table_columns_to_match_ordered_list(df, column_list, transform="upper"):
    have = [(i, _transform(c, transform)) for i, c in enumerate(df.columns, 1)]
    want = [(i, _transform(c, transform)) for i, c in enumerate(column_list, 1)]
    rows = [(i, c, None, None) for i, c in have if (i, c) not in want] + [
        (None, None, i, c) for i, c in want if (i, c) not in have]
    return _schema_rows(df, rows, "relation_column_idx int, relation_column string, input_column_idx int, input_column string")


def table_row_count_to_equal(df, value, group_by=None, row_condition=None):
    return expression_is_true(df, F.count(F.lit(1)) == F.lit(value), group_by, row_condition)


def table_row_count_to_be_between(df, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False):
    return expression_between(df, F.count(F.lit(1)), min_value, max_value, group_by, row_condition, strictly)


def table_row_count_to_equal_other_table(df, compare_df, group_by=None, compare_group_by=None, factor=1,
                                         row_condition=None, compare_row_condition=None):
    return equal_expression(df, F.count(F.lit(1)), compare_df, F.count(F.lit(1)) * F.lit(factor), group_by,
                            compare_group_by, row_condition, compare_row_condition)


def table_row_count_to_equal_other_table_times_factor(df, compare_df, factor, group_by=None, compare_group_by=None,
                                                      row_condition=None, compare_row_condition=None):
    return table_row_count_to_equal_other_table(df, compare_df, group_by, compare_group_by, factor, row_condition,
                                                compare_row_condition)


def table_aggregation_to_equal_other_table(df, expression, compare_df, compare_expression=None, group_by=None,
                                           compare_group_by=None, row_condition=None, compare_row_condition=None,
                                           tolerance=0.0, tolerance_percent=None):
    return equal_expression(df, expression, compare_df, compare_expression, group_by, compare_group_by, row_condition,
                            compare_row_condition, tolerance, tolerance_percent)


def _ts(x) -> Column:
    """A timestamp argument: datetime/date objects and ISO date(-time) text are literals, other text is SQL."""
    import re

    from tessera.functions.calendar import ntz_lit

    if isinstance(x, (_dt.datetime, _dt.date)) or (isinstance(x, str) and re.match(r"^\d{4}-\d{2}-\d{2}([ T].*)?$", x)):
        return ntz_lit(x)
    return _e(x)


def _shift(ts: Column, datepart: str, n: int) -> Column:
    unit = datepart.upper()
    if unit == "WEEK":
        return F.timestamp_add("DAY", F.lit(7 * n), ts)
    return F.timestamp_add(unit, F.lit(n), ts)


def row_values_to_have_recent_data(df, column, datepart, interval, now, row_condition=None):
    """EXP-55: fails (one row) when the latest non-future timestamp is older than ``now - interval``."""
    now_c = _ts(now).cast("timestamp_ntz")
    ts = F.col(column).cast("timestamp_ntz")
    src = _filter(df.where(ts <= now_c), row_condition)
    m = src.agg(F.max(ts).alias("max_timestamp"))
    floor = _ts(_dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
    return m.where(F.coalesce(F.col("max_timestamp"), floor) < _shift(now_c, datepart, -int(interval)))


def grouped_row_values_to_have_recent_data(df, group_by, timestamp_column, datepart, interval, now, row_condition=None):
    """EXP-56: groups whose latest non-future timestamp is older than ``now - interval``."""
    now_c = _ts(now).cast("timestamp_ntz")
    ts = F.col(timestamp_column).cast("timestamp_ntz")
    src = _filter(df.where(ts <= now_c), row_condition)
    latest = src.groupBy(*group_by).agg(F.max(ts).alias("latest_timestamp_column"))
    return latest.where(F.col("latest_timestamp_column") < _shift(now_c, datepart, -int(interval))).select(
        F.lit(1).cast("bigint").alias("row_count"), *group_by, F.lit(1).alias("join_key"), "latest_timestamp_column")


# ---------------------------------------------------------------------------
# multi-column
# ---------------------------------------------------------------------------


def compound_columns_to_be_unique(df, column_list, ignore_row_if="all_values_are_missing", row_condition=None):
    """EXP-57: key combinations occurring more than once (map-side partial counts)."""
    if not column_list:
        raise ValueError("column_list is not a list of column names")
    src = _filter(df, row_condition).where(ignore_row_if_expression(ignore_row_if, column_list))
    return src.groupBy(*column_list).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def select_column_values_to_be_unique_within_record(df, column_list, ignore_row_if="all_values_are_missing",
                                                    row_condition=None):
    """EXP-58: rows whose non-NULL values (compared as md5 of their text) are not all distinct.

    Row-wise array expression — no row index, no unpivot, no shuffle.
    """
    src = _filter(df, row_condition).where(ignore_row_if_expression(ignore_row_if, column_list))
    hashed = F.array(*[F.md5(F.col(c).cast("string")) for c in column_list])
    n_distinct = F.size(F.array_distinct(F.filter(hashed, lambda x: x.isNotNull())))
    return src.select(*column_list, n_distinct.alias("column_values")).where(
        F.col("column_values") < F.lit(len(column_list)))


def multicolumn_sum_to_equal(df, column_list, sum_total, group_by=None, row_condition=None):
    total = reduce(lambda a, b: a + b, [F.sum(c) for c in column_list])
    target = F.lit(sum_total) if isinstance(sum_total, (int, float)) else F.sum(sum_total)
    return expression_is_true(df, total == target, group_by, row_condition)


def column_pair_values_A_to_be_greater_than_B(df, column_A, column_B, or_equal=False, row_condition=None):
    a, b = F.col(column_A), F.col(column_B)
    return expression_is_true(df, a >= b if or_equal else a > b, None, row_condition)


def column_pair_values_to_be_equal(df, column_A, column_B, row_condition=None):
    return expression_is_true(df, F.col(column_A) == F.col(column_B), None, row_condition)


def column_pair_values_to_be_in_set(df, column_A, column_B, value_pairs_set, row_condition=None):
    for p in value_pairs_set:
        if len(p) != 2:
            raise ValueError(f"not a pair of values: {p!r}")
    pred = _or([(F.col(column_A) == F.lit(a)) & (F.col(column_B) == F.lit(b)) for a, b in value_pairs_set])
    return expression_is_true(df, pred, None, row_condition)


# ---------------------------------------------------------------------------
# distributional
# ---------------------------------------------------------------------------


def column_values_to_be_within_n_stdevs(df, column, group_by=None, sigma_threshold=3):
    """EXP-63: per-group sums whose z-score over all groups exceeds the threshold.

    The global mean/stddev is one aggregate row joined back on a constant key
    (never a whole-table ``over()`` window).
    """
    g = list(group_by or [])
    metric = df.groupBy(*g).agg(F.sum(column).alias(column)) if g else df.agg(F.sum(column).alias(column))
    stats = metric.agg(F.avg(column).alias(f"{column}_average"), F.stddev_samp(column).alias(f"{column}_stddev"))
    j = metric.withColumn("_k", F.lit(1)).join(F.broadcast(stats.withColumn("_k", F.lit(1))), "_k").drop("_k")
    z = (F.col(column) - F.col(f"{column}_average")) / F.nullif(F.col(f"{column}_stddev"), F.lit(0.0))
    return j.withColumn(f"{column}_sigma", z).where(F.abs(F.col(f"{column}_sigma")) > F.lit(sigma_threshold))


def _metric_expression(c: Column, take_logs: bool) -> Column:
    """FUN-11."""
    return F.coalesce(F.ln(F.nullif(c, F.lit(0))), F.lit(0.0)) if take_logs else F.coalesce(c, F.lit(0))


def column_values_to_be_within_n_moving_stdevs(df, column, date_column, now, group_by=None, period="day",
                                               lookback_periods=1, trend_periods=7, test_periods=14, sigma_threshold=3,
                                               sigma_threshold_upper=None, sigma_threshold_lower=None,
                                               take_diffs=True, take_logs=True):
    """EXP-64: per-period sums → optional log and lag difference → trailing mean/stddev → z outside bounds.

    Windows run on the per-period aggregate (one row per period and group).
    """
    from pyspark.sql import Window as W

    upper = sigma_threshold_upper if sigma_threshold_upper else sigma_threshold
    lower = sigma_threshold_lower if sigma_threshold_lower else -1 * sigma_threshold
    g = list(group_by or [])
    from tessera.functions.calendar import trunc_ntz

    metric = df.groupBy(trunc_ntz(period, F.col(date_column)).alias("metric_period"), *g).agg(
        F.sum(column).alias("agg_metric_value"))
    w = W.partitionBy(*g).orderBy("metric_period") if g else W.orderBy("metric_period")
    if take_diffs:
        metric = metric.withColumn("prior_agg_metric_value", F.lag("agg_metric_value", lookback_periods).over(w))
        val = _metric_expression(F.col("agg_metric_value"), take_logs) - _metric_expression(
            F.col("prior_agg_metric_value"), take_logs)
    else:
        val = _metric_expression(F.col("agg_metric_value"), take_logs)
    metric = metric.withColumn("metric_test_value", val)
    trail = w.rowsBetween(-int(trend_periods), -1)
    calc = metric.withColumn("metric_test_rolling_average", F.avg("metric_test_value").over(trail)).withColumn(
        "metric_test_rolling_stddev", F.stddev_samp("metric_test_value").over(trail))
    calc = calc.withColumn("metric_test_delta", F.col("metric_test_value") - F.col("metric_test_rolling_average"))
    calc = calc.withColumn("metric_test_sigma", F.col("metric_test_delta") / F.nullif(
        F.col("metric_test_rolling_stddev"), F.lit(0.0)))
    now_p = trunc_ntz(period, _ts(now))
    start = _shift(now_p, period, -int(test_periods))
    sig = F.col("metric_test_sigma")
    return calc.where((F.col("metric_period") >= start) & (F.col("metric_period") < now_p)
                      & ~((sig >= F.lit(lower)) & (sig <= F.lit(upper))))


def row_values_to_have_data_for_every_n_datepart(df, date_col, date_part="day", interval=None, row_condition=None,
                                                 exclusion_condition=None, test_start_date=None, test_end_date=None):
    """EXP-65: periods of the spine [start, end) without rows.

    Start/end default to the data's min/max date, computed as a sub-aggregate
    inside the same plan (no driver round trip). The spine is generated by a
    ``sequence`` explode whose size is the number of periods.
    """
    from tessera.operators.calendar import date_spine_between

    src = _filter(df, row_condition)
    d = F.col(date_col)
    bounds = src.agg(F.min(d.cast("date")).alias("_s"), F.max(d.cast("date")).alias("_e"))
    if test_start_date is not None:
        bounds = bounds.withColumn("_s", _ts(test_start_date).cast("date"))
    if test_end_date is not None:
        bounds = bounds.withColumn("_e", _ts(test_end_date).cast("date"))
    spine = date_spine_between(bounds, "_s", "_e", date_part, out=f"date_{date_part}")
    from tessera.functions.calendar import trunc_ntz

    part = trunc_ntz(date_part, d)
    if interval:
        spine = spine.where(F.pmod(_boundary_diff(F.col("_s"), F.col(f"date_{date_part}"), date_part), F.lit(interval)) == 0)
        shift = -F.pmod(_boundary_diff(F.col("_s"), d, date_part), F.lit(interval))
        part = _shift_col(part, date_part, shift)
    if interval:  # rows need the spine start; bounds is one aggregate row, joined on a constant key
        model = src.withColumn("_k", F.lit(1)).join(F.broadcast(bounds.select("_s").withColumn("_k", F.lit(1))), "_k")
    else:
        model = src
    model = model.groupBy(part.alias(f"date_{date_part}")).agg(F.count(F.lit(1)).alias("row_cnt"))
    spine = spine.select(F.col(f"date_{date_part}").cast("timestamp_ntz").alias(f"date_{date_part}"))
    j = spine.join(model, f"date_{date_part}", "left")
    out = j.select(f"date_{date_part}", F.col("row_cnt").isNull().alias("is_missing"),
                   F.coalesce(F.col("row_cnt"), F.lit(0)).cast("bigint").alias("row_cnt")).where(F.col("row_cnt") == 0)
    return out.where(_e(exclusion_condition)) if exclusion_condition is not None else out


def _boundary_diff(start: Column, end: Column, part: str) -> Column:
    from tessera.functions.calendar import datediff_boundaries

    return datediff_boundaries(start, end, part)


def _shift_col(ts: Column, part: str, n: Column) -> Column:
    unit = part.upper()
    if unit == "WEEK":
        return F.timestamp_add("DAY", n * 7, ts)
    return F.timestamp_add(unit, n, ts)


# ---------------------------------------------------------------------------
# core tests used by model YAML (NULL-tolerant where the reference is)
# ---------------------------------------------------------------------------


def not_null(df, column):
    return df.where(F.col(column).isNull())


def unique(df, column_or_expr):
    c = _e(column_or_expr) if not (isinstance(column_or_expr, str) and column_or_expr in df.columns) else F.col(column_or_expr)
    return df.where(c.isNotNull()).groupBy(c.alias("unique_field")).agg(F.count(F.lit(1)).alias("n_records")).where(
        F.col("n_records") > 1)


def accepted_values(df, column, values):
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).select(F.col(column).alias("value_field"))


def relationships(df, column, parent: DataFrame, field: str):
    """JOIN-18: child values absent from the parent (NULL children ignored)."""
    child = df.where(F.col(column).isNotNull()).select(F.col(column).alias("child_value"))
    par = parent.select(F.col(field).alias("child_value"))
    return child.join(par, "child_value", "left_anti")


def expression_is_true_for_column(df, column_name, expression, condition=None):
    """EXP-69 (date-library form): rows meeting ``condition`` where ``column_name <expression>`` is not true.

    ``expression`` is the text following the column, e.g. ``"= 3"`` or ``"is not null"``.
    """
    return expression_is_true(df, f"{column_name} {expression}", None, condition)


def seeded_rand(seed: int = 42) -> Column:
    """FUN-02: reproducible uniform [0, 1) values (use instead of an unseeded ``rand()`` in tests)."""
    return F.rand(seed)
