"""Registered expectation queries over the driver tables (each returns failing rows)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import expectations as X
from tessera.plans.catalog import register
from tessera.plans.present import present
from tessera.sources.tables import read_table


def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


def _docs_labels(spark, sf_dir):
    """documents ⟕ labels — unlabeled documents carry NULL quality/toxic."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return d.join(_t(spark, sf_dir, "labels"), "doc_id", "left")


DOCS_LABELS_SQL = "(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


# --- SQL shapes ------------------------------------------------------------

def s_true(src, expr, group_by=None, where=None, cond="= true"):
    sel = [f"{g} AS col_{i}" for i, g in enumerate(group_by or [], 1)] + [f"({expr}) AS expression"]
    w = f" WHERE {where}" if where else ""
    gb = (" GROUP BY " + ", ".join(group_by)) if group_by else ""
    return f"SELECT * FROM (SELECT {', '.join(sel)} FROM {src}{w}{gb}) t WHERE NOT (expression {cond})"


def s_between(src, expr, mn=None, mx=None, group_by=None, where=None, strictly=False):
    op = "" if strictly else "="
    parts = ["1=1"]
    if mn is not None:
        parts.append(f"{expr} >{op} {mn}")
    if mx is not None:
        parts.append(f"{expr} <{op} {mx}")
    return s_true(src, " AND ".join(parts), group_by, where)


def s_equal(a_src, a_expr, b_src, b_expr, group_by=None, b_group_by=None, where=None, b_where=None,
            tolerance=0.0, tolerance_percent=None):
    """Both sides stacked with their value in a column of its own, and folded per key; a key that holds a NULL is never
    the other side's, so such rows are folded per side."""
    cols = [f"col_{i}" for i in range(1, len(group_by or []) + 1)]

    def side(number, src, expr, keys, cond):
        picked = [f"{k} AS {c}" for k, c in zip(keys or [], cols, strict=True)]
        values = [f"{expr} AS x", "NULL AS y"] if number == 0 else ["NULL AS x", f"{expr} AS y"]
        return (f"SELECT {', '.join([*picked, f'{number} AS side', *values])} FROM {src}" + (f" WHERE {cond}" if cond else "")
                + (f" GROUP BY {', '.join(keys)}" if keys else ""))

    stacked = f"{side(0, a_src, a_expr, group_by, where)} UNION ALL {side(1, b_src, b_expr, b_group_by or group_by, b_where)}"
    apart = f"CASE WHEN {' OR '.join(f'{c} IS NULL' for c in cols)} THEN side ELSE 2 END"
    folded = f"SELECT {''.join(c + ', ' for c in cols)}max(x) AS x, max(y) AS y FROM ({stacked})"
    folded += f" GROUP BY {', '.join([*cols, apart])}" if cols else ""
    gap = "abs(coalesce(x, 0) - coalesce(y, 0))"
    share = f"CASE WHEN x <> 0 THEN CAST({gap} / CAST(x AS DOUBLE) AS DOUBLE) END"
    over = f"{share} > {tolerance_percent}" if tolerance_percent else f"{gap} > {tolerance}"
    return (f"SELECT {''.join(c + ', ' for c in cols)}x AS expression, y AS compare_expression, {gap} AS expression_difference, "
            f"round({share}, 6) AS expression_difference_percent FROM ({folded}) WHERE {over}")


def q(name, sql):
    """Register a check query: builder returns the failing rows, rounded for comparison."""
    def deco(fn):
        register(name, sql)(lambda spark, sf_dir: present(fn(spark, sf_dir)))
        return fn
    return deco


# --- generalized --------------------------------------------------------------

@q("exp_expression_is_true", s_true("lineitem", "l_extendedprice * (1 - l_discount) >= 1000"))
def _(spark, d):
    return X.expression_is_true(_t(spark, d, "lineitem"), "l_extendedprice * (1 - l_discount) >= 1000")


@q("exp_expression_is_true_grouped",
   s_true("lineitem", "sum(l_quantity) > 400000", ["l_returnflag", "l_linestatus"]))
def _(spark, d):
    return X.expression_is_true(_t(spark, d, "lineitem"), "sum(l_quantity) > 400000", ["l_returnflag", "l_linestatus"])


@q("exp_expression_between_grouped",
   s_between("orders", "avg(o_totalprice)", 250000, 252000, ["o_orderpriority"], "o_orderstatus <> 'P'"))
def _(spark, d):
    return X.expression_between(_t(spark, d, "orders"), "avg(o_totalprice)", 250000, 252000, ["o_orderpriority"],
                                "o_orderstatus <> 'P'")


@q("exp_equal_expression",
   s_equal("lineitem", "sum(l_extendedprice)", "orders", "sum(o_totalprice)", ["l_orderkey"], ["o_orderkey"],
           tolerance_percent=0.5))
def _(spark, d):
    return X.equal_expression(_t(spark, d, "lineitem"), "sum(l_extendedprice)", _t(spark, d, "orders"),
                              "sum(o_totalprice)", ["l_orderkey"], ["o_orderkey"], tolerance_percent=0.5)


# --- column values -------------------------------------------------------------

@q("exp_column_values_to_be_between", s_between("lineitem", "l_discount", 0.0, 0.08, where="l_returnflag = 'R'"))
def _(spark, d):
    return X.column_values_to_be_between(_t(spark, d, "lineitem"), "l_discount", 0.0, 0.08, "l_returnflag = 'R'")


@q("exp_column_values_to_be_between_strict", s_between("lineitem", "l_quantity", 1, 50, strictly=True))
def _(spark, d):
    return X.column_values_to_be_between(_t(spark, d, "lineitem"), "l_quantity", 1, 50, strictly=True)


@q("exp_column_values_to_not_be_null", s_true(DOCS_LABELS_SQL, "quality IS NOT NULL"))
def _(spark, d):
    return X.column_values_to_not_be_null(_docs_labels(spark, d), "quality")


@q("exp_column_values_to_be_null", s_true(DOCS_LABELS_SQL, "toxic IS NULL", where="lang = 'de'"))
def _(spark, d):
    return X.column_values_to_be_null(_docs_labels(spark, d), "toxic", "lang = 'de'")


@q("exp_column_values_to_be_unique",
   "SELECT o_custkey, count(*) AS n_records FROM orders WHERE NOT (o_custkey IS NULL) GROUP BY o_custkey HAVING count(*) > 1")
def _(spark, d):
    return X.column_values_to_be_unique(_t(spark, d, "orders"), "o_custkey")


@q("exp_column_values_to_be_in_set",
   "SELECT v.value_field FROM (SELECT l_returnflag AS value_field FROM lineitem) v "
   "LEFT JOIN (SELECT 'A' AS value_field UNION ALL SELECT 'N') s ON v.value_field = s.value_field WHERE s.value_field IS NULL")
def _(spark, d):
    return X.column_values_to_be_in_set(_t(spark, d, "lineitem"), "l_returnflag", ["A", "N"])


@q("exp_column_values_to_not_be_in_set",
   "SELECT v.value_field FROM (SELECT o_orderpriority AS value_field FROM orders WHERE o_orderstatus = 'O') v "
   "JOIN (SELECT '1-URGENT' AS value_field UNION ALL SELECT '2-HIGH' UNION ALL SELECT '2-HIGH') s ON v.value_field = s.value_field")
def _(spark, d):
    return X.column_values_to_not_be_in_set(_t(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "2-HIGH"],
                                            row_condition="o_orderstatus = 'O'")


_INC_SQL = (
    "WITH v AS (SELECT o_orderkey AS sort_column, o_totalprice AS value_field FROM orders), "
    "l AS (SELECT *, lag(value_field) OVER (ORDER BY sort_column, value_field) AS value_field_lag FROM v) "
    "SELECT * FROM l WHERE value_field_lag IS NOT NULL AND NOT (value_field > value_field_lag)")


@q("exp_column_values_to_be_increasing", _INC_SQL)
def _(spark, d):
    return X.column_values_to_be_increasing(_t(spark, d, "orders"), "o_totalprice", sort_column="o_orderkey")


@q("exp_column_values_to_be_increasing_grouped",
   "WITH v AS (SELECT l_linenumber AS sort_column, l_orderkey, l_extendedprice AS value_field FROM lineitem), "
   "l AS (SELECT *, lag(value_field) OVER (PARTITION BY l_orderkey ORDER BY sort_column, value_field) AS value_field_lag FROM v) "
   "SELECT * FROM l WHERE value_field_lag IS NOT NULL AND NOT (value_field >= value_field_lag)")
def _(spark, d):
    return X.column_values_to_be_increasing(_t(spark, d, "lineitem"), "l_extendedprice", sort_column="l_linenumber",
                                            strictly=False, group_by=["l_orderkey"])


@q("exp_column_values_to_be_decreasing",
   "WITH v AS (SELECT l_shipdate AS sort_column, l_orderkey AS value_field FROM lineitem WHERE l_linestatus = 'F'), "
   "l AS (SELECT *, lag(value_field) OVER (ORDER BY sort_column, value_field) AS value_field_lag FROM v) "
   "SELECT * FROM l WHERE value_field_lag IS NOT NULL AND NOT (value_field < value_field_lag)")
def _(spark, d):
    return X.column_values_to_be_decreasing(_t(spark, d, "lineitem"), "l_orderkey", sort_column="l_shipdate",
                                            row_condition="l_linestatus = 'F'")


@q("exp_column_values_to_have_consistent_casing",
   "SELECT * FROM (SELECT count(1) AS set_count, count(DISTINCT lower(distinct_values)) AS set_count_case_insensitive "
   "FROM (SELECT DISTINCT c_mktsegment AS distinct_values FROM customer)) WHERE set_count <> set_count_case_insensitive")
def _(spark, d):
    return X.column_values_to_have_consistent_casing(_t(spark, d, "customer"), "c_mktsegment")


@q("exp_column_values_to_have_consistent_casing_display",
   "SELECT lower(distinct_values) AS inconsistent_columns, count(distinct_values) AS set_count_case_insensitive "
   "FROM (SELECT DISTINCT l_returnflag || lower(l_linestatus) AS distinct_values FROM lineitem "
   "UNION SELECT DISTINCT upper(l_returnflag) || l_linestatus FROM lineitem) GROUP BY 1 HAVING count(distinct_values) > 1")
def _(spark, d):
    li = _t(spark, d, "lineitem")
    mixed = li.select(F.concat("l_returnflag", F.lower("l_linestatus")).alias("v")).unionByName(
        li.select(F.concat(F.upper("l_returnflag"), "l_linestatus").alias("v")))
    return X.column_values_to_have_consistent_casing(mixed, "v", display_inconsistent_columns=True)


# --- aggregate functions -------------------------------------------------------

@q("exp_column_distinct_count_to_equal", s_true("lineitem", "count(DISTINCT l_linestatus) = 2", ["l_returnflag"]))
def _(spark, d):
    return X.column_distinct_count_to_equal(_t(spark, d, "lineitem"), "l_linestatus", 2, ["l_returnflag"])


@q("exp_column_distinct_count_to_be_greater_than", s_true("orders", "count(DISTINCT o_custkey) > 1000", ["o_orderpriority"]))
def _(spark, d):
    return X.column_distinct_count_to_be_greater_than(_t(spark, d, "orders"), "o_custkey", 1000, ["o_orderpriority"])


@q("exp_column_distinct_count_to_be_less_than", s_true("lineitem", "count(DISTINCT l_suppkey) < 100"))
def _(spark, d):
    return X.column_distinct_count_to_be_less_than(_t(spark, d, "lineitem"), "l_suppkey", 100)


@q("exp_column_distinct_count_to_equal_other_table",
   s_equal("lineitem", "count(DISTINCT l_orderkey)", "orders", "count(DISTINCT o_orderkey)"))
def _(spark, d):
    return X.column_distinct_count_to_equal_other_table(_t(spark, d, "lineitem"), "l_orderkey", _t(spark, d, "orders"),
                                                        "o_orderkey")


@q("exp_column_distinct_values_to_be_in_set",
   "SELECT v.value_field FROM (SELECT DISTINCT o_orderstatus AS value_field FROM orders) v "
   "LEFT JOIN (SELECT 'F' AS value_field UNION ALL SELECT 'O') s ON v.value_field = s.value_field WHERE s.value_field IS NULL")
def _(spark, d):
    return X.column_distinct_values_to_be_in_set(_t(spark, d, "orders"), "o_orderstatus", ["F", "O"])


@q("exp_column_distinct_values_to_contain_set",
   "SELECT s.value_field FROM (SELECT DISTINCT value_field FROM (SELECT 'AUTOMOBILE' AS value_field UNION ALL "
   "SELECT 'SPACESHIP' UNION ALL SELECT 'SPACESHIP')) s LEFT JOIN (SELECT DISTINCT c_mktsegment AS value_field FROM customer) v "
   "ON s.value_field = v.value_field WHERE v.value_field IS NULL")
def _(spark, d):
    return X.column_distinct_values_to_contain_set(_t(spark, d, "customer"), "c_mktsegment",
                                                   ["AUTOMOBILE", "SPACESHIP", "SPACESHIP"])


@q("exp_column_distinct_values_to_equal_set",
   "SELECT v.column_value, s.value_field FROM (SELECT DISTINCT o_orderpriority AS column_value FROM orders) v "
   "FULL OUTER JOIN (SELECT DISTINCT value_field FROM (SELECT '1-URGENT' AS value_field UNION ALL SELECT '2-HIGH' "
   "UNION ALL SELECT '9-NEVER')) s ON v.column_value = s.value_field WHERE v.column_value IS NULL OR s.value_field IS NULL")
def _(spark, d):
    return X.column_distinct_values_to_equal_set(_t(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "9-NEVER"])


_LG = ["l_returnflag"]


@q("exp_column_max_to_be_between", s_between("lineitem", "max(l_extendedprice)", 1000, 104000, _LG))
def _(spark, d):
    return X.column_max_to_be_between(_t(spark, d, "lineitem"), "l_extendedprice", 1000, 104000, _LG)


@q("exp_column_min_to_be_between", s_between("lineitem", "min(l_quantity)", 1, 1, ["l_linestatus"], "l_discount > 0.05"))
def _(spark, d):
    return X.column_min_to_be_between(_t(spark, d, "lineitem"), "l_quantity", 1, 1, ["l_linestatus"], "l_discount > 0.05")


@q("exp_column_mean_to_be_between", s_between("lineitem", "avg(l_quantity)", 25.3, 25.6, ["l_returnflag", "l_linestatus"]))
def _(spark, d):
    return X.column_mean_to_be_between(_t(spark, d, "lineitem"), "l_quantity", 25.3, 25.6, ["l_returnflag", "l_linestatus"])


@q("exp_column_median_to_be_between",
   s_between("orders", "percentile_cont(0.5) WITHIN GROUP (ORDER BY o_totalprice)", 249000, 252000, ["o_orderpriority"]))
def _(spark, d):
    return X.column_median_to_be_between(_t(spark, d, "orders"), "o_totalprice", 249000, 252000, ["o_orderpriority"])


@q("exp_column_quantile_values_to_be_between",
   s_between("lineitem", "percentile_cont(0.9) WITHIN GROUP (ORDER BY l_extendedprice)", 94000, 95000, _LG))
def _(spark, d):
    return X.column_quantile_values_to_be_between(_t(spark, d, "lineitem"), "l_extendedprice", 0.9, 94000, 95000, _LG)


@q("exp_column_stdev_to_be_between", s_between("lineitem", "stddev_samp(l_quantity)", 14.3, 14.5, ["l_linestatus"]))
def _(spark, d):
    return X.column_stdev_to_be_between(_t(spark, d, "lineitem"), "l_quantity", 14.3, 14.5, ["l_linestatus"])


@q("exp_column_sum_to_be_between", s_between("lineitem", "sum(l_quantity)", None, 500000, _LG, strictly=True))
def _(spark, d):
    return X.column_sum_to_be_between(_t(spark, d, "lineitem"), "l_quantity", None, 500000, _LG, strictly=True)


@q("exp_column_unique_value_count_to_be_between",
   s_between("lineitem", "count(DISTINCT l_partkey)", 1990, None, ["l_linestatus"]))
def _(spark, d):
    return X.column_unique_value_count_to_be_between(_t(spark, d, "lineitem"), "l_partkey", 1990, None, ["l_linestatus"])


@q("exp_column_proportion_of_unique_values_to_be_between",
   s_between("orders", "CAST(count(DISTINCT o_custkey) AS DOUBLE) / count(o_custkey)", 0.33, 1.0, ["o_orderstatus"]))
def _(spark, d):
    return X.column_proportion_of_unique_values_to_be_between(_t(spark, d, "orders"), "o_custkey", 0.33, 1.0,
                                                              ["o_orderstatus"])


_MCV_SQL = (
    "WITH vc AS (SELECT l_shipmode_like AS value_field, count(*) AS value_count FROM "
    "(SELECT l_returnflag || l_linestatus AS l_shipmode_like FROM lineitem) GROUP BY 1), "
    "r AS (SELECT *, row_number() OVER (ORDER BY value_count DESC, value_field ASC NULLS FIRST) AS value_count_rank FROM vc) "
    "SELECT value_field FROM r WHERE value_count_rank = {n} AND value_field NOT IN ('NO', 'RF')")


@q("exp_column_most_common_value_to_be_in_set", _MCV_SQL.format(n=2))
def _(spark, d):
    li = _t(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("l_shipmode_like"))
    return X.column_most_common_value_to_be_in_set(li, "l_shipmode_like", ["NO", "RF"], top_n=2)


# --- string matching -------------------------------------------------------------

@q("exp_column_values_to_match_regex", s_true("customer", "regexp_matches(c_name, '^Customer#0000[0-9]{5}$')"))
def _(spark, d):
    return X.column_values_to_match_regex(_t(spark, d, "customer"), "c_name", "^Customer#0000[0-9]{5}$")


@q("exp_column_values_to_not_match_regex", s_true("orders", "NOT regexp_matches(o_orderpriority, '(?i)urgent')"))
def _(spark, d):
    return X.column_values_to_not_match_regex(_t(spark, d, "orders"), "o_orderpriority", "urgent", flags="i")


@q("exp_column_values_to_match_regex_list",
   s_true("orders", "regexp_matches(o_orderpriority, '^[12]-') AND regexp_matches(o_orderpriority, 'URGENT|HIGH')"))
def _(spark, d):
    return X.column_values_to_match_regex_list(_t(spark, d, "orders"), "o_orderpriority", ["^[12]-", "URGENT|HIGH"],
                                               match_on="all")


@q("exp_column_values_to_not_match_regex_list",
   s_true("part", "NOT regexp_matches(p_type, 'BRASS') OR NOT regexp_matches(p_type, '^LARGE')"))
def _(spark, d):
    return X.column_values_to_not_match_regex_list(_t(spark, d, "part"), "p_type", ["BRASS", "^LARGE"], match_on="any")


@q("exp_column_values_to_match_like_pattern", s_true("orders", "o_orderpriority LIKE '%-%'"))
def _(spark, d):
    return X.column_values_to_match_like_pattern(_t(spark, d, "orders"), "o_orderpriority", "%-%")


@q("exp_column_values_to_not_match_like_pattern", s_true("customer", "NOT (c_mktsegment LIKE '%MACH%')"))
def _(spark, d):
    return X.column_values_to_not_match_like_pattern(_t(spark, d, "customer"), "c_mktsegment", "%MACH%")


@q("exp_column_values_to_match_like_pattern_list",
   s_true("orders", "o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '%LOW'"))
def _(spark, d):
    return X.column_values_to_match_like_pattern_list(_t(spark, d, "orders"), "o_orderpriority", ["1-%", "%LOW"])


@q("exp_column_values_to_not_match_like_pattern_list",
   s_true("part", "NOT (p_brand LIKE 'Brand#1%') AND NOT (p_brand LIKE '%5')"))
def _(spark, d):
    return X.column_values_to_not_match_like_pattern_list(_t(spark, d, "part"), "p_brand", ["Brand#1%", "%5"],
                                                          match_on="all")


@q("exp_column_value_lengths_to_equal", s_true("customer", "length(c_name) = 18"))
def _(spark, d):
    return X.column_value_lengths_to_equal(_t(spark, d, "customer"), "c_name", 18)


@q("exp_column_value_lengths_to_be_between", s_between("part", "length(p_name)", 10, 40))
def _(spark, d):
    return X.column_value_lengths_to_be_between(_t(spark, d, "part"), "p_name", 10, 40)


# --- table shape ---------------------------------------------------------------------

@q("exp_table_row_count_to_equal", s_true("lineitem", "count(*) = 12000", ["l_linenumber"]))
def _(spark, d):
    return X.table_row_count_to_equal(_t(spark, d, "lineitem"), 12000, ["l_linenumber"])


@q("exp_table_row_count_to_be_between", s_between("orders", "count(*)", 2900, 3100, ["o_orderpriority"]))
def _(spark, d):
    return X.table_row_count_to_be_between(_t(spark, d, "orders"), 2900, 3100, ["o_orderpriority"])


@q("exp_table_row_count_to_equal_other_table",
   s_equal("lineitem", "count(*)", "orders", "count(*) * 1", ["l_orderkey"], ["o_orderkey"]))
def _(spark, d):
    return X.table_row_count_to_equal_other_table(_t(spark, d, "lineitem"), _t(spark, d, "orders"), ["l_orderkey"],
                                                  ["o_orderkey"])


@q("exp_table_row_count_to_equal_other_table_times_factor",
   s_equal("orders", "count(*)", "customer", "count(*) * 10"))
def _(spark, d):
    return X.table_row_count_to_equal_other_table_times_factor(_t(spark, d, "orders"), _t(spark, d, "customer"), 10)


@q("exp_table_aggregation_to_equal_other_table",
   s_equal("lineitem", "sum(l_quantity)", "lineitem", "sum(l_quantity)", ["l_suppkey"], where="l_linestatus = 'F'",
           b_where="l_linestatus = 'O'", tolerance=20000))
def _(spark, d):
    li = _t(spark, d, "lineitem")
    return X.table_aggregation_to_equal_other_table(li, "sum(l_quantity)", li, None, ["l_suppkey"], None,
                                                    "l_linestatus = 'F'", "l_linestatus = 'O'", tolerance=20000)


_NOW = dt.datetime(2001, 8, 15)


@q("exp_row_values_to_have_recent_data",
   "SELECT * FROM (SELECT max(CAST(o_orderdate AS TIMESTAMP)) AS max_timestamp FROM orders "
   "WHERE CAST(o_orderdate AS TIMESTAMP) <= TIMESTAMP '2001-08-15 00:00:00' AND o_orderstatus = 'F') "
   "WHERE coalesce(max_timestamp, TIMESTAMP '1970-01-01 00:00:00') < TIMESTAMP '2001-08-15 00:00:00' - INTERVAL 10 DAY")
def _(spark, d):
    return X.row_values_to_have_recent_data(_t(spark, d, "orders"), "o_orderdate", "day", 10, _NOW, "o_orderstatus = 'F'")


@q("exp_grouped_row_values_to_have_recent_data",
   "SELECT CAST(1 AS BIGINT) AS row_count, l_suppkey, 1 AS join_key, latest_timestamp_column FROM "
   "(SELECT l_suppkey, max(CAST(l_shipdate AS TIMESTAMP)) AS latest_timestamp_column FROM lineitem "
   "WHERE CAST(l_shipdate AS TIMESTAMP) <= TIMESTAMP '2001-08-15 00:00:00' GROUP BY l_suppkey) "
   "WHERE latest_timestamp_column < TIMESTAMP '2001-08-15 00:00:00' - INTERVAL 2 MONTH")
def _(spark, d):
    return X.grouped_row_values_to_have_recent_data(_t(spark, d, "lineitem"), ["l_suppkey"], "l_shipdate", "month", 2, _NOW)


# --- multi-column --------------------------------------------------------------------

@q("exp_compound_columns_to_be_unique",
   "SELECT l_orderkey, l_suppkey, count(*) AS n_records FROM lineitem WHERE NOT (l_orderkey IS NULL AND l_suppkey IS NULL) "
   "GROUP BY l_orderkey, l_suppkey HAVING count(*) > 1")
def _(spark, d):
    return X.compound_columns_to_be_unique(_t(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"])


@q("exp_select_column_values_to_be_unique_within_record",
   "SELECT o_orderkey, o_custkey, CAST(len(list_distinct(list_filter([md5(CAST(o_orderkey AS VARCHAR)), "
   "md5(CAST(o_custkey AS VARCHAR))], lambda x: x IS NOT NULL))) AS INTEGER) AS column_values FROM orders "
   "WHERE NOT (o_orderkey IS NULL OR o_custkey IS NULL) AND column_values < 2")
def _(spark, d):
    return X.select_column_values_to_be_unique_within_record(_t(spark, d, "orders"), ["o_orderkey", "o_custkey"],
                                                             ignore_row_if="any_value_is_missing")


@q("exp_multicolumn_sum_to_equal", s_true("lineitem", "sum(l_discount) + sum(l_tax) = sum(l_quantity)", ["l_linestatus"]))
def _(spark, d):
    return X.multicolumn_sum_to_equal(_t(spark, d, "lineitem"), ["l_discount", "l_tax"], "l_quantity", ["l_linestatus"])


@q("exp_column_pair_values_A_to_be_greater_than_B", s_true("lineitem", "l_discount >= l_tax"))
def _(spark, d):
    return X.column_pair_values_A_to_be_greater_than_B(_t(spark, d, "lineitem"), "l_discount", "l_tax", or_equal=True)


@q("exp_column_pair_values_to_be_equal", s_true("orders", "o_orderkey = o_custkey", where="o_orderpriority = '1-URGENT'"))
def _(spark, d):
    return X.column_pair_values_to_be_equal(_t(spark, d, "orders"), "o_orderkey", "o_custkey", "o_orderpriority = '1-URGENT'")


@q("exp_column_pair_values_to_be_in_set",
   s_true("lineitem", "(l_returnflag = 'N' AND l_linestatus = 'O') OR (l_returnflag = 'R' AND l_linestatus = 'F') "
          "OR (l_returnflag = 'A' AND l_linestatus = 'F')"))
def _(spark, d):
    return X.column_pair_values_to_be_in_set(_t(spark, d, "lineitem"), "l_returnflag", "l_linestatus",
                                             [("N", "O"), ("R", "F"), ("A", "F")])


# --- distributional -------------------------------------------------------------------

@q("exp_column_values_to_be_within_n_stdevs",
   "WITH m AS (SELECT l_suppkey, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY 1), "
   "s AS (SELECT *, avg(l_quantity) OVER () AS l_quantity_average, stddev_samp(l_quantity) OVER () AS l_quantity_stddev FROM m), "
   "z AS (SELECT *, (l_quantity - l_quantity_average) / nullif(l_quantity_stddev, 0) AS l_quantity_sigma FROM s) "
   "SELECT l_suppkey, round(l_quantity, 6) AS l_quantity, round(l_quantity_average, 6) AS l_quantity_average, "
   "round(l_quantity_stddev, 6) AS l_quantity_stddev, round(l_quantity_sigma, 6) AS l_quantity_sigma FROM z "
   "WHERE abs(l_quantity_sigma) > 2")
def _(spark, d):
    return X.column_values_to_be_within_n_stdevs(_t(spark, d, "lineitem"), "l_quantity", ["l_suppkey"], 2)


_MOVING_SQL = (
    "WITH g AS (SELECT date_trunc('month', o_orderdate) AS metric_period, sum(o_totalprice) AS agg_metric_value "
    "FROM orders GROUP BY 1), "
    "p AS (SELECT *, lag(agg_metric_value, 1) OVER (ORDER BY metric_period) AS prior_agg_metric_value FROM g), "
    "v AS (SELECT *, coalesce(ln(nullif(agg_metric_value, 0)), 0) - coalesce(ln(nullif(prior_agg_metric_value, 0)), 0) "
    "AS metric_test_value FROM p), "
    "c AS (SELECT *, avg(metric_test_value) OVER (ORDER BY metric_period ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) "
    "AS metric_test_rolling_average, stddev_samp(metric_test_value) OVER (ORDER BY metric_period ROWS BETWEEN 6 PRECEDING "
    "AND 1 PRECEDING) AS metric_test_rolling_stddev FROM v), "
    "s AS (SELECT *, metric_test_value - metric_test_rolling_average AS metric_test_delta, "
    "(metric_test_value - metric_test_rolling_average) / nullif(metric_test_rolling_stddev, 0) AS metric_test_sigma FROM c) "
    "SELECT metric_period, round(agg_metric_value, 6) AS agg_metric_value, round(prior_agg_metric_value, 6) AS prior_agg_metric_value, "
    "round(metric_test_value, 6) AS metric_test_value, round(metric_test_rolling_average, 6) AS metric_test_rolling_average, "
    "round(metric_test_rolling_stddev, 6) AS metric_test_rolling_stddev, round(metric_test_delta, 6) AS metric_test_delta, "
    "round(metric_test_sigma, 6) AS metric_test_sigma FROM s "
    "WHERE metric_period >= date_trunc('month', TIMESTAMP '2001-08-15') - INTERVAL 60 MONTH "
    "AND metric_period < date_trunc('month', TIMESTAMP '2001-08-15') AND NOT (metric_test_sigma >= -1 AND metric_test_sigma <= 1)")


@q("exp_column_values_to_be_within_n_moving_stdevs", _MOVING_SQL)
def _(spark, d):
    return X.column_values_to_be_within_n_moving_stdevs(_t(spark, d, "orders"), "o_totalprice", "o_orderdate", _NOW,
                                                        period="month", trend_periods=6, test_periods=60,
                                                        sigma_threshold=1)


_EVERY_SQL = (
    "WITH b AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events WHERE event_type = 'purchase'), "
    "spine AS (SELECT CAST(s AS TIMESTAMP) + to_hours(CAST(k AS INTEGER)) AS date_hour, e FROM b, "
    "range(0, date_diff('hour', CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP))) r(k)), "
    "m AS (SELECT date_trunc('hour', ts) AS date_hour, count(*) AS row_cnt FROM events WHERE event_type = 'purchase' GROUP BY 1) "
    "SELECT sp.date_hour, m.row_cnt IS NULL AS is_missing, coalesce(m.row_cnt, 0) AS row_cnt "
    "FROM spine sp LEFT JOIN m ON sp.date_hour = m.date_hour WHERE coalesce(m.row_cnt, 0) = 0 AND sp.date_hour <= CAST(sp.e AS TIMESTAMP)")


@q("exp_row_values_to_have_data_for_every_n_datepart", _EVERY_SQL)
def _(spark, d):
    return X.row_values_to_have_data_for_every_n_datepart(_t(spark, d, "events"), "ts", "hour",
                                                          row_condition="event_type = 'purchase'")


_EVERY_INTERVAL_SQL = (
    "WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e FROM orders "
    "WHERE o_orderpriority = '1-URGENT'), "
    "spine AS (SELECT CAST(s AS TIMESTAMP) + to_days(CAST(k AS INTEGER)) AS date_day, s FROM b, "
    "range(0, date_diff('day', CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP))) r(k) WHERE k % 3 = 0), "
    "m AS (SELECT date_trunc('day', o_orderdate) - to_days(CAST(date_diff('day', CAST(b.s AS TIMESTAMP), o_orderdate) % 3 AS INTEGER)) "
    "AS date_day, count(*) AS row_cnt FROM orders, b WHERE o_orderpriority = '1-URGENT' GROUP BY 1) "
    "SELECT sp.date_day, m.row_cnt IS NULL AS is_missing, coalesce(m.row_cnt, 0) AS row_cnt "
    "FROM spine sp LEFT JOIN m ON sp.date_day = m.date_day WHERE coalesce(m.row_cnt, 0) = 0")


@q("exp_row_values_to_have_data_for_every_n_datepart_interval", _EVERY_INTERVAL_SQL)
def _(spark, d):
    return X.row_values_to_have_data_for_every_n_datepart(_t(spark, d, "orders"), "o_orderdate", "day", interval=3,
                                                          row_condition="o_orderpriority = '1-URGENT'")


# --- core YAML tests ---------------------------------------------------------------------

@q("exp_relationships",
   "SELECT l_orderkey AS child_value FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)")
def _(spark, d):
    return X.relationships(_t(spark, d, "lineitem"), "l_orderkey", _t(spark, d, "orders"), "o_orderkey")


@q("exp_accepted_values",
   "SELECT o_orderstatus AS value_field FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')")
def _(spark, d):
    return X.accepted_values(_t(spark, d, "orders"), "o_orderstatus", ["F", "O"])


@q("exp_unique_expression",
   "SELECT l_orderkey || '-' || l_linenumber AS unique_field, count(*) AS n_records FROM lineitem "
   "WHERE l_orderkey || '-' || l_linenumber IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def _(spark, d):
    return X.unique(_t(spark, d, "lineitem"), "concat(l_orderkey, '-', l_linenumber)")


@q("exp_not_null", "SELECT doc_id, lang, source, n_chars, quality, toxic FROM " + DOCS_LABELS_SQL + " WHERE toxic IS NULL")
def _(spark, d):
    return X.not_null(_docs_labels(spark, d), "toxic")


# --- schema-only checks (no job; the table's schema is the input) -------------------------

def _cols_sql(table: str) -> str:
    return (f"(SELECT upper(column_name) AS c, CAST(ordinal_position AS INTEGER) AS i, "
            f"CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
            f"WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT' THEN 'float' "
            f"WHEN 'DATE' THEN 'date' ELSE lower(data_type) END AS t "
            f"FROM information_schema.columns WHERE table_name = '{table}')")


@q("exp_column_values_to_be_of_type",
   "SELECT 'l_shipdate' AS column_name, t AS column_type, 'timestamp' AS expected_type FROM " + _cols_sql("lineitem")
   + " WHERE c = 'L_SHIPDATE' AND lower(t) <> 'timestamp'")
def _(spark, d):
    return X.column_values_to_be_of_type(_t(spark, d, "lineitem"), "l_shipdate", "timestamp")


@q("exp_column_values_to_be_in_type_list",
   "SELECT 'o_totalprice' AS column_name, t AS column_type FROM " + _cols_sql("orders")
   + " WHERE c = 'O_TOTALPRICE' AND lower(t) NOT IN ('double', 'float')")
def _(spark, d):
    return X.column_values_to_be_in_type_list(_t(spark, d, "orders"), "o_totalprice", ["DOUBLE", "float"])


@q("exp_column_to_exist",
   "SELECT 'L_SHIPMODE' AS column_name, -1 AS matching_column_index, true AS column_index_matches "
   "WHERE NOT EXISTS (SELECT 1 FROM " + _cols_sql("lineitem") + " WHERE c = 'L_SHIPMODE')")
def _(spark, d):
    return X.column_to_exist(_t(spark, d, "lineitem"), "l_shipmode")


@q("exp_column_to_exist_at_index",
   "SELECT 'L_TAX' AS column_name, CAST(i - 1 AS INTEGER) AS matching_column_index, (i = 3) AS column_index_matches FROM "
   + _cols_sql("lineitem") + " WHERE c = 'L_TAX' AND NOT (i = 3)")
def _(spark, d):
    return X.column_to_exist(_t(spark, d, "lineitem"), "l_tax", column_index=3)


@q("exp_table_column_count_to_equal",
   "SELECT n AS number_actual_columns, 6 AS value FROM (SELECT CAST(count(*) AS INTEGER) AS n FROM "
   + _cols_sql("orders") + ") WHERE n <> 6")
def _(spark, d):
    return X.table_column_count_to_equal(_t(spark, d, "orders"), 6)


@q("exp_table_column_count_to_be_between",
   "SELECT n AS number_actual_columns, 2 AS min_value, 10 AS max_value FROM (SELECT CAST(count(*) AS INTEGER) AS n FROM "
   + _cols_sql("lineitem") + ") WHERE NOT (n >= 2 AND n <= 10)")
def _(spark, d):
    return X.table_column_count_to_be_between(_t(spark, d, "lineitem"), 2, 10)


@q("exp_table_column_count_to_equal_other_table",
   "SELECT a.n AS number_columns, b.n AS compare_number_columns FROM (SELECT CAST(count(*) AS INTEGER) AS n FROM "
   + _cols_sql("supplier") + ") a, (SELECT CAST(count(*) AS INTEGER) AS n FROM " + _cols_sql("customer")
   + ") b WHERE a.n <> b.n")
def _(spark, d):
    return X.table_column_count_to_equal_other_table(_t(spark, d, "supplier"), _t(spark, d, "customer"))


_WANT = ["O_ORDERKEY", "O_CUSTKEY", "O_COMMENT"]
_WANT_SQL = " UNION ALL ".join(f"SELECT '{w}' AS w, {i} AS wi" for i, w in enumerate(_WANT, 1))


@q("exp_table_columns_to_contain_set",
   f"SELECT w AS input_column, CAST(NULL AS VARCHAR) AS relation_column FROM ({_WANT_SQL}) "
   f"WHERE w NOT IN (SELECT c FROM {_cols_sql('orders')})")
def _(spark, d):
    return X.table_columns_to_contain_set(_t(spark, d, "orders"), [w.lower() for w in _WANT])


@q("exp_table_columns_to_not_contain_set",
   f"SELECT w AS input_column, w AS relation_column FROM ({_WANT_SQL}) WHERE w IN (SELECT c FROM {_cols_sql('orders')})")
def _(spark, d):
    return X.table_columns_to_not_contain_set(_t(spark, d, "orders"), [w.lower() for w in _WANT])


@q("exp_table_columns_to_match_set",
   f"SELECT c AS relation_column, CAST(NULL AS VARCHAR) AS input_column FROM {_cols_sql('orders')} "
   f"WHERE c NOT IN (SELECT w FROM ({_WANT_SQL})) UNION ALL "
   f"SELECT CAST(NULL AS VARCHAR), w FROM ({_WANT_SQL}) WHERE w NOT IN (SELECT c FROM {_cols_sql('orders')})")
def _(spark, d):
    return X.table_columns_to_match_set(_t(spark, d, "orders"), [w.lower() for w in _WANT])


@q("exp_table_columns_to_match_ordered_list",
   f"SELECT r.i AS relation_column_idx, r.c AS relation_column, w.wi AS input_column_idx, w.w AS input_column "
   f"FROM {_cols_sql('orders')} r FULL OUTER JOIN ({_WANT_SQL}) w ON r.c = w.w AND r.i = w.wi "
   f"WHERE r.c IS NULL OR w.w IS NULL")
def _(spark, d):
    return X.table_columns_to_match_ordered_list(_t(spark, d, "orders"), [w.lower() for w in _WANT])
