import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.operators import expectations as X
from tessera.operators.ordered import previous_in_order
from tessera.operators.suite import Check, run_suite


@pytest.fixture(scope="module")
def data_test(spark):
    rows = [(1, "2020-10-21", 0.0, 1.0, "a", "b", None, None, 1.0),
            (2, "2020-10-22", 1.0, 0.0, "b", "ab", None, None, 1.0),
            (3, "2020-10-23", 0.5, 0.5, "c", "abc", None, None, 1.0),
            (4, "2020-10-23", 0.5, 0.5, "c", "abcd", None, None, 1.0)]
    return spark.createDataFrame(rows, "idx int, date_col string, col_numeric_a float, col_numeric_b float, "
                                       "col_string_a string, col_string_b string, col_null string, col_null_2 string, "
                                       "col_numeric_a_plus_b double")


@pytest.fixture(scope="module")
def data_text(spark):
    rows = [("ab@gmail.com", "91001", "91001-123"), ("ab@mail.com", "90210", "90210-123"),
            ("abc@gmail.com", "90026", "90026-123"), ("abc.com@gmail.com", "09876", "09876-023")]
    return spark.createDataFrame(rows, "email_address string, postal_code_5 string, postal_code_5_3 string")


def n(df):
    return df.count()


def test_generalized(data_test):
    assert n(X.expression_is_true(data_test, "col_numeric_a + col_numeric_b = col_numeric_a_plus_b")) == 0
    assert n(X.expression_is_true(data_test, "col_numeric_a > 0")) == 1  # idx 1 fails
    assert n(X.expression_is_true(data_test, "col_null = 'x'")) == 0  # NULL passes
    assert n(X.expression_between(data_test, "col_numeric_a", 0, 1)) == 0
    assert n(X.expression_between(data_test, "col_numeric_a", 0, 1, strictly=True)) == 2  # 0 and 1
    with pytest.raises(ValueError):
        X.expression_between(data_test, "col_numeric_a")
    assert n(X.equal_expression(data_test, "sum(col_numeric_a)", data_test, "sum(col_numeric_b)")) == 0
    assert n(X.equal_expression(data_test, "count(*)", group_by=["idx"])) == 0


def test_column_values(data_test, data_text):
    assert n(X.column_values_to_not_be_null(data_test, "col_numeric_a")) == 0
    assert n(X.column_values_to_be_null(data_test, "col_null")) == 0
    assert n(X.column_values_to_be_unique(data_test, "idx")) == 0
    assert n(X.column_values_to_be_unique(data_test, "col_string_a")) == 1
    assert n(X.column_values_to_be_in_set(data_test, "col_string_a", ["a", "b", "c"])) == 0
    assert n(X.column_values_to_be_in_set(data_test, "col_null", ["a"])) == 4  # NULL fails
    assert n(X.column_values_to_not_be_in_set(data_test, "col_string_a", ["c", "c"])) == 4  # 2 rows × 2 entries
    assert n(X.column_values_to_be_increasing(data_test, "idx")) == 0
    assert n(X.column_values_to_be_increasing(data_test, "date_col", sort_column="idx", strictly=False)) == 0
    assert n(X.column_values_to_be_increasing(data_test, "date_col", sort_column="idx", strictly=True)) == 1
    assert n(X.column_values_to_be_decreasing(data_test, "idx", sort_column="idx")) == 3
    assert n(X.column_values_to_be_of_type(data_test, "idx", "INT")) == 0
    assert n(X.column_values_to_be_in_type_list(data_test, "col_string_a", ["string", "varchar"])) == 0
    assert n(X.column_values_to_have_consistent_casing(data_test, "col_string_a")) == 0
    assert n(X.column_values_to_match_regex(data_text, "email_address", r"@[^.]*")) == 0
    assert n(X.column_values_to_match_regex(data_text, "email_address", r"@gmail\.com$")) == 1
    assert n(X.column_values_to_match_regex_list(data_text, "email_address", ["@[^.]*", "&"], match_on="all")) == 4
    assert n(X.column_values_to_not_match_regex(data_text, "email_address", r"&")) == 0
    assert n(X.column_values_to_match_like_pattern(data_text, "postal_code_5_3", "%-%")) == 0
    assert n(X.column_values_to_match_like_pattern_list(data_text, "email_address", ["%@%", "%&%"], "any")) == 0
    assert n(X.column_value_lengths_to_equal(data_text, "postal_code_5", 5)) == 0
    assert n(X.column_value_lengths_to_be_between(data_text, "postal_code_5_3", 9, 9)) == 0


def test_aggregates(data_test):
    assert n(X.column_distinct_count_to_equal(data_test, "col_string_a", 3)) == 0
    assert n(X.column_distinct_count_to_be_greater_than(data_test, "col_string_a", 3)) == 1
    assert n(X.column_distinct_values_to_be_in_set(data_test, "col_string_a", ["a", "b", "c"])) == 0
    assert n(X.column_distinct_values_to_contain_set(data_test, "col_string_a", ["a", "z"])) == 1
    assert n(X.column_distinct_values_to_equal_set(data_test, "col_string_a", ["a", "b", "c", "d"])) == 1
    assert n(X.column_max_to_be_between(data_test, "idx", 4, 4)) == 0
    assert n(X.column_mean_to_be_between(data_test, "col_numeric_a", 0.5, 0.5)) == 0
    assert n(X.column_median_to_be_between(data_test, "col_numeric_a", 0.5, 0.5)) == 0
    assert n(X.column_quantile_values_to_be_between(data_test, "idx", 0.95, 3.8, 3.9)) == 0
    assert n(X.column_stdev_to_be_between(data_test, "col_numeric_a", 0.4, 0.42)) == 0
    assert n(X.column_sum_to_be_between(data_test, "idx", 10, 10)) == 0
    assert n(X.column_unique_value_count_to_be_between(data_test, "col_string_a", 3, 3)) == 0
    assert n(X.column_proportion_of_unique_values_to_be_between(data_test, "col_string_a", 0.75, 0.75)) == 0
    assert n(X.column_most_common_value_to_be_in_set(data_test, "col_string_a", ["c"], top_n=1)) == 0
    assert n(X.column_most_common_value_to_be_in_set(data_test, "col_string_a", ["a"], top_n=1)) == 1


def test_table_shape(spark, data_test):
    assert n(X.column_to_exist(data_test, "col_numeric_a", column_index=3)) == 0
    assert n(X.column_to_exist(data_test, "nope")) == 1
    assert n(X.table_column_count_to_equal(data_test, 9)) == 0
    assert n(X.table_column_count_to_be_between(data_test, 1, 8)) == 1
    assert n(X.table_columns_to_contain_set(data_test, ["idx", "col_string_a"])) == 0
    assert n(X.table_columns_to_not_contain_set(data_test, ["idx", "nope"])) == 1
    assert n(X.table_columns_to_match_set(data_test, list(data_test.columns))) == 0
    assert n(X.table_columns_to_match_ordered_list(data_test, ["idx", "col_numeric_a"])) > 0
    assert n(X.table_row_count_to_equal(data_test, 4)) == 0
    assert n(X.table_row_count_to_be_between(data_test, 1, 4)) == 0
    factored = data_test.withColumn("factor", F.explode(F.array(F.lit(1), F.lit(2))))
    assert n(X.table_row_count_to_equal_other_table_times_factor(factored, data_test, 2)) == 0
    assert n(X.table_row_count_to_equal_other_table(factored, data_test)) == 1
    now = dt.datetime(2020, 10, 24)
    ts = data_test.withColumn("ts", F.col("date_col").cast("timestamp_ntz"))
    assert n(X.row_values_to_have_recent_data(ts, "ts", "day", 2, now)) == 0
    assert n(X.row_values_to_have_recent_data(ts, "ts", "day", 2, now, row_condition="idx = 1")) == 1
    assert n(X.grouped_row_values_to_have_recent_data(ts, ["col_string_a"], "ts", "day", 2, now)) == 1


def test_multi_column(data_test):
    assert n(X.compound_columns_to_be_unique(data_test, ["date_col", "col_string_b"])) == 0
    assert n(X.compound_columns_to_be_unique(data_test, ["date_col", "col_string_a"])) == 1
    assert n(X.select_column_values_to_be_unique_within_record(data_test, ["col_string_a", "col_string_b"])) == 0
    assert n(X.multicolumn_sum_to_equal(data_test, ["col_numeric_a", "col_numeric_b"], 4)) == 0
    assert n(X.column_pair_values_A_to_be_greater_than_B(data_test, "col_numeric_a_plus_b", "col_numeric_a", True)) == 0
    assert n(X.column_pair_values_to_be_equal(data_test, "col_numeric_a", "col_numeric_b")) == 2
    assert n(X.column_pair_values_to_be_in_set(data_test, "col_numeric_a", "col_numeric_b",
                                               [(0, 1), (1, 0), (0.5, 0.5)])) == 0
    with pytest.raises(ValueError):
        X.column_pair_values_to_be_in_set(data_test, "col_numeric_a", "col_numeric_b", [(0, 1, 2)])
    with pytest.raises(ValueError):
        X.compound_columns_to_be_unique(data_test, ["idx"], ignore_row_if="bad")


def test_distributional(spark):
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    rows = [(d, g, float(10 + (i % 3))) for i, d in enumerate(days) for g in range(4)]
    rows.append((days[-3], 0, 500.0))  # spike
    df = spark.createDataFrame(rows, "date_day timestamp_ntz, group_id int, row_value double")
    assert n(X.column_values_to_be_within_n_stdevs(df, "row_value", ["group_id"], 1.4)) >= 1
    assert n(X.column_values_to_be_within_n_stdevs(df, "row_value")) == 0  # one group → stddev NULL
    mv = X.column_values_to_be_within_n_moving_stdevs(df, "row_value", "date_day", dt.datetime(2024, 3, 1),
                                                      test_periods=10, sigma_threshold=6)
    assert {r["metric_period"] for r in mv.collect()} >= {days[-3]}
    gaps = df.where(F.col("date_day") != days[10])
    miss = X.row_values_to_have_data_for_every_n_datepart(gaps, "date_day", "day")
    assert [r["date_day"] for r in miss.collect()] == [days[10]]
    assert n(X.row_values_to_have_data_for_every_n_datepart(gaps, "date_day", "day", interval=2)) == 0


def test_previous_in_order_matches_window(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 5), rnd.randint(0, 50), rnd.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g int, k int, v double")
    got = previous_in_order(df, "v", ["k", "v"], ["g"], "lag_v", num_ranges=7)
    want = df.withColumn("lag_v", F.lag("v").over(W.partitionBy("g").orderBy("k", "v")))
    assert sorted(got.select("g", "k", "v", "lag_v").collect()) == sorted(want.collect())
    got2 = previous_in_order(df, "v", ["k", "v"], None, "lag_v", num_ranges=5)
    want2 = df.withColumn("lag_v", F.lag("v").over(W.orderBy("k", "v")))
    assert sorted(got2.select("g", "k", "v", "lag_v").collect()) == sorted(want2.collect())


def test_suite_thresholds(data_test):
    checks = [Check("unique(idx)", "data_test", lambda: X.column_values_to_be_unique(data_test, "idx")),
              Check("unique(a)", "data_test", lambda: X.column_values_to_be_unique(data_test, "col_string_a")),
              Check("unique(a) warn", "data_test", lambda: X.column_values_to_be_unique(data_test, "col_string_a"),
                    severity="warn"),
              Check("error_if >5", "data_test", lambda: X.column_values_to_be_unique(data_test, "col_string_a"),
                    error_if=">5")]
    got = {r["check"]: r["status"] for r in run_suite(checks).collect()}
    assert got == {"unique(idx)": "pass", "unique(a)": "error", "unique(a) warn": "warn", "error_if >5": "warn"}


def test_group_quantile_matches_percentile(spark):
    from tessera.operators.ordered import group_quantile

    rnd = random.Random(5)
    rows = [(rnd.choice([0, 1, 1, 1, 2]), float(rnd.randint(0, 40)) if rnd.random() > 0.05 else None) for _ in range(2500)]
    rows += [(3, 7.0)]  # single-value group
    df = spark.createDataFrame(rows, "g int, v double")
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {r.g: r.quantile for r in group_quantile(df, "v", q, ["g"]).collect()}
        want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", F.lit(q)).alias("p")).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    tot = group_quantile(df, "v", 0.5).first()[0]
    assert abs(tot - df.agg(F.percentile("v", F.lit(0.5))).first()[0]) < 1e-9


def test_running_total_ties_share(spark):
    from tessera.operators.ordered import running_total

    df = spark.createDataFrame([(1, "2020-10-21", 1.0), (1, "2020-10-22", 2.0), (1, "2020-10-22", 3.0), (2, "2020-10-21", 5.0)],
                               "idx int, date_col string, v double")
    inc = {(r.idx, r.date_col, r.v): r.running_total for r in running_total(df, "v", ["idx"], "date_col").collect()}
    assert inc[(1, "2020-10-21", 1.0)] == 1.0 and inc[(1, "2020-10-22", 2.0)] == 6.0 and inc[(1, "2020-10-22", 3.0)] == 6.0
    dec = {(r.idx, r.date_col, r.v): r.running_total for r in running_total(df, "v", ["idx"], "date_col", True).collect()}
    assert dec[(1, "2020-10-21", 1.0)] == 6.0 and dec[(2, "2020-10-21", 5.0)] == 5.0
    assert n(X.column_values_to_be_increasing(running_total(df, "v", ["idx"], "date_col"), "running_total",
                                              sort_column="date_col", strictly=False, group_by=["idx"])) == 0


def test_equal_expression_outer_semantics(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 5), (None, 7)], "k string, v int")
    b = spark.createDataFrame([("x", 3), ("z", 4), (None, 7)], "k string, v int")
    rows = {(r.col_1, r.expression, r.compare_expression, r.expression_difference)
            for r in X.equal_expression(a, "sum(v)", b, "sum(v)", ["k"]).collect()}
    # x matches (3 = 3); y and z exist on one side only (missing side counts as 0);
    # NULL keys never match, so each side's NULL group fails on its own
    assert rows == {("y", 5, None, 5), ("z", None, 4, 4), (None, 7, None, 7), (None, None, 7, 7)}
    pct = X.equal_expression(a, "sum(v)", b, "sum(v) * 2", ["k"], tolerance_percent=0.5).collect()
    assert {r.col_1 for r in pct} == {"x", "y", None}  # z: percent is NULL (no own value) and passes


def test_every_period_explicit_bounds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 2, 4)], "d timestamp_ntz")
    miss = X.row_values_to_have_data_for_every_n_datepart(df, "d", "day", test_start_date=dt.date(2024, 1, 1),
                                                          test_end_date="2024-01-06")
    assert sorted(r.date_day for r in miss.collect()) == [dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 5)]
    # latest row 2024-01-04 00:00 is 36 h before "now": stale for a 1-day window, fresh for 2 days
    assert X.row_values_to_have_recent_data(df, "d", "day", 1, "2024-01-05 12:00:00").count() == 1
    assert X.row_values_to_have_recent_data(df, "d", "day", 2, "2024-01-05 12:00:00").count() == 0


def test_regex_flag_alphabet(spark):
    assert [X.inline_flags(f) for f in ("", "i", "ic", "ci", "ie", "sp", "ps", "U", "imm")] == ["", "i", "", "i", "i", "", "s", "", "im"]
    df = spark.createDataFrame([("Ab",), ("ab",), ("a\nb",)], "x string")
    assert n(X.column_values_to_match_regex(df, "x", "ab", flags="c")) == 2
    assert n(X.column_values_to_match_regex(df, "x", "ab", flags="ie")) == 1
    assert n(X.column_values_to_match_regex(df, "x", "a.*b", flags="sp")) == 2
    assert n(X.column_values_to_match_regex(df, "x", "a.*b", flags="psi")) == 0


def test_regex_flags(data_text):
    assert n(X.column_values_to_match_regex(data_text, "email_address", "GMAIL", flags="i")) == 1  # ab@mail.com
    assert n(X.column_values_to_match_regex(data_text, "email_address", "GMAIL")) == 4
    with pytest.warns(UserWarning, match="'q'"):
        assert n(X.column_values_to_match_regex(data_text, "email_address", "GMAIL", flags="qi")) == 1
