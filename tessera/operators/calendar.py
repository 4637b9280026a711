"""Table-valued calendar operators: series, date spine, date dimension, fiscal 4-5-4 calendar.

Spines are generated from one bounds row in two levels (runs of periods, dealt over the partitions, then the periods of
a run), so their size is the number of periods and no array holds a long spine. The fiscal calendar is date arithmetic
on each day: a day's fiscal year comes from the sorted ends of all fiscal years, one short array, and its week, period
and quarter from the days since the year's start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import calendar as C


SPINE_RUN = 32_768  # periods that one array of a spine holds at most


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """DAT-26: 1..n as ``generated_number``."""
    if upper_bound <= 0:
        raise ValueError("generate_series requires a positive upper bound")
    return spark.range(1, upper_bound + 1).select(F.col("id").alias("generated_number"))


def date_spine_between(bounds: DataFrame, start_col: str, end_col: str, datepart: str = "day",
                       out: str | None = None) -> DataFrame:
    """DAT-27: periods start, start+1, … strictly before ``end`` for every bounds row."""
    out = out or f"date_{datepart}"
    s, e = F.col(start_col), F.col(end_col)
    n = C.datediff_boundaries(s, e, datepart)
    runs = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(SPINE_RUN).cast("bigint"))).otherwise(
        F.array().cast("array<bigint>"))
    spine = bounds.select("*", F.explode(runs).alias("_run"), n.alias("_n")).repartition(F.col("_run"))
    run = F.sequence("_run", F.least(F.col("_run") + SPINE_RUN, F.col("_n")) - 1)
    spine = spine.select("*", F.explode(run).alias("_k"))
    spine = spine.withColumn(out, C.dateadd(datepart, F.col("_k").cast("int"), s))
    return spine.where(F.col(out) <= e.cast("timestamp_ntz")).drop("_run", "_n", "_k")


def date_spine(spark: SparkSession, datepart: str, start_date, end_date) -> DataFrame:
    b = spark.range(1).select(C.ntz_lit(start_date).alias("_s"), C.ntz_lit(end_date).alias("_e"))
    return date_spine_between(b, "_s", "_e", datepart).select(f"date_{datepart}")


def base_dates_between(bounds: DataFrame, start_col: str, end_col: str, datepart: str = "day") -> DataFrame:
    """DAT-28 over a bounds row (explicit range)."""
    sp = date_spine_between(bounds, start_col, end_col, datepart)
    return sp.select(F.col(f"date_{datepart}").cast("timestamp_ntz").alias(f"date_{datepart}"))


def get_base_dates(spark: SparkSession, start_date=None, end_date=None, n_dateparts: int | None = None,
                   datepart: str = "day", today=None) -> DataFrame:
    """DAT-28: explicit [start, end) or the last ``n_dateparts`` periods up to tomorrow (exclusive)."""
    if start_date is not None and end_date is not None:
        s, e = C.ntz_lit(start_date), C.ntz_lit(end_date)
    elif n_dateparts and datepart:
        t = C.ntz_lit(today).cast("date") if today is not None else C.today()
        s, e = C.dateadd(datepart, -1 * n_dateparts, t), C.tomorrow(t).cast("timestamp_ntz")
    else:
        raise ValueError("give start_date and end_date, or n_dateparts")
    b = spark.range(1).select(s.alias("_s"), e.alias("_e"))
    return base_dates_between(b, "_s", "_e", datepart)


def date_dimension(base_dates: DataFrame, date_col: str = "date_day") -> DataFrame:
    """DAT-29: one row per day with 36 calendar attributes."""
    d = F.col("date_day")
    py = F.col("prior_year_date_day")
    pyoy = F.col("prior_year_over_year_date_day")
    days = base_dates.select(F.col(date_col).cast("date").alias("date_day")).select(
        "date_day",
        F.add_months(d, -12).alias("prior_year_date_day"),
        F.date_sub(d, 364).alias("prior_year_over_year_date_day"),
    )
    return days.select(
        "date_day",
        C.yesterday(d).alias("prior_date_day"),
        C.tomorrow(d).alias("next_date_day"),
        "prior_year_date_day",
        "prior_year_over_year_date_day",
        C.day_of_week(d, isoweek=False).alias("day_of_week"),
        C.day_of_week(d, isoweek=True).alias("day_of_week_iso"),
        C.day_name(d, short=False).alias("day_of_week_name"),
        C.day_name(d, short=True).alias("day_of_week_name_short"),
        C.day_of_month(d).alias("day_of_month"),
        C.day_of_year(d).alias("day_of_year"),
        C.week_start(d).alias("week_start_date"),
        C.week_end(d).alias("week_end_date"),
        C.week_start(pyoy).alias("prior_year_week_start_date"),
        C.week_end(pyoy).alias("prior_year_week_end_date"),
        C.week_of_year(d).alias("week_of_year"),
        C.iso_week_start(d).alias("iso_week_start_date"),
        C.iso_week_end(d).alias("iso_week_end_date"),
        C.iso_week_start(pyoy).alias("prior_year_iso_week_start_date"),
        C.iso_week_end(pyoy).alias("prior_year_iso_week_end_date"),
        C.iso_week_of_year(d).alias("iso_week_of_year"),
        C.week_of_year(pyoy).alias("prior_year_week_of_year"),
        C.iso_week_of_year(pyoy).alias("prior_year_iso_week_of_year"),
        F.month(d).cast("int").alias("month_of_year"),
        C.month_name(d, short=False).alias("month_name"),
        C.month_name(d, short=True).alias("month_name_short"),
        F.trunc(d, "month").alias("month_start_date"),
        C.last_day(d, "month").alias("month_end_date"),
        F.trunc(py, "month").alias("prior_year_month_start_date"),
        C.last_day(py, "month").alias("prior_year_month_end_date"),
        F.quarter(d).cast("int").alias("quarter_of_year"),
        F.trunc(d, "quarter").alias("quarter_start_date"),
        C.last_day(d, "quarter").alias("quarter_end_date"),
        F.year(d).cast("int").alias("year_number"),
        F.trunc(d, "year").alias("year_start_date"),
        C.last_day(d, "year").alias("year_end_date"),
    )


def fiscal_year_ends(dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1) -> DataFrame:
    """(fiscal_year_number, fiscal_year_end_date): of the weeks that start in the year-end month, the last day of that
    which ends nearest to the month's end. Week ends are seven days apart, so none tie."""
    week_end = F.date_add("date_day", 6)
    opens_week = (F.col("month_of_year") == year_end_month) & (F.col("day_of_week") == week_start_day)
    return dates.where(opens_week).groupBy((F.col("year_number") - shift_year).alias("fiscal_year_number")).agg(
        F.min_by(week_end, F.abs(F.datediff(F.last_day("date_day"), week_end))).alias("fiscal_year_end_date"))


def fiscal_year_dates(dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1,
                      shift_year: int = 1) -> DataFrame:
    """DAT-30: each day with its fiscal year and week. ``dates`` is a date dimension without gaps.

    A fiscal year begins on the day after the one before ended; days up to the first end and after the last drop out.
    """
    ends = fiscal_year_ends(dates, year_end_month, week_start_day, shift_year).agg(
        F.sort_array(F.collect_list(F.struct(F.col("fiscal_year_end_date").alias("last"),
                                             F.col("fiscal_year_number").alias("number")))).alias("_ends"))
    day = F.col("date_day")
    # one row, joined on a constant key
    d = dates.select(day, "day_of_week", F.lit(1).alias("_k")).join(F.broadcast(ends.withColumn("_k", F.lit(1))), "_k")
    d = d.withColumn("_past", F.size(F.filter("_ends", lambda y: y["last"] < day)))
    d = d.where((F.col("_past") > 0) & (F.col("_past") < F.size("_ends"))).withColumn("_year", F.get("_ends", F.col("_past")))
    start = F.date_add(F.get("_ends", F.col("_past") - 1)["last"], 1)
    week_start = F.date_sub(day, F.pmod(F.col("day_of_week") - F.lit(week_start_day), F.lit(7)))
    return d.select(
        day,
        F.col("_year.number").alias("fiscal_year_number"),
        start.alias("fiscal_year_start_date"),
        F.col("_year.last").alias("fiscal_year_end_date"),
        week_start.alias("week_start_date"),
        F.date_add(week_start, 6).alias("week_end_date"),
        (F.floor(F.datediff(day, start) / 7) + 1).cast("int").alias("fiscal_week_of_year"),
    )


def fiscal_periods(dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1) -> DataFrame:
    """DAT-31: quarters of 13 weeks, the last with any 53rd; in each, periods of 4, 5 and the remaining weeks."""
    f = fiscal_year_dates(dates, year_end_month, week_start_day, shift_year)
    week = F.col("fiscal_week_of_year") - 1
    quarter = F.least(F.floor(week / 13), F.lit(3)).cast("int")
    week = week - 13 * quarter
    period = F.when(week < 4, 0).when(week < 9, 1).otherwise(2)
    skipped = F.when(week < 4, 0).when(week < 9, 4).otherwise(9)
    return f.select(
        "date_day", "fiscal_year_number", "week_start_date", "week_end_date", "fiscal_week_of_year",
        (week - skipped + 1).cast("int").alias("fiscal_week_of_period"),
        (3 * quarter + period + 1).cast("int").alias("fiscal_period_number"),
        (quarter + 1).alias("fiscal_quarter_number"),
        (period + 1).alias("fiscal_period_of_quarter"),
    )


def dim_date_with_fiscal(dates: DataFrame, year_end_month: int = 1, week_start_day: int = 1,
                         shift_year: int = 1) -> DataFrame:
    """DAT-32: date dimension ⟕ fiscal periods USING (date_day)."""
    fp = fiscal_periods(dates, year_end_month, week_start_day, shift_year).drop("week_start_date", "week_end_date")
    return dates.join(fp, "date_day", "left")


def bounds_of(df: DataFrame, col: str) -> DataFrame:
    """One row (_s, _e) with the min and max of ``col`` (a cheap partial aggregate)."""
    return df.agg(F.min(F.col(col)).cast("timestamp_ntz").alias("_s"), F.max(F.col(col)).cast("timestamp_ntz").alias("_e"))




def dim_hour(spark: SparkSession, today, n_days: int = 28) -> DataFrame:
    """DAT-33: the hours of the ``n_days`` days before ``today`` and of ``today`` itself."""
    return get_base_dates(spark, n_dateparts=24 * n_days, datepart="hour", today=today)


def dim_week(spark: SparkSession, today, n_weeks: int = 52) -> DataFrame:
    """DAT-33: the ``n_weeks`` week starts before ``today``."""
    return get_base_dates(spark, n_dateparts=n_weeks, datepart="week", today=today)


def get_date_dimension(spark: SparkSession, start_date, end_date) -> DataFrame:
    """DAT-29 in the library's call shape: the date dimension for [start_date, end_date)."""
    return date_dimension(get_base_dates(spark, start_date, end_date))
