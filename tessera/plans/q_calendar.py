"""Registered calendar queries: spines, date dimension and fiscal calendar bounded by order dates,
and the calendar column helpers applied to whole fact tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import calendar as C
from tessera.operators import calendar as K
from tessera.plans.catalog import register
from tessera.plans.present import present
from tessera.sources.tables import read_table

_NOW = dt.datetime(2001, 8, 15, 10, 30, 0)


def _dim(spark, sf_dir):
    b = K.bounds_of(read_table(spark, sf_dir, "orders"), "o_orderdate")
    return K.date_dimension(K.base_dates_between(b, "_s", "_e", "day"))


def _spine_sql(part: str, src: str = "orders", col: str = "o_orderdate") -> str:
    unit = {"day": "to_days", "month": "to_months", "hour": "to_hours", "week": "to_weeks", "year": "to_years"}[part]
    return (
        f"WITH b AS (SELECT CAST(min({col}) AS TIMESTAMP) AS s, CAST(max({col}) AS TIMESTAMP) AS e FROM {src}) "
        f"SELECT s + {unit}(CAST(k AS INTEGER)) AS date_{part} FROM b, range(0, date_diff('{part}', s, e)) r(k) "
        f"WHERE s + {unit}(CAST(k AS INTEGER)) <= e")


for _part in ("day", "week", "month", "hour"):
    def _mk(part):
        def fn(spark, sf_dir):
            b = K.bounds_of(read_table(spark, sf_dir, "orders"), "o_orderdate")
            return K.base_dates_between(b, "_s", "_e", part)
        return fn
    register(f"cal_date_spine_{_part}", _spine_sql(_part))(_mk(_part))


_DIM_CTE = """
base AS (SELECT CAST(min(o_orderdate) AS TIMESTAMP) AS s, CAST(max(o_orderdate) AS TIMESTAMP) AS e FROM orders),
spine AS (SELECT CAST(s + to_days(CAST(k AS INTEGER)) AS DATE) AS date_day FROM base, range(0, date_diff('day', s, e)) r(k)),
dd AS (SELECT date_day, CAST(date_day - INTERVAL 1 YEAR AS DATE) AS prior_year_date_day,
              CAST(date_day - 364 AS DATE) AS prior_year_over_year_date_day FROM spine),
dim AS (
SELECT date_day,
  CAST(date_day - 1 AS DATE) AS prior_date_day, CAST(date_day + 1 AS DATE) AS next_date_day,
  prior_year_date_day, prior_year_over_year_date_day,
  CAST(dayofweek(date_day) + 1 AS INTEGER) AS day_of_week, CAST(isodow(date_day) AS INTEGER) AS day_of_week_iso,
  strftime(date_day, '%A') AS day_of_week_name, strftime(date_day, '%a') AS day_of_week_name_short,
  CAST(dayofmonth(date_day) AS INTEGER) AS day_of_month, CAST(dayofyear(date_day) AS INTEGER) AS day_of_year,
  CAST(date_day - CAST(dayofweek(date_day) AS INTEGER) AS DATE) AS week_start_date,
  CAST(date_day - CAST(dayofweek(date_day) AS INTEGER) + 6 AS DATE) AS week_end_date,
  CAST(prior_year_over_year_date_day - CAST(dayofweek(prior_year_over_year_date_day) AS INTEGER) AS DATE) AS prior_year_week_start_date,
  CAST(prior_year_over_year_date_day - CAST(dayofweek(prior_year_over_year_date_day) AS INTEGER) + 6 AS DATE) AS prior_year_week_end_date,
  CAST(ceil(dayofyear(date_day) / 7) AS INTEGER) AS week_of_year,
  CAST(date_trunc('week', date_day) AS DATE) AS iso_week_start_date,
  CAST(date_trunc('week', date_day) + INTERVAL 6 DAY AS DATE) AS iso_week_end_date,
  CAST(date_trunc('week', prior_year_over_year_date_day) AS DATE) AS prior_year_iso_week_start_date,
  CAST(date_trunc('week', prior_year_over_year_date_day) + INTERVAL 6 DAY AS DATE) AS prior_year_iso_week_end_date,
  CAST(weekofyear(date_day) AS INTEGER) AS iso_week_of_year,
  CAST(ceil(dayofyear(prior_year_over_year_date_day) / 7) AS INTEGER) AS prior_year_week_of_year,
  CAST(weekofyear(prior_year_over_year_date_day) AS INTEGER) AS prior_year_iso_week_of_year,
  CAST(month(date_day) AS INTEGER) AS month_of_year,
  strftime(date_day, '%B') AS month_name, strftime(date_day, '%b') AS month_name_short,
  CAST(date_trunc('month', date_day) AS DATE) AS month_start_date, last_day(date_day) AS month_end_date,
  CAST(date_trunc('month', prior_year_date_day) AS DATE) AS prior_year_month_start_date,
  last_day(prior_year_date_day) AS prior_year_month_end_date,
  CAST(quarter(date_day) AS INTEGER) AS quarter_of_year,
  CAST(date_trunc('quarter', date_day) AS DATE) AS quarter_start_date,
  CAST(date_trunc('quarter', date_day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
  CAST(year(date_day) AS INTEGER) AS year_number,
  CAST(date_trunc('year', date_day) AS DATE) AS year_start_date,
  CAST(date_trunc('year', date_day) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end_date
FROM dd)"""


@register("cal_date_dimension", "WITH " + _DIM_CTE + " SELECT * FROM dim")
def q_date_dimension(spark, sf_dir):
    """DAT-29 over the order-date range."""
    return _dim(spark, sf_dir)


def _fiscal_cte(yem: int, wsd: int, shift: int) -> str:
    """Fiscal days by arithmetic alone: the week end (weekday ``wsd + 5`` modulo 7 from Sunday) within three days of the
    month's end, kept to weeks that start in the month and the range; as-of joins find the ends around a day."""
    last = (wsd + 5) % 7
    return f"""
span AS (SELECT min(date_day) AS lo, max(date_day) AS hi FROM dim),
closing AS (SELECT y, make_date(y, {yem}, 1) AS first_of, last_day(make_date(y, {yem}, 1)) AS last_of, lo, hi
            FROM span, range(year(lo), year(hi) + 1) r(y)),
bounded AS (SELECT y, greatest(lo, first_of) AS a, least(hi, last_of) AS z,
                   last_of + 3 - CAST((dayofweek(last_of + 3) - {last} + 7) % 7 AS INTEGER) AS best FROM closing),
weekly AS (SELECT y, best, CAST(a + 6 + CAST(({last} - dayofweek(a + 6) + 7) % 7 AS INTEGER) AS DATE) AS soonest,
                  CAST(z + 6 - CAST((dayofweek(z + 6) - {last} + 7) % 7 AS INTEGER) AS DATE) AS latest FROM bounded WHERE a <= z),
fends AS (SELECT CAST(y - {shift} AS BIGINT) AS fy, CAST(least(greatest(best, soonest), latest) AS DATE) AS fin
          FROM weekly WHERE soonest <= latest),
fdays AS (SELECT date_day, n.fy, CAST(p.fin + 1 AS DATE) AS began, n.fin, date_day - p.fin - 1 AS nth
          FROM dim ASOF JOIN fends n ON date_day <= n.fin ASOF JOIN fends p ON date_day > p.fin),
fiscal_days AS (SELECT date_day, CAST(fy AS INTEGER) AS fiscal_year_number, began AS fiscal_year_start_date, fin AS fiscal_year_end_date,
                       CAST(date_day - CAST(nth % 7 AS INTEGER) AS DATE) AS week_start_date,
                       CAST(date_day - CAST(nth % 7 AS INTEGER) + 6 AS DATE) AS week_end_date,
                       CAST(nth // 7 + 1 AS INTEGER) AS fiscal_week_of_year FROM fdays),
-- a period of each week of a year, looked up by the week's number
retail AS (SELECT CAST(row_number() OVER (ORDER BY q, p, w) AS INTEGER) AS week, q, p, w
           FROM range(1, 5) a(q), range(1, 4) b(p), range(1, 6) c(w) WHERE w <= CASE WHEN p = 2 OR (q = 4 AND p = 3) THEN 5 ELSE 4 END),
fiscal AS (
  SELECT date_day, fiscal_year_number, week_start_date, week_end_date, fiscal_week_of_year, CAST(w AS INTEGER) AS fiscal_week_of_period,
         CAST(3 * q + p - 3 AS INTEGER) AS fiscal_period_number, CAST(q AS INTEGER) AS fiscal_quarter_number,
         CAST(p AS INTEGER) AS fiscal_period_of_quarter
  FROM fiscal_days JOIN retail ON week = fiscal_week_of_year)"""


@register("cal_fiscal_year_dates", "WITH " + _DIM_CTE + "," + _fiscal_cte(12, 1, 1) + " SELECT * FROM fiscal_days")
def q_fiscal_year_dates(spark, sf_dir):
    """DAT-30 (December year end, Sunday weeks)."""
    return K.fiscal_year_dates(_dim(spark, sf_dir), 12, 1, 1)


@register("cal_fiscal_periods", "WITH " + _DIM_CTE + "," + _fiscal_cte(1, 1, 1) + " SELECT * FROM fiscal")
def q_fiscal_periods(spark, sf_dir):
    """DAT-31 with the date library's own test parameters (year_end_month=1, week_start_day=1, shift_year=1)."""
    return K.fiscal_periods(_dim(spark, sf_dir), 1, 1, 1)


@register(
    "cal_dim_date_fiscal",
    "WITH " + _DIM_CTE + "," + _fiscal_cte(1, 1, 1)
    + " SELECT d.*, f.fiscal_year_number, f.fiscal_week_of_year, f.fiscal_week_of_period, f.fiscal_period_number, "
      "f.fiscal_quarter_number, f.fiscal_period_of_quarter FROM dim d LEFT JOIN fiscal f USING (date_day)",
)
def q_dim_date_fiscal(spark, sf_dir):
    """DAT-32: date dimension with fiscal columns."""
    return K.dim_date_with_fiscal(_dim(spark, sf_dir), 1, 1, 1)


_HELPERS_SQL = """
SELECT l_orderkey, l_linenumber, l_shipdate,
  CAST(date_part('quarter', l_shipdate) AS INTEGER) AS ship_quarter,
  strftime(l_shipdate, '%A') AS day_name, strftime(l_shipdate, '%a') AS day_name_short,
  CAST(dayofmonth(l_shipdate) AS INTEGER) AS day_of_month,
  CAST(isodow(l_shipdate) AS INTEGER) AS day_of_week_iso, CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS day_of_week,
  CAST(dayofyear(l_shipdate) AS INTEGER) AS day_of_year,
  CAST(CAST(l_shipdate AS DATE) - CAST(dayofweek(l_shipdate) AS INTEGER) AS DATE) AS week_start,
  CAST(CAST(l_shipdate AS DATE) - CAST(dayofweek(l_shipdate) AS INTEGER) + 6 AS DATE) AS week_end,
  CAST(ceil(dayofyear(l_shipdate) / 7) AS INTEGER) AS week_of_year,
  CAST(date_trunc('week', l_shipdate) AS DATE) AS iso_week_start,
  CAST(date_trunc('week', l_shipdate) + INTERVAL 6 DAY AS DATE) AS iso_week_end,
  CAST(weekofyear(l_shipdate) AS INTEGER) AS iso_week_of_year,
  strftime(l_shipdate, '%B') AS month_name, strftime(l_shipdate, '%b') AS month_name_short,
  CAST(l_shipdate AS DATE) - 1 AS yesterday, CAST(l_shipdate AS DATE) + 1 AS tomorrow,
  CAST(l_shipdate AS DATE) - 30 AS n_days_ago_30, CAST(l_shipdate AS DATE) + 30 AS n_days_away_30,
  CAST(date_trunc('week', CAST(l_shipdate AS DATE) - 14) AS DATE) AS n_weeks_ago_2,
  CAST(date_trunc('week', CAST(l_shipdate AS DATE) + 7) AS DATE) AS next_week,
  CAST(date_trunc('month', CAST(l_shipdate AS DATE) - INTERVAL 3 MONTH) AS DATE) AS n_months_ago_3,
  CAST(date_trunc('month', CAST(l_shipdate AS DATE) + INTERVAL 1 MONTH) AS DATE) AS next_month,
  strftime(CAST(date_trunc('month', CAST(l_shipdate AS DATE) - INTERVAL 1 MONTH) AS DATE), '%b') AS last_month_name,
  CAST(month(CAST(l_shipdate AS DATE) - INTERVAL 1 MONTH) AS INTEGER) AS last_month_number,
  CAST(month(CAST(l_shipdate AS DATE) + INTERVAL 1 MONTH) AS INTEGER) AS next_month_number,
  CAST(date_diff('month', l_shipdate, TIMESTAMP '2001-08-15 10:30:00') AS BIGINT) AS months_since,
  CAST(date_diff('week', l_shipdate, TIMESTAMP '2001-08-15 10:30:00') AS BIGINT) AS weeks_since,
  CAST(date_diff('hour', l_shipdate, TIMESTAMP '2001-08-15 10:30:00') AS BIGINT) AS hours_since,
  date_trunc('day', l_shipdate + INTERVAL 12 HOUR) AS rounded_ship,
  last_day(l_shipdate) AS month_end,
  CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
  CAST(date_trunc('year', l_shipdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end,
  round(epoch(l_shipdate), 6) AS unix_seconds,
  make_timestamp(CAST(epoch(l_shipdate) * 1000000 AS BIGINT)) AS from_unix,
  CAST(timezone('America/Los_Angeles', timezone('UTC', l_shipdate)) AS TIMESTAMP) AS ship_los_angeles
FROM lineitem"""


@register("cal_helpers_lineitem", _HELPERS_SQL)
def q_calendar_helpers(spark, sf_dir):
    """DAT-01..25, 34 as column functions over every lineitem row (explicit ``now``)."""
    li = read_table(spark, sf_dir, "lineitem")
    s = F.col("l_shipdate")
    now = C.ntz_lit(_NOW)
    return present(li.select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        C.date_part("quarter", s).cast("int").alias("ship_quarter"),
        C.day_name(s).alias("day_name"), C.day_name(s, True).alias("day_name_short"),
        C.day_of_month(s).alias("day_of_month"),
        C.day_of_week(s, True).alias("day_of_week_iso"), C.day_of_week(s, False).alias("day_of_week"),
        C.day_of_year(s).alias("day_of_year"),
        C.week_start(s).alias("week_start"), C.week_end(s).alias("week_end"), C.week_of_year(s).alias("week_of_year"),
        C.iso_week_start(s).alias("iso_week_start"), C.iso_week_end(s).alias("iso_week_end"),
        C.iso_week_of_year(s).alias("iso_week_of_year"),
        C.month_name(s).alias("month_name"), C.month_name(s, True).alias("month_name_short"),
        C.yesterday(s).alias("yesterday"), C.tomorrow(s).alias("tomorrow"),
        C.n_days_ago(30, s).alias("n_days_ago_30"), C.n_days_away(30, s).alias("n_days_away_30"),
        C.n_weeks_ago(2, s).alias("n_weeks_ago_2"), C.next_week(s).alias("next_week"),
        C.n_months_ago(3, s).alias("n_months_ago_3"), C.next_month(s).alias("next_month"),
        C.last_month_name(s).alias("last_month_name"), C.last_month_number(s).alias("last_month_number"),
        C.next_month_number(s).alias("next_month_number"),
        C.periods_since(s, "month", now).alias("months_since"),
        C.periods_since(s, "week", now).alias("weeks_since"),
        C.periods_since(s, "hour", now).alias("hours_since"),
        C.round_timestamp(s).alias("rounded_ship"),
        C.last_day(s, "month").alias("month_end"), C.last_day(s, "quarter").alias("quarter_end"),
        C.last_day(s, "year").alias("year_end"),
        C.to_unixtimestamp(s).alias("unix_seconds"),
        C.from_unixtimestamp(C.to_unixtimestamp(s) * F.lit(1000000).cast("bigint"), "microseconds").alias("from_unix"),
        C.convert_timezone(s, "America/Los_Angeles").alias("ship_los_angeles"),
    ))


@register("cal_generate_series", "SELECT generate_series AS generated_number FROM generate_series(1, (SELECT count(*) FROM supplier))")
def q_generate_series(spark, sf_dir):
    """DAT-26: 1..n with n read from the data (one scalar to the driver; rows generated distributed)."""
    n = read_table(spark, sf_dir, "supplier").count()
    return K.generate_series(spark, n)
