import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import calendar as C
from tessera.operators import calendar as K


def test_golden_dates(spark):
    df = spark.createDataFrame([(dt.date(2020, 11, 29),), (dt.date(2020, 12, 1),)], ["d"])
    d = F.col("d")
    rows = df.select(
        C.yesterday(d).alias("prior"), C.tomorrow(d).alias("next"), C.day_name(d).alias("dn"),
        C.day_name(d, True).alias("dns"), C.day_of_month(d).alias("dom"), C.day_of_week(d, False).alias("dow"),
        C.day_of_week(d, True).alias("idow"), C.day_of_year(d).alias("doy"), C.week_start(d).alias("ws"),
        C.week_end(d).alias("we"), C.week_of_year(d).alias("woy"), C.iso_week_start(d).alias("iws"),
        C.iso_week_end(d).alias("iwe"), C.iso_week_of_year(d).alias("iwoy"), F.month(d).alias("m"),
        C.month_name(d).alias("mn"), C.month_name(d, True).alias("mns"),
    ).collect()
    a, b = rows
    assert (a.prior, a.next, b.prior, b.next) == (dt.date(2020, 11, 28), dt.date(2020, 11, 30), dt.date(2020, 11, 30),
                                                  dt.date(2020, 12, 2))
    assert (a.dn, a.dns, b.dn, b.dns) == ("Sunday", "Sun", "Tuesday", "Tue")
    assert (a.dom, a.dow, a.idow, a.doy) == (29, 1, 7, 334)
    assert (b.dom, b.dow, b.idow, b.doy) == (1, 3, 2, 336)
    assert (a.ws, a.we, b.ws, b.we) == (dt.date(2020, 11, 29), dt.date(2020, 12, 5), dt.date(2020, 11, 29), dt.date(2020, 12, 5))
    assert (a.woy, b.woy) == (48, 48)
    assert (a.iws, a.iwe, a.iwoy) == (dt.date(2020, 11, 23), dt.date(2020, 11, 29), 48)
    assert (b.iws, b.iwe, b.iwoy) == (dt.date(2020, 11, 30), dt.date(2020, 12, 6), 49)
    assert (a.m, a.mn, a.mns, b.m, b.mn, b.mns) == (11, "November", "Nov", 12, "December", "Dec")


def test_epoch_timezone_rounding(spark):
    df = spark.createDataFrame([(1623076520,)], ["e"])
    r = df.select(C.from_unixtimestamp("e").alias("ts")).select(
        "ts", C.to_unixtimestamp("ts").alias("back"), C.convert_timezone("ts", "America/Los_Angeles").alias("la"),
    ).select("*", C.round_timestamp("la").alias("r_la"), C.round_timestamp("ts").alias("r_utc")).first()
    assert r.ts == dt.datetime(2021, 6, 7, 14, 35, 20) and r.back == 1623076520.0
    assert r.la == dt.datetime(2021, 6, 7, 7, 35, 20)
    assert r.r_la == dt.datetime(2021, 6, 7) and r.r_utc == dt.datetime(2021, 6, 8)


def test_boundary_datediff_and_shifts(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 59), dt.datetime(2020, 1, 1, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(C.datediff_boundaries("a", "b", "hour").alias("h"), C.datediff_boundaries("a", "b", "day").alias("d"),
                  C.n_months_ago(1, "a").alias("lm"), C.next_month_number("a").alias("nmn"),
                  C.last_day("a", "quarter").alias("qe"), C.last_day("a", "year").alias("ye")).first()
    assert (r.h, r.d, r.lm, r.nmn) == (1, 0, dt.date(2019, 12, 1), 2)
    assert (r.qe, r.ye) == (dt.date(2020, 3, 31), dt.date(2020, 12, 31))


def test_spine_end_exclusive_and_series(spark):
    sp = K.date_spine(spark, "day", dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 5)).collect()
    assert [r[0].day for r in sp] == [1, 2, 3, 4]
    assert K.generate_series(spark, 4).count() == 4
    m = K.get_base_dates(spark, n_dateparts=3, datepart="day", today=dt.date(2021, 1, 10)).collect()
    assert [r[0].day for r in m] == [7, 8, 9, 10]


def test_fiscal_calendar(spark):
    dim = K.get_date_dimension(spark, "2015-01-01", "2022-12-31")
    assert len(dim.columns) == 36  # date_day + 35 attributes, as the reference builds it
    fp = K.fiscal_periods(dim, year_end_month=1, week_start_day=1, shift_year=1)
    weeks = fp.groupBy("fiscal_year_number").agg(F.max("fiscal_week_of_year").alias("w")).collect()
    assert all(r.w in (52, 53) for r in weeks)
    per = fp.groupBy("fiscal_year_number", "fiscal_period_number").agg(F.countDistinct("week_start_date").alias("n"))
    counts = {(r.fiscal_period_number, r.n) for r in per.collect()}
    # 4-5-4 pattern per quarter (period 12 takes week 53 in long years)
    assert {p for p, _ in counts} == set(range(1, 13))
    assert all(n == (5 if p % 3 == 2 else 4) or (p == 12 and n == 5) for p, n in counts)
    assert fp.agg(F.max("fiscal_quarter_number")).first()[0] == 4


def _plain_fiscal(days, month, first_weekday, shift):
    """Fiscal days by loops: (day, year, start, end, week start, week)."""
    opens = [d for d in days if d.isoweekday() % 7 + 1 == first_weekday]
    ends = []
    for year in sorted({d.year for d in days}):
        last = dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(1)
        near = [d + dt.timedelta(6) for d in opens if (d.year, d.month) == (year, month)]
        if near:
            ends.append((min(near, key=lambda e: abs((e - last).days)), year - shift))
    out = []
    for (before, _), (end, year) in zip(ends[:-1], ends[1:], strict=True):
        for d in days:
            if before < d <= end:
                week = (d - before).days - 1
                out.append((d, year, before + dt.timedelta(1), end, d - dt.timedelta(week % 7), week // 7 + 1))
    return sorted(out)


@pytest.mark.parametrize(("start", "end", "month", "first_weekday", "shift"), [
    ("2015-01-01", "2019-06-01", 1, 1, 1), ("2014-01-30", "2019-01-16", 1, 2, 0), ("2012-12-10", "2017-12-12", 12, 1, 1),
    ("2000-02-28", "2004-02-29", 2, 5, 1), ("2010-06-29", "2013-06-27", 6, 7, 0), ("2015-03-01", "2015-09-01", 12, 1, 1)])
def test_fiscal_years_match_plain_loops(spark, start, end, month, first_weekday, shift):
    """Ranges that begin or end inside the year-end month are among these."""
    lo, hi = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    days = [lo + dt.timedelta(k) for k in range((hi - lo).days)]
    dim = K.get_date_dimension(spark, start, end)
    rows = K.fiscal_year_dates(dim, month, first_weekday, shift).collect()
    want = _plain_fiscal(days, month, first_weekday, shift)
    assert sorted((r.date_day, r.fiscal_year_number, r.fiscal_year_start_date, r.fiscal_year_end_date, r.week_start_date,
                   r.fiscal_week_of_year) for r in rows) == want
    assert all(r.week_end_date - r.week_start_date == dt.timedelta(6) for r in rows)


def test_long_spine_is_dealt_in_runs(spark):
    """A quarter of seconds: no array holds more than a run, and several tasks make the periods."""
    spine = K.date_spine(spark, "second", dt.datetime(2020, 1, 1), dt.datetime(2020, 4, 1))
    got = spine.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("date_second").alias("d"),
                    F.min("date_second").alias("lo"), F.max("date_second").alias("hi")).first()
    assert got.n == got.d == 91 * 86_400
    assert (got.lo, got.hi) == (dt.datetime(2020, 1, 1), dt.datetime(2020, 3, 31, 23, 59, 59))
    assert K.date_spine(spark, "day", dt.datetime(2020, 1, 5), dt.datetime(2020, 1, 1)).count() == 0


def test_truncation_independent_of_session_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2021-03-14 02:30:00",), ("2021-11-07 01:30:00",)], ["s"]).select(
            F.col("s").cast("timestamp_ntz").alias("t"))
        rows = df.select(C.trunc_ntz("hour", "t").alias("h"), C.trunc_ntz("day", "t").alias("d"),
                         C.trunc_ntz("month", "t").alias("m"), C.round_timestamp("t").alias("r"),
                         C.to_unixtimestamp("t").alias("u")).collect()
        assert [r.h for r in rows] == [dt.datetime(2021, 3, 14, 2), dt.datetime(2021, 11, 7, 1)]
        assert [r.d for r in rows] == [dt.datetime(2021, 3, 14), dt.datetime(2021, 11, 7)]
        assert [r.m for r in rows] == [dt.datetime(2021, 3, 1), dt.datetime(2021, 11, 1)]
        assert rows[0].u == 1615689000.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_hour_and_week_dims(spark):
    h = K.dim_hour(spark, dt.date(2021, 1, 10), n_days=2).collect()
    assert len(h) >= 48 and h[-1][0] == dt.datetime(2021, 1, 10, 23)
    w = K.dim_week(spark, dt.date(2021, 1, 10), n_weeks=3).collect()
    assert len(w) == 3 and w[0][0] == dt.datetime(2020, 12, 20)  # n week starts; the end is exclusive


def test_random_instants_match_duckdb(spark):
    import random

    import duckdb

    rnd = random.Random(17)
    base = dt.datetime(1900, 1, 1)
    pairs = [(base + dt.timedelta(seconds=rnd.randint(0, 200 * 365 * 86400)),
              base + dt.timedelta(seconds=rnd.randint(0, 200 * 365 * 86400))) for _ in range(500)]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(
        "a", "b",
        C.datediff_boundaries("a", "b", "year").alias("dy"), C.datediff_boundaries("a", "b", "month").alias("dm"),
        C.datediff_boundaries("a", "b", "week").alias("dw"), C.datediff_boundaries("a", "b", "day").alias("dd"),
        C.datediff_boundaries("a", "b", "hour").alias("dh"), C.week_start("a").alias("ws"),
        C.iso_week_start("a").alias("iws"), C.iso_week_of_year("a").alias("iwoy"), C.week_of_year("a").alias("woy"),
        C.day_of_week("a", False).alias("dow"), C.last_day("a", "quarter").alias("qe"), C.round_timestamp("a").alias("r"),
        C.trunc_ntz("hour", "a").alias("th"), C.to_unixtimestamp("a").alias("u"),
    ).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE p (a TIMESTAMP, b TIMESTAMP)")
    con.executemany("INSERT INTO p VALUES (?, ?)", pairs)
    want = con.execute("""
        SELECT a, b, date_diff('year', a, b), date_diff('month', a, b), date_diff('week', a, b), date_diff('day', a, b),
               date_diff('hour', a, b), CAST(a AS DATE) - CAST(dayofweek(a) AS INTEGER), CAST(date_trunc('week', a) AS DATE),
               weekofyear(a), CAST(ceil(dayofyear(a) / 7) AS INTEGER), dayofweek(a) + 1,
               CAST(date_trunc('quarter', a) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE),
               date_trunc('day', a + INTERVAL 12 HOUR), date_trunc('hour', a), epoch(a)
        FROM p""").fetchall()
    key = lambda r: (r[0], r[1])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(g)[:13] == tuple(w)[:13], (g, w)
        assert g[13] == w[13] and g[14] == w[14] and abs(g[15] - w[15]) < 1e-6, (g, w)
