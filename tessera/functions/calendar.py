"""Calendar column functions (Column -> Column), DuckDB-branch semantics of the reference.

Weeks: ``week_start`` is the Sunday on or before the date (non-ISO), the ISO
helpers use Monday. Every "now"-based helper takes an explicit ``now`` so
results are reproducible; ``now()`` itself is only a convenience.
Timestamps are ``timestamp_ntz`` throughout, so no helper depends on the
session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F



def ntz_lit(x) -> Column:
    """A ``timestamp_ntz`` literal that does not depend on any time zone.

    Python ``datetime`` literals travel as zone-aware timestamps and would shift
    with the session zone when cast; the ISO text form casts exactly.
    """
    if isinstance(x, Column):
        return x.cast("timestamp_ntz")
    if isinstance(x, _dt.datetime):
        return F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(x, _dt.date):
        return F.lit(x.isoformat()).cast("timestamp_ntz")
    return F.lit(str(x)).cast("timestamp_ntz")


def _epoch() -> Column:
    return ntz_lit("1970-01-01 00:00:00")


_SUBDAY_MICROS = {"hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000}


def ntz_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a naive timestamp, read as wall-clock fields.

    Zone-free by construction (``timestamp_diff`` on NTZ input goes through the
    session zone and shifts wall times that do not exist there).
    """
    t = _c(ts).cast("timestamp_ntz")
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    secs = F.date_part(F.lit("SECOND"), t)  # seconds with fraction
    return (days * F.lit(86_400_000_000) + F.hour(t).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(t).cast("bigint") * F.lit(60_000_000) + (secs * F.lit(1_000_000)).cast("bigint"))


def trunc_ntz(part: str, ts) -> Column:
    """Truncate to ``part`` as a ``timestamp_ntz``, independent of the session time zone.

    (Spark's ``date_trunc`` returns a zone-aware timestamp even for NTZ input,
    so its buckets would move with the session zone.) Calendar units truncate
    the date; sub-day units add the hour/minute/second fields back onto the
    date (interval arithmetic on NTZ is zone-free).
    """
    p = part.lower()
    t = _c(ts).cast("timestamp_ntz")
    if p in ("year", "quarter", "month", "week"):
        return F.trunc(t.cast("date"), p).cast("timestamp_ntz")
    if p == "day":
        return t.cast("date").cast("timestamp_ntz")
    if p in _SUBDAY_MICROS:
        day = t.cast("date").cast("timestamp_ntz")
        h = F.hour(t)
        m = F.minute(t) if p in ("minute", "second") else F.lit(0)
        sec = F.second(t) if p == "second" else F.lit(0)
        return day + F.make_dt_interval(F.lit(0), h, m, sec.cast("decimal(18,6)"))
    raise ValueError(f"unsupported date part {part!r}")


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def _d(x) -> Column:
    return _c(x).cast("date")


def convert_timezone(col, target_tz: str, source_tz: str = "UTC") -> Column:
    """DAT-01: naive timestamp read in ``source_tz`` → naive wall time in ``target_tz``."""
    return F.convert_timezone(F.lit(source_tz), F.lit(target_tz), _c(col).cast("timestamp_ntz"))


def date_part(part: str, d) -> Column:
    return F.date_part(F.lit(part), _c(d))


# English day and month names (the formatter's default-locale output), in calendar order.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
               "November", "December")


def day_name(d, short: bool = False) -> Column:
    """Sunday / Sun — an array lookup by day of week (no per-row date formatting)."""
    names = [n[:3] if short else n for n in DAY_NAMES]
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.dayofweek(_c(d)))


def day_of_month(d) -> Column:
    return F.dayofmonth(_c(d))


def day_of_week(d, isoweek: bool = True) -> Column:
    """ISO: Monday=1 … Sunday=7; otherwise Sunday=1 … Saturday=7."""
    return (F.weekday(_c(d)) + 1) if isoweek else F.dayofweek(_c(d))


def day_of_year(d) -> Column:
    return F.dayofyear(_c(d))


def from_unixtimestamp(epochs, format: str = "seconds") -> Column:  # noqa: A002
    """DAT-07: epoch number → naive UTC timestamp."""
    unit = {"seconds": "SECOND", "milliseconds": "MILLISECOND", "microseconds": "MICROSECOND"}.get(format)
    if unit is None:
        raise ValueError(f"unsupported epoch format {format!r}")
    return F.timestamp_add(unit, _c(epochs), _epoch())


def to_unixtimestamp(ts) -> Column:
    """DAT-08: seconds since the epoch (fractional), reading the naive timestamp as UTC."""
    return ntz_micros(ts) / F.lit(1e6)


def iso_week_start(d) -> Column:
    return F.trunc(_d(d), "week")


def iso_week_end(d) -> Column:
    return F.date_add(iso_week_start(d), 6)


def iso_week_of_year(d) -> Column:
    return F.weekofyear(_c(d))


def week_start(d) -> Column:
    """DAT-12: the Sunday on or before the date."""
    return F.date_sub(_d(d), F.dayofweek(_c(d)) - 1)


def week_end(d) -> Column:
    return F.date_add(week_start(d), 6)


def week_of_year(d) -> Column:
    """DAT-14: ``ceil(dayofyear / 7)``."""
    return F.ceil(F.dayofyear(_c(d)) / F.lit(7)).cast("int")


def month_name(d, short: bool = False) -> Column:
    """November / Nov — an array lookup by month number."""
    names = [n[:3] if short else n for n in MONTH_NAMES]
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.month(_c(d)))


def now(tz: str | None = None, at: _dt.datetime | None = None) -> Column:
    """DAT-16: current (or the given ``at``) naive timestamp in ``tz``."""
    base = ntz_lit(at) if at is not None else F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return base if tz is None else convert_timezone(base, tz, "UTC")


def today(tz: str | None = None, at: _dt.datetime | None = None) -> Column:
    return now(tz, at).cast("date")


def yesterday(d) -> Column:
    return F.date_sub(_d(d), 1)


def tomorrow(d) -> Column:
    return F.date_add(_d(d), 1)


def n_days_ago(n: int, d) -> Column:
    return F.date_sub(_d(d), n)


def n_days_away(n: int, d) -> Column:
    return F.date_add(_d(d), n)


def n_weeks_ago(n: int, d) -> Column:
    """DAT-19: shift by n weeks, then truncate to the (Monday) week."""
    return F.trunc(F.date_sub(_d(d), 7 * n), "week")


def n_weeks_away(n: int, d) -> Column:
    return F.trunc(F.date_add(_d(d), 7 * n), "week")


def last_week(d) -> Column:
    return n_weeks_ago(1, d)


def next_week(d) -> Column:
    return n_weeks_away(1, d)


def n_months_ago(n: int, d) -> Column:
    return F.trunc(F.add_months(_d(d), -n), "month")


def n_months_away(n: int, d) -> Column:
    return F.trunc(F.add_months(_d(d), n), "month")


def last_month(d) -> Column:
    return n_months_ago(1, d)


def next_month(d) -> Column:
    return n_months_away(1, d)


def last_month_name(d, short: bool = True) -> Column:
    return month_name(last_month(d), short)


def last_month_number(d) -> Column:
    return F.month(last_month(d))


def next_month_name(d, short: bool = True) -> Column:
    return month_name(next_month(d), short)


def next_month_number(d) -> Column:
    return F.month(next_month(d))


_TRUNC = {"year": "year", "quarter": "quarter", "month": "month", "week": "week", "day": "day",
          "hour": "hour", "minute": "minute", "second": "second"}


def datediff_boundaries(start, end, part: str) -> Column:
    """DAT-22/25: period difference as the reference engine counts it.

    Calendar units (year, quarter, month, day, hour, minute, second) count
    boundaries crossed; ``week`` counts whole 7-day spans of the day difference.
    """
    s, e = _c(start).cast("timestamp_ntz"), _c(end).cast("timestamp_ntz")
    p = part.lower()
    if p == "year":
        return (F.year(e) - F.year(s)).cast("bigint")
    if p == "quarter":
        return ((F.year(e) * 4 + F.quarter(e)) - (F.year(s) * 4 + F.quarter(s))).cast("bigint")
    if p == "month":
        return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("bigint")
    if p == "day":
        return F.datediff(e.cast("date"), s.cast("date")).cast("bigint")
    if p == "week":
        days = F.datediff(e.cast("date"), s.cast("date"))
        return (F.signum(days) * F.floor(F.abs(days) / F.lit(7))).cast("bigint")
    if p in ("hour", "minute", "second"):
        return F.floor((ntz_micros(trunc_ntz(p, e)) - ntz_micros(trunc_ntz(p, s))) / F.lit(_SUBDAY_MICROS[p])).cast("bigint")
    raise ValueError(f"unsupported date part {part!r}")


def periods_since(col, period: str = "day", now_at=None) -> Column:
    """DAT-22: boundary count from ``col`` to ``now_at``."""
    return datediff_boundaries(col, now_at if now_at is not None else now(), period)


def round_timestamp(ts) -> Column:
    """DAT-23: nearest day (ties round up)."""
    return trunc_ntz("day", F.timestamp_add("HOUR", F.lit(12), _c(ts).cast("timestamp_ntz")))


def date(year: int, month: int, day: int) -> Column:
    return F.make_date(F.lit(year), F.lit(month), F.lit(day))


def datetime(year: int, month: int, day: int, hour: int = 0, minute: int = 0, second: int = 0,
             tz: str | None = None) -> Column:
    ts = F.make_timestamp_ntz(F.lit(year), F.lit(month), F.lit(day), F.lit(hour), F.lit(minute), F.lit(second))
    return ts if tz is None else convert_timezone(ts, "UTC", tz)


def date_trunc(part: str, d) -> Column:
    return trunc_ntz(part, d)


def last_day(d, part: str = "month") -> Column:
    """DAT-34: last day of the month / quarter / year containing ``d``."""
    dd = _d(d)
    if part == "month":
        return F.last_day(dd)
    months = {"quarter": 3, "year": 12}[part]
    return F.date_sub(F.add_months(F.trunc(dd, part), months), 1)


def dateadd(part: str, n, d) -> Column:
    p = part.upper()
    if p == "WEEK":
        return F.timestamp_add("DAY", _c(n) * 7, _c(d).cast("timestamp_ntz"))
    return F.timestamp_add(p, _c(n), _c(d).cast("timestamp_ntz"))


def type_timestamp() -> str:
    """FUN-09: the naive timestamp type used for every timestamp in this package."""
    return "timestamp_ntz"


def type_datetime() -> str:
    """FUN-09: zone-aware instant type (only for conversions at the boundaries)."""
    return "timestamp"
