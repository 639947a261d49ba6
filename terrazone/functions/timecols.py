"""Column expressions for half-open time intervals and native cadences (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import col

DAY_SECONDS = 86400.0


def days_between(start, end) -> Column:
    """Length of [start, end) in fractional days."""
    s, e = col(start).cast("timestamp"), col(end).cast("timestamp")
    return (F.unix_micros(e) - F.unix_micros(s)) / F.lit(DAY_SECONDS * 1e6)


def month_start(c) -> Column:
    return F.date_trunc("month", col(c).cast("timestamp"))


def next_month(c) -> Column:
    return F.add_months(F.trunc(col(c).cast("date"), "MM"), 1).cast("timestamp")


def _plus_days(ts: Column, days: int) -> Column:
    return ts + F.expr(f"INTERVAL {days} DAYS")


def interval_end(start, cadence) -> Column:
    """End of the native interval beginning at ``start``.

    daily: next day; dekadal: 1 -> 11 -> 21 -> next month, other starts NULL; 16day: capped at the
    end of the year; monthly: the same day of the next month's start. Unknown cadences give NULL.
    """
    s, cad = col(start).cast("timestamp"), col(cadence)
    day = F.dayofmonth(s)
    year_end = F.date_trunc("year", F.add_months(F.trunc(s.cast("date"), "YEAR"), 12).cast("timestamp"))
    dekad = F.when(day.isin(1, 11), _plus_days(s, 10)).when(
        day == 21, next_month(s) + (s - F.date_trunc("day", s)))
    return (F.when(cad == "daily", _plus_days(s, 1))
            .when(cad == "dekadal", dekad)
            .when(cad == "16day", F.least(_plus_days(s, 16), year_end))
            .when(cad == "monthly", next_month(s)))


def interval_index(instant, cadence) -> Column:
    """Running number of the native interval (counted from 1 January of each year) holding an instant."""
    t, cad = col(instant).cast("timestamp"), col(cadence)
    year, month, day = F.year(t), F.month(t), F.dayofmonth(t)
    return (F.when(cad == "daily", F.unix_date(t.cast("date")).cast("long"))
            .when(cad == "dekadal", (year * 36 + (month - 1) * 3 + F.least(F.floor((day - 1) / 10), F.lit(2))).cast("long"))
            .when(cad == "16day", (year * 23 + F.floor((F.dayofyear(t) - 1) / 16)).cast("long"))
            .when(cad == "monthly", (year * 12 + month).cast("long")))


def expected_count(start, end, cadence) -> Column:
    """Native intervals overlapping [start, end); closed form, no calendar table is needed."""
    s, e = col(start).cast("timestamp"), col(end).cast("timestamp")
    last = e - F.expr("INTERVAL 1 MICROSECOND")
    return F.when(e > s, interval_index(last, cadence) - interval_index(s, cadence) + 1).otherwise(F.lit(0).cast("long"))


def overlap_days(a_start, a_end, b_start, b_end) -> Column:
    """Overlap of two intervals in days, 0 when disjoint, NULL when any bound is missing."""
    cols = [col(c).cast("timestamp") for c in (a_start, a_end, b_start, b_end)]
    known = cols[0].isNotNull() & cols[1].isNotNull() & cols[2].isNotNull() & cols[3].isNotNull()
    return F.when(known, F.greatest(F.lit(0.0), days_between(F.greatest(cols[0], cols[2]), F.least(cols[1], cols[3]))))


def period_years(code) -> Column:
    """First and last year of a 20-year period code (P, then two-digit start and end years)."""
    c = col(code)
    y0, y1 = F.substring(c, 3, 2).try_cast("int"), F.substring(c, 5, 2).try_cast("int")
    return F.struct((F.lit(2000) + y0).alias("first_year"),
                    (F.lit(2000) + F.when(y1 == 0, 100).otherwise(y1)).alias("last_year"))


def utc_timestamp(text) -> Column:
    """ISO text, with or without a trailing Z, read as UTC; other text gives NULL."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(col(text)), "Z$", ""))


def prefetch_start(start, cadence, margin_days: int = 17) -> Column:
    """Earliest observation start to read for a window: 16-day composites may begin before it."""
    s = col(start).cast("timestamp")
    return F.when(col(cadence) == "16day", _plus_days(s, -margin_days)).otherwise(s)
