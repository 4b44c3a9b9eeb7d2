"""Numeric time coordinates for the standard, noleap and 360-day calendars, as Column arithmetic."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_UNIT = {"days": 86400, "hours": 3600, "minutes": 60, "seconds": 1}
# Days before each month in a 365-day year (fixed values).
DAYS_BEFORE_MONTH = (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334)


def _unit_and_origin(units: str) -> tuple[int, str]:
    found = re.match(r"\s*(days|hours|minutes|seconds)\s+since\s+(\d{1,4}-\d{1,2}-\d{1,2})", units)
    if not found:
        raise ValueError(f"time units must read '<unit> since <date>', not {units!r}")
    return SECONDS_PER_UNIT[found.group(1)], found.group(2)


def micros_of_day(ts: Column) -> Column:
    """Microseconds since midnight, as a whole number."""
    second = (F.date_part(F.lit("SECOND"), ts) * 1000000).cast("long")
    return (F.hour(ts).cast("long") * 3600 + F.minute(ts).cast("long") * 60) * 1000000 + second


def _noleap_day(year: Column, month: Column, day: Column) -> Column:
    before = F.element_at(F.array(*[F.lit(d) for d in DAYS_BEFORE_MONTH]), month)
    number = year.cast("long") * 365 + before + day - 1
    return F.when(~((month == 2) & (day == 29)), number)


def cf_time(ts: Column, units: str = "days since 1850-01-01", calendar: str = "noleap") -> Column:
    """Offset of a date from the origin in ``units``; NULL for a date the calendar does not have."""
    seconds, origin = _unit_and_origin(units)
    year, month, day = (int(p) for p in origin.split("-"))
    if calendar in ("noleap", "365_day"):
        start = year * 365 + DAYS_BEFORE_MONTH[month - 1] + day - 1
        days = _noleap_day(F.year(ts), F.month(ts), F.day(ts)) - F.lit(start)
    elif calendar == "360_day":
        number = F.year(ts).cast("long") * 360 + (F.month(ts) - 1) * 30 + F.day(ts) - 1
        days = F.when(F.day(ts) <= 30, number) - F.lit(year * 360 + (month - 1) * 30 + day - 1)
    elif calendar in ("standard", "gregorian", "proleptic_gregorian"):
        days = F.datediff(F.to_date(ts), F.lit(origin).cast("date")).cast("long")
    else:
        raise ValueError(f"unknown calendar {calendar!r}")
    # One division of whole numbers keeps the result exact to the last bit.
    return (days * F.lit(86400000000) + micros_of_day(ts)).cast("double") / F.lit(float(seconds * 1000000))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once a row, however often ``body`` names it: a Column that is named again is copied."""
    return F.transform(F.array(value), body)[0]


def cf_date(value: Column, units: str = "days since 1850-01-01", calendar: str = "noleap") -> Column:
    """The date of an offset in ``units``, the inverse of :func:`cf_time`: struct of year, month, day and micros since midnight.

    Whole units are counted exactly; of a fraction, what a double holds, to the nearest microsecond. NULL gives NULL.
    """
    seconds, origin = _unit_and_origin(units)
    year, month, day = (int(p) for p in origin.split("-"))
    per_day = F.lit(86400000000)

    def parts(days: Column, rest: Column) -> Column:
        def named(*fields: Column) -> Column:
            return F.struct(*[p.cast("int").alias(n) for p, n in zip(fields, ("year", "month", "day"), strict=True)], rest.alias("micros"))

        if calendar in ("noleap", "365_day"):
            before = F.array(*[F.lit(d) for d in DAYS_BEFORE_MONTH])

            def by_month(y: Column, inside: Column) -> Column:
                number = F.size(F.filter(before, lambda d: d <= inside))
                return _let(number, lambda m: named(y, m, inside - F.element_at(before, m) + 1))

            def by_year(total: Column) -> Column:
                return _let(F.floor(total / 365).cast("long"), lambda y: _let((total - y * 365).cast("int"), lambda inside: by_month(y, inside)))

            return _let(days + F.lit(year * 365 + DAYS_BEFORE_MONTH[month - 1] + day - 1), by_year)
        if calendar == "360_day":
            total = days + F.lit(year * 360 + (month - 1) * 30 + day - 1)
            inside = F.pmod(total, F.lit(360))
            return named(F.floor(total / 360), F.floor(inside / 30) + 1, F.pmod(inside, F.lit(30)) + 1)
        if calendar in ("standard", "gregorian", "proleptic_gregorian"):
            return _let(F.date_add(F.lit(origin).cast("date"), days.cast("int")), lambda date: named(F.year(date), F.month(date), F.day(date)))
        raise ValueError(f"unknown calendar {calendar!r}")

    def of_micros(micros: Column) -> Column:
        # The rest is exact, so the quotient is a whole number that only the division of doubles rounds.
        return _let(F.pmod(micros, per_day), lambda rest: _let(F.rint((micros - rest) / per_day).cast("long"), lambda days: parts(days, rest)))

    def of_value(v: Column) -> Column:
        whole = F.floor(v)
        micros = whole.cast("long") * F.lit(seconds * 1000000) + F.rint((v - whole) * F.lit(float(seconds * 1000000))).cast("long")
        return F.when(v.isNotNull(), _let(micros, of_micros))

    return _let(value, of_value)


# Steps of a frequency in a day, for series that count their steps from the start of year 0 (fixed values).
STEPS_PER_DAY = {"day": 1, "6hr": 4, "3hr": 8, "1hr": 24}


def step_year(index: Column, freq: str, calendar: str = "noleap") -> Column:
    """The year of a step that is counted from the start of year 0 in steps of the frequency."""
    if freq == "yr":
        return index.cast("int")
    if freq == "mon":
        return F.floor(index / 12).cast("int")
    if freq not in STEPS_PER_DAY:
        raise ValueError(f"unknown frequency {freq!r}")
    return cf_date(index.cast("double") / F.lit(float(STEPS_PER_DAY[freq])), "days since 0000-01-01", calendar)["year"]


def encode_time(dtype: str, value: Column, units: str, calendar: str) -> Column:
    """Numbers pass through as double, timestamps are encoded, other types are an error."""
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        return value.cast("double")
    if dtype in ("timestamp", "timestamp_ntz", "date"):
        return cf_time(value.cast("timestamp_ntz"), units, calendar)
    raise TypeError(f"cannot encode type {dtype} as time")


def noleap_year_fraction(ts: Column) -> Column:
    """Year with the day of a 365-day year as its fraction (months counted by the days that have elapsed)."""
    before = F.element_at(F.array(*[F.lit(d) for d in DAYS_BEFORE_MONTH]), F.month(ts))
    return (F.year(ts).cast("long") * 365 + before + F.day(ts)).cast("double") / F.lit(365.0)


def month_index(ts: Column) -> Column:
    """Months counted from year 0, the key of monthly series."""
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("int")


def year_block(year: Column, first: int, step: int) -> Column:
    """First year of the block of ``step`` years that ``year`` falls in."""
    return (F.lit(first) + F.floor((year - F.lit(first)) / F.lit(step)) * F.lit(step)).cast("int")
