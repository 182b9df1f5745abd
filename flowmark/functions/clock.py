"""Date and time expressions. Times are UTC seconds since 1970 or minutes of the day, as whole numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowmark.schema import PERIOD_HOURS, PERIODS
from flowmark.session import micros


def slot_seconds(ts: Column | str, minutes: int = 15) -> Column:
    """Start of the slot that a timestamp lies in."""
    width = minutes * 60
    return (F.floor(micros(ts) / F.lit(width * 1_000_000)) * width).cast("bigint")


def minute_of_day(seconds: Column) -> Column:
    return (F.pmod(seconds, F.lit(86400)) / 60).cast("int")


def day_number(seconds: Column) -> Column:
    return F.floor(seconds / 86400).cast("bigint")


def weekday_of(seconds: Column) -> Column:
    """Monday is 0."""
    return F.pmod(day_number(seconds) + 3, F.lit(7)).cast("int")


def period_of(minute: Column) -> Column:
    """The period that a minute of the day (taken modulo a day) lies in; windows are half-open and NT wraps."""
    m = F.pmod(minute, F.lit(1440))
    out = F.lit(None).cast("string")
    for name, (a, b) in PERIODS.items():
        inside = (m >= a) & (m < b) if a < b else (m >= a) | (m < b)
        out = F.when(inside, F.lit(name)).otherwise(out)
    return F.when(minute.isNotNull(), out)


def period_hours(period: Column) -> Column:
    out = F.lit(None).cast("double")
    for name, h in PERIOD_HOURS.items():
        out = F.when(period == name, F.lit(h)).otherwise(out)
    return out


def period_window(day: Column, minute: Column) -> Column:
    """Struct (start_s, end_s) of the concrete window that a moment lies in; NT after midnight began the day before."""
    p = period_of(minute)
    start, end = F.lit(None).cast("int"), F.lit(None).cast("int")
    for name, (a, b) in PERIODS.items():
        start, end = F.when(p == name, F.lit(a)).otherwise(start), F.when(p == name, F.lit(b if a < b else b + 1440)).otherwise(end)
    back = F.when((p == "NT") & (minute < PERIODS["NT"][1]), 1440).otherwise(0)
    return F.struct(((day * 1440 + start - back) * 60).alias("start_s"), ((day * 1440 + end - back) * 60).alias("end_s"))


def touched_periods(t0: Column, t3: Column, step: int = 15) -> Column:
    """Semicolon list of the periods touched from t0 to t3 (minutes), in order of first touch."""
    return F.array_join(F.array_distinct(F.transform(F.sequence(t0, F.greatest(t0, t3), F.lit(step)), period_of)), ";")


def clock_of_column(name: Column) -> Column:
    """Minute of the day in a column name such as spd_mph_07:35; null if there is none."""
    hh, mm = F.regexp_extract(name, r"(\d{2}):(\d{2})$", 1), F.regexp_extract(name, r"(\d{2}):(\d{2})$", 2)
    return F.when(hh != "", hh.try_cast("int") * 60 + mm.try_cast("int"))


def window_text(text: Column) -> Column:
    """Struct (start, end, hours) of a window written HHMM_HHMM; the end may lie past midnight."""
    part = lambda i: F.regexp_extract(text, r"^(\d{2})(\d{2})_(\d{2})(\d{2})$", i).try_cast("int")
    a, b = part(1) * 60 + part(2), part(3) * 60 + part(4)
    return F.struct(a.alias("start"), b.alias("end"), (F.pmod(b - a - 1, F.lit(1440)) + 1).cast("double").alias("minutes"))


def in_window(minute: Column, start: Column, end: Column) -> Column:
    """Whether a minute lies in a half-open window that may wrap midnight."""
    return F.when(start < end, (minute >= start) & (minute < end)).otherwise((minute >= start) | (minute < end))


def truncated_at_midnight(start: Column, end: Column) -> Column:
    """Hours of a window that is cut at midnight (a night window counts to 24:00 only)."""
    return F.when(end > start, end - start).otherwise(1440 - start) / 60.0
