"""Dates: several formats, shifting in columns and in text, ages, clock hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import replace_each


def two_digit_year(year: Column) -> Column:
    """69-99 lie in the last century."""
    n = year.try_cast("int")
    return F.when(F.length(year) == 2, n + F.when(n >= 69, 1900).otherwise(2000)).otherwise(n)


def parse_date(text: Column) -> Column:
    """M/D/Y with two or four digits of year, or Y-M-D; null where none fits."""
    slash, iso = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})\s*$", r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})\s*$"
    s = lambda i: F.regexp_extract(text, slash, i)
    d = lambda i: F.regexp_extract(text, iso, i)
    shown = F.when(text.rlike(slash), F.concat_ws("-", F.lpad(two_digit_year(s(3)).cast("string"), 4, "0"), F.lpad(s(1), 2, "0"), F.lpad(s(2), 2, "0"))).when(
        text.rlike(iso), F.concat_ws("-", d(1), F.lpad(d(2), 2, "0"), F.lpad(d(3), 2, "0"))
    )
    return shown.try_cast("date")


def shift_date_text(text: Column, days: Column) -> Column:
    """One date text shifted in its format; M/D keeps its form; anything else stays."""
    date = parse_date(text)
    full = F.when(text.rlike("/"), F.date_format(F.date_add(date, days), "MM/dd/yyyy")).otherwise(F.date_format(F.date_add(date, days), "yyyy-MM-dd"))
    short = r"^\s*(\d{1,2})/(\d{1,2})\s*$"
    day = F.concat(F.lit("2024-"), F.lpad(F.regexp_extract(text, short, 1), 2, "0"), F.lit("-"), F.lpad(F.regexp_extract(text, short, 2), 2, "0")).try_cast("date")
    return F.coalesce(full, F.when(text.rlike(short), F.date_format(F.date_add(day, days), "MM/dd")), text)


def shift_dates_in_text(text: Column, days: Column) -> Column:
    """All M/D/Y and Y-M-D dates of the text shifted, once."""
    return replace_each(text, r"\b\d{1,2}/\d{1,2}/\d{2,4}\b|\b\d{4}-\d{2}-\d{2}\b", lambda m: shift_date_text(m, days))


def shift_dotted_dates(text: Column, days: Column) -> Column:
    """MM.DD.YYYY, else DD.MM.YYYY, of years after 2000."""

    def fresh(m: Column) -> Column:
        a, b, y = F.substring(m, 1, 2), F.substring(m, 4, 2), F.substring(m, 7, 4)
        first, second = F.concat_ws("-", y, a, b).try_cast("date"), F.concat_ws("-", y, b, a).try_cast("date")
        shown = F.coalesce(F.date_format(F.date_add(first, days), "MM.dd.yyyy"), F.date_format(F.date_add(second, days), "dd.MM.yyyy"))
        return F.when(y.cast("int") > 2000, F.coalesce(shown, m)).otherwise(m)

    return replace_each(text, r"\b\d{2}\.\d{2}\.\d{4}\b", fresh)


def age_years(born: Column, at: Column) -> Column:
    """Years to one decimal, null outside 0-120 (both exclusive)."""
    age = F.bround(F.datediff(at, born) / F.lit(365.25), 1)
    return F.when((age > 0) & (age < 120), age)


def top_coded(age: Column, most: float = 90.0) -> Column:
    return F.when(age.isNotNull(), F.least(age, F.lit(most)))


def clock_hour(text: Column) -> Column:
    """'h:mm AM' to 0-23, null where unreadable."""
    pattern = r"(?i)^\s*(\d{1,2}):\d{2}\s*(AM|PM)"
    hour = F.regexp_extract(text, pattern, 1).try_cast("int")
    return hour % 12 + F.when(F.upper(F.regexp_extract(text, pattern, 2)) == "PM", 12).otherwise(0)


def at_offset(start: Column, seconds: Column) -> Column:
    """Start plus relative seconds, in microseconds."""
    return F.timestamp_micros(F.unix_micros(start.cast("timestamp")) + F.round(seconds * 1000000).cast("bigint"))
