"""Dates in any usual spelling as Column expressions: words, numbers and signs are told apart, then put in order.

Read are: years first or last, with two or four digits; months as numbers or by name, in any place; ordinals; a weekday; a time of
day with or without AM, PM and zone; year and month or a year alone, which mean the first day; eight digits; serial numbers of
spreadsheets.  Of two numbers before the year the month comes first, unless only the other can be a month.  A text with any
other word, or one that names no day of the calendar, is no date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months and weekdays.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
# Two-digit years from here on are of the last century.
PIVOT = 69
#: Serial numbers that count as dates (1954 to 2119) and the day that they count from.
SERIALS, EPOCH = (20_000, 80_000), "1899-12-30"

_TIME = r"\s*\b([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d([.,]\d+)?)?\s*([ap]\.?m\b\.?)?\s*(z\b|utc\b|gmt\b|[+-]\d{2}:?\d{2}\b)?|\b(1[0-2]|0?[1-9])\s*[ap]\.?m\b\.?"
_DAYS = rf"\b({'|'.join(f'{d[:3]}({d[3:]})?' for d in WEEKDAYS)}|tues|thur|thurs)\b\.?"
_MONTH = rf"^({'|'.join(f'{m[:3]}({m[3:]})?' for m in MONTHS if m != 'may')}|may|sept)$"


def _plain(x: Column) -> Column:
    """Lower case, without time, weekday, endings of ordinals and filling words."""
    text = F.lower(F.trim(x))
    text = F.regexp_replace(text, r"(?<=\d)t(?=\d{1,2}:)", " ")
    text = F.regexp_replace(text, _TIME, " ")
    text = F.regexp_replace(text, _DAYS, " ")
    text = F.regexp_replace(text, r"\b(\d{1,2})(st|nd|rd|th)\b", "$1")
    return F.trim(F.regexp_replace(text, r"\b(of|the|at|on)\b", " "))


def _year(n: Column) -> Column:
    short = n.try_cast("int")
    century = F.when(short >= PIVOT, F.lit(1900)).otherwise(F.lit(2000))
    return F.when(F.length(n) == 4, short).when(F.length(n) <= 2, century + short)


def _day(year: Column, month: Column, day: Column) -> Column:
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    named = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), two(month), two(day)).try_cast("date")
    return F.when(year.between(1, 9999) & month.between(1, 12) & day.between(1, 31), named)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _of_parts(numbers: Column, month: Column, named: Column) -> Column:
    """The date of a text's numbers, with the month if it is ``named``."""
    n = lambda i: F.get(numbers, F.lit(i))
    number = lambda i: n(i).try_cast("int")
    long = lambda i: F.length(n(i)) == 4
    one, count = F.lit(1), F.size(numbers)
    with_name = (
        F.when((count == 2) & (long(0) | (number(0) > 31)), F.struct(_year(n(0)), month, number(1)))
        .when(count == 2, F.struct(_year(n(1)), month, number(0)))
        .when((count == 1) & long(0), F.struct(number(0), month, one))
    )
    day_first, short = (number(0) > 12) & (number(1) <= 12), F.length(n(0)) <= 2
    eight = F.length(n(0)) == 8
    part = lambda i, k: F.substring(n(0), i, k).try_cast("int")
    numeric = (
        F.when((count == 3) & long(0), F.struct(number(0), number(1), number(2)))
        .when((count == 3) & short & day_first, F.struct(_year(n(2)), number(1), number(0)))
        .when((count == 3) & short, F.struct(_year(n(2)), number(0), number(1)))
        .when((count == 2) & long(0), F.struct(number(0), number(1), one))
        .when((count == 2) & long(1), F.struct(number(1), number(0), one))
        .when((count == 1) & eight, F.struct(part(1, 4), part(5, 2), part(7, 2)))
        .when((count == 1) & long(0) & number(0).between(1900, 2100), F.struct(number(0), one, one))
    )
    of = lambda parts: parts.cast("struct<y: int, m: int, d: int>")
    return _let(F.when(named, of(with_name)).otherwise(of(numeric)), lambda p: _day(p["y"], p["m"], p["d"]))


def _of_text(text: Column) -> Column:
    """The date of a text in lower case, without time and weekday."""
    words = F.regexp_extract_all(text, F.lit(r"([a-z]+)"), 1)
    numbers = F.regexp_extract_all(text, F.lit(r"(\d+)"), 1)
    month = lambda w: F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.substring(F.get(w, F.lit(0)), 1, 3)).cast("int")
    clean = text.rlike(r"^[a-z0-9\s,./'\-]+$")
    # numbers with signs between them, never a sign without a number behind it
    digits = text.rlike(r"^'?\d+([\s,./\-]+'?\d+)*$") & ~text.rlike(r"^\d+\.\d+$")
    found = lambda w: _let(numbers, lambda n: _let((F.size(w) == 1) & F.get(w, F.lit(0)).rlike(_MONTH), lambda named: F.when(named | digits, _of_parts(n, month(w), named))))
    return F.when(clean, _let(words, found))


def any_date(x: Column) -> Column:
    """The date that a text names, as a date; null for other texts."""
    serial = F.trim(x).try_cast("double")
    counted = F.when(serial.between(*SERIALS), F.date_add(F.lit(EPOCH).cast("date"), F.floor(serial).cast("int")))
    return F.coalesce(counted, _let(_plain(x), _of_text))
