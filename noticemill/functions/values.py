"""Numbers and dates in cells as Column expressions.  ANSI mode is on, so that every cast is a ``try_``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dates

# Date formats that spreadsheets use.
SHEET_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "M-d-yyyy", "MMM d, yyyy", "MMMM d, yyyy")


def headcount(x: Column, inner_blanks: bool = False) -> Column:
    """A whole number: no commas, fractions cut off; null for anything else, infinity included."""
    text = F.replace(x.cast("string"), F.lit(","), F.lit(""))
    if inner_blanks:
        text = F.replace(text, F.lit(" "), F.lit(""))
    number = F.trim(text).try_cast("double")
    return F.when(F.abs(number) < 2147483648.0, number.try_cast("int"))


def _parsed(x: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.to_date(F.try_to_timestamp(x, F.lit(f))) for f in formats])


def sheet_date(x: Column) -> Column:
    """A cell's date, in any usual spelling, as ISO text; a text that is no date stays as it is."""
    text = F.trim(x.cast("string"))
    iso = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & text.try_cast("date").isNotNull()
    # a text without digits is no date, and most dates are ISO already
    other = F.when(text.rlike("[0-9]"), F.date_format(dates.any_date(text), "yyyy-MM-dd"))
    return F.when(iso, text).otherwise(F.coalesce(other, x.cast("string")))


def page_date(x: Column) -> Column:
    """A page table's date as ISO text: blanks inside are artefacts; what no format reads stays, without blanks."""
    # nearly all dates are two digits each, which are read by their places; each pattern costs more than all of that
    plain = F.replace(x, F.lit(" "), F.lit(""))
    year = F.substring(plain, 7, 2)
    named = F.concat(F.when(year >= "69", F.lit("19")).otherwise(F.lit("20")), year, F.lit("-"), F.substring(plain, 1, 2), F.lit("-"), F.substring(plain, 4, 2))
    iso = named.try_cast("date").cast("string")
    usual = (F.substring(plain, 3, 1) == "/") & (F.substring(plain, 6, 1) == "/") & (F.length(plain) == 8) & (iso == named)
    # as a function of an element, the long way stays out of the code of the short one, which is compiled only while it is small
    return F.when(usual, iso).otherwise(F.get(F.transform(F.array(x), _other_page_date), F.lit(0)))


def _other_page_date(x: Column) -> Column:
    text = F.regexp_replace(x, r"(?U)\s+", "")
    short = F.regexp_extract(text, r"^(\d{1,2}/\d{1,2}/)(\d{2})$", 2)
    century = F.when(short.try_cast("int") >= 69, F.lit("19")).otherwise(F.lit("20"))
    full = F.when(short != "", F.concat(F.regexp_extract(text, r"^(\d{1,2}/\d{1,2}/)(\d{2})$", 1), century, short)).otherwise(text)
    iso = F.when(x.rlike("[0-9]"), F.date_format(_parsed(full, ("M/d/yyyy", "yyyy-MM-dd", "M-d-yyyy")), "yyyy-MM-dd"))
    missing = x.isNull() | F.trim(x).isin("", "nan", "None")
    return F.when(~missing, F.coalesce(iso, text))


def as_date(x: Column) -> Column:
    """The date of an ISO text; null for other texts."""
    return x.try_cast("date")


def lead_days(notice: Column, effective: Column) -> Column:
    return F.datediff(effective, notice)


def iso_days(notice: Column, effective: Column) -> Column:
    """Days between two ISO texts of ten characters; null otherwise."""
    n, e = F.substring(notice, 1, 10), F.substring(effective, 1, 10)
    return F.when((F.length(n) == 10) & (F.length(e) == 10), F.datediff(as_date(e), as_date(n)))


def month_label(month: Column) -> Column:
    """The short name of a month's number."""
    names = F.array(*[F.lit(m[:3].capitalize()) for m in dates.MONTHS])
    return F.when(month.between(1, 12), F.element_at(names, F.greatest(F.lit(1), F.least(F.lit(12), month)).cast("int")))


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def fiscal_start(d: Column) -> Column:
    """Year in which the fiscal year of a date begins, on the first of July."""
    return F.year(d) - F.when(F.month(d) < 7, 1).otherwise(0)


def fiscal_label(year: Column) -> Column:
    return F.concat(F.lit("FY "), year.cast("string"), F.lit("-"), F.right((year + 1).cast("string"), F.lit(2)))
