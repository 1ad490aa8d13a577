"""The table of notices: cells, filters, sorting, pages."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from . import positions
from .positions import Key

CELLS = ("company", "county", "employees", "notice", "effective", "type", "industry")
PAGE_SIZES = (50, 100, 150, 200, 0)
#: Rows that may be sorted off the top for a page.
NEAR = 20_000


def cells(notices: DataFrame) -> DataFrame:
    """Display cells of every notice, with ``ord`` and the number of employees for sorting."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return notices.select(
        text.escape(blank("company")).alias("company"),
        text.county_label(blank("county")).alias("county"),
        text.thousands(F.col("employees")).alias("employees"),
        F.substring(blank("notice_date"), 1, 10).alias("notice"),
        F.substring(blank("effective_date"), 1, 10).alias("effective"),
        blank("layoff_type").alias("type"),
        blank("industry").alias("industry"),
        F.col("employees").alias("headcount"),
        "ord",
    )


@dataclass(frozen=True)
class Filters:
    """Blank values do not filter.  Rows without a notice date pass both ends of a range."""

    company: str = ""
    any_text: str = ""
    county: str = ""
    industry: str = ""
    kind: str = ""
    notice_from: str = ""
    notice_to: str = ""

    def condition(self) -> Column:
        found = []
        if self.company:
            found.append(F.lower("company").contains(self.company.lower()))
        if self.any_text:
            found.append(F.lower(F.concat_ws(" ", *CELLS)).contains(self.any_text.lower()))
        for name, value in (("county", self.county), ("industry", self.industry), ("type", self.kind)):
            if value:
                found.append(F.col(name) == value)
        if self.notice_from:
            found.append((F.col("notice") == "") | (F.col("notice") >= self.notice_from))
        if self.notice_to:
            found.append((F.col("notice") == "") | (F.col("notice") <= self.notice_to))
        return reduce(lambda a, b: a & b, found, F.lit(True))


def newest_first() -> list[Key]:
    return [Key(F.col("notice"), descending=True), Key(F.col("ord"))]


def by_cell(name: str, descending: bool = False) -> list[Key]:
    """A browser's sort: cells that begin with a number first, by number (dates, that is, by year); then texts."""
    number, word = text.number_first(F.col(name)), F.lower(name)
    return [Key(number, descending), Key(word, descending), Key(F.col("ord"))]


def page(rows: DataFrame, order: list[Key], number: int = 1, size: int = PAGE_SIZES[0]) -> DataFrame:
    """Rows of a page; size 0 is everything.  A page beyond the last is the last, one before the first is the first.

    Near pages are cut off the top of the rows.  Pages that begin beyond ``NEAR`` rows are found by counts of ranges, at a cost that does
    not depend on the page.
    """
    sorting = [k.sorted() for k in order]
    if not size:
        return rows.orderBy(*sorting)
    at = max(1, number)
    if at * size > NEAR:
        return positions.page(rows, order, at, size)
    # the rows up to the page asked for tell how many pages there are, as far as it matters
    top = rows.orderBy(*sorting).limit(at * size)
    placed = top.select("*", F.row_number().over(Window.orderBy(*sorting)).alias("_place"), F.count("*").over(Window.partitionBy()).alias("_rows"))
    page_at = F.least(F.lit(at), F.greatest(F.lit(1), F.ceil(F.col("_rows") / size)))
    return placed.where((F.col("_place") > (page_at - 1) * size) & (F.col("_place") <= page_at * size)).drop("_place", "_rows")


def options(notices: DataFrame) -> DataFrame:
    """Values of the filters: kind and value, in their order."""
    given = lambda c: F.coalesce(F.col(c), F.lit(""))
    values = {"county": text.county_label(given("county")), "industry": text.strip(given("industry")), "type": text.strip(given("layoff_type"))}
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in values.items()])
    return notices.select(F.inline(pairs)).where(F.col("value") != "").distinct().orderBy("kind", "value")
