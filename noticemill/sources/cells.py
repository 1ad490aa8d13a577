"""Spreadsheet grids and page tables, after extraction, as notices.

Extractors give rows of cells with their place (``ord``).  Headers are read on the driver, which resolves them to cell numbers;
everything else is a projection.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, values
from ..schema import NOTICE

SHEET_FIELDS = [f.name for f in NOTICE]
# Sheets that are preferred, and the cells of a detailed sheet without a header.
PREFERRED_SHEETS = ("Sheet1", "Detailed WARN Report ", "Detailed WARN Report")
POSITIONS = {"county": 0, "notice_date": 1, "effective_date": 3, "company": 4, "layoff_type": 5, "employees": 6, "address": 7, "industry": 8}


def choose_sheet(names: Iterable[str]) -> str:
    names = list(names)
    return next((n for n in PREFERRED_SHEETS if n in names), names[0])


# Header keywords by field; all words of one of the groups must occur, and the first field that fits takes the column.
NAMED_SHEET = (
    ("notice_date", (("notice", "date"),)),
    ("effective_date", (("effective", "date"),)),
    ("company", (("company",),)),
    ("employees", (("no", "employee"),)),
    ("county", (("county",),)),
    ("city", (("city",),)),
    ("layoff_type", (("layoff",), ("warn",), ("type",))),
    ("address", (("address",),)),
    ("industry", (("industry",),)),
)
DETAILED_SHEET = tuple((f, {"effective_date": (("effective",),), "employees": (("employ",),)}.get(f, w)) for f, w in NAMED_SHEET)
PAGE_TABLE = (
    ("county", (("county",), ("parish",))),
    ("notice", (("notice",), ("received",))),
    ("effective", (("effective",),)),
    ("company", (("company",), ("employer",))),
    ("employees", (("employee",), ("no.",), ("number",), ("laid",))),
    ("address", (("address",),)),
    ("type", (("layoff",), ("closure",), ("type",))),
    ("industry", (("industry",),)),
)


def resolve(headers: Iterable[object], rules: tuple, last_wins: bool = True) -> dict[str, int]:
    """Cell number of each field; of several columns the last (or first) wins."""
    found: dict[str, int] = {}
    for i, header in enumerate(headers):
        name = str(header).lower().replace("\n", " ").strip()
        field = next((f for f, groups in rules if any(all(w in name for w in g) for g in groups)), None)
        if field and (last_wins or field not in found):
            found[field] = i
    return found


def header(grid: DataFrame, named: bool = False) -> tuple:
    """Place and cells of the first row, or of the first with a cell that contains ``company``; (None, None) if there is none."""
    rows = grid.where(F.exists("cells", lambda c: F.lower(c).contains("company"))) if named else grid
    found = rows.where(F.col("ord").isNotNull()).orderBy("ord").select("ord", "cells").first()
    return (found.ord, found.cells) if found else (None, None)


def _cell(found: dict[str, int], field: str) -> Column:
    return F.get("cells", found[field]) if field in found else F.lit(None).cast("string")


def normalise(rows: DataFrame, keep_missing: bool = True) -> DataFrame:
    """Raw text columns by field name as typed notices, with ``ord`` and any further columns kept.

    Rows without a company or a number of employees above 0 go.  A missing cell of a text column reads ``nan``, as it always
    has; without ``keep_missing`` it stays null.
    """
    raw = F.coalesce(F.col("company"), F.lit("nan"))
    # decided before the names are cleaned: no entity or inner white space can turn another name into one of these
    named = ~F.lower(text.strip(raw)).isin("company", "nan", "")
    rows = rows.where((values.headcount(F.col("employees")) > 0) & named)
    missing = F.lit("nan") if keep_missing else F.lit(None).cast("string")
    plain = {c: text.strip_cell(F.coalesce(F.col(c), missing)) for c in ("county", "city", "layoff_type", "address", "industry")}
    return rows.withColumns(
        {
            "company": text.fix_company(raw),
            "notice_date": values.sheet_date(F.col("notice_date")),
            "effective_date": values.sheet_date(F.col("effective_date")),
            "employees": values.headcount(F.col("employees")),
            **plain,
        }
    )


def parse_grid(grid: DataFrame, sheet: str) -> DataFrame:
    """Notices of a grid (ord, cells array<string>); an empty grid gives an empty result.

    A modern sheet has its header in its first row.  A detailed sheet has it where a cell names a company; without one, the
    fields have fixed places.  The grid is read for its header and again for its rows.
    """
    at, headers = header(grid, named=sheet != "Sheet1")
    found = resolve(headers or [], NAMED_SHEET if sheet == "Sheet1" else DETAILED_SHEET) or (POSITIONS if sheet != "Sheet1" else {})
    body = grid.where(F.col("ord") > at) if at is not None else grid
    fields = {f: _cell(found, f) if f in found else F.lit("" if f in ("county", "city", "layoff_type", "address", "industry") else None) for f in SHEET_FIELDS}
    return normalise(body.select("ord", *[c.cast("string").alias(f) for f, c in fields.items()])).select("ord", *SHEET_FIELDS)


def without_trailer(grid: DataFrame, n: int = 2, sheet: str | None = None) -> DataFrame:
    """A grid (ord, ...) without its last ``n`` rows, which older sheets fill with sums and notes; with ``sheet``, without those of each.

    The place of the last rows is found by ``n`` aggregates, one row a sheet, so that no sheet is sorted.
    """
    by = [F.col(sheet)] if sheet else []
    rest = grid
    for _ in range(n):
        last = rest.groupBy(*by).agg(F.max("ord").alias("_last"))
        if sheet:
            last = last.withColumnRenamed(sheet, "_sheet")
        same = F.col(sheet).eqNullSafe(F.col("_sheet")) if sheet else F.lit(True)
        rest = rest.join(F.broadcast(last), same).where(F.col("ord") < F.col("_last")).drop("_last", "_sheet")
    return rest


def legacy_notices(rows: DataFrame, newer: bool = False) -> DataFrame:
    """Raw text columns company, effective_date and employees of an older sheet: names joined at right quotes, rows of whole numbers.

    The ``newer`` layout repeats its header, whose rows go, and spells one brand in several ways.  Sheets in several tables come as
    rows with a further column, which stays.
    """
    if newer:
        rows = rows.where(~F.coalesce(F.col("company").contains("Company"), F.lit(False)))
    named = rows.withColumns({"company": text.fix_company_legacy(F.col("company"), brand=newer), "employees": values.headcount(F.col("employees"))})
    return named.where(F.col("employees") > 0)


def parse_page_tables(tables: DataFrame, year: int) -> DataFrame:
    """Notices of page tables (page, nth, header array<string>, ord, cells array<string>) of one fiscal year.

    Headers differ from table to table, so that each table's cell numbers are computed beside its rows.  Names that contain
    ``company`` are repeated headers.  A notice date in the first cell is not read.
    """

    def field_of(name: Column) -> Column:
        """The first field that a cell of the header fits, by its name."""
        out = F
        for field, groups in PAGE_TABLE:
            out = out.when(reduce(lambda a, b: a | b, [name.contains(word) for (word,) in groups]), F.lit(field))
        return out.otherwise(F.lit(""))

    # a header's cells are told apart once a row, and so are names and numbers: a generated column is not computed again where it is used
    fields = [f for f, _ in PAGE_TABLE]
    names = F.transform(F.transform("header", lambda h: F.lower(F.coalesce(h, F.lit("none")))), field_of)
    placed = tables.select("*", F.explode(F.array(names)).alias("_fields"))
    placed = placed.select("*", F.inline(F.array(F.struct(*[(F.array_position("_fields", F.lit(f)).cast("int") - 1).alias(f"_{f}") for f in fields]))))
    most = F.greatest(*[F.col(f"_{f}") for f in fields])
    usable = placed.where((F.col("_company") >= 0) & (F.col("_employees") >= 0) & (F.size("cells") > most))
    cell = lambda f: F.get("cells", F.col(f"_{f}"))
    read = F.struct(text.fix_company_pdf(F.col("_name")).alias("company"), values.headcount(F.col("_number"), inner_blanks=True).alias("employees"))
    rows = usable.withColumns({"_name": cell("company"), "_number": cell("employees")}).select("*", F.inline(F.array(read)))
    rows = rows.where((F.trim("company") != "") & ~F.lower("company").contains("company") & (F.col("employees") >= 1))
    given = {"notice": F.when(F.col("_notice") > 0, cell("notice")), "effective": F.when(F.col("_effective") >= 0, cell("effective"))}
    given |= {f: F.when(F.col(f"_{f}") >= 0, F.coalesce(cell(f), F.lit("None"))).otherwise(F.lit("")) for f in ("county", "address", "type")}
    rows = rows.select("page", "nth", "ord", "company", "employees", F.inline(F.array(F.struct(*[c.alias(f"_{f}") for f, c in given.items()]))))
    return rows.select(
        "page",
        "nth",
        "ord",
        "company",
        "employees",
        values.page_date(F.col("_notice")).alias("notice_date"),
        values.page_date(F.col("_effective")).alias("effective_date"),
        *[text.strip_cell(F.col(f"_{f}")).alias(name) for f, name in (("county", "county"), ("address", "address"), ("type", "layoff_type"))],
        F.lit(year).cast("string").alias("fiscal_year"),
        F.lit("pdf").alias("source"),
    )
