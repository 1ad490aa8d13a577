"""Every query of the library by name; each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import dates, text, values
from .operators import charts, diff, digests, history, kpis, merge, search, text_index
from .oracle import MONTH_RANGE, ORACLE_SQL
from .plans import ingest
from .schema import NOTICE
from .sinks import runs, scratch, store
from .sources import cells, envelopes, lines, star
from .sources import words as words_source
from .streaming import changes, windows

FIELDS = [f.name for f in NOTICE]


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.normalise(star.raw_notices(spark, sf_dir))


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_duplicates(clean(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even filings as history, odd ones as the live set."""
    rows = clean(spark, sf_dir)
    year = values.fiscal_start(values.as_date(F.col("effective_date"))).cast("string")
    past = rows.where(F.col("filing") % 2 == 0).select("company", "employees", "effective_date", "county", year.alias("fiscal_year"), F.lit("pdf").alias("source"))
    live = rows.where(F.col("filing") % 2 == 1).select("company", "employees", "effective_date", "county", "city", "industry")
    return history.union_sources(past, live)


def snapshots(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] | list[str] = diff.STRICT) -> tuple[DataFrame, DataFrame]:
    """(latest, snapshot), with ``ord`` and ``fields``: each lacks a tenth of the filings that the other has.  Notices are cleaned once for both."""
    rows = scratch.stored(clean(spark, sf_dir).select("ord", "filing", *fields))
    return rows.where(F.col("filing") % 10 != 1).drop("filing"), rows.where(F.col("filing") % 10 != 0).drop("filing")


# Cells of sheets and page tables made from the raw notices, in the ways that extractors give them.
NAMED_HEADER = ["Notice Date", "Effective Date", "Company", "No. Of\nEmployees", "County/Parish", "City", "Layoff/Closure Type", "Address", "Related Industry"]
NAMED_FIELDS = ["notice_date", "effective_date", "company", "employees", "county", "city", "layoff_type", "address", "industry"]
PAGE_TABLES = (
    (["County", "Notice Date", "Effective Date", "Company", "No. Of Employees", "Address", "Layoff/Closure"],
     ["county", "notice_date", "effective_date", "company", "employees", "address", "layoff_type"]),
    (["Received Date", "Employer", "Laid Off", "Effective", "Parish", "Address", "Type"],
     ["notice_date", "company", "employees", "effective_date", "county", "address", "layoff_type"]),
)


def _any_format(date: Column) -> Column:
    """The date in one of the six formats of spreadsheets, by filing."""
    day = values.as_date(date)
    formats = F.array(*[F.date_format(day, f) for f in values.SHEET_FORMATS])
    return F.get(formats, (F.col("filing") % len(values.SHEET_FORMATS)).cast("int"))


def _spaced(date: Column) -> Column:
    """The date as page tables have it: two digits a year and blanks between all characters; other texts as they are."""
    day = values.as_date(date).cast("string")
    spaced = [F.lit(c) if c == "/" else F.substring(day, c, 1) for c in (6, 7, "/", 9, 10, "/", 3, 4)]
    return F.coalesce(F.concat(*[part for c in spaced for part in (c, F.lit(" "))]), date)


def _sheet(sheet: str, fields: list[str | None], top: list[tuple[str, list[str]]]) -> Callable[[SparkSession, str], DataFrame]:
    """Notices of a grid with the rows ``top`` (ord, cells) before all others; None is a column without meaning."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = star.raw_notices(spark, sf_dir).withColumn("notice_date", _any_format(F.col("notice_date")))
        grid = raw.select("ord", F.array(*[F.col(f) if f else F.lit("-") for f in fields]).alias("cells"))
        if top:
            grid = grid.unionByName(spark.createDataFrame(top, "ord string, cells array<string>"))
        return cells.parse_grid(scratch.stored(grid), sheet)  # a sheet is read for its header first

    return run


def _by_layout(layout: Column, each: Callable[[list[str], list[str]], list]) -> Column:
    """An array for each row, made from header and fields of its layout."""
    return reduce(lambda out, k: out.when(layout == k, F.array(*each(*PAGE_TABLES[k]))), range(len(PAGE_TABLES)), F)


def page_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of page tables of two layouts; one has its notice dates in the first cell, where they are not read."""
    raw = star.raw_notices(spark, sf_dir)
    raw = raw.withColumns({c: _spaced(F.col(c)) for c in ("notice_date", "effective_date")})
    # both layouts from one reading of the notices
    page = F.pmod("filing", F.lit(len(PAGE_TABLES))).cast("int")
    header = _by_layout(page, lambda header, _: [F.lit(h) for h in header])
    tables = raw.select(page.alias("page"), F.lit(0).alias("nth"), header.alias("header"), "ord", _by_layout(page, lambda _, fields: fields).alias("cells"))
    return cells.parse_page_tables(tables, 2014).drop("page", "nth")


def _older_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.raw_notices(spark, sf_dir).select("ord", "filing", "company", "effective_date", "employees")


def legacy_sheet_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet of the newer of the older layouts: headers come again, and one brand is spelled in several ways."""
    spelled = F.concat(F.get(F.array(*[F.lit(b) for b in text.LEGACY_BRAND]), (F.col("filing") % 3).cast("int")), F.lit(" "), F.col("company"))
    company = F.when(F.col("filing") % 41 == 0, F.lit("Company")).when(F.col("filing") % 37 == 0, spelled).otherwise(F.col("company"))
    rows = _older_raw(spark, sf_dir).withColumn("company", company)
    return merge.merge_by_company(cells.legacy_notices(cells.without_trailer(rows), newer=True))


def legacy_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sheets of an older workbook together, each without its own last rows."""
    rows = _older_raw(spark, sf_dir).withColumn("sheet", F.col("filing") % 3)
    return merge.merge_by_company(cells.legacy_notices(cells.without_trailer(rows, sheet="sheet")))


#: Spellings of dates by order, as patterns; None is a spreadsheet's serial number.
DATE_PATTERNS = (
    "yyyy-MM-dd", "M/d/yyyy", "d MMM yyyy", "MMMM d, yyyy", "EEEE, MMMM d, yyyy", "dd-MMM-yy", "yyyyMMdd", "yyyy/M/d h:mm a", "MM.dd.yyyy",
    "d'th of' MMMM, yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'", "MMM. d 'yy", None,
)


def date_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date of every order, read back from one of many spellings."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    serial = F.datediff("day", F.lit(dates.EPOCH).cast("date")).cast("string")
    spelled = F.array(*[F.date_format(F.col("day").cast("timestamp"), p.replace("'yy", "''yy") if p.endswith(" 'yy") else p) if p else serial for p in DATE_PATTERNS])
    spelled = F.get(spelled, (F.col("o_orderkey") % len(DATE_PATTERNS)).cast("int"))
    return orders.select("o_orderkey", values.sheet_date(spelled).alias("day"))


def placed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of pages of which only the words and their places are known.

    Rows are set out on pages, each of one layout: cells wrap after a few words, and every word is a little off its place.
    """
    raw = star.raw_notices(spark, sf_dir)
    raw = raw.withColumns({c: _spaced(F.col(c)) for c in ("notice_date", "effective_date")})
    pages = max(1, -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // 100))
    layout = F.pmod("filing", F.lit(len(PAGE_TABLES)))
    page = 2 * F.pmod(F.xxhash64("ord"), F.lit(pages)) + layout
    rows = raw.select(page.alias("page"), "ord", _by_layout(layout, lambda _, fields: fields).alias("cells"))
    # rows are sent to their pages, and a page is set out and read where its rows are: words, some thirty a row, are not sent
    rows = rows.repartition(max(-(-pages // 500), spark.sparkContext.defaultParallelism), "page")
    rows = rows.withColumn("row", F.row_number().over(Window.partitionBy("page").orderBy("ord")))
    titles = _by_layout(F.pmod("page", F.lit(len(PAGE_TABLES))), lambda header, _: [F.lit(h.replace(" ", "  ")) for h in header])
    lines = F.when(F.col("row") == 1, F.array(F.struct(F.lit(0).alias("row"), titles.alias("cells")), F.struct("row", "cells"))).otherwise(F.array(F.struct("row", "cells")))
    each = rows.select("page", F.inline(lines)).select("page", "row", F.posexplode("cells").alias("column", "cell"))
    # dates hold eight words a line, other cells three
    each = each.withColumn("wide", F.when(F.col("cell").rlike("^[0-9/ ]+$"), 8).otherwise(3))
    words = each.select("page", "row", "column", "wide", F.posexplode(F.array_remove(F.split(F.trim("cell"), r"\s+"), "")).alias("at", "word"))
    off = lambda seed: F.pmod(F.xxhash64("page", "row", "column", "at", F.lit(seed)), F.lit(100)) / 100
    x0 = 600 * F.col("column") + F.col("at") % F.col("wide") * F.when(F.col("wide") == 8, 12).otherwise(150) + 2 * off(1)
    top = 90 * F.col("row") + 12 * F.floor(F.col("at") / F.col("wide")) + off(2)
    words = words.select("page", x0.alias("x0"), top.alias("top"), "word").select("page", "x0", (F.col("x0") + 5 * F.char_length("word")).alias("x1"), "top", (F.col("top") + 10).alias("bottom"), "word")
    return cells.parse_page_tables(words_source.tables(words), 2014).drop("page", "nth", "ord")


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged filings and monthly sums after two files of a hundred have changed and one has gone."""
    source, folder = scratch.folder(spark), scratch.folder(spark)
    raw = star.raw_notices(spark, sf_dir, F.col("l_orderkey") % 100).withColumn("file", F.col("filing") % 100)
    lines_of = lambda rows, at: rows.drop("filing").write.partitionBy("file").option("compression", "gzip").json(at)
    lines_of(raw, source)
    ingest.ingest(spark, source, folder)
    for k in (3, 7, 20):
        scratch.remove(spark, f"{source}/file={k}")
    changed = raw.where(((F.col("file") == 3) & (F.col("filing") % 200 == 3)) | (F.col("file") == 20))
    lines_of(changed.withColumn("employees", F.when(F.col("file") == 20, F.lit("1,000")).otherwise(F.col("employees"))), f"{source}/again")
    ingest.ingest(spark, source, folder)
    scratch.remove(spark, source)
    found = ingest.merged(spark, folder)
    by_month = ingest.months(spark, folder).select(F.col("month").alias("effective_date"), "employees", F.lit("month").alias("company"))
    return found.unionByName(by_month, allowMissingColumns=True)


def legacy_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = star.raw_notices(spark, sf_dir).select("ord", "company", "effective_date", "employees")
    return merge.merge_by_company(cells.legacy_notices(cells.without_trailer(raw)))


def _change(with_snapshot: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        new, baseline = snapshots(spark, sf_dir, FIELDS)
        entry = diff.change_entry(new, baseline if with_snapshot else None, "run", FIELDS)
        sums = ["timestamp", "new_count", "removed_count", "total_employees_new", "total_employees_removed"]
        if not with_snapshot:
            return entry.select(*sums)
        listed = [F.size("new_entries").alias("new_listed"), F.size("removed_entries").alias("removed_listed")]
        return entry.select(*sums, *listed, F.array_join("new_entries.company", "|").alias("new_companies"))

    return run


def _of_notices(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(notices(spark, sf_dir))


def _of_records(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(records(spark, sf_dir))


def _strict(side: int) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: diff.strict(*snapshots(spark, sf_dir))[side].select("ord", "company", "effective_date", "employees")


def _casefold(side: int, only: Callable[[DataFrame], DataFrame] = lambda x: x) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: only(diff.casefold(*snapshots(spark, sf_dir))[side]).select("first_ord", "company", "employees")


def _no_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = clean(spark, sf_dir).where(F.col("filing") % 10 != 1).select("ord", *FIELDS)
    return diff.strict(latest, spark.createDataFrame([], NOTICE))[0].select("ord", "company", "effective_date", "employees")


def successive(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] | list[str]) -> list[DataFrame]:
    """Three snapshots, one after another, each without another tenth of the filings.  Notices are cleaned once for all."""
    rows = scratch.stored(clean(spark, sf_dir).select("filing", *fields))
    return [rows.where(F.col("filing") % 10 != k).drop("filing") for k in range(3)]


def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes between successive snapshots, followed by a stream that stops after the second and goes on with the third."""
    feeds, folder = scratch.folder(spark), scratch.folder(spark)
    buckets = max(1, -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // changes.BUCKET_KEYS))
    for k, rows in enumerate(successive(spark, sf_dir, diff.STRICT), 1):
        changes.feed(rows, k, buckets).write.parquet(f"{feeds}/taken-{k}")
        if k > 1:
            found = changes.follow(spark, feeds, folder)
    scratch.remove(spark, feeds)
    return changes.added_and_removed(found)


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change line and totals of each of three runs; an attempt that was never committed leaves no trace."""
    folder, before = scratch.folder(spark), None
    for k, rows in enumerate(successive(spark, sf_dir, ["ord", *FIELDS]), 1):
        base = runs.head(spark, folder)
        entry = diff.change_entry(rows, store.read_snapshot(spark, folder, before) if before else None, f"at {k}", FIELDS)
        totals = store.payload(rows, f"at {k}")
        runs.write(folder, {"totals": totals, "changes": entry})  # a run that stopped here
        store.write_run(spark, folder, f"run {k}", rows, totals, entry, base)
        before = f"run {k}"
    log = store.read_log(spark, folder).select("run_id", "new_count", "removed_count", "total_employees_new", "total_employees_removed")
    return log.join(store.read_totals(spark, folder).select("run_id", "total_records", "total_employees"), "run_id")


def _log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = F.col("event_id")
    line = F.to_json(
        F.struct(
            F.concat(F.lit("run "), n.cast("string")).alias("timestamp"),
            (n % 5).cast("int").alias("new_count"),
            (n % 7).alias("total_employees_new"),
        )
    )
    return events.select(n.alias("ord"), F.when(n % 4 == 0, F.lit("{broken")).otherwise(line).alias("value"))


def _log_file(spark: SparkSession, sf_dir: str) -> str:
    """The change log as text files, in its order."""
    folder = scratch.folder(spark)
    _log_lines(spark, sf_dir).repartitionByRange(8, "ord").sortWithinPartitions("ord").select("value").write.text(folder)
    return folder


def _tail(log: DataFrame) -> DataFrame:
    return envelopes.log_tail(log).select("ord", "timestamp", "new_count", "total_employees_new")


def changelog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines that can be read of a log in text files, with their numbers."""
    return envelopes.log_entries(lines.numbered(spark, _log_file(spark, sf_dir))).select("ord", "timestamp", "new_count")


def _page(filters: search.Filters, order: Callable[[], list], number: int, size: int) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = search.cells(notices(spark, sf_dir)).where(filters.condition())
        return search.page(rows, order(), number, size).select(*search.CELLS)

    return run


def indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several texts looked for with one index."""
    index = text_index.build(search.cells(notices(spark, sf_dir)), scratch.folder(spark))
    found = [text_index.search(spark, index, field, wanted).select(F.lit(wanted).alias("wanted"), *search.CELLS) for field, wanted in INDEXED]
    return reduce(DataFrame.unionByName, found)


#: Fields and texts of the search with an index: three letters and more, fewer, several words, and none that occurs.
INDEXED = (("any_text", "NATION_1"), ("company", "labs"), ("company", "x "), ("any_text", "77"), ("company", "000001 & Labs"), ("any_text", "nowhere at all"))
#: Months that have a column in the matrix of counties and months.
MONTHS = charts.months_between(*MONTH_RANGE)
SEARCH = search.Filters(company="Labs", kind="Layoff Permanent", notice_from="1996-01-01", notice_to="1999-12-31")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "notices_clean": lambda spark, sf_dir: clean(spark, sf_dir).select("ord", *FIELDS),
    "sheet_named": _sheet("Sheet1", NAMED_FIELDS, [("", NAMED_HEADER)]),
    "sheet_detailed": _sheet(
        "Detailed WARN Report", [None, *NAMED_FIELDS], [("", ["Report", "of all notices"]), (" ", ["#", *(h.replace("No. Of\n", "") for h in NAMED_HEADER)])]
    ),
    "sheet_positions": _sheet(
        "Detailed WARN Report", ["county", "notice_date", None, "effective_date", "company", "layoff_type", "employees", "address", "industry"], []
    ),
    "page_tables": page_tables,
    "placed_words": placed_words,
    "incremental_ingest": incremental_ingest,
    "legacy_sheet": legacy_sheet,
    "legacy_sheet_newer": legacy_sheet_newer,
    "legacy_sheets": legacy_sheets,
    "date_spellings": date_spellings,
    "change_entry": _change(True),
    "change_entry_no_snapshot": _change(False),
    "merge_duplicates": notices,
    "legacy_merge": lambda spark, sf_dir: merge.merge_by_company(clean(spark, sf_dir)),
    "payload_totals": _of_notices(merge.payload_totals),
    "company_groups": _of_notices(lambda n: charts.typed(n).select("company", "company_clean").distinct()),
    "county_forms": _of_notices(
        lambda n: n.select("county", text.county_short(F.col("county")).alias("short"), text.county_label(F.col("county")).alias("label")).distinct()
    ),
    "timeline": _of_notices(charts.timeline),
    "monthly_ma3": _of_notices(charts.monthly_ma3),
    "daily_rolling30": _of_notices(charts.daily_rolling30),
    "top_companies": _of_notices(charts.top_companies),
    "county_month_long": _of_notices(charts.county_month),
    "county_month_pivot": _of_notices(lambda n: charts.county_month_pivot(n, MONTHS)),
    "treemap_leaves": _of_notices(charts.treemap_leaves),
    "treemap_parents": _of_notices(charts.treemap_parents),
    "sector_breakdown": _of_notices(charts.sector_breakdown),
    "lead_time_stats": _of_notices(charts.lead_time_stats),
    "lead_time_hist": _of_notices(charts.lead_time_hist),
    "county_top10": _of_notices(charts.county_top),
    "union_sources": _of_records(lambda r: r.select("company", "employees", "effective_date", "county", "city", "industry", "fiscal_year", "source")),
    "union_totals": _of_records(history.grand_totals),
    "fiscal_year_summary": _of_records(lambda r: history.fiscal_year_summary(r, list(range(1993, 2004)))),
    "year_over_year": _of_records(lambda r: history.year_over_year(r, list(range(1993, 2004)))),
    "multiyear_month": _of_records(history.multiyear_month),
    "month_lines": _of_records(history.month_lines),
    "kpi_avg_lead": _of_notices(kpis.average_lead),
    "kpi_largest": _of_notices(kpis.largest),
    "kpi_top_county": _of_notices(kpis.top_county),
    "recent_notices": _of_notices(lambda n: search.page(search.cells(n), search.newest_first(), size=0).select(*search.CELLS)),
    "notice_search_page": _page(SEARCH, search.newest_first, 2, 50),
    "any_text_search": _of_notices(lambda n: search.cells(n).where(search.Filters(any_text="NATION_1").condition()).select(*search.CELLS)),
    "js_sort_page": _page(search.Filters(), lambda: search.by_cell("notice"), 3, 100),
    "notice_last_page": _page(search.Filters(), search.newest_first, 10**9, 100),
    "js_sort_far_page": _page(search.Filters(), lambda: search.by_cell("company", descending=True), 400, 100),
    "indexed_search": indexed_search,
    "filter_options": _of_notices(search.options),
    "diff_strict_added": _strict(0),
    "diff_strict_removed": _strict(1),
    "diff_no_snapshot": _no_snapshot,
    "diff_casefold_added": _casefold(0),
    "diff_casefold_removed": _casefold(1),
    "diff_largest_added": _casefold(0, diff.largest),
    "diff_totals": lambda spark, sf_dir: diff.totals(*snapshots(spark, sf_dir)),
    "digest_casefold_added": lambda spark, sf_dir: digests.casefold(*snapshots(spark, sf_dir))[0].select("first_ord", "company", "employees"),
    "digest_casefold_removed": lambda spark, sf_dir: digests.casefold(*snapshots(spark, sf_dir))[1].select("first_ord", "company", "employees"),
    "digest_totals": lambda spark, sf_dir: digests.totals(*snapshots(spark, sf_dir)),
    "stream_changes": stream_changes,
    "run_history": run_history,
    "changelog_tail": lambda spark, sf_dir: _tail(_log_lines(spark, sf_dir)),
    "changelog_lines": changelog_lines,
    "changelog_file_tail": lambda spark, sf_dir: _tail(lines.last(spark, _log_file(spark, sf_dir))),
    "stream_closed_days": lambda spark, sf_dir: windows.closed_days(spark, f"{sf_dir}/events.parquet"),
    "stream_event_days": lambda spark, sf_dir: windows.event_days(spark, f"{sf_dir}/events.parquet"),
}

__all__ = ["ORACLE_SQL", "QUERIES"]
