"""The reporting datasets.  Every function takes merged notices and returns the rows that a chart shows.

Windows without a partition run over aggregates (months, days, sectors), never over notices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sectors, text, values
from ..sinks import scratch

TOP_COMPANIES, TOP_COUNTIES, TOP_TREEMAP, TOP_COUNTY_BAR = 25, 20, 80, 10


def typed(notices: DataFrame) -> DataFrame:
    """Dates as dates (null where a text is none), employees without nulls, and the grouped company name."""
    return notices.withColumns(
        {
            "effective_on": values.as_date(F.col("effective_date")),
            "notice_on": values.as_date(F.col("notice_date")),
            "employees": F.coalesce(F.col("employees"), F.lit(0)).cast("long"),
            "company_clean": text.company_group(F.coalesce(F.col("company"), F.lit("None"))),
        }
    )


def _dated(notices: DataFrame) -> DataFrame:
    return typed(notices).where(F.col("effective_on").isNotNull())


def _total(name: str = "employees"):
    return F.sum("employees").cast("long").alias(name)


def timeline(notices: DataFrame) -> DataFrame:
    """Dated notices with their hover text, coloured by county, or by company where no notice has a county."""
    hover = F.concat(
        F.lit("<b>"), F.col("company"), F.lit("</b><br>"), F.date_format("effective_on", "MMM dd, yyyy"),
        F.lit("<br>"), F.format_number("employees", 0), F.lit(" employees"),
    )
    # evaluated once with both colours; the first row with a county decides, and the look for it stops there
    kept = scratch.stored(_dated(notices).select("company", "county", "effective_on", "employees", hover.alias("hover")))
    colour = "company" if kept.where(F.trim("county") != "").isEmpty() else "county"
    return kept.select("company", "effective_on", "employees", F.col(colour).alias("colour"), "hover")


def monthly_ma3(notices: DataFrame) -> DataFrame:
    """Employees by month and the mean of up to three months; months without notices do not count."""
    months = _dated(notices).groupBy(values.month_key(F.col("effective_on")).alias("month")).agg(_total())
    window = Window.orderBy("month").rowsBetween(-2, 0)
    return months.select("month", "employees", F.round(F.avg("employees").over(window), 6).alias("ma3"))


def daily_rolling30(notices: DataFrame) -> DataFrame:
    """Every day from the first to the last: employees, mean of 30 days, running total."""
    days = _dated(notices).groupBy(F.col("effective_on").alias("day")).agg(_total())
    ends = days.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    spine = ends.where(F.col("a").isNotNull()).select(F.explode(F.sequence("a", "b")).alias("day"))
    filled = spine.join(days, "day", "left").select("day", F.coalesce("employees", F.lit(0)).cast("long").alias("employees"))
    window = Window.orderBy("day")
    return filled.select(
        "day",
        "employees",
        F.round(F.avg("employees").over(window.rowsBetween(-29, 0)), 6).alias("rolling30"),
        F.sum("employees").over(window.rowsBetween(Window.unboundedPreceding, 0)).cast("long").alias("cumulative"),
    )


def top_companies(notices: DataFrame, n: int = TOP_COMPANIES) -> DataFrame:
    each = typed(notices).groupBy(F.col("company_clean").alias("company")).agg(_total())
    return each.orderBy(F.desc("employees"), "company").limit(n)


def _with_county(notices: DataFrame) -> DataFrame:
    return notices.where(F.trim("county") != "")


def county_month(notices: DataFrame, n: int = TOP_COUNTIES) -> DataFrame:
    """Employees by county and month, for the counties with most."""
    each = _with_county(_dated(notices)).groupBy("county", values.month_key(F.col("effective_on")).alias("month")).agg(_total())
    months = F.collect_list(F.struct("month", "employees")).alias("months")  # one entry a month
    top = each.groupBy("county").agg(F.sum("employees").alias("total"), months).orderBy(F.desc("total"), "county").limit(n)
    return top.select("county", F.inline("months"))


def months_between(first: str, last: str) -> list[str]:
    """Months as ``yyyy-MM``, both ends included."""
    (a, m), (b, n) = (map(int, x.split("-")) for x in (first, last))
    return [f"{k // 12}-{k % 12 + 1:02d}" for k in range(12 * a + m - 1, 12 * b + n)]


def county_month_pivot(notices: DataFrame, months: list[str], n: int = TOP_COUNTIES) -> DataFrame:
    """The same as a matrix with a column for each of ``months``; a county's month that is not among them stops the query."""
    known = F.col("month").isin(months)
    unknown = F.raise_error(F.concat(F.lit("month without a column: "), "month")).cast("long")
    each = county_month(notices, n).withColumn("employees", F.when(known, F.col("employees")).otherwise(unknown))
    return each.groupBy("county").pivot("month", months).agg(F.sum("employees")).na.fill(0)


def _by_type(notices: DataFrame, n: int) -> DataFrame:
    kind = F.coalesce(F.when(F.col("layoff_type") != "", F.col("layoff_type")), F.lit("Unknown"))
    each = typed(notices).groupBy(kind.alias("layoff_type"), "company").agg(_total())
    kinds = F.collect_list(F.struct("layoff_type", "employees")).alias("kinds")  # one entry a type
    top = each.groupBy("company").agg(F.sum("employees").alias("total"), kinds).orderBy(F.desc("total"), "company").limit(n)
    return top.select("company", F.inline("kinds")).select("layoff_type", "company", "employees")


def treemap_leaves(notices: DataFrame, n: int = TOP_TREEMAP) -> DataFrame:
    return _by_type(notices, n)


def treemap_parents(notices: DataFrame, n: int = TOP_TREEMAP) -> DataFrame:
    """Sum of each type, and the mean of its leaves weighted by themselves."""
    colour = F.sum(F.col("employees") * F.col("employees")) / F.sum("employees")
    return _by_type(notices, n).groupBy("layoff_type").agg(_total(), F.round(colour, 6).alias("colour"))


def sector_breakdown(notices: DataFrame) -> DataFrame:
    # keywords are looked for once in each industry, and in each name that has none
    given = F.nullif(text.strip(F.coalesce("industry", F.lit(""))), F.lit(""))
    names = typed(notices).groupBy(given.alias("industry"), F.when(sectors.is_given(given), F.lit("")).otherwise(F.col("company_clean")).alias("name")).agg(_total())
    each = names.groupBy(sectors.sector(F.col("industry"), F.col("name")).alias("sector")).agg(_total())
    share = F.round(100 * F.col("employees") / F.sum("employees").over(Window.partitionBy()), 6)
    return each.withColumn("share", share).orderBy(F.desc("employees"), "sector")


def _lead_days(notices: DataFrame, most: int = 365) -> DataFrame:
    both = typed(notices).where(F.col("notice_on").isNotNull() & F.col("effective_on").isNotNull())
    days = both.select(values.lead_days(F.col("notice_on"), F.col("effective_on")).alias("days"))
    return days.where(F.col("days").between(0, most))


def lead_time_stats(notices: DataFrame) -> DataFrame:
    """Notices, exact median in whole days, mean, and percent of 60 days or more; no row if there is no notice."""
    stats = _lead_days(notices).agg(
        F.count("*").alias("notices"),
        F.floor(F.percentile("days", 0.5)).cast("long").alias("median_days"),
        F.round(F.avg("days"), 6).alias("mean_days"),
        F.round(100 * F.avg((F.col("days") >= 60).cast("int")), 6).alias("at_least_60"),
    )
    return stats.where(F.col("notices") > 0)


def lead_time_hist(notices: DataFrame, width: int = 10) -> DataFrame:
    """Notices by classes of ``width`` days."""
    bucket = (F.floor(F.col("days") / width) * width).cast("int").alias("days_from")
    return _lead_days(notices).groupBy(bucket).agg(F.count("*").alias("notices"))


def county_top(notices: DataFrame, n: int = TOP_COUNTY_BAR) -> DataFrame:
    each = _with_county(typed(notices)).groupBy(text.county_short(F.col("county")).alias("county"))
    return each.agg(_total(), F.count("company").alias("notices")).orderBy(F.desc("employees"), "county").limit(n)
