"""Several years: union of sources, fiscal years, months across years."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values

LIVE_LABEL = "FY 2025-26 (Live)"


def union_sources(history: DataFrame, live: DataFrame) -> DataFrame:
    """History and live notices in one table; the live ones are of the fiscal year ``current``."""
    tagged = live.withColumns({"fiscal_year": F.lit("current"), "source": F.lit("xlsx")})
    return history.withColumn("employees", F.col("employees").cast("long")).unionByName(
        tagged.withColumn("employees", F.col("employees").cast("long")), allowMissingColumns=True
    )


def fiscal_year_summary(records: DataFrame, years: list[int], live_label: str = LIVE_LABEL) -> DataFrame:
    """Records and employees of every year of the catalogue, in order, and of the live set if there is one."""
    spark = records.sparkSession
    named = [(str(y), None, "pdf") for y in years] + [("current", live_label, "xlsx")]
    catalogue = spark.createDataFrame(named, "fiscal_year string, label string, source string")
    catalogue = catalogue.withColumn("label", F.coalesce("label", values.fiscal_label(F.col("fiscal_year").try_cast("int"))))
    each = records.groupBy("fiscal_year").agg(F.count("*").alias("records"), F.sum("employees").cast("long").alias("employees"))
    # few rows: one a year
    whole = F.broadcast(catalogue).join(each, "fiscal_year", "left").where((F.col("fiscal_year") != "current") | F.col("records").isNotNull())
    zero = F.lit(0).cast("long")
    columns = ["fiscal_year", "label", F.coalesce("records", zero).alias("records"), F.coalesce("employees", zero).alias("employees"), "source"]
    return whole.select(*columns).orderBy("fiscal_year")


def year_over_year(records: DataFrame, years: list[int], live_label: str = LIVE_LABEL) -> DataFrame:
    """Employees of every year, and the number of notices of the live set; page tables repeat notices, so theirs says nothing."""
    each = fiscal_year_summary(records, years, live_label)
    notices = F.when(F.col("source") == "xlsx", F.col("records")).alias("notices")
    return each.select("fiscal_year", "label", "source", "employees", notices).orderBy("fiscal_year")


def grand_totals(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("total_records"), F.coalesce(F.sum("employees"), F.lit(0)).cast("long").alias("total_employees"))


def multiyear_month(records: DataFrame, compact: bool = False) -> DataFrame:
    """Employees by year and month, and whether the year is the last.

    Dates that are stored unparsed drop out, as they always have; ``compact`` reads dates with blanks inside as well.
    """
    day = values.as_date(values.page_date(F.col("effective_date")) if compact else F.col("effective_date"))
    dated = records.withColumn("_day", day).where(F.col("_day").isNotNull())
    each = dated.groupBy(F.year("_day").alias("year"), F.month("_day").alias("month")).agg(F.sum(F.coalesce("employees", F.lit(0))).cast("long").alias("employees"))
    return each.withColumn("is_current", F.col("year") == F.max("year").over(Window.partitionBy()))


def month_lines(records: DataFrame, compact: bool = False) -> DataFrame:
    """``multiyear_month`` as it is drawn: years as texts, months by their short names, in order."""
    each = multiyear_month(records, compact).orderBy("year", "month")
    return each.select(F.col("year").cast("string").alias("line"), "month", values.month_label(F.col("month")).alias("label"), "employees", "is_current")
