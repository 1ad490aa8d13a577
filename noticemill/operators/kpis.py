"""Headline indicators.  Each is one row; without data, texts read N/A."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, values


def average_lead(notices: DataFrame) -> DataFrame:
    """Mean days of notice between 1 and 729, rounded half to even, as ``Nd``."""
    days = notices.select(values.iso_days(F.col("notice_date"), F.col("effective_date")).alias("d")).where((F.col("d") > 0) & (F.col("d") < 730))
    mean = F.bround(F.avg("d"), 0).cast("long")
    return days.agg(F.coalesce(F.concat(mean.cast("string"), F.lit("d")), F.lit("N/A")).alias("avg_lead_days"))


def largest(notices: DataFrame) -> DataFrame:
    """The notice with most employees; the first of equals."""
    row = F.min_by(F.struct("company", "employees"), F.struct((-F.col("employees")).alias("a"), F.col("ord").alias("b")))
    return notices.agg(row.alias("r")).select(
        F.coalesce("r.company", F.lit("N/A")).alias("company"), F.coalesce(text.thousands(F.col("r.employees")), F.lit("N/A")).alias("employees")
    )


def top_county(notices: DataFrame) -> DataFrame:
    """The county with most employees, as it is written; the one that comes first of equals."""
    each = notices.withColumn("county", text.strip(F.coalesce(F.col("county"), F.lit("")))).where(F.col("county") != "")
    sums = each.groupBy("county").agg(F.sum("employees").cast("long").alias("employees"), F.min("ord").alias("ord"))
    best = sums.orderBy(F.desc("employees"), "ord").limit(1).agg(F.first("county").alias("c"), F.first("employees").alias("e"))
    return best.select(F.coalesce("c", F.lit("N/A")).alias("county"), F.coalesce(text.thousands(F.col("e")), F.lit("N/A")).alias("employees"))
