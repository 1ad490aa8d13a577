"""Duplicates of one filing, and totals of a payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import KEYS


def first_in_order(name: str, order: str = "ord") -> Column:
    """The first value that is not null, by the rows' order."""
    return F.min_by(name, F.when(F.col(name).isNotNull(), F.col(order)))


SORT_KEY = "_hash"


def sort_key(*keys: str | Column) -> Column:
    """A hash of a group's keys, to be grouped by first.

    First texts by order cannot be held in a hash table, so that rows are sorted by group; a number in front decides nearly all
    comparisons, which texts that begin alike do not.
    """
    return F.xxhash64(*keys).alias(SORT_KEY)


def payload_order() -> Column:
    """A merged notice's place in a payload as a text that sorts: by effective date, nulls last, then by the other keys."""
    names = ("effective_date", *[k for k in KEYS if k != "effective_date"])
    return F.concat_ws("\x01", *[F.coalesce(F.col(k), F.lit("\uffff")) for k in names])


def merge_duplicates(rows: DataFrame) -> DataFrame:
    """One row for each filing: employees add up, other fields keep their first value.  Null keys are a key like any other.

    ``ord`` is the place in the payload, which decides ties from here on.  Few rows share a filing: rows are sent as they are and sorted
    once, where adding up before sending would sort them twice and send their ``ord`` with each of the first values.
    """
    merged = rows.withColumn(SORT_KEY, sort_key(*KEYS)).repartition(SORT_KEY).groupBy(SORT_KEY, *KEYS).agg(
        F.sum("employees").cast("long").alias("employees"),
        *[first_in_order(c).alias(c) for c in ("notice_date", "address", "industry")],
    )
    return merged.drop(SORT_KEY).withColumn("ord", payload_order())


def merge_by_company(rows: DataFrame) -> DataFrame:
    """The older merge: by date and company only; ``ord`` is where a pair appeared first."""
    keys = ("effective_date", "company")
    return rows.groupBy(sort_key(*keys), *keys).agg(F.sum("employees").cast("long").alias("employees"), F.min("ord").alias("ord")).drop(SORT_KEY)


def payload_totals(notices: DataFrame) -> DataFrame:
    return notices.agg(
        F.count("*").alias("total_records"),
        F.coalesce(F.sum("employees"), F.lit(0)).cast("long").alias("total_employees"),
        F.min("effective_date").alias("date_range_start"),
        F.max("effective_date").alias("date_range_end"),
    )
