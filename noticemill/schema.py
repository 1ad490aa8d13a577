"""Schemas of notices, envelopes and the change log."""

from __future__ import annotations

from pyspark.sql import types as T

NOTICE = T.StructType(
    [
        T.StructField("company", T.StringType()),
        T.StructField("notice_date", T.StringType()),
        T.StructField("effective_date", T.StringType()),
        T.StructField("employees", T.IntegerType()),
        T.StructField("county", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("layoff_type", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("industry", T.StringType()),
    ]
)
#: Keys of a notice: rows that agree in them are one filing.
KEYS = ("company", "effective_date", "county", "city", "layoff_type")

HISTORY_RECORD = T.StructType(
    [
        T.StructField("company", T.StringType()),
        T.StructField("employees", T.LongType()),
        T.StructField("notice_date", T.StringType()),
        T.StructField("effective_date", T.StringType()),
        T.StructField("county", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("layoff_type", T.StringType()),
        T.StructField("fiscal_year", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)
HISTORY_ENVELOPE = T.StructType(
    [
        T.StructField("fiscal_year", T.LongType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("total_employees", T.LongType()),
        T.StructField("records", T.ArrayType(HISTORY_RECORD)),
    ]
)
LATEST_ENVELOPE = T.StructType(
    [
        T.StructField("total_records", T.IntegerType()),
        T.StructField("total_employees", T.LongType()),
        T.StructField("date_range_start", T.StringType()),
        T.StructField("date_range_end", T.StringType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("records", T.ArrayType(NOTICE)),
    ]
)
CHANGE = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("new_count", T.IntegerType()),
        T.StructField("removed_count", T.IntegerType()),
        T.StructField("new_entries", T.ArrayType(NOTICE)),
        T.StructField("removed_entries", T.ArrayType(NOTICE)),
        T.StructField("total_employees_new", T.LongType()),
        T.StructField("total_employees_removed", T.LongType()),
    ]
)
