import datetime

import pytest
from pyspark.sql import functions as F

from noticemill.functions import dates, values

SPELLINGS = [
    ("2024-01-05", "2024-01-05"), ("2024/01/05", "2024-01-05"), ("2024.1.5", "2024-01-05"), ("2024 01 05", "2024-01-05"), ("20240105", "2024-01-05"),
    ("1/5/2024", "2024-01-05"), ("01/05/2024", "2024-01-05"), ("1-5-2024", "2024-01-05"), ("01.05.2024", "2024-01-05"), ("1/5/24", "2024-01-05"),
    ("01-05-24", "2024-01-05"), ("1.5.24", "2024-01-05"), ("1/5/'24", "2024-01-05"), ("1/5/69", "1969-01-05"), ("1/5/68", "2068-01-05"), ("12/31/99", "1999-12-31"),
    ("13/1/2024", "2024-01-13"), ("31.12.2023", "2023-12-31"), ("25/12/23", "2023-12-25"), ("12/25/23", "2023-12-25"),
    ("Jan 5, 2024", "2024-01-05"), ("January 5, 2024", "2024-01-05"), ("january 5 2024", "2024-01-05"), ("JANUARY 5TH, 2024", "2024-01-05"), ("5 January 2024", "2024-01-05"),
    ("5 Jan 24", "2024-01-05"), ("5-Jan-24", "2024-01-05"), ("05-Jan-2024", "2024-01-05"), ("Jan-05-2024", "2024-01-05"), ("2024 January 5", "2024-01-05"),
    ("2024-Jan-05", "2024-01-05"), ("the 5th of January 2024", "2024-01-05"), ("1st March 2023", "2023-03-01"), ("March 2nd, 2023", "2023-03-02"), ("3rd Mar. 2023", "2023-03-03"),
    ("Sept 9, 2020", "2020-09-09"), ("Sep. 9, 2020", "2020-09-09"), ("September 9, '20", "2020-09-09"), ("May 1, 2020", "2020-05-01"), ("1may2020", "2020-05-01"),
    ("Friday, January 5, 2024", "2024-01-05"), ("Fri Jan 5 2024", "2024-01-05"), ("Tues, 2 Jan 2024", "2024-01-02"), ("Thurs. 4 January 2024", "2024-01-04"),
    ("2024-01-05 13:45", "2024-01-05"), ("2024-01-05 13:45:10", "2024-01-05"), ("2024-01-05T13:45:10", "2024-01-05"), ("2024-01-05T13:45:10Z", "2024-01-05"),
    ("2024-01-05T13:45:10.250+02:00", "2024-01-05"), ("1/5/2024 1:45 PM", "2024-01-05"), ("1/5/2024 1:45:10 p.m.", "2024-01-05"), ("1/5/2024 12:00 AM", "2024-01-05"),
    ("Jan 5, 2024 at 9:30 am", "2024-01-05"), ("9:30 AM, January 5, 2024", "2024-01-05"), ("January 5, 2024 3pm", "2024-01-05"), ("2024-01-05 00:00:00 UTC", "2024-01-05"),
    ("Jan 2024", "2024-01-01"), ("January, 2024", "2024-01-01"), ("2024-03", "2024-03-01"), ("3/2024", "2024-03-01"), ("2024", "2024-01-01"),
    ("45296", "2024-01-05"), ("45296.75", "2024-01-05"), ("36526", "2000-01-01"), ("  1/5/2024  ", "2024-01-05"), ("February 29, 2024", "2024-02-29"),
]
OTHERS = [
    None, "", "TBD", "n/a", "nan", "None", "2/30/2024", "February 29, 2023", "13/13/2024", "2024-13-01", "32 Jan 2024", "Phase 2", "Phase 2 of 2024", "1/5", "Jan 5",
    "March", "5", "123", "100000", "12.5", "1/2/3/4", "1/5/2024 and 1/6/2024", "5 January March 2024", "Q1 2024", "1//", "-", "2024-01-05x", "Room 12, 2024", "0/5/2024", "99999999",
]


def test_spellings(spark):
    assert len(SPELLINGS) >= 60
    rows = spark.createDataFrame([*SPELLINGS, *[(t, None) for t in OTHERS]], "t string, e string")
    got = rows.select("t", "e", dates.any_date(F.col("t")).cast("string").alias("g")).collect()
    assert [(r.t, r.g) for r in got] == [(r.t, r.e) for r in got]


def test_sheet_dates_keep_what_is_no_date(one):
    assert one(values.sheet_date, "5-Jan-24") == "2024-01-05"
    assert one(values.sheet_date, "to be announced in 2024") == "to be announced in 2024"
    assert one(values.sheet_date, None) is None


@pytest.mark.parametrize("pattern", ["yyyy-MM-dd", "M/d/yyyy", "d MMMM yyyy", "MMM d, yyyy", "EEEE, MMMM d, yyyy", "yyyyMMdd", "dd-MMM-yyyy h:mm a"])
def test_every_day_of_a_year(spark, pattern):
    days = spark.range(366).select(F.date_add(F.lit(datetime.date(2020, 1, 1)), F.col("id").cast("int")).alias("d"))
    assert days.where(~dates.any_date(F.date_format(F.col("d").cast("timestamp"), pattern)).eqNullSafe(F.col("d"))).count() == 0


def test_month_labels(one):
    assert one(lambda x: values.month_label(x.cast("int")), "9") == "Sep"
    assert one(lambda x: values.month_label(x.cast("int")), "13") is None
