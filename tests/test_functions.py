import datetime

import pytest
from pyspark.sql import functions as F

from noticemill.functions import sectors, text, values


@pytest.mark.parametrize(
    ("function", "given", "expected"),
    [
        (text.fix_company, "Test &amp; Co", "Test & Co"),
        (text.fix_company, "Juul Labs", "Juul Labs, Inc."),
        (text.fix_company, "  Trim  ", "Trim"),
        (text.fix_company, " Trim ", "Trim"),
        (text.fix_company, "Julia Co", "Juul Labs, Inc."),
        (text.fix_company, "A&amp;nbsp;B", "A B"),
        (text.fix_company, "Joe&RSQUO;s   Shop", "Joe's Shop"),
        (text.fix_company_pdf, "A&nbsp;B", "A&nbsp;B"),
        (text.fix_company_pdf, None, "None"),
        (text.fix_company_legacy, "A&rsquo;B&rsquo;C", "A'C"),
        (text.company_group, "Amazon LAX 35", "Amazon"),
        (text.company_group, "Acme (12)", "Acme"),
        (text.company_group, "Hotel San Diego", "Hotel"),
        (text.company_group, "Foo Ontario Mills", "Foo"),
        (text.company_group, "Bay Club San Francisco", "Bay Club"),
        (text.company_group, "Bay Club Thousand Oaks", "Bay Club Thousand"),
        (text.company_group, "amazon web", "amazon web"),
        (text.county_short, "Los Angeles County", "Los Angeles"),
        (text.county_short, "County Line Parish ", "County Line"),
        (text.county_label, "Los Angeles County Parish", "Los Angeles"),
        (text.escape, "<a & b>", "&lt;a & b&gt;"),
        (text.thousands, "1234", "1,234"),
        (text.thousands, "invalid", "invalid"),
        (text.number_first, "3M", 3.0),
        (text.number_first, "2024-05-01", 2024.0),
        (text.number_first, "x1", None),
        (values.headcount, "100", 100),
        (values.headcount, "1,200", 1200),
        (values.headcount, "12.9", 12),
        (values.headcount, "-12.9", -12),
        (values.headcount, "invalid", None),
        (values.headcount, "NaN", None),
        (values.headcount, "inf", None),
        (values.headcount, "99999999999", None),
        (values.sheet_date, "2026-04-08", "2026-04-08"),
        (values.sheet_date, "4/8/2026", "2026-04-08"),
        (values.sheet_date, "2026-04-08 00:00:00", "2026-04-08"),
        (values.sheet_date, "TBD", "TBD"),
        (values.sheet_date, None, None),
        (values.page_date, "0 6 / 1 8 / 2 0 14", "2014-06-18"),
        (values.page_date, "06/18/75", "1975-06-18"),
        (values.page_date, "06/18/14", "2014-06-18"),
        (values.page_date, "06-18-2014", "2014-06-18"),
        (values.page_date, "soon er", "sooner"),
        (values.page_date, "nan", None),
        (values.as_date, "bad", None),
        (values.as_date, "2020-02-29", datetime.date(2020, 2, 29)),
    ],
)
def test_scalar(one, function, given, expected):
    assert one(function, given) == expected


def test_juul_with_boundary(one):
    assert one(lambda x: text.fix_company(x, word_boundary=True), "Julia Co") == "Julia Co"
    assert one(lambda x: text.fix_company(x, word_boundary=True), "JUUL labs") == "Juul Labs, Inc."


def test_page_headcount(one):
    assert one(lambda x: values.headcount(x, inner_blanks=True), "1 2 3") == 123


def test_labels(one):
    assert one(lambda x: values.fiscal_label(x.cast("int")), "2014") == "FY 2014-15"
    assert one(lambda x: text.signed(x.cast("int")), "1200") == "+1,200"
    assert one(lambda x: text.signed(x.cast("int")), "-5") == "-5"
    assert one(lambda x: text.plural(x.cast("int"), "notice"), "1") == "notice"


@pytest.mark.parametrize(
    ("industry", "company", "expected"),
    [
        ("Information Services", "x", "Technology"),
        ("nan", "Acme AI", "Other"),
        ("", "Scale ai Lab", "Technology"),
        (None, "Kids Care", "Healthcare"),
        ("56 Administrative and Support and Waste Management", "x", "56 Administrative and Support and Waste "),
        (" ", "Motor House", "Manufacturing"),
    ],
)
def test_sector(spark, industry, company, expected):
    df = spark.createDataFrame([(industry, company)], "i string, c string")
    assert df.select(sectors.sector(F.col("i"), F.col("c")).alias("s")).first().s == expected
