"""Inputs and outputs that are known from published charts."""

import datetime

from noticemill.operators import charts, history

MONTHS = {
    "2025-01": (140, 140.0), "2025-02": (2, 71.0), "2025-06": (78, 73.33333333333333), "2025-07": (2075, 718.3333333333334),
    "2025-08": (1273, 1142.0), "2025-09": (6754, 3367.3333333333335), "2025-10": (7160, 5062.333333333333), "2025-11": (6733, 6882.333333333333),
    "2025-12": (7054, 6982.333333333333), "2026-01": (6720, 6835.666666666667), "2026-02": (2587, 5453.666666666667),
}
LEAD = "0:67 1:4 2:2 3:4 4:14 5:2 6:1 8:9 12:1 14:5 15:2 18:1 19:6 22:1 23:1 24:1 26:8 27:2 28:8 29:2 30:1 31:4 33:2 34:2 35:3 36:1 37:3 39:3 40:1 41:9 45:1 46:8 47:5 48:5 49:13 50:10 52:4 53:13 54:12 55:2 56:3 57:2 58:4 59:23 60:150 61:116 62:139 63:100 64:23 65:22 66:12 67:41 68:10 69:5 70:12 71:15 72:5 73:4 74:2 75:1 76:5 78:5 80:3 83:1 85:4 89:22 90:63 91:2 92:1 93:1 95:1 96:2 98:1 99:2 100:5 101:1 103:2 112:1 115:1 116:1 118:2 129:1 149:1 161:2 184:1 234:1 275:1 309:2 346:1"
TYPES = {
    "Closure Temporary": ([393, 773, 324, 54, 447], 532.2345554997489),
    "Layoff Not known at this time": ([200], 200.0),
    "Layoff Temporary": ([914, 263, 394, 330], 614.7822198842714),
}


def notices(spark, rows):
    names = "company string, notice_date string, effective_date string, employees int, county string, city string, layoff_type string, address string, industry string, ord string"
    return spark.createDataFrame([(c, n, e, k, "X County", "", t, "", "", f"{i:06}") for i, (c, n, e, k, t) in enumerate(rows)], names)


def test_months(spark):
    df = notices(spark, [("A", None, f"{m}-15", e, "") for m, (e, _) in MONTHS.items()])
    assert [(r.month, r.employees, r.ma3) for r in charts.monthly_ma3(df).orderBy("month").collect()] == [(m, e, round(a, 6)) for m, (e, a) in MONTHS.items()]


def test_lead_time(spark):
    start, rows = datetime.date(2025, 1, 1), []
    for d, n in (map(int, x.split(":")) for x in LEAD.split()):
        rows += [("A", str(start), str(start + datetime.timedelta(d)), 1, "")] * n
    r = charts.lead_time_stats(notices(spark, rows)).first()
    assert (r.notices, r.median_days, r.at_least_60) == (1068, 61, round(74.25093632958801, 6))


def test_treemap(spark):
    rows = [(f"{t}{i}", None, "2025-01-01", v, t) for t, (values, _) in TYPES.items() for i, v in enumerate(values)]
    found = {r.layoff_type: (r.employees, r.colour) for r in charts.treemap_parents(notices(spark, rows)).collect()}
    assert found == {t: (sum(v), round(c, 6)) for t, (v, c) in TYPES.items()}


def test_years(spark):
    rows = [("A", None, "0 6 / 1 8 / 2 0 14", 5, ""), ("B", None, "2016-05-01", 150, ""), ("C", None, "2016-07-02", 32, "")]
    df = notices(spark, rows)
    plain = {(r.year, r.month): (r.employees, r.is_current) for r in history.multiyear_month(df).collect()}
    assert plain == {(2016, 5): (150, True), (2016, 7): (32, True)}
    assert {r.year for r in history.multiyear_month(df, compact=True).collect()} == {2014, 2016}


def test_year_summary(spark):
    past = notices(spark, [("A", None, "2014-08-01", 5, "")]).selectExpr("company", "employees", "'2014' fiscal_year", "'pdf' source")
    live = notices(spark, [("B", None, "2025-08-01", 7, "")]).select("company", "employees")
    rows = history.fiscal_year_summary(history.union_sources(past, live), [2014, 2015]).collect()
    assert {(r.fiscal_year, r.label, r.records, r.employees) for r in rows} == {
        ("2014", "FY 2014-15", 1, 5), ("2015", "FY 2015-16", 0, 0), ("current", "FY 2025-26 (Live)", 1, 7)
    }


def test_empty(spark):
    df = notices(spark, [("A", None, None, 5, None)]).where("false")
    for chart in (charts.timeline, charts.monthly_ma3, charts.daily_rolling30, charts.top_companies, charts.county_month, lambda n: charts.county_month_pivot(n, ["2025-01"]),
                  charts.treemap_parents, charts.sector_breakdown, charts.lead_time_stats, charts.lead_time_hist, charts.county_top):
        assert chart(df).count() == 0
