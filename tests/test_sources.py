import json

from noticemill.sources import cells, envelopes

SHEET = [
    ["Notice Date", "Effective\nDate", "Company", "No. of Employees", "County", "City", "Layoff Type", "Address"],
    ["2026-01-01", "2026-02-01", "Test Company", "100", "Test County", "Test City", "Layoff", "123 Test St"],
    ["2026-01-05", "2026-03-01", "Another Co", "50", "Another County", None, "Closure", "456 Side St"],
    ["2026-01-05", "2026-03-01", "nan", "50", "", "", "", ""],
    ["2026-01-05", "2026-03-01", "Zero", "0", "", "", "", ""],
    ["2026-01-05", "2026-03-01", "Bad", "many", "", "", "", ""],
]


def grid(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "ord long, cells array<string>")


def test_sheet(spark):
    rows = cells.parse_grid(grid(spark, SHEET), "Sheet1").orderBy("ord").collect()
    assert [(r.company, r.employees, r.county, r.city, r.industry) for r in rows] == [
        ("Test Company", 100, "Test County", "Test City", ""),
        ("Another Co", 50, "Another County", "nan", ""),
    ]


def test_detailed_sheet(spark):
    body = [["X County", "1/2/2026", "1/3/2026", "3/4/2026", "Acme", "Layoff", "1,200", "1 Main", "Retail"]]
    header = [["County/Parish", "Notice Date", "Processed", "Effective", "Company", "Layoff/Closure", "No. Of Employees", "Address", "Related Industry"]]
    for rows in ([["Report"]] + header + body, body):
        r = cells.parse_grid(grid(spark, rows), "Detailed WARN Report").first()
        assert (r.company, r.employees, r.notice_date, r.effective_date, r.county, r.city) == ("Acme", 1200, "2026-01-02", "2026-03-04", "X County", "")


def test_empty_sheet(spark):
    assert cells.parse_grid(grid(spark, []), "Sheet1").count() == 0
    assert cells.choose_sheet(["a", "Sheet1"]) == "Sheet1"
    assert cells.choose_sheet(["a", "b"]) == "a"


def test_page_tables(spark):
    header = ["County", "Notice", "Effective", "Company", "Employees", "Address", "Layoff/Closure"]
    rows = [
        (1, 0, header, 1, ["Alameda County", "06/01/2020", "0 6 / 1 8 / 2 0 14", "A&amp;B", "1 2", None, "Layoff"]),
        (1, 0, header, 2, ["x", "x", "x", "Some Company", "5", "x", "x"]),
        (1, 0, header, 3, ["x", "x", "x", "Short", "5"]),
        (1, 0, header, 4, [None, "", "", "No County", "7", "x", "x"]),
        (2, 0, ["a", "b"], 1, ["x", "5"]),
        (3, 0, ["Notice", "Company", "Number"], 1, ["06/01/2020", "First", "9"]),
    ]
    df = spark.createDataFrame(rows, "page int, nth int, header array<string>, ord long, cells array<string>")
    found = {r.company: r for r in cells.parse_page_tables(df, 2014).collect()}
    assert set(found) == {"A&B", "No County", "First"}
    assert (found["A&B"].employees, found["A&B"].effective_date, found["A&B"].notice_date, found["A&B"].address) == (12, "2014-06-18", "2020-06-01", "None")
    assert found["No County"].county == "None" and found["No County"].effective_date is None
    assert found["First"].notice_date is None and found["First"].county == ""


def test_envelopes(spark, tmp_path):
    record = {"company": "A", "employees": 5, "effective_date": "2020-01-01", "fiscal_year": 2014, "source": "pdf"}
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "y.json").write_text(json.dumps({"fiscal_year": 2014, "records": [record, record]}, indent=1))
    assert [r.fiscal_year for r in envelopes.history(spark, str(tmp_path / "h")).collect()] == ["2014", "2014"]
    for name, whole in (("a.json", {"records": [record]}), ("b.json", [record])):
        (tmp_path / name).write_text(json.dumps(whole, indent=1))
        assert [r.company for r in envelopes.latest(spark, str(tmp_path / name)).collect()] == ["A"]
    assert envelopes.latest(spark, str(tmp_path / "missing.json")).count() == 0
    assert len(envelopes.file_hashes(spark, str(tmp_path / "a.json")).first().md5) == 32


def test_log_tail_cuts_before_it_drops(spark):
    lines = [(i, "broken" if i % 2 else json.dumps({"timestamp": str(i), "new_count": i})) for i in range(30)]
    tail = envelopes.log_tail(spark.createDataFrame(lines, "ord long, value string"))
    assert sorted(r.ord for r in tail.collect()) == [20, 22, 24, 26, 28]
