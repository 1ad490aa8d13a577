"""Incremental ingestion, placed words, workbooks and the HTML message."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from noticemill.operators import merge
from noticemill.plans import ingest
from noticemill.sinks import report, runs
from noticemill.sources import cells, words, workbooks
from noticemill.functions import values

from .test_operators import notices


def rows(rnd, file, n=30, companies=400):
    return [
        {"ord": f"{file:03}-{i:03}", "company": f"Co {file} {rnd.randrange(companies)}", "effective_date": rnd.choice(["2025-01-05", "2025-02-05", "TBD"]), "employees": str(rnd.randrange(1, 9)), "notice_date": rnd.choice([None, "2024-12-01", "2024-12-02"]), "county": "X County", "address": rnd.choice([None, "1 Main"])}
        for i in range(n)
    ]


def put(folder, file, content):
    (folder / f"f {file:03}.json").write_text("".join(json.dumps({k: v for k, v in r.items() if v is not None}) + "\n" for r in content))


def full(spark, folder):
    """Filings and months of all files, parsed and merged at once."""
    merged = merge.merge_duplicates(cells.normalise(ingest.json_lines(None, spark, [str(folder)])))
    month = values.month_key(values.as_date(F.col("effective_date")))
    months = merged.groupBy(month.alias("month")).agg(F.sum("employees").alias("employees")).where("month is not null")
    return told(merged), sorted(map(tuple, months.collect()))


def told(merged):
    columns = sorted(c for c in merged.columns if c != "ord")
    return sorted(merged.select(*columns).collect(), key=str)


def now(spark, folder):
    return told(ingest.merged(spark, folder)), sorted(map(tuple, ingest.months(spark, folder).collect()))


def test_an_ingestion_follows_the_change(spark, tmp_path):
    rnd, source, folder = random.Random(1), tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    files = {k: rows(rnd, k) for k in range(100)}
    shared = {**files[0][0], "ord": "100-000", "employees": "50", "notice_date": "2024-11-11"}
    files[50] = [*files[50], shared]  # a filing of two files
    for k, content in files.items():
        put(source, k, content)
    first = ingest.ingest(spark, str(source), folder)
    assert (first.version, first.changed_files, first.parsed_files) == (1, 100, 100) and now(spark, folder) == full(spark, source)
    assert ingest.ingest(spark, str(source), folder).version is None

    put(source, 50, files[50][1:-1])  # the shared filing's other part goes, and a row
    second = ingest.ingest(spark, str(source), folder)
    assert (second.changed_files, second.parsed_files, second.shared_files) == (1, 1, 1)
    assert second.rows_read <= 0.04 * 3000 and now(spark, folder) == full(spark, source)

    (source / "f 007.json").unlink()
    (source / "f 008.json").rename(source / "f 208.json")  # known content under another name
    (source / "f 009.json").write_text("")  # as good as gone
    put(source, 300, [{**r, "ord": "300" + r["ord"]} for r in files[10]])
    third = ingest.ingest(spark, str(source), folder)
    assert (third.version, third.changed_files, third.parsed_files) == (3, 5, 1) and now(spark, folder) == full(spark, source)

    for path in source.glob("*.json"):
        path.unlink()
    ingest.ingest(spark, str(source), folder)
    assert now(spark, folder) == ([], [])


def test_an_ingestion_that_stops_leaves_no_trace(spark, tmp_path, monkeypatch):
    rnd, source, folder = random.Random(2), tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    put(source, 1, rows(rnd, 1))
    ingest.ingest(spark, str(source), folder)
    before = now(spark, folder)
    put(source, 1, rows(rnd, 2))

    def stop(*_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(runs, "commit", stop)
        with pytest.raises(OSError, match="gone"):
            ingest.ingest(spark, str(source), folder)
    assert now(spark, folder) == before
    assert ingest.ingest(spark, str(source), folder).version == 2
    assert now(spark, folder) == full(spark, source)


# placed words


def page(texts, lefts, page_number=1, row_height=40, start=100.0, jitter=lambda: 0.0):
    """Words of a page's rows; a cell is a list of lines."""
    out = []
    for r, row in enumerate(texts):
        for left, cell in zip(lefts, row, strict=True):
            for n, line in enumerate(cell):
                x = left
                for w in line.split():
                    out.append((page_number, x + jitter(), x + 5.0 * len(w), start + row_height * r + 11 * n + jitter(), start + row_height * r + 11 * n + 10, w))
                    x += 5.0 * len(w) + 3
    return out


WORDS = "page int, x0 double, x1 double, top double, bottom double, word string"


def test_wrapped_cells_and_jitter(spark):
    rnd = random.Random(4)
    lefts = [20, 140, 300, 420]
    header = [["County"], ["Company", "Name"], ["No. Of", "Employees"], ["Layoff/Closure"]]
    body = [
        [["Alameda", "County"], ["Acme Widgets", "and Sons", "Inc."], ["12"], ["Closure"]],
        [["Kern County"], ["Short"], ["7"], []],
        [[], ["No County Co"], ["1,005"], ["Layoff Temporary"]],
    ]
    for _ in range(10):
        placed = page([header, *body], lefts, jitter=lambda: rnd.uniform(-0.4, 0.4))
        rnd.shuffle(placed)
        other = page([header, body[1]], lefts, page_number=2, start=7.0)
        got = words.tables(spark.createDataFrame(placed + other, WORDS)).orderBy("page", "ord").collect()
        assert [list(r.header) for r in got] == [["County", "Company Name", "No. Of Employees", "Layoff/Closure"]] * 4
        assert [list(r.cells) for r in got] == [
            ["Alameda County", "Acme Widgets and Sons Inc.", "12", "Closure"], ["Kern County", "Short", "7", None], [None, "No County Co", "1,005", "Layoff Temporary"],
            ["Kern County", "Short", "7", None],
        ]
    parsed = cells.parse_page_tables(words.tables(spark.createDataFrame(placed, WORDS)), 2014)
    assert sorted((r.company, r.employees, r.county) for r in parsed.collect()) == [("Acme Widgets and Sons Inc.", 12, "Alameda County"), ("No County Co", 1005, "None"), ("Short", 7, "Kern County")]


def test_pages_without_rows_or_words(spark):
    header = page([[["Company"], ["Number"]]], [20, 200])
    assert words.tables(spark.createDataFrame(header, WORDS)).count() == 0
    assert words.tables(spark.createDataFrame([], WORDS)).count() == 0
    assert words.tables(spark.createDataFrame([(1, None, None, None, None, None), (1, 1.0, 2.0, 1.0, 2.0, "")], WORDS)).count() == 0


def test_islands(spark):
    rnd = random.Random(6)
    spans = [(rnd.randrange(3), float(a), float(a + rnd.randrange(1, 6))) for a in rnd.sample(range(300), 90)]
    got = words.islands(spark.createDataFrame(spans, "g int, low double, high double"), ["g"], "low", "high", 1.5, "n").collect()
    for g in range(3):
        own, n, reached, want = sorted(s[1:] for s in spans if s[0] == g), 0, None, []
        for low, high in own:
            n += reached is not None and low > reached + 1.5
            reached = max(high, reached or high)
            want.append((low, high, n))
        assert sorted((r.low, r.high, r.n) for r in got if r.g == g) == want


# workbooks


def workbook(path, sheets, inline=False):
    """A minimal workbook; numbers stay numbers, other texts go to the shared ones."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared: list[str] = []

    def xml(text):
        return text.replace("&", "&amp;").replace("<", "&lt;")

    def cell(r, c, v):
        if v is None:
            return ""
        at = f'r="{chr(65 + c)}{r}"'
        if isinstance(v, (int, float)):
            return f"<c {at}><v>{v}</v></c>"
        if inline:
            return f'<c {at} t="inlineStr"><is><t>{xml(v)}</t></is></c>'
        shared.append(f"<si><t>{xml(v)}</t></si>" if " " not in v else "<si>" + "".join(f'<r><t xml:space="preserve">{xml(p)}</t></r>' for p in (v[:3], v[3:])) + "</si>")
        return f'<c {at} t="s"><v>{len(shared) - 1}</v></c>'

    parts = {}
    for k, (_, table) in enumerate(sheets, 1):
        body = "".join(f'<row r="{r}">{"".join(cell(r, c, v) for c, v in enumerate(row))}</row>' for r, row in enumerate(table, 1) if row)
        parts[f"xl/worksheets/sheet{k}.xml"] = f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
    names = "".join(f'<sheet name="{n}" sheetId="{k}" r:id="rId{k}"/>' for k, (n, _) in enumerate(sheets, 1))
    parts["xl/workbook.xml"] = f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>'
    links = "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
    parts["xl/_rels/workbook.xml.rels"] = f"<Relationships>{links}</Relationships>"
    if shared:
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{main}">{"".join(shared)}</sst>'
    with zipfile.ZipFile(path, "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)


HEADER = ["Notice Date", "Effective Date", "Company", "No. Of\nEmployees", "County", "City"]


@pytest.mark.parametrize("inline", [False, True])
def test_workbooks(spark, tmp_path, inline):
    body = [[45296, "2/1/2024", "A & B <Co>", 1200, "Kern County", None], [], ["TBD", 45323.5, "Other", "7", None, "Town"]]
    workbook(tmp_path / "a.xlsx", [("Summary", [["x"]]), ("Sheet1", [HEADER, *body])], inline)
    workbook(tmp_path / "b.xlsx", [("Detailed WARN Report", [["Report"], HEADER, *body])], inline)
    got = workbooks.notices(spark, str(tmp_path / "a.xlsx")).orderBy("ord").collect()
    want = [("A & B <Co>", 1200, "2024-01-05", "2024-02-01", "Kern County"), ("Other", 7, "TBD", "2024-02-01", "nan")]
    assert [(r.company, r.employees, r.notice_date, r.effective_date, r.county) for r in got] == want
    got = workbooks.notices(spark, str(tmp_path / "b.xlsx")).orderBy("ord").collect()
    assert [(r.company, r.employees, r.notice_date, r.effective_date, r.county) for r in got] == want
    grid = workbooks.read(spark, str(tmp_path))
    assert sorted({(r.file[-6:], r.sheet, r.nth) for r in grid.collect()}) == [("a.xlsx", "Sheet1", 1), ("a.xlsx", "Summary", 0), ("b.xlsx", "Detailed WARN Report", 0)]
    older = cells.without_trailer(grid, sheet="sheet").groupBy("sheet").count().collect()
    assert {r.sheet: r["count"] for r in older} == {"Sheet1": 1, "Detailed WARN Report": 2}


def test_many_rows_of_a_workbook(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbooks, "ROWS", 10)
    workbook(tmp_path / "a.xlsx", [("Sheet1", [HEADER, *[[None, None, f"Co {i}", i + 1, "X", "Y"] for i in range(57)]])])
    assert sorted(r.employees for r in workbooks.notices(spark, str(tmp_path / "a.xlsx")).collect()) == list(range(1, 58))


def test_html_message(spark):
    from noticemill.operators import diff
    from noticemill.sinks import store

    rows = notices(spark, [(f"<Co> & {i}", None, "2025-01-01", 1500, "X County") for i in range(12)])
    entry = diff.change_entry(rows, notices(spark, [("Old", None, None, 5)]), "t", store.FIELDS).first()
    page = report.message_html(entry, 12, 18_000, "today")
    assert page.count("<tr>") == 11 and "&lt;Co&gt; &amp; 0" in page and "... and 2 more" in page and "Removed since the last run: 1" in page and "18,000" in page
    assert report.message_html(diff.change_entry(rows.limit(0), rows, "t", store.FIELDS).first(), 0, 0) is None
