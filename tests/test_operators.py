import json

import pytest
from pyspark.sql import functions as F

from noticemill import catalog
from noticemill.operators import charts, diff, kpis, merge, search
from noticemill.plans import refresh
from noticemill.sinks import report, runs, store
from noticemill.sources import envelopes
from noticemill.streaming import windows

from .conftest import SMALL

NAMES = "company string, notice_date string, effective_date string, employees int, county string, city string, layoff_type string, address string, industry string, ord string"


def notices(spark, rows):
    full = [(*r, *[None] * (9 - len(r)), f"{i:04}") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, NAMES)


def test_merge_takes_first_value_that_is_not_null(spark):
    df = notices(spark, [("A", None, "2025-01-01", 5, None, "x"), ("A", "2024-12-01", "2025-01-01", 6, None, "x"), ("A", "2024-11-01", "2025-01-01", 7, None, "x")])
    for n in (1, 3):
        r = merge.merge_duplicates(df.repartition(n)).collect()
        assert [(x.employees, x.notice_date, x.ord) for x in r] == [(18, "2024-12-01", "\x01".join(["2025-01-01", "A", "\uffff", "x", "\uffff"]))]


def test_sums_are_kept(spark):
    df = catalog.notices(spark, SMALL).cache()
    total = merge.payload_totals(df).first().total_employees
    assert catalog.clean(spark, SMALL).agg(F.sum("employees")).first()[0] == total
    for chart in (charts.sector_breakdown,):
        assert chart(df).agg(F.sum("employees")).first()[0] == total
    dated = charts.typed(df).where("effective_on is not null").agg(F.sum("employees")).first()[0]
    assert charts.monthly_ma3(df).agg(F.sum("employees")).first()[0] == dated
    assert charts.daily_rolling30(df).agg(F.max("cumulative")).first()[0] == dated
    df.unpersist()


def test_diff(spark):
    a = notices(spark, [("A", None, "2025-01-01", 5), ("A", None, "2025-01-01", 5), ("B", None, None, 6)])
    b = notices(spark, [("a ", None, "2025-01-01", 5), ("B", None, None, 6), ("C", None, "2025-01-01", 1)])
    added, removed = diff.strict(a, b)
    assert [r.company for r in added.collect()] == ["A", "A"] and sorted(r.company for r in removed.collect()) == ["C", "a "]
    added, removed = diff.casefold(a, b)
    assert added.count() == 0 and [r.company for r in removed.collect()] == ["C"]
    assert all(side.count() == 0 for side in (*diff.strict(a, a), *diff.casefold(a, a)))
    t = diff.totals(a, b).first()
    assert (t.latest_count, t.snapshot_count, t.added_count, t.removed_count, t.employees_delta) == (3, 3, 0, 1, 4)


def test_kpis(spark):
    df = notices(spark, [("A", "2025-01-01", "2025-03-02", 1500, " X "), ("B", "2025-01-01", "2025-01-02", 1500, "Y"), ("C", "bad", "2025-01-01", 2, "")])
    assert kpis.average_lead(df).first()[0] == "30d"
    assert tuple(kpis.largest(df).first()) == ("A", "1,500")
    assert tuple(kpis.top_county(df).first()) == ("X", "1,500")
    none = df.where("false")
    assert kpis.average_lead(none).first()[0] == "N/A" and tuple(kpis.largest(none).first()) == ("N/A", "N/A")
    assert tuple(kpis.top_county(none).first()) == ("N/A", "N/A")


def test_pages(spark):
    df = search.cells(notices(spark, [(f"Co {i}", None if i % 5 == 0 else f"2025-01-{i + 1:02}", "x", i, "A County", None, "Layoff") for i in range(12)]))
    pages = [[r.company for r in search.page(df, search.newest_first(), p, 5).collect()] for p in (0, 1, 2, 3, 9)]
    assert pages[0] == pages[1] and pages[3] == pages[4] and len(pages[3]) == 2
    assert sum(map(len, pages[1:4])) == 12 and pages[1][0] == "Co 11"
    assert len(search.page(df, search.newest_first(), 1, 0).collect()) == 12
    late = df.where(search.Filters(notice_from="2025-01-10").condition())
    assert {r.company for r in late.collect()} == {"Co 0", "Co 5", "Co 9", "Co 10", "Co 11"}


def test_options(spark):
    df = notices(spark, [("A", None, None, 1, "X County", None, "T", None, " I "), ("B", None, None, 1, "", None, None, None, None)])
    assert {tuple(r) for r in search.options(df).collect()} == {("county", "X"), ("type", "T"), ("industry", "I")}


def test_refresh(spark, tmp_path):
    folder = str(tmp_path)
    first = notices(spark, [("A", "2025-01-01", "2025-03-01", 5, "X County", "c", "t"), ("B", None, "2025-03-02", 6, "X County", "c", "t")])
    out = refresh.run(spark, first, folder, "1", "t1")
    assert (out.entry.new_count, out.totals.total_employees, out.failed) == (2, 11, {})
    assert "New notices: 2" in out.message[1] and "A" in out.message[1]
    second = notices(spark, [("A", "2025-01-01", "2025-03-01", 5, "X County", "c", "t"), ("C", None, "2025-03-02", 9, "Y County", "c", "t")])
    out = refresh.run(spark, second, folder, "2", "t2")
    assert (out.entry.new_count, out.entry.removed_count, out.entry.new_entries[0].company) == (1, 1, "C")
    assert "| C | 9 |" in out.report and runs.ids(spark, folder) == ["2", "1"]
    assert report.message(out.entry.__class__(**{**out.entry.asDict(), "new_count": 0}), 1, 1) is None
    assert out.manifest.where("status = 'ok'").count() == len(refresh.CHARTS) + len(refresh.YEAR_CHARTS) == 11
    assert refresh.run(spark, second, folder, "2", "t2").entry.new_count == 1  # a repeated run adds no second line
    assert sorted(r.run_id for r in store.read_log(spark, folder).collect()) == ["1", "2"]
    parts = sorted((tmp_path / "changes").glob("attempt=*/*.json"))
    first = [x for p in parts for x in p.read_text().splitlines() if json.loads(x)["timestamp"] == "t1"]
    assert len(first) == 1 and "total_employees_removed" not in json.loads(first[0])


def test_payload_order_decides_ties(spark):
    """Ties go by effective date (nulls last), then company, and not by the place in the input."""
    rows = [("Z", "2025-01-05", None, 9, "Q County"), ("Y", "2025-01-05", "2025-06-01", 9, "P County"), ("X", "2025-01-05", "2025-02-01", 9, "O County"), ("W", "2025-01-05", "2025-06-01", 9, "N County")]
    merged = merge.merge_duplicates(notices(spark, rows))
    in_order = ["X", "W", "Y", "Z"]
    assert [r.company for r in merged.orderBy("ord").collect()] == in_order
    assert kpis.largest(merged).first().company == "X" and kpis.top_county(merged).first().county == "O County"
    assert [r.company for r in search.page(search.cells(merged), search.newest_first(), 1, 3).collect()] == in_order[:3]


def test_yearly_files_and_metadata(spark, tmp_path):
    records = spark.createDataFrame([("A", 5, "2014"), ("B", 6, "2015")], "company string, employees long, fiscal_year string")
    store.write_years(records, str(tmp_path / "years"))
    store.write_combined(records, str(tmp_path / "whole"))
    assert {p.name for p in (tmp_path / "years").glob("fiscal*")} == {"fiscal_year=2014", "fiscal_year=2015"}
    assert spark.read.json(str(tmp_path / "whole")).count() == 2
    (tmp_path / "meta.json").write_text('{"etag": "x", "changed": true}')
    assert {tuple(r) for r in envelopes.metadata(spark, str(tmp_path / "meta.json")).collect()} == {("etag", "x"), ("changed", "true")}
    assert envelopes.metadata(spark, str(tmp_path / "none.json")).count() == 0


def test_a_month_without_a_column_stops_the_query(spark):
    df = notices(spark, [("A", None, "2025-03-01", 5, "X County")])
    assert charts.county_month_pivot(df, ["2025-02", "2025-03"]).first()["2025-03"] == 5
    with pytest.raises(Exception, match="month without a column"):
        charts.county_month_pivot(df, ["2025-02"]).collect()


def test_stream_equals_batch(spark):
    path = f"{SMALL}/events.parquet"
    stream = windows.event_days(spark, path).collect()
    batch = windows.daily(spark.read.parquet(path)).collect()
    assert sorted(map(tuple, stream)) == sorted(map(tuple, batch))


def test_changes_by_batch(spark, tmp_path):
    sample = notices(spark, [("A", None, "2025-01-01", 5), ("B", None, "2025-01-01", 6)])
    sample.write.parquet(str(tmp_path / "in"))
    sink = windows.log_changes(lambda: sample.where("company = 'A'"), str(tmp_path / "log"), store.FIELDS)
    query = spark.readStream.schema(sample.schema).parquet(str(tmp_path / "in")).writeStream.foreachBatch(sink).trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    lines = [json.loads(x) for p in (tmp_path / "log").glob("*/*.json") for x in p.read_text().splitlines()]
    assert [(x["new_count"], x["removed_count"]) for x in lines] == [(1, 0)]


def test_pages_by_position(spark, monkeypatch):
    """Any page of any order is that of a sort of all rows."""
    from noticemill.operators import positions

    rnd = __import__("random").Random(8)
    rows = [(rnd.choice([None, "a", "b", "c", "9 z", "10", "007"]), None, rnd.choice([None, "2025-01-01", "2025-01-02"]), rnd.randrange(9)) for _ in range(700)]
    df = search.cells(notices(spark, rows)).cache()
    monkeypatch.setattr(positions, "FEW", 40)
    monkeypatch.setattr(positions, "SAMPLE", 60)
    monkeypatch.setattr(positions, "RANGES", 5)
    monkeypatch.setattr(search, "NEAR", 0)
    for order in (search.newest_first(), search.by_cell("company"), search.by_cell("company", descending=True)):
        whole = [r.ord for r in df.orderBy(*[k.sorted() for k in order]).collect()]
        for number, size in ((1, 10), (2, 50), (7, 100), (35, 20), (36, 20), (10**9, 100)):
            at = min(number, -(-len(whole) // size)) - 1
            assert [r.ord for r in search.page(df, order, number, size).collect()] == whole[at * size : (at + 1) * size]
    assert search.page(df.where("false"), search.newest_first(), 10**9, 100).count() == 0
    df.unpersist()


@pytest.mark.parametrize("block", [32_768, 64])
def test_indexed_search_equals_the_scan(spark, tmp_path, monkeypatch, block):
    from noticemill.operators import text_index

    monkeypatch.setattr(text_index, "BLOCK_ROWS", block)
    rnd = __import__("random").Random(2)
    names = ["Ámbar Labs", "ACME & Sons", "a", "", "Zoë", "x" * 50, "acme acme", "😀 smile", None]
    rows = [(f"{rnd.choice(names) or ''} {rnd.randrange(50)}" if rnd.random() < 0.9 else rnd.choice(names), None, None, rnd.randrange(9), rnd.choice(["X County", None])) for _ in range(500)]
    df = search.cells(notices(spark, rows))
    index = text_index.build(df, str(tmp_path))
    for field, wanted in (("company", "acme"), ("company", "e & s"), ("company", "z"), ("company", "ë "), ("company", "xx"), ("any_text", "x 7"), ("any_text", "😀"), ("company", "none of these"), ("company", "")):
        condition = search.Filters(**{field: wanted}).condition()
        want = sorted(r.ord for r in df.where(condition).collect())
        assert sorted(r.ord for r in text_index.search(spark, index, field, wanted).collect()) == want


def test_indexed_search_reads_matching_blocks_only(spark, tmp_path, monkeypatch):
    from noticemill.operators import text_index

    monkeypatch.setattr(text_index, "BLOCK_ROWS", 32)
    df = search.cells(notices(spark, [(f"plain {i}" if i != 77 else "needle here", None, None, i) for i in range(600)]))
    index = text_index.build(df, str(tmp_path), ("company",))
    found = text_index.search(spark, index, "company", "NEEDLE")
    assert [r.headcount for r in found.collect()] == [77]
    assert len(found.inputFiles()) > 0 and text_index.candidates(spark, index, "company", "needle").count() == 1


def test_digests_narrow_to_the_change(spark):
    from noticemill.operators import digests

    same = [(f"Co {i}", None, "2025-01-01", i % 7) for i in range(3000)]
    a = notices(spark, [*same, ("New", None, None, 1), ("NEW ", None, None, 1)])
    b = notices(spark, [*same, ("Old", None, "2025-01-01", None)])
    near = digests.narrowed(a, b)
    assert near[0].count() + near[1].count() < 600
    for own, plain in zip(digests.casefold(a, b), diff.casefold(a, b), strict=True):
        assert sorted(map(tuple, own.collect())) == sorted(map(tuple, plain.collect()))
    assert digests.totals(a, b).first().asDict() == diff.totals(a, b).first().asDict()
    assert all(side.count() == 0 for side in digests.narrowed(a, a))


def test_headcounts_that_are_missing_count_as_none(spark):
    from noticemill.operators import history

    records = spark.createDataFrame([(None, "2020-01-05", "2019", "pdf"), (5, "2020-02-05", "current", "xlsx")], "employees long, effective_date string, fiscal_year string, source string")
    assert [(r.line, r.label, r.employees) for r in history.month_lines(records).collect()] == [("2020", "Jan", 0), ("2020", "Feb", 5)]
    assert [(r.fiscal_year, r.notices) for r in history.year_over_year(records, [2019, 2018]).collect()] == [("2018", None), ("2019", None), ("current", 1)]
