"""Work that must not grow beyond the rows: what is shuffled, written and read again."""

from pyspark.sql import functions as F

from noticemill.operators import diff, search, text_index
from noticemill.schema import NOTICE
from noticemill.sinks import runs, store
from noticemill.sources import cells

from .test_operators import notices


def test_an_index_is_as_long_as_its_rows(spark, tmp_path):
    df = search.cells(notices(spark, [(f"Co {i}", None, None, i) for i in range(300)]))
    index = text_index.build(df, str(tmp_path), ("company",))
    assert index.grams(spark).agg(F.max(F.length("slots"))).first()[0] <= 2 * 300
    assert text_index.search(spark, index, "company", "co 29").count() == 11


def test_slots_as_lists_and_as_bitmaps_are_the_same():
    import numpy as np

    for n in (1, 2047, 2048, 32_768):
        slots = np.arange(32_768)[-n:]
        assert np.flatnonzero(np.unpackbits(text_index._bits(text_index._slots(slots)), bitorder="little")).tolist() == slots.tolist()


def test_records_are_columnar_and_older_runs_stay_readable(spark, tmp_path):
    rows = notices(spark, [("A", None, "2020-01-01", 1), ("B", None, None, 2)])
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in NOTICE], "ord")
    folder = str(tmp_path)
    rows.write.json(f"{folder}/records/attempt=old")
    assert runs.commit(spark, folder, "old", "1", 0) == 1
    entry = diff.change_entry(rows, store.read_snapshot(spark, folder, "1"), "t", store.FIELDS)
    store.write_run(spark, folder, "2", rows, store.payload(rows, "t"), entry, 1)
    assert not list(tmp_path.glob("records/attempt=[!o]*")) and list(tmp_path.glob("records.parquet/attempt=*"))
    for run in ("1", "2"):
        assert sorted(r.company for r in store.read_snapshot(spark, folder, run).collect()) == ["A", "B"]


def test_a_change_line_is_the_same_however_many_keys_differ(spark, monkeypatch):
    a = notices(spark, [(f"Co {i}", None, "2025-01-01", 1) for i in range(60)])
    b = notices(spark, [(f"Co {i}", None, "2025-01-01", 1) for i in range(30, 90)])
    want = diff.change_entry(a, b, "t", ["company"], 5).first()
    monkeypatch.setattr(diff, "SENT_KEYS", 0)
    for first in (3, 45, 1000):
        monkeypatch.setattr(diff, "FIRST_ROWS", first)
        assert diff.change_entry(a, b, "t", ["company"], 5).first() == want


def test_a_header_is_found_in_one_pass(spark):
    grid = spark.createDataFrame([("2", ["Company"]), ("1", ["x"]), ("3", ["company"])], "ord string, cells array<string>")
    assert cells.header(grid) == ("1", ["x"]) and cells.header(grid, named=True) == ("2", ["Company"])
    assert cells.header(grid.where("false"), named=True) == (None, None)


def test_cells_of_a_header_are_told_apart_once(spark):
    tables = spark.createDataFrame([(1, 0, ["Company"], "1", ["A"])], "page int, nth int, header array<string>, ord string, cells array<string>")
    plan = cells.parse_page_tables(tables, 2014)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(header") == 1
