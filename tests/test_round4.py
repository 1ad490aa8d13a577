"""Work on pages and their tables: done once a row, and the same as the plain way."""

import random

from pyspark.sql import functions as F

from noticemill import catalog
from noticemill.functions import values
from noticemill.sources import words

from .conftest import SMALL
from .test_round3_growth import plan


def numbered(spans, gap):
    n, reached, out = 0, None, []
    for low, high in spans:
        n += reached is not None and low > reached + gap
        reached = high if reached is None else reached if high is None else max(reached, high)
        out.append(n)
    return out


def by(part, low, high, gap):
    part = sorted(part, key=lambda w: [(x is not None, x or 0) for x in (w[low], w[high], *w)])
    return list(zip(numbered([(w[low], w[high]) for w in part], gap), part, strict=True))


def joined(cell):
    return " ".join(w[4] for _, w in sorted(by(cell, 2, 3, words.LINE_GAP), key=lambda p: (p[0], p[1][0], p[1][4]))) if cell else None


def read(page):
    """A page's rows below its header, word by word."""
    rows = by(page, 2, 3, words.ROW_GAP)
    header = by([w for n, w in rows if n == 0], 0, 1, words.COLUMN_GAP)
    columns = [[w for k, w in header if k == c] for c in range(header[-1][0] + 1)]
    begins = [float("-inf"), *[min(w[0] for w in c) - words.INDENT for c in columns[1:]], float("inf")]
    for n in range(1, rows[-1][0] + 1):
        own = [w for k, w in rows if k == n]
        yield n, [joined(c) for c in columns], [joined([w for w in own if a <= w[0] < b]) for a, b in zip(begins, begins[1:], strict=False)]


def test_pages_are_read_as_word_by_word(spark):
    rnd, pages = random.Random(5), {}
    for page in [None, *range(1, 12)]:
        top, pages[page] = 0.0, []
        for row in range(rnd.randrange(1, 9)):
            for _ in range(rnd.randrange(1, 14)):
                x, y = float(rnd.randrange(0, 120) if row else rnd.randrange(0, 5) * 30 + rnd.randrange(3)), top + rnd.randrange(0, 14)
                pages[page].append((x, rnd.choice([None, x + rnd.randrange(1, 9)]), y, rnd.choice([None, y + rnd.randrange(1, 5)]), rnd.choice("abcéz😀") * rnd.randrange(1, 3)))
            top += rnd.choice([20, 40])
    placed = [(page, *w) for page, own in pages.items() for w in own]
    rnd.shuffle(placed)
    got = words.tables(spark.createDataFrame(placed, "page int, x0 double, x1 double, top double, bottom double, word string")).collect()
    want = [(page, 0, header, n, cells) for page, own in pages.items() for n, header, cells in read(own) if any(cells)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) > 20


def test_words_have_no_windows(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 1.0, 2.0, "A")], "page int, x0 double, x1 double, top double, bottom double, word string")
    assert "Window" not in plan(words.tables(df)) and plan(words.tables(df)).count("Exchange") == 1
    odd = [(1, 0.0, 1.0, 0.0, 1.0, "Company"), (1, 0.0, 1.0, 50.0, 51.0, "A"), (1, float("nan"), 1.0, 50.0, 51.0, "nowhere"), (1, 0.0, 1.0, 90.0, None, "B")]
    assert sorted((r.ord, r.cells) for r in words.tables(spark.createDataFrame(odd, df.schema)).collect()) == [(1, ["A"]), (2, ["B"])]


def test_notices_of_page_tables_are_read_once(spark):
    assert plan(catalog.page_tables(spark, SMALL)).count("lineitem.parquet") == 1


def test_page_dates_in_the_usual_form_are_read_by_place(spark):
    dates = {
        "0 1 / 0 2 / 9 6 ": "1996-01-02", "01/02/68": "2068-01-02", "1 2/3 1/6 9": "1969-12-31", "02/30/20": "02/30/20", "02/29/20": "2020-02-29", "0 2/ 2 9/2 1": "02/29/21",
        "01/5T/96": "01/5T/96", "1/2/96": "1996-01-02", "01\t/02/96": "1996-01-02", "01/02/1996": "1996-01-02", "1996-01-02": "1996-01-02", "1-2-1996": "1996-01-02", "+1/02/96": "+1/02/96",
        "01/-2/96": "01/-2/96", "T B D": "TBD", "": None, " ": None, "nan": None, "None": None, None: None, "13/01/20": "13/01/20", "01/02/9६": "01/02/9६", "00/00/00": "00/00/00", "ab/cd/ef": "ab/cd/ef",
    }
    df = spark.createDataFrame([(x,) for x in dates], "x string").select("x", values.page_date(F.col("x")).alias("y"))
    assert {r.x: r.y for r in df.collect()} == dates
    # the patterns of other dates are no part of the code that reads usual ones
    assert df._jdf.queryExecution().optimizedPlan().toString().split("transform(array(x")[0].count("regexp_replace") == 0


def test_an_index_is_built_where_its_rows_lie(spark, tmp_path, monkeypatch):
    from noticemill.operators import search, text_index

    from .test_operators import notices

    df = search.cells(notices(spark, [(f"Co {i}", None, None, i) for i in range(300)]))
    sent, write = [], type(df).write
    monkeypatch.setattr(type(df), "write", property(lambda self: sent.append(plan(self).count("Exchange")) or write.fget(self)))
    index = text_index.build(df, str(tmp_path), ("company",))
    assert sent == [plan(df).count("Exchange"), 0]
    found = text_index.candidates(spark, index, "company", "co 29").collect()
    # a block that was read in parts
    index.grams(spark).write.mode("append").partitionBy("field").parquet(f"{tmp_path}/grams")
    assert sorted(text_index.candidates(spark, index, "company", "co 29").collect()) == sorted(found)


def test_slots_are_short():
    import numpy as np

    from noticemill.operators import text_index

    rnd = np.random.default_rng(1)
    for n in (1, 5, 100, 3000, 4000, 20_000):
        slots = np.sort(rnd.choice(32_768, n, replace=False))
        coded = text_index._slots(slots)
        assert np.flatnonzero(np.unpackbits(text_index._bits(coded), bitorder="little")).tolist() == slots.tolist()
        assert len(coded) <= min(n + 32_768 // 255, text_index.BITMAP_BYTES)


def test_an_ingestion_writes_rows_once(spark, tmp_path, monkeypatch):
    from contextlib import contextmanager

    from noticemill.plans import ingest
    from noticemill.sinks import scratch

    from .test_ingest_sources import full, now, put, rows

    rnd, source, folder = random.Random(3), tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for k in range(4):
        put(source, k, rows(rnd, k))
    aside, written = [], scratch.written

    @contextmanager
    def counted(df):
        with written(df) as kept:
            aside.append(kept.count() if "company" in kept.columns else 0)
            yield kept

    monkeypatch.setattr(scratch, "written", counted)
    ingest.ingest(spark, str(source), folder)
    assert sum(aside) == 0 and not (tmp_path / "out/postings").exists() and now(spark, folder) == full(spark, source)
    aside.clear()
    put(source, 1, [*rows(rnd, 9), rows(random.Random(3), 0)[0]])
    ingest.ingest(spark, str(source), folder)
    assert sum(aside) < 60 and now(spark, folder) == full(spark, source)


def test_marked_rows_are_all_that_share_a_key(spark):
    from noticemill.plans import ingest

    rows = spark.range(4000).select(F.xxhash64("id").alias("k"))
    keys = spark.range(0, 4000, 100).select(F.xxhash64("id").alias("k"))
    marked = ingest._marked(rows, keys).where("marked")
    assert marked.count() < 60 and marked.join(keys, "k", "left_semi").count() == 40
    assert ingest._sharing(rows, keys).count() == 40 and ingest._marked(rows, keys.limit(0)).where("not marked").count() == 4000


def test_files_are_dealt_before_their_texts_are_made(spark):
    from noticemill.sources import star

    dealt = star.raw_notices(spark, SMALL, F.col("l_orderkey") % 100)
    sent = next(line for line in plan(dealt).split("Exchange")[1:] if "REPARTITION_BY_COL" in line)
    assert "c_name" in sent and "lpad" in plan(dealt).split("Exchange")[0] and "lpad" not in sent
    assert dealt.exceptAll(star.raw_notices(spark, SMALL)).count() == 0 and dealt.count() == star.raw_notices(spark, SMALL).count()
