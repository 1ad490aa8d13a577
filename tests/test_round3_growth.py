"""Work of the shared steps: how often rows are sent and sorted, and that the shorter ways give the same results."""

from pyspark.sql import functions as F

from noticemill.functions import text
from noticemill.operators import merge

from .test_operators import notices


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_are_stripped_as_texts_are(spark):
    odd = ["", " ", "a", " a", "a ", "\ta b\n", "\x85a", "a　", "é", "aé", " é ", "a  b", "!", "~", "\x7f", None]
    df = spark.createDataFrame([(x,) for x in odd], "x string")
    assert df.where(~text.strip_cell(F.col("x")).eqNullSafe(text.strip(F.col("x")))).count() == 0


def test_filings_are_sorted_once(spark):
    merged = plan(merge.merge_duplicates(notices(spark, [("A", None, "2025-01-01", 1)])))
    assert merged.count("Sort [") == 1 and merged.count("Exchange hashpartitioning") == 1


def test_a_page_is_looked_for_between_two_bounds(spark):
    from noticemill.operators import positions

    keyed = spark.range(5000).select(F.col("id").alias("_k0"))
    order = [positions.Key(F.col("id"))]
    bounds = positions._bounds(keyed, order, 5000, [F.col("_k0").asc()], 2000, 2100)
    assert len(bounds) == 2 and bounds[0][0] < 2000 and bounds[1][0] >= 2100


def test_sides_are_sent_once(spark):
    from noticemill.operators import diff

    a, b = (notices(spark, [(f"Co {i}", None, "2025-01-01", 1) for i in r]).cache() for r in (range(30), range(20, 50)))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(diff.casefold(a, b)[0]).count("Exchange hashpartitioning") == 1
        assert plan(diff.strict(a, b)[0]).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert diff.casefold(a, b)[0].count() == 20 and diff.strict(a, b)[1].count() == 20


def test_keys_that_share_a_hash_are_told_apart():
    import pandas as pd

    from noticemill.streaming import changes

    def counts(*rows):
        df = pd.DataFrame(rows, columns=["hash", "company", "effective_date", "employees", "rows"])
        return df.astype({"hash": "Int64", "employees": "Int32", "rows": "Int64"})

    def found(before, after):
        return {(r.company, r.before, r.after) for r in changes.changed(before, after).itertuples()}

    one = counts((1, "A", None, 5, 1), (2, "B", "d", None, 2), (3, "C", "d", 1, 1))
    assert found(one, counts((2, "B", "d", None, 3), (1, "A", None, 5, 1), (4, "D", "d", 1, 1))) == {("B", 2, 3), ("C", 1, 0), ("D", 0, 1)}
    assert found(one, counts((1, "X", None, 5, 1), (2, "B", "d", None, 2), (3, "C", "d", 1, 1))) == {("A", 1, 0), ("X", 0, 1)}
    assert found(one, counts((1, "A", None, 5, 1), (1, "Y", None, 5, 1))) == {("Y", 0, 1), ("B", 2, 0), ("C", 1, 0)}
    assert found(one, one) == set()


def test_words_that_lie_with_their_pages_are_not_sent(spark):
    from noticemill.sources import words

    spans = [(None, 0, 0.0, "Company"), (None, 0, 90.0, "No."), (None, 20, 0.0, "A"), (None, 32, 1.0, "B"), (None, 20, 91.0, "7")]
    rows = [(page, float(x), x + 10.0, float(top), top + 10.0, word) for _, top, x, word in spans for page in (None, 1)]
    df = spark.createDataFrame(rows, "page int, x0 double, x1 double, top double, bottom double, word string").repartition(3, "page")
    found = words.tables(df)
    assert plan(found).count("Exchange") == 1
    assert [(r.page, r.header, r.cells) for r in found.orderBy("page").collect()] == [(p, ["Company", "No."], ["A B", "7"]) for p in (None, 1)]
