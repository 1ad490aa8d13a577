import random

import duckdb
import numpy as np
import pytest

from noticemill.llm import near_duplicates as nd
from noticemill.llm import queries
from tests.conftest import SMALL


def words(rnd, n, size=400):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


def corpus():
    """Copies from exact to barely similar, short texts, a large group of near copies, and texts that share passages."""
    rnd, texts = random.Random(3), []
    for n in (3, 10, 40, 150, 600):
        for _ in range(4):
            base = words(rnd, n)
            texts.append(" ".join(base))
            for share in (0, 0.01, 0.02, 0.04, 0.05, 0.06, 0.1, 0.3):
                copy = [w if rnd.random() >= share else f"x{rnd.randrange(10**6)}" for w in base]
                texts.append(" ".join(copy))
    base = words(rnd, 200)
    for i in range(300):
        texts.append(" ".join(w if rnd.random() >= (i % 40) / 400 else f"y{rnd.randrange(10**6)}" for w in base))
    passage = " ".join(words(rnd, 60))
    texts += [f"{' '.join(words(rnd, 60))} {passage} {' '.join(words(rnd, 60))}" for _ in range(60)]
    texts += [None, "", "   ", "\t\n", "one", "ONE", "one\x1ctwo", "One two", "one TWO", "one two three", "É é", "é é"] + ["same text here"] * 30
    rnd.shuffle(texts)
    return texts


def brute(texts, width):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    parent = list(range(len(texts)))

    def root(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= 80 * (len(a) + len(b) - common):
                    x, y = sorted((root(i), root(j)))
                    parent[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, width):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "c", i) for i, t in enumerate(texts)], "doc_id long, text string, kept string, node long")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(df, width).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in enumerate(brute(texts, width))}


@pytest.mark.parametrize("listed", [0, 1 << 18])
def test_groups_with_failed_pairs_are_looked_at_again(spark, monkeypatch, listed):
    """Without the parity screen nearly all pairs that share a table fail, so that groups need many forests."""
    monkeypatch.setattr(nd, "LISTED", 8)
    monkeypatch.setattr(nd, "MOST_LISTED", listed)
    monkeypatch.setattr(nd, "LEAST_BITS", 64)
    monkeypatch.setattr(nd, "MOST_BITS", 64)
    texts = corpus()[:130]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(df, 2).collect()}
    assert got == {i: c for i, (_, c) in enumerate(brute(texts, 2))}


def test_forest_spans():
    rnd = random.Random(5)
    for n in (1, 2, 30, 200):
        pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(n)]
        i, j = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))

        def parts(at, i=i, j=j, n=n):
            label = list(range(n))
            for k in at:
                a, b = label[i[k]], label[j[k]]
                label = [a if x == b else x for x in label]
            return [label.index(x) for x in label]

        chosen = nd.forest(i, j, n)
        whole = parts(range(n))
        assert parts(chosen) == whole and len(chosen) == n - len(set(whole))


def test_parity_never_exceeds_the_difference():
    rnd = np.random.default_rng(4)
    for size in (5, 70, 900, 9000):
        common = rnd.integers(0, 1 << 63, size, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rnd.integers(0, 1 << 63, max(1, size // k), dtype=np.uint64)])) for k in (9, 11))
        p, q = (np.frombuffer(nd.parity(s), dtype=np.uint8) for s in (a, b))
        while len(p) != len(q):
            p, q = sorted((p, q), key=len)
            q = q[: len(q) // 2] ^ q[len(q) // 2 :]
        apart = int(np.bitwise_count(p ^ q).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_large_groups_meet_across_parts(spark, monkeypatch):
    monkeypatch.setattr(nd, "GROUP", 16)
    texts = corpus()[::2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(df, 5).collect()}
    assert got == {i: c for i, (_, c) in enumerate(brute(texts, 5))}


def test_repeated_ids_and_large_ids(spark):
    """Ids beyond 2^53 stand beside nulls; of two texts under one id the one with more shingles is linked."""
    big = 2**60 + 1
    rows = [(None, "a b c d e f"), (big, "a b c d e f"), (big + 2, "a b c d e f"), (7, "x y"), (7, "a b c d e f"), (8, "x y"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(df, 2).collect()), key=str)
    assert got == sorted([(None, 5, None), (big, 5, 7), (big + 2, 5, 7), (7, 1, 7), (7, 5, 7), (8, 1, 8), (None, 0, None)], key=str)


def test_one_of_each_keeps_clashing_columns(spark):
    schema = "doc_id long, text string, row string, nth int, kept boolean, hash long, _nth int"
    rows = [(1, "a b c d", "p", 1, False, 5, 7), (2, "a b c d", "q", 2, True, 6, 8), (3, "e f", "r", 3, None, 7, 9), (3, "g h", "s", 4, None, 8, 10), (None, "a b c d", "t", 5, None, 9, 11)]
    df = spark.createDataFrame(rows, schema)
    out = nd.one_of_each(df, 2)
    assert out.columns == df.columns
    got = [tuple(r) for r in out.collect()]
    assert rows[0] in got and rows[4] in got and len(got) == 3 and sum(r in got for r in rows[2:4]) == 1


def test_edges_of_tables(spark):
    schema = "doc_id long, text string"
    assert nd.near_duplicates(spark.createDataFrame([], schema), 2).count() == 0
    df = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, None)], schema)
    rows = sorted(((r.doc_id, r.component_id, r.kept) for r in nd.near_duplicates(df, 2).collect()), key=str)
    assert rows == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (None, None, True), (None, None, True)], key=str)
    assert sorted((r.doc_id is None, r.text) for r in nd.one_of_each(df, 2).where("text is not null").collect()) == [(False, "a b c d"), (True, "a b c d")]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300)], "x long, y long")
    got = {r.node: r.label for r in nd.components(links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100, 300: 100}
    assert nd.components(links.where("false")).count() == 0


def test_query_equals_its_sql(spark):
    rows = queries.op5_near_duplicates(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    expected = con.execute(queries.ORACLE_SQL["op5_near_duplicates"])
    assert rows.columns == [d[0] for d in expected.description]
    assert sorted(map(tuple, rows.collect())) == sorted(expected.fetchall())
