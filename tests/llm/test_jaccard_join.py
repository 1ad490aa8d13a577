import random

import duckdb
import numpy as np
import pytest

from noticemill.llm import jaccard_join as jj
from noticemill.llm import near_duplicates as nd
from noticemill.llm import queries
from tests.conftest import SMALL

from .test_near_duplicates import words


def corpus(seed=5):
    """Copies around nine tenths, small sets, chains of slowly changing texts, a large close group, passages that many share."""
    rnd, texts = random.Random(seed), []
    for n in (4, 9, 11, 12, 13, 22, 60, 200, 900):
        for _ in range(3):
            base = words(rnd, n)
            texts.append(" ".join(base))
            for share in (0, 0.005, 0.01, 0.015, 0.02, 0.03, 0.05, 0.2):
                texts.append(" ".join(w if rnd.random() >= share else f"x{rnd.randrange(10**6)}" for w in base))
            texts += [" ".join(base[1:]), " ".join([*base, "end"]), " ".join([*base, *base[: n // 20 + 1]])]
    chain = words(rnd, 80)
    for _ in range(25):
        chain[rnd.randrange(80)] = f"c{rnd.randrange(10**6)}"
        texts.append(" ".join(chain))
    base = words(rnd, 150)
    for i in range(150):
        texts.append(" ".join(w if rnd.random() >= (i % 30) / 900 else f"y{rnd.randrange(10**6)}" for w in base))
    passage = words(rnd, 90)
    texts += [" ".join([*words(rnd, 5), *passage, *words(rnd, 8)]) for _ in range(60)]
    texts += [None, "", "   ", "\t\n", "one", "ONE", "one\x1ctwo", "One two", "one TWO", "one two three", "É é", "é é"] + ["the same text here"] * 20
    rnd.shuffle(texts)
    return texts


def brute(texts, width, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    parent = list(range(len(texts)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 1000 >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 1000 * common >= percent * (len(a) + len(b) - common):
                    x, y = sorted((root(i), root(j)))
                    parent[y] = x
    return [(i, len(s), root(i)) for i, s in enumerate(sets)]


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def found(spark, texts, *how):
    return sorted(map(tuple, jj.jaccard_components(documents(spark, texts).repartition(6), *how).collect()))


@pytest.mark.parametrize(("width", "percent"), [(3, 900), (2, 805)])
def test_components_equal_brute_force(spark, width, percent):
    texts = corpus()
    assert found(spark, texts, width, percent / 1000) == brute(texts, width, percent)


def test_small_fragments_and_groups_change_nothing(spark, monkeypatch):
    """Overlaps in many fragments, hot segments in blocks, shuffled joins."""
    texts = corpus(6)
    monkeypatch.setattr(jj, "SEGMENT", 16)
    monkeypatch.setattr(nd, "GROUP", 8)
    monkeypatch.setattr(nd, "SLICE", 4)
    assert found(spark, texts) == brute(texts, 3, 900)


def test_similar_sets_share_a_segment_key():
    """Random pairs at the least similarity, and those with many empty segments, for sizes small and large."""
    rng, share = np.random.default_rng(7), jj.Fraction("0.9")
    lows = jj.size_classes(share)
    for n in [*range(9, 60), 200, 1000, 5000]:
        for _ in range(20):
            common = rng.integers(0, 1 << 64, size=n, dtype=np.uint64)
            if n % 3 == 0:
                common = common >> np.uint64(rng.integers(0, 6))  # crowded into few fragments
            extra = n * 10 // 9 - n
            left = int(rng.integers(0, extra + 1))
            more = rng.integers(0, 1 << 64, size=extra, dtype=np.uint64)
            a, b = np.unique(np.concatenate([common, more[:left]])), np.unique(np.concatenate([common, more[left:]]))
            keys = [set(jj.segment_keys(s, lows, share).tolist()) for s in (a, b)]
            assert np.array_equal(a, b) or keys[0] & keys[1]


def test_classes_hold_similar_sizes():
    share = jj.Fraction("0.9")
    lows = jj.size_classes(share)
    for n in range(1, 3000):
        largest = n * 10 // 9
        assert np.searchsorted(lows, largest, "right") - np.searchsorted(lows, n, "right") in (0, 1)


def test_repeated_and_null_ids_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "a"), (1, text, "b"), (2, text + " more", "a"), (None, text, None), (3, "other words here", ""), (3, text, "a"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keys string")
    docs = docs.withColumns({c: docs["keys"] for c in ("label", "cut", "x", "n_shingles")})
    got = [tuple(r) for r in jj.jaccard_components(docs).collect()]
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=order) == sorted([(1, 38, 1), (1, 38, 1), (2, 39, 1), (None, 38, None), (3, 1, 1), (3, 38, 1), (None, 0, None)], key=order)


def test_empty_table(spark):
    assert jj.jaccard_components(documents(spark, [])).count() == 0


def test_long_texts(spark):
    rnd = random.Random(1)
    base = [f"v{rnd.randrange(10**9)}" for _ in range(150_000)]
    near = [w if rnd.random() > 0.01 else "z" for w in base]
    far = [w if rnd.random() > 0.06 else "z" for w in base]
    assert [r[2] for r in found(spark, [" ".join(t) for t in (base, near, far)])] == [0, 0, 2]


def test_query_equals_its_sql_and_leaves_no_tables(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    shared = Path(urlparse(spark.conf.get("spark.checkpoint.dir")).path)
    before = set(shared.glob("written-*"))
    rows = queries.op13_jaccard_join(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    assert sorted(map(tuple, rows.collect())) == sorted(con.execute(queries.ORACLE_SQL["op13_jaccard_join"]).fetchall())
    assert len(set(shared.glob("written-*")) - before) == 1


def test_sets_of_many_copies_are_dealt_alike(spark, monkeypatch):
    """Beyond the bound of what is sent, large groups of copies and the others go different ways."""
    monkeypatch.setattr(nd, "BROADCAST_ROWS", 3)
    texts = ["copies of one text here"] * 60 + [f"text {i // 2} of two copies" for i in range(40)] + [f"a single text {i}" for i in range(20)]
    assert found(spark, texts) == brute(texts, 3, 900)
