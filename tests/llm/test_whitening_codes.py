import hashlib
import math
from decimal import Decimal

import duckdb
import numpy as np
import pytest

from noticemill.llm import queries, vector_codes, whitening
from tests.conftest import SMALL

BAD = [None, [0.5, None, 0.1, 0.2], [math.nan, 0.0, 0.0, 0.0], [0.0, math.inf, 0.0, 0.0]]


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, n string, q string, id string")


def vectors(n, dims, seed=1, scale=0.3):
    spread = np.linspace(1, 3, dims)
    return (np.random.default_rng(seed).normal(size=(n, dims)) * spread * scale).astype(np.float32)


def whole(found):
    return {(r.vec_id, i): r for i, r in enumerate(sorted(found.collect(), key=lambda r: (r.vec_id is None, r.vec_id or 0)))}


def test_whitening_equals_eigenvectors(spark):
    v = vectors(300, 8)
    rows = [(i, x.tolist(), 0, "", "", "") for i, x in enumerate(v)]
    rows += [(1000 + i, v[0].tolist(), 1, None, None, None) for i in range(150)]  # a third of all rows are copies
    rows += [(2000 + i, x and x * 2, 0, "", "", "") for i, x in enumerate(BAD)] + [(None, v[1].tolist(), 0, "", "", "")]
    found = whitening.whiten(table(spark, rows).repartition(40), components=8).collect()
    x = np.floor(256 * v.astype(np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    e, vec = np.linalg.eigh(np.cov(fit.T, bias=True))
    e, vec = e[::-1], vec[:, ::-1]
    assert len(found) == 451
    sign = None
    for r in found:
        own = x[1 if r.vec_id is None else 0 if r.vec_id >= 1000 else r.vec_id]
        assert (r.n, r.deviation) == (n, int(((n * own - s) ** 2).sum()))
        expected = (own - s / n) @ vec / np.sqrt(e)
        got = np.array(r.whitened)
        sign = np.sign(got * expected) if sign is None else sign
        assert np.allclose(got, sign * expected, atol=1e-9)
        assert np.allclose(r.explained, e / e.sum(), rtol=1e-9)
        assert r.identity_error < 1e-12


def test_tree_has_several_levels(spark):
    v = vectors(2000, 4)
    x = np.floor(256 * v.astype(np.float64)).astype(np.int64)
    fit = spark.createDataFrame([(row.tolist(),) for row in x], "q array<long>").repartition(300)
    r = whitening.triangular_factor(fit, len(x), [int(c) for c in x.sum(0)])
    assert np.allclose(r.T @ r / len(x), np.cov(x.T, bias=True))


def test_small_variances_keep_their_digits(spark):
    v = np.random.default_rng(4).normal(size=(200, 3)) * [3e6, 1, 1]
    v[:, 1] += v[:, 0]
    found = whitening.whiten(table(spark, [(i, x.tolist(), 0, "", "", "") for i, x in enumerate(v)], "double"), components=3)
    assert found.first().identity_error < 1e-6


@pytest.mark.parametrize("rows", [0, 1, 3])
def test_whitening_of_few_vectors(spark, rows):
    found = whitening.whiten(table(spark, [(i, x.tolist(), 0, "", "", "") for i, x in enumerate(vectors(rows, 8))])).collect()
    assert len(found) == rows
    for r in found:
        assert len(r.whitened) == 4 and r.whitened[rows - 1 :] == [None] * (5 - rows)
    if rows == 1:
        assert found[0].deviation == 0 and found[0].identity_error is None and found[0].explained == [None] * 4


def test_large_entries_are_exact(spark):
    big = [[1e15, 2.0, 3.0, 4.0], [-1e15, 5.0, 6.0, 7.0], [3e14, 5.0, 1.0, 7.0]]
    found = whitening.whiten(table(spark, [(i, x, 0, "", "", "") for i, x in enumerate(big)], "double"))
    x = [[math.floor(256 * c) for c in row] for row in big]
    s = [sum(c) for c in zip(*x)]
    assert {r.vec_id: r.deviation for r in found.collect()} == {
        i: Decimal(sum((3 * c - t) ** 2 for c, t in zip(row, s))) for i, row in enumerate(x)
    }


def test_several_lengths_are_refused(spark):
    mixed = table(spark, [(1, [0.5] * 4, 0, "", "", ""), (2, [0.5] * 8, 0, "", "", "")])
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(mixed)
    with pytest.raises(ValueError, match="components"):
        vector_codes.compress(mixed)


def brute_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """rows: (id, vector, label); returns codes, errors, codebooks."""
    x = [[math.floor(scale * float(c)) for c in v] for _, v, _ in rows]
    width = len(x[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in x]
    first = {}
    for (i, _, _), v in zip(rows, x):
        first[i] = min(first.get(i, v), v)
    begin = [first[i] for i in sorted(first)[:entries]]
    books = [[v[p * width : (p + 1) * width] for v in begin] for p in range(parts)]

    def assign():
        out = []
        for v in cut:
            out.append([min((sum((a - b) ** 2 for a, b in zip(q, e)), k) for k, e in enumerate(books[p])) for p, q in enumerate(v)])
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p] for v, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    return [[k for _, k in f] for f in found], [sum(d for d, _ in f) for f in found], books


@pytest.mark.parametrize(("n", "entries", "scale"), [(120, 16, 0.3), (5, 16, 0.3), (40, 8, 1e12)])
def test_codes_equal_brute_force(spark, n, entries, scale):
    v = vectors(n, 8, seed=n, scale=scale).astype(np.float64)
    rows = [(3 * i + 1, x.tolist(), [None, 0, 1][i % 3]) for i, x in enumerate(v)]
    rows += [(5000 + i, v[0].tolist(), 7) for i in range(n // 2)] + [(1, v[-1].tolist(), 1)]  # copies, and an id twice
    bad = [(9000 + i, x and x * 2, 0) for i, x in enumerate(BAD)]
    source = table(spark, [(i, x, y, "a", None, "b") for i, x, y in rows + bad], "double").repartition(7)
    coded, books = vector_codes.compress(source, entries=entries)
    codes, errors, expected = brute_codes(rows, entries=entries)
    assert books == expected
    total = {}
    for (_, _, y), e in zip(rows, errors):
        total[y] = total.get(y, 0) + e
    order = lambda r: (r[0], r[1], r[2], r[3])
    assert sorted(((r.vec_id, r.codes, int(r.error), int(r.label_error)) for r in coded.collect()), key=order) == sorted(
        ((i, c, e, total[y]) for (i, _, y), c, e in zip(rows, codes, errors)), key=order
    )


def test_annulus_is_inclusive_and_ties_go_to_lower_entries():
    rng = np.random.default_rng(2)
    for _ in range(40):
        entries = rng.integers(-6, 7, size=(rng.integers(1, 60), 3))
        x = rng.integers(-9, 10, size=(500, 3))
        number, distance = vector_codes.Codebook(entries.tolist()).nearest(x)
        d = ((x[:, None] - entries[None]) ** 2).sum(2)
        assert (number == d.argmin(1)).all() and (distance == d.min(1)).all()


def test_no_vectors(spark):
    coded, books = vector_codes.compress(table(spark, [(1, None, 0, "", "", "")]))
    assert coded.count() == 0 and books == [] and vector_codes.digest([]) == hashlib.sha256(b"").hexdigest()


def test_sums_of_many_keys(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_ROWS", 4)
    keys = [None] * 40 + [1] * 30 + list(range(2, 40)) * 2
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, v long")
    total = {k: sum(i for i, x in enumerate(keys) if x == k) for k in keys}
    assert sorted((r.v, r.s) for r in vector_codes.with_sums(rows, "k", "v", "s").collect()) == [(i, total[k]) for i, k in enumerate(keys)]


def test_codes_query_equals_its_sql(spark):
    found = queries.op12_vector_codes(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMALL}/embeddings.parquet')")
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(queries.ORACLE_SQL["op12_vector_codes"]).fetchall())


def test_whitening_query(spark):
    rows = queries.op11_whitening(spark, SMALL).collect()
    assert len(rows) % 4 == 0 and {r.component for r in rows} == {1, 2, 3, 4}
    assert max(r.identity_error for r in rows) < 1e-4
