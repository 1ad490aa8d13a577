import random
import re
from collections import defaultdict

import pytest

from noticemill.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Water-filling by hand: share what is left by weight among those below their limit, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, out = set(), dict.fromkeys(names, 0.0)
    total = 1.5 * sum(sizes.values())
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        for s in names:
            out[s] = 2.0 * sizes[s] if s in full else share[s]
        if not over:
            return out
        full |= over


def frame(spark):
    rnd, rows = random.Random(9), []
    for source, n in (("a", 700), ("b", 90), ("Z", 40), ("é", 40), (None, 60), ("one", 1), ("empty", 3), ("𝒳", 30)):
        for _ in range(n):
            text = None if source == "empty" else " ".join(["w"] * int(rnd.lognormvariate(4, 1)))
            rows.append((len(rows), text, source, 1.0, 7))
    rows += [(None, "null id\t\x0bthree", "a", 1.0, 7)] + [(5000, "again and again", "a", 1.0, 7)] * 25
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target double, rows long"), rows


def test_mix(spark):
    df, rows = frame(spark)
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = targets(sizes)
    got = mixing.mix(df).toPandas()
    assert len(got) == len(rows)
    source_of = {r[0]: r[2] for r in rows}
    taken = defaultdict(int)
    for r in got.itertuples():
        s = source_of[None if r.doc_id != r.doc_id else int(r.doc_id)]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= (60 if s != "one" else sizes[s])
    again = mixing.mix(df.repartition(7)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert got[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))
    assert mixing.mixed_documents(df).count() == got[got["size"] > 0].copies.sum()
    assert mixing.mixed_documents(df).columns == df.columns


def test_each_document_has_its_share(spark):
    """Over many seeds, every single document's mean number of copies is near its source's target over its size."""
    df = spark.createDataFrame([(i, "s" if i % 4 else "t", 10 + 7 * (i % 5)) for i in range(64)], "doc_id long, source string, size long")
    runs, copies, share = 12, defaultdict(float), {}
    for seed in range(runs):
        old, mixing.SEED = mixing.SEED, 1000 + seed
        for r in mixing.plan_copies(df).collect():
            copies[r.doc_id] += (r.base + r.sure + r.extra) / runs
            share[r.doc_id] = r.target / r.source_size
        mixing.SEED = old
    assert len(copies) == 64
    off = [copies[i] - share[i] for i in copies]
    assert max(map(abs, off)) < 0.6  # four standard errors of a fair coin
    assert sum(o * o for o in off) / 64 < 1.5 * 0.25 / runs  # the spread of fair draws, not of a fixed choice

def test_small_tables(spark):
    df, _ = frame(spark)
    assert mixing.mix(df.where("false")).count() == 0 and mixing.mixed_documents(df.where("false")).count() == 0
    none = df.where("text is null")
    assert [r.taken for r in mixing.mix(none).collect()] == [0, 0, 0]
    assert mixing.mixed_documents(none).count() == 0


@pytest.mark.parametrize("total", [1.5, 1.3])
def test_a_long_document_does_not_miss_the_target(spark, monkeypatch, total):
    """Sources with one document of a third of their words, and with one of 20,020 words, get their target for any draw."""
    rnd, rows = random.Random(4), []
    for source, n, long in (("third", 499, None), ("long", 900, 20020), ("three", 700, 9000)):
        sizes = [rnd.randrange(60, 140) for _ in range(n)]
        sizes += [sum(sizes) * 34 // 66] if long is None else [long] * (3 if source == "three" else 1)
        rows += [(len(rows) + i, source, size) for i, size in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    for seed in (1, 2, 3):
        monkeypatch.setattr(mixing, "SEED", seed)
        got = mixing.plan_copies(df, weights=(1,), total=total).toPandas()
        assert len(got) == len(rows) and not got.duplicated(["doc_id"]).any()
        assert got["extra"].isin([0, 1]).all()
        for _, own in got.groupby("source"):
            assert abs((own["size"] * (own.base + own.sure + own.extra)).sum() - own.target.iloc[0]) < 100
