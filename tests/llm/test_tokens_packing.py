import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from noticemill.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "it's DON'T I'LL 12³ x", "<|endoftext|>a<|startoftext|> b", "é é ñ 日本語 ̈x", "a\x1cb\x85c d e", "ab" * 3000, "word " * 9000,
    "Σας ΣΑΣ İstanbul ß ﬁ", "... !!! ---", "​ zero", "tab\tnew\nline\r\n",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    enc = tokens.encoder(PATH)
    for t in TEXTS:
        assert list(np.frombuffer(enc.ids(t or ""), "<u4")) == library.encode(t or "", add_special_tokens=False).ids
    for block in range(0x20, 0x3000, 37):
        t = "".join(f"a{chr(c)}b {chr(c)} C{chr(c)}{chr(c)}" for c in range(block, block + 37))
        assert list(np.frombuffer(enc.ids(t), "<u4")) == library.encode(t, add_special_tokens=False).ids


def test_splicing_equals_the_whole(library):
    enc, rnd = tokens.encoder(PATH), random.Random(5)
    for _ in range(200):
        t = "".join(rnd.choice(["ab", "c", "'s", " ", "\n", "é", "ñ", "12", "...", "́", "日", "<|endoftext|>", " the "]) for _ in range(rnd.randint(0, 150)))
        n = len(library.encode(t, add_special_tokens=False).ids)
        for chunk, overlap in ((16, 4), (40, 1), (5, 30)):
            assert tokens.spliced_count(enc, t, chunk, overlap) == n
    assert tokens.spliced_count(enc, "x" * 500, 50, 5) == len(library.encode("x" * 500, add_special_tokens=False).ids)


def test_texts_without_blanks(library):
    enc, rnd = tokens.encoder(PATH), random.Random(6)
    parts = ["日本語", "文。", "テスト、", "が", "\u3099", "の", "no.1x", "3a", "'s", "'S.s", "ก", "ำ", "。", "<|endoftext|>", "é.", "!\u0301a", "각", "，中"]
    for _ in range(300):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120)))
        ids = library.encode(t, add_special_tokens=False).ids
        assert list(np.frombuffer(enc.ids(t), "<u4")) == ids
        for chunk, overlap in ((16, 4), (40, 1), (5, 30), (1, 1)):
            assert tokens.spliced_count(enc, t, chunk, overlap) == len(ids)


def test_encoded_characters_grow_with_the_text(monkeypatch):
    enc, seen = tokens.encoder(PATH), []
    spans = enc.spans
    monkeypatch.setattr(enc, "spans", lambda t: (seen.append(len(t)), spans(t))[1])
    for text in ("abcdefgh" * 20_000, "一二三" * 20_000, "中文。" * 20_000, "a " + "x" * 100_000):
        seen.clear()
        tokens.spliced_count(enc, text, 1000, 50)
        assert sum(seen) <= 1.2 * len(text) + 5000
    assert max(map(len, enc.runs), default=0) <= tokens.LONGEST_KEPT


def test_other_vocabularies_go_to_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    enc, other = tokens.encoder(path), Tokenizer.from_file(path)
    assert not enc.known
    for t in TEXTS:
        ids = other.encode(t or "", add_special_tokens=False).ids
        assert list(np.frombuffer(enc.ids(t or ""), "<u4")) == ids and tokens.spliced_count(enc, t or "", 16, 4) == len(ids)


def frame(spark):
    rows = [(i, t, "clash", 1, 2) for i, t in enumerate(TEXTS)] + [(None, "null id", "", 0, 0), (3, TEXTS[3], "again", 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, length long, klass int")


def test_counts(spark, library):
    found = tokens.count_tokens(frame(spark), PATH, chunk=1000, overlap=8).collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        t = "null id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 2048)
    assert tokens.count_tokens(frame(spark).where("false"), PATH).count() == 0


def test_nnls_meets_its_conditions():
    rng = np.random.default_rng(1)
    a, b = rng.random((20, 60)), rng.random(20)
    x = packing.nnls(a, b)
    gain = a.T @ (b - a @ x)
    assert (x >= 0).all() and (gain <= 1e-6).all() and np.abs(gain[x > 0]).max() < 1e-6


def test_combinations():
    found = {tuple(sorted(c[c > 0])) for c in packing.combinations(8, 3)}
    brute = {tuple(sorted((a, b, 8 - a - b))) for a in range(1, 9) for b in range(1, 9) if 8 - a - b > 0} | {(a, 8 - a) for a in range(1, 5)} | {(8,)}
    assert found == brute


def test_plan_uses_the_histogram():
    rng = np.random.default_rng(2)
    for scale in (0, 1, 3, 5000):
        h = rng.integers(0, scale + 1, size=33)
        h[0] = 0
        used = np.zeros_like(h)
        for parts, n in packing.plan(h):
            assert sum(parts) <= 32
            np.add.at(used, parts, n)
        assert (used == h).all()


@pytest.mark.parametrize("window", [64, 4096])
def test_pack(spark, library, window):
    got = packing.pack(frame(spark), PATH, window=window, unit=window // 64 or 1, keep_ids=True).toPandas()
    assert not got.duplicated(["sequence_id", "offset"]).any() and (got.length > 0).all()
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert (own.offset == own.length.cumsum() - own.length).all() and own.length.sum() <= window
    for r in got.itertuples():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32
    for doc in range(len(TEXTS)):
        own = got[got.doc_id == doc].sort_values("start")
        ids = [*library.encode(TEXTS[doc] or "", add_special_tokens=False).ids, 2]
        copies = 2 if doc == 3 else 1
        assert own.length.sum() == copies * len(ids) and (own.doc_tokens == len(ids)).all()
        if copies == 1:
            assert [int(i) for x in own.ids for i in x] == ids
    assert packing.pack(frame(spark).where("false"), PATH).count() == 0


def test_padding(spark):
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame(pd.DataFrame({"doc_id": range(3000), "text": ["a " * int(n) for n in rng.lognormal(6, 1, 3000)]}))
    got = packing.pack(docs, PATH).toPandas()
    assert got.length.sum() / (4096 * got.sequence_id.nunique()) > 0.97


def test_padding_of_short_texts(spark):
    rng = np.random.default_rng(4)
    words = [2] * 1500 + [0] * 500 + [int(n) for n in rng.lognormal(6, 1, 2000)]
    docs = spark.createDataFrame(pd.DataFrame({"doc_id": range(len(words)), "text": ["a " * n for n in words]}))
    got = packing.pack(docs, PATH).toPandas()
    assert len(got) >= len(words) and got.length.sum() / (4096 * got.sequence_id.nunique()) > 0.97


def test_ids_of_long_texts_come_in_runs(library):
    rnd, enc = random.Random(9), tokens.encoder(PATH)
    for trial in range(300):
        words = [rnd.choice(["word", "Größe", "日本語。", "don't", "x1.y", "<|endoftext|>", "́", "ab" * 40, "é"]) for _ in range(rnd.randrange(1, 60))]
        text = rnd.choice(["", " ", "\n\n"]).join(words)
        runs = list(tokens.id_runs(enc, text, rnd.choice([8, 30, 100])))
        assert list(np.frombuffer(b"".join(runs), "<u4")) == library.encode(text, add_special_tokens=False).ids


def test_memory_of_a_very_long_text():
    """Pieces of 20 MB of text take little more memory than the text."""
    import tracemalloc

    text = " ".join(f"w{i % 977} some more words, and others;" for i in range(640_000))
    enc = tokens.encoder(PATH)
    list(tokens.id_runs(enc, text[: 1 << 20]))
    tracemalloc.start()
    n = sum(len(ids) for ids in tokens.id_runs(enc, text)) // 4
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) > 19 << 20 and n > 5_000_000 and peak < 100 << 20


def test_pack_of_a_long_text(spark, library, monkeypatch):
    text = " ".join(f"w{i} and" for i in range(40_000))
    ids = [*library.encode(text, add_special_tokens=False).ids, packing.END_ID]
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = sorted(packing.pack(docs, PATH, keep_ids=True).collect(), key=lambda r: (r.doc_id, r.start))
    assert [i for r in got if r.doc_id == 1 for i in r.ids] == ids
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) for r in got)
    assert {r.doc_tokens for r in got if r.doc_id == 1} == {len(ids)}
