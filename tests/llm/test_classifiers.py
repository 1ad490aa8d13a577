import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from noticemill.llm import language, quality, toxicity
from noticemill.llm.common import fold_of

from ..conftest import SMALL

MEDIUM = "/root/testdata/sf0.01"


def test_fold():
    assert toxicity.fold("Ｉ１D1OТ") == "iiidiot"[2:] or toxicity.fold("ｉd10т") == "idiot"
    assert toxicity.fold("m0r0n $tup1d") == "moron stupid"
    assert toxicity.fold("sc​um") == "scum"


def test_hits_and_exceptions():
    found = toxicity.automaton((("moron", 2.0), ("retard", 3.0), ("cat ", 1.0)))
    fold = toxicity.fold
    assert [h[2] for h in toxicity.hits(fold("a m0r0n, morons; oxymoron"), found)] == [2.0, 2.0]
    assert toxicity.hits(fold("fire retardant foam"), found) == []
    assert [h[2] for h in toxicity.hits(fold("the cat, a category"), found)] == [1.0]
    assert toxicity.measures(None, found) == toxicity.measures("", found) == (0.0, 0.0)


def test_lexicon_keeps_the_longest_beginning(spark):
    rows = [(f"plain words {i} vileword", 1) for i in range(9)] + [(f"grumpstem{c} plain", 1) for c in "abcdefgh"] + [(f"plain words {i} worthy", 0) for i in range(30)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"), 17, 30)
    assert any(e.strip() == "vileword" for e in lexicon) and "grumpstem" in lexicon and "plain" not in lexicon
    assert not any(e.startswith("vile") and len(e.strip()) < 8 for e in lexicon)


def test_logistic():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 2))
    y = (x @ [2, -1] + 0.3 > 0).astype(float)
    b = toxicity.logistic(x, y)
    assert (((b[0] + x @ b[1:]) > 0) == y).mean() > 0.97


def test_discriminant_equals_the_formula():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, (300, 3)), rng.normal(1, 2, (200, 3))])
    y = np.repeat([0, 1], [300, 200])
    m = quality.Discriminant(x, y)
    z = (x - m.centre) / m.scale
    logs = []
    for k in (0, 1):
        s = m.factors[k] @ m.factors[k].T
        d = z - m.means[k]
        logs.append(np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    assert np.allclose(m.score(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-9)


def test_bloom_filters_hold_what_they_took():
    texts = {"aa": ["the thing that they thought"] * 3, "bb": ["über größe straße"] * 3}
    grams = {k: np.unique(np.concatenate(language.gram_hashes(v)[0])) for k, v in texts.items()}
    f = language.Filters(["aa", "bb"], grams)
    share, letters = f.shares(["they thing", "größe", "12 !", ""])
    assert share[0, 0] > 0.95 and share[1, 1] == 1 and list(letters) == [9, 5, 0, 0]
    assert f.decide([None, "", "12", "thing"])[0] == ["und", "und", "und", "aa"]


def test_many_languages_take_more_slices():
    names = [f"l{i:03}" for i in range(70)]
    grams = {n: np.unique(np.concatenate(language.gram_hashes([chr(0x4E00 + 10 * i) + chr(0x4E01 + 10 * i)])[0])) for i, n in enumerate(names)}
    f = language.Filters(names, grams)
    assert f.decide([chr(0x4E00 + 10 * 69) + chr(0x4E01 + 10 * 69)])[0] == ["l069"]


@pytest.mark.parametrize(("name", "label", "least"), [("op7_toxicity", "toxic", 0.95), ("op8_quality", "quality", 0.95), ("op10_language", "lang", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    found = entry.queries()[name](spark, MEDIUM)
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    truth = docs.select("doc_id", "lang") if label == "lang" else spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", label)
    guess = "lang_pred" if label == "lang" else "predicted"
    r = found.join(truth, "doc_id").where("held_out").agg(F.avg((F.col(guess) == F.col(label)).cast("int")), F.min("score"), F.max("score")).first()
    assert r[0] >= least and 0 <= r[1] <= r[2] <= 1 and found.count() == docs.count()


def edge(spark):
    rows = [(1, None, "en", "x"), (2, "", None, "x"), (3, "?!", "en", "x"), (None, "some words", "fr", "x"), (4, "w " * 50_000, "en", "x"), (4, "w " * 50_000, "en", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_edges(spark):
    docs, none = edge(spark), fold_of(F.col("doc_id"), 5) == 0
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, None, None), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for given, known in ((docs, labels), (docs.where("false"), labels), (docs, labels.where("false"))):
        n = given.count()
        assert toxicity.score_toxicity(given, known, none).where("score between 0 and 1").count() == n
        assert quality.score_quality(given, known, none).where("score between 0 and 1").count() == n
        found = language.identify(given, language.learn_filters(given, F.lit(False)))
        assert found.where("score between 0 and 1").count() == n
    found = language.identify(docs, language.learn_filters(docs, F.lit(False)))
    assert found.where("lang_pred = 'und'").count() == 3


def test_labels_never_reach_held_out_rows(spark):
    """Turning round the labels of held-out ids changes nothing."""
    held_out = fold_of(F.col("doc_id"), 3) == 1
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(held_out, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.score_quality(docs, labels, held_out).collect()}
    assert a == {r.doc_id: r.score for r in quality.score_quality(docs, turned, held_out).collect()}


def test_automaton_equals_a_plain_scan():
    """Every entry at every place, without an automaton."""
    import random

    rnd, letters = random.Random(6), "abcd "
    entries = {"".join(rnd.choice("abcd") for _ in range(rnd.randint(2, 4))) + rnd.choice(["", " "]): 1.0 + rnd.random() for _ in range(40)}
    found = toxicity.automaton(tuple(sorted(entries.items())))
    weights, whole = {}, {}
    for e, w in entries.items():
        weights[e.strip()] = max(w, weights.get(e.strip(), 0))
        whole[e.strip()] = e.endswith(" ") and whole.get(e.strip(), True)
    for _ in range(200):
        text = "".join(rnd.choice(letters) for _ in range(60))
        plain = []
        for word, weight in weights.items():
            for a in range(len(text) - len(word) + 1):
                b = a + len(word)
                if text[a:b] == word and not text[a - 1 : a].isalpha() and not (whole[word] and text[b : b + 1].isalpha()):
                    plain.append((a, b, weight))
        assert sorted(toxicity.hits(text, found)) == sorted(plain)


def test_filters_against_exact_sets():
    """Every n-gram that a language has is found; the rest pass no oftener than the fill says, and shares are corrected for that."""
    rng = np.random.default_rng(8)
    grams = {k: rng.integers(0, 1 << 63, 3000, dtype=np.uint64) for k in "abc"}
    filters = language.Filters(list("abc"), grams)
    other = rng.integers(0, 1 << 63, 50_000, dtype=np.uint64)
    for i, k in enumerate("abc"):
        held = [language.Filters._bit(filters.slices[0][c], i) for c in language.cells_of(grams[k])]
        assert all(h.all() for h in held)
        passed = np.logical_and.reduce([language.Filters._bit(filters.slices[0][c], i).astype(bool) for c in language.cells_of(other)])
        assert abs(passed.mean() - filters.chance[i]) < 0.002


def test_a_language_of_one_document_is_learnt(spark):
    rows = [(i, f"common words of the first tongue number {'abcdefghij'[i % 10]}", "aa") for i in range(40)] + [(99, "зовсім інша мова з власними літерами", "bb")]
    filters = language.learn_filters(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(False))
    assert filters.decide(["інша мова", "words of the tongue"])[0] == ["bb", "aa"]


def test_a_text_with_both_labels_counts_as_toxic(spark):
    docs = spark.createDataFrame([(i, f"text {i // 2} vileword") for i in range(20)] + [(i, f"plain {i}") for i in range(20, 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2 if i < 20 else 0) for i in range(60)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels, F.lit(False)).collect()
    assert all(r.predicted == (r.doc_id < 20) for r in got)


def test_long_texts_go_in_parts(monkeypatch):
    """Counts and shares do not depend on how texts are cut and put together."""
    import pandas as pd

    texts = ["Größe und Straße, " * 40, None, "", "the thing that they thought 12 " * 30, "x" * 700, "a b c " * 200]
    rows = pd.DataFrame({"label": ["aa", "aa", "bb", "bb", "aa", "bb"], "text": texts})
    grams = {k: np.unique(np.concatenate(language.gram_hashes([t or "" for t in rows.text[rows.label == k]])[0])) for k in ("aa", "bb")}
    seen = []
    for most in (1 << 17, 50, 7):
        monkeypatch.setattr(language, "CHUNK_CHARS", most)
        counts = pd.concat(language._count_grams(iter([rows]))).sort_values(["lang", "gram"])
        share, letters = language.Filters(["aa", "bb"], grams).shares(texts)
        seen.append((counts.to_numpy().tolist(), share.tolist(), letters.tolist()))
    assert seen[0] == seen[1] == seen[2]


def test_exception_phrases_are_swept_once():
    """Equal to looking at every phrase for every hit, and in time that grows with the text."""
    import random
    import time

    found = toxicity.automaton((("idiot", 2.0), ("stupid", 1.0), ("moron", 3.0)))
    rnd = random.Random(4)
    parts = ["idiot", "idiot proof", "not an idiot", "not stupid", "stupid", "moron", "moronidae", "not a moron", "plain"]
    for _ in range(200):
        text = " ".join(rnd.choice(parts) for _ in range(30))
        phrases = [(m, m + len(p)) for p in toxicity.EXCEPTIONS for m in range(len(text)) if text.startswith(p, m)]
        phrases = [(a, b) for a, b in phrases if not a or not text[a - 1].isalpha()]
        words = [(a, a + len(w), x) for w, x in (("idiot", 2.0), ("stupid", 1.0), ("moron", 3.0)) for a in range(len(text)) if text.startswith(w, a)]
        words = [(a, b, x) for a, b, x in words if not a or not text[a - 1].isalpha()]
        assert sorted(toxicity.hits(text, found)) == sorted(w for w in words if not any(a <= w[0] and w[1] <= b for a, b in phrases))
    long = "fire retardant idiot proof moron " * 30_000  # 1 MB
    began = time.time()
    assert len(toxicity.hits(long, found)) == 30_000
    assert time.time() - began < 5


def test_a_repeated_labelled_id_is_one_row_of_the_sample(spark):
    from noticemill.llm.labels import label_sample, with_labels

    docs = spark.createDataFrame([(1, f"text {i}") for i in range(3000)] + [(2, "other"), (None, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, toxic int")
    given = with_labels(docs, label_sample(labels, "toxic", F.lit(True), 10), ["doc_id", "text"])
    assert sorted((r.doc_id, r.label) for r in given.collect()) == [(1, 1), (2, 0)]
    assert given.collect()[0].text == with_labels(docs.repartition(5), label_sample(labels, "toxic", F.lit(True), 10), ["doc_id", "text"]).collect()[0].text
