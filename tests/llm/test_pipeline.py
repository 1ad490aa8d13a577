from pyspark.sql import functions as F

import corpus_pipeline
from noticemill.llm.common import table

from ..conftest import SMALL


def test_stages(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = seen[name] = spark.read.parquet(str(tmp_path / name))
        assert docs.count() > 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = {n: {r.doc_id for r in d.select("doc_id").distinct().collect()} for n, d in seen.items()}
    assert ids["toxicity"] >= ids["language"] >= ids["near_duplicates"] >= ids["mixing"] == ids["packing"]
    labels = {r.doc_id: r.toxic for r in table(spark, SMALL, "labels").collect()}
    toxic = {i for i, v in labels.items() if v == 1}
    clean = {i for i, v in labels.items() if v == 0}
    assert len(ids["toxicity"] & toxic) < 0.6 * len(toxic) and len(ids["toxicity"] & clean) > 0.95 * len(clean)
    got = {tuple(r) for r in corpus_pipeline.run(spark, SMALL).drop("sequence_id", "offset").collect()}
    assert got == {tuple(r) for r in seen["packing"].drop("sequence_id", "offset").collect()}


def test_edges(spark):
    rows = [(1, None, "en", "a", None), (None, "some words of a text", None, None, 3), (2, "", "fr", None, 0), (3, "some words of a text", "en", "a", 3)]
    docs = spark.createDataFrame(rows, table(spark, SMALL, "documents").schema)
    for d in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, SMALL)
            out.collect()
            if name != "packing":
                assert out.columns == docs.columns


def test_stages_keep_clashing_columns_and_large_ids(spark):
    """Names that stages might use themselves, ids beyond 2^53 beside null, a very long text, one id with two texts."""
    clash = ["_size", "base", "_nth", "_found", "row", "units", "place", "score", "predicted", "lang_pred", "copies", "label", "kept", "rows"]
    base = table(spark, SMALL, "documents").where("source is not null").limit(150).coalesce(1)
    more = spark.createDataFrame(
        [(2**60 + 1, "the quick words of a long text " * 20000, "en", "src", 1), (None, "some words that have no id", "en", "src", 1), (5, "one text of an id", "en", "src", 1), (5, "another text of the same id", "en", "src", 1)],
        base.schema,
    )
    docs = base.unionByName(more).select("*", *[F.lit(f"mine {c}").alias(c) for c in clash])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"mine {c}" for r in rows for c in clash), name
        assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs.coalesce(1), SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").distinct().collect()}


def test_run_equals_brute_force(spark):
    """Every stage against plain Python over the rows that the stage before kept: no shared code but the learnt models and vocabulary."""
    import zlib
    from collections import Counter, defaultdict

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from noticemill.llm import language, toxicity

    from .test_mixing import targets
    from .test_near_duplicates import brute

    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    whole = {r.doc_id: r for r in docs.collect()}
    stages, kept = dict(corpus_pipeline.STAGES), {}
    rows = docs
    for name in list(stages)[:-1]:
        rows = stages[name](spark, rows, SMALL)
        kept[name] = [r.doc_id for r in rows.select("doc_id").collect()]

    # toxicity: the lexicon of the sample, every entry looked for at every place
    sample = {r.doc_id: r.toxic for r in labels.where("toxic is not null").collect()}
    given = spark.createDataFrame([(whole[i].text, int(y)) for i, y in sample.items() if i in whole and whole[i].text is not None], "text string, label int")
    counts = Counter(r.label for r in given.collect())
    lexicon = dict(toxicity.SEEDS) | toxicity.learn_lexicon(given, counts[1], counts[0])

    def plain(text):
        folded, total = toxicity.fold(text or ""), 0.0
        entries = defaultdict(lambda: (0.0, True))
        for e, w in lexicon.items():
            entries[e.strip()] = (max(w, entries[e.strip()][0]), e.endswith(" ") and entries[e.strip()][1])
        starts = lambda w: [a for a in range(len(folded)) if folded.startswith(w, a) and not (a and folded[a - 1].isalpha())]
        excused = [(a, a + len(p)) for p in toxicity.EXCEPTIONS if p in folded for a in starts(p)]
        for e, (w, closed) in entries.items():
            if e not in folded:
                continue
            for a in starts(e):
                if not (closed and folded[a + len(e) : a + len(e) + 1].isalpha()) and not any(x <= a and a + len(e) <= y for x, y in excused):
                    total += w
        return (np.log1p(total), np.log1p(100 * total / len(text.split()))) if total else (0.0, 0.0)

    measured = {i: plain(r.text) for i, r in whole.items()}
    learnt = [i for i in sample if i in whole and whole[i].text is not None]
    curve = toxicity.logistic(np.array([measured[i] for i in learnt]), np.array([float(sample[i] > 0) for i in learnt]))
    score = {i: 1 / (1 + np.exp(-(curve[0] + np.dot(m, curve[1:])))) for i, m in measured.items()}
    assert sorted(kept["toxicity"]) == sorted(i for i, s in score.items() if s < 0.5)

    # language: filters replaced by the sets of n-grams that they hold, to within the chance of a false hit
    left = docs.join(spark.createDataFrame([(i,) for i in kept["toxicity"]], "doc_id long"), "doc_id", "left_semi")
    filters = language.learn_filters(left, F.lit(False))
    names, scores = filters.decide([whole[i].text for i in kept["toxicity"]])
    least = dict(zip(filters.languages, filters.least, strict=True))
    fits = [i for i, n, s in zip(kept["toxicity"], names, scores, strict=True) if n != "und" and s >= max(0.3, 0.8 * least[n])]
    assert sorted(kept["language"]) == sorted(fits)
    assert all(whole[i].text and any(c.isalpha() for c in whole[i].text) for i in fits)

    # near-duplicates: all pairs
    ids = sorted(kept["language"])
    component = brute([whole[i].text for i in ids], 5)
    assert sorted(kept["near_duplicates"]) == [i for k, i in enumerate(ids) if component[k][1] == k]

    # mixing: targets by hand, whole copies, no document more than twice
    size = {i: len((whole[i].text or "").split()) for i in kept["near_duplicates"]}
    of_source = defaultdict(int)
    for i, n in size.items():
        of_source[whole[i].source] += n
    copies, taken = Counter(kept["mixing"]), defaultdict(int)
    for i, n in copies.items():
        taken[whole[i].source] += n * size[i]
    assert max(copies.values()) <= 2 and set(copies) <= set(size)
    for s, t in targets(of_source).items():
        assert abs(taken[s] - t) <= max(n for i, n in size.items() if whole[i].source == s)

    # packing: the library's ids, every piece once, no gaps, nothing over the window
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    want = Counter()
    for i, n in copies.items():
        tokens = [*library.encode(whole[i].text, add_special_tokens=False).ids, 2]
        for at in range(0, len(tokens), 4096):
            own = np.array(tokens[at : at + 4096], "<u4")
            want[(i, at, len(own), zlib.crc32(own.tobytes()), len(tokens))] += n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces) == want
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and sum(own[-1]) <= 4096
