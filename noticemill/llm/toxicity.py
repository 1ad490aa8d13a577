"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits or signs that stand for letters, so that ``1d10t``
and its Cyrillic spelling read alike.  The lexicon holds word beginnings.  Its entries and weights are learnt from a bounded
sample of labelled documents: an entry's weight is the log-odds of documents that have it; of a chain of beginnings with the
same support (``wort``, ``worth``, ... ``worthless``) the longest is kept.  A small seed list supplies entries that the sample
does not show.  Hits inside an exception phrase do not count.  The weights of a text's hits, as a sum and per word, go through
a logistic curve fitted on the same sample.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, cut
from .labels import label_sample, with_labels

#: Bound of the labelled sample, for each label value.
SAMPLE_PER_CLASS = 6000
#: Documents of the sample that must have an entry, and the least log-odds of an entry.
LEAST_SUPPORT = 5
LEAST_WEIGHT = 2.5
#: Bound of the lexicon.
MOST_ENTRIES = 4000
SHORTEST, LONGEST = 4, 16

# Seed entries and their weights.
SEEDS = {"idiot": 3.0, "moron": 3.0, "stupid": 2.0, "imbecile": 3.0, "scumbag": 3.5, "dumbass": 3.5, "retard": 3.0, "bastard": 3.0, "bitch": 3.5, "asshole": 4.0, "fuck": 4.0, "cunt": 4.0, "whore": 3.5, "slut": 3.5}
# Phrases in which a hit does not count.
EXCEPTIONS = (
    "retardant", "flame retard", "fire retard", "retardation factor", "not stupid", "stupidly simple",
    "bastard file", "bastard sword", "bastard title", "bastard toadflax", "bitches brew", "idiot board", "idiot light", "idiot proof", "idiot-proof", "idiotproof",
    "not an idiot", "not a moron", "keep it simple stupid", "keep it simple, stupid", "cuntz", "slutsk", "moronidae",
)
# Letters that look like a Latin letter, and signs that stand for one.
HOMOGLYPHS = {
    "a": "аα@4",
    "b": "вβ",
    "c": "сϲ",
    "e": "еεё3",
    "h": "һн",
    "i": "іι1ı",
    "j": "ј",
    "k": "кκ",
    "m": "м",
    "n": "ո",
    "o": "оο0",
    "p": "рρ",
    "s": "ѕ$5",
    "t": "тτ7",
    "u": "υս",
    "v": "ν",
    "w": "ԝ",
    "x": "хχ",
    "y": "уγ",
}
_WORD = re.compile(r"[^\W\d_]+")


@functools.lru_cache(maxsize=1)
def fold_table() -> dict[int, str]:
    table = {ord(c): letter for letter, likes in HOMOGLYPHS.items() for c in likes}
    for c in range(0xFF01, 0xFF5F):  # full-width forms
        plain = unicodedata.normalize("NFKC", chr(c)).lower()
        table[c] = table.get(ord(plain), plain)
    table |= dict.fromkeys((0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF), "")  # invisible
    return table


def fold(text: str) -> str:
    return text.lower().translate(fold_table())


def _beginnings(words: set[str]) -> set[str]:
    """Word beginnings of SHORTEST to LONGEST letters, and whole words with a closing blank."""
    out = {w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)}
    out.update(w + " " for w in words if len(w) < SHORTEST + 8)
    return out


def _support(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        counts = {0: Counter(), 1: Counter()}
        for text, label in zip(pdf["text"], pdf["label"], strict=True):
            counts[int(label > 0)].update(_beginnings(set(_WORD.findall(fold(text)))))
        entries = sorted(counts[0].keys() | counts[1].keys())
        if entries:
            yield pd.DataFrame({"entry": entries, "toxic": [counts[1][e] for e in entries], "clean": [counts[0][e] for e in entries]})


def learn_lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries and weights from a sample with columns text and label."""
    counted = sample.mapInPandas(_support, "entry string, toxic long, clean long")
    total = counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    found = total.where(F.col("toxic") >= LEAST_SUPPORT).withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
    rows = found.orderBy(F.desc("toxic"), F.desc("weight"), "entry").limit(MOST_ENTRIES).collect()
    support = {r.entry: r.toxic for r in rows}
    weights = {r.entry: r.weight for r in rows}
    longer: dict[str, int] = {}
    for e, n in support.items():
        longer[e[:-1]] = max(longer.get(e[:-1], 0), n)
    closed = {e for e, n in support.items() if longer.get(e, 0) < 0.95 * n}
    kept: dict[str, float] = {}
    for e in sorted(closed, key=lambda e: (len(e), e)):
        if not any(e[:k] in kept for k in range(SHORTEST, len(e))):
            kept[e] = weights[e]
    return kept


@functools.lru_cache(maxsize=4)
def automaton(lexicon: tuple[tuple[str, float], ...]):
    """Entries, with 0 for exception phrases; an entry that ends in a blank is a whole word."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for entry, weight in lexicon:
        word = entry.strip()
        old = found.get(word, (0, 0.0, True))
        found.add_word(word, (len(word), max(weight, old[1]), entry.endswith(" ") and old[2]))
    for phrase in EXCEPTIONS:
        found.add_word(phrase, (len(phrase), 0.0, False))
    if len(found):
        found.make_automaton()
    return found


def hits(folded: str, found) -> list[tuple[int, int, float]]:
    """(start, end, weight) of entries at word starts that lie in no exception phrase."""
    spans, excused = [], []
    for last, (size, weight, whole) in found.iter(folded):
        start = last + 1 - size
        if (start and folded[start - 1].isalpha()) or (whole and folded[last + 1 : last + 2].isalpha()):
            continue
        (spans if weight else excused).append((start, last + 1, weight))
    if not excused:
        return spans
    # both lists come in the order of their ends: of the phrases that end no earlier than a hit, the one that begins first decides
    ends = [b for _, b, _ in excused]
    begins = list(accumulate((a for a, _, _ in reversed(excused)), min))
    behind = [len(ends) - bisect_left(ends, b) for _, b, _ in spans]
    return [s for s, n in zip(spans, behind, strict=True) if not n or begins[n - 1] > s[0]]


def measures(text: str | None, found) -> tuple[float, float]:
    """Sum of weights and weights per hundred words, both as log(1 + x)."""
    if not text or not len(found):
        return 0.0, 0.0
    total = sum(w for _, _, w in hits(fold(text), found))
    return (math.log1p(total), math.log1p(100 * total / len(text.split()))) if total else (0.0, 0.0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights (constant first) by Newton's method with a ridge on the slopes."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge * max(1, len(x))] * (x.shape[1] - 1)) * 1e-1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


#: Curve where nothing can be learnt: any seed hit of usual weight counts as toxic.
DEFAULT_CURVE = (-3.0, 2.0, 1.0)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    per_class: int = SAMPLE_PER_CLASS,
    score_as: str = "score",
    predicted_as: str = "predicted",
) -> DataFrame:
    """A score (0 to 1) and a prediction (0 or 1) for each row of ``docs``, beside its own columns.

    ``labels`` has doc_id and toxic; rows for which ``held_out``, an expression over doc_id, is true are not learnt from.
    Null and empty texts score as texts without a hit.  Whole texts are scanned, in time that grows with their length alone.  Repeated
    rows score alike; of rows that repeat a labelled id one is learnt from, that whose text hashes lowest.  Without usable labels the seed list and
    a default curve decide.  A text with both labels counts as toxic.  The lexicon has ``MOST_ENTRIES`` entries at most, those
    of most toxic documents, of ``SHORTEST`` to ``LONGEST`` letters; longer words match by their beginnings.  Columns of ``docs`` named ``score_as`` or ``predicted_as`` are replaced.
    """
    bounded_batches(docs.sparkSession)
    sample = label_sample(labels, "toxic", ~held_out, per_class)
    given = with_labels(docs, sample, ["doc_id", "text"]).where(F.col("text").isNotNull())
    given = cut(given.groupBy("text").agg(F.max("label").alias("label")))  # small by construction; learnt from three times
    lexicon, curve = dict(SEEDS), DEFAULT_CURVE
    counts = {int(r.label > 0): r["count"] for r in given.groupBy("label").count().collect()} if len(sample) else {}
    if counts.get(0) and counts.get(1):
        lexicon |= learn_lexicon(given, counts[1], counts[0])
    entries = tuple(sorted(lexicon.items()))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = automaton(entries)
        for pdf in batches:
            x = [measures(t, found) for t in pdf["text"]]
            yield pd.DataFrame({"label": pdf["label"], "x1": [a for a, _ in x], "x2": [b for _, b in x]})

    if counts.get(0) and counts.get(1):
        fit = given.select("text", F.col("label").cast("double")).mapInPandas(measured, "label double, x1 double, x2 double").toPandas()
        curve = tuple(logistic(fit[["x1", "x2"]].to_numpy(), (fit["label"] > 0).to_numpy(float)))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = automaton(entries)
        x = np.array([measures(t, found) for t in texts]).reshape(-1, 2)
        return pd.Series(1 / (1 + np.exp(-np.clip(curve[0] + x @ np.array(curve[1:]), -30, 30))))

    scored = docs.withColumn(score_as, score(F.col("text")))
    return scored.withColumn(predicted_as, (F.col(score_as) >= 0.5).cast("int"))
