"""Quality by regularised quadratic discriminant analysis over transformed document statistics.

Each class is a normal distribution over the statistics.  Its covariance is shrunk towards the pooled one and that towards
its diagonal, so that it can be inverted whatever the sample.  A document's score is the logistic of the difference of the
two log-densities, Mahalanobis distances taken with the classes' Cholesky factors, which are computed once.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, cut, with_ids
from .labels import label_sample, with_labels

#: Bound of the labelled sample, for each label value.
SAMPLE_PER_CLASS = 10_000
#: Share of the pooled covariance in a class's, and of the diagonal in the pooled one.
TO_POOLED, TO_DIAGONAL = 0.1, 0.05

STATISTICS = ("words", "word_length", "distinct", "repeat", "upper", "digit", "sign", "short_words", "lines", "line_copies", "marks", "letters")


def _byte_classes() -> np.ndarray:
    """(256, 6): upper case, digit, other printable sign, sentence mark, letter or part of one, line end."""
    c = np.zeros((256, 6))
    b = np.arange(256)
    c[:, 0] = (b >= 65) & (b <= 90)
    c[:, 1] = (b >= 48) & (b <= 57)
    mark = np.isin(b, list(b".,;:?'\"()-"))
    letter = ((b | 32) >= 97) & ((b | 32) <= 122) | (b >= 128)
    c[:, 2] = (b > 32) & (b < 127) & ~letter & ~mark & (c[:, 1] == 0)
    c[:, 3] = mark
    c[:, 4] = letter
    c[:, 5] = b == 10
    return c


BYTE_CLASSES = _byte_classes()


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text; zeros for a null or blank one."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    upper, digit, sign, mark, letter, lines = np.bincount(raw, minlength=256) @ BYTE_CLASSES
    n, size = len(words), len(raw)
    rows = text.split("\n")
    same = sum(map(operator.eq, words, words[1:]))
    distinct = len(set(words))
    shortest = sum(len(w) <= 3 for w in words)
    return [
        np.log1p(n),
        np.log1p(size / n),
        np.log((distinct + 1) / (n**0.85 + 1)),
        np.log1p(100 * same / n),
        np.log1p(100 * upper / size),
        np.log1p(100 * digit / size),
        np.log1p(100 * sign / size),
        np.sqrt(shortest / n),
        np.log1p(100 * lines / n),
        np.log1p(100 * (1 - len(set(rows)) / len(rows))),
        np.log1p(100 * mark / size),
        np.sqrt(letter / size),
    ]


class Discriminant:
    """Two normal classes with shrunk covariances."""

    def __init__(self, x: np.ndarray, y: np.ndarray, to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL):
        self.centre, self.scale = x.mean(0), x.std(0) + 1e-6
        z = (x - self.centre) / self.scale
        own = [z[y == k] for k in (0, 1)]
        self.means = [o.mean(0) for o in own]
        spread = [np.cov(o.T, bias=True).reshape(z.shape[1], -1) for o in own]
        pooled = sum(s * len(o) for s, o in zip(spread, own, strict=True)) / len(z)
        pooled = (1 - to_diagonal) * pooled + to_diagonal * np.diag(np.diag(pooled) + 1e-3)
        self.factors = [np.linalg.cholesky((1 - to_pooled) * s + to_pooled * pooled) for s in spread]
        self.inverse = [np.linalg.inv(f) for f in self.factors]
        self.constant = [np.log(len(o) / len(z)) - np.log(np.diag(f)).sum() for o, f in zip(own, self.factors, strict=True)]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        logs = [c - 0.5 * (((z - m) @ i.T) ** 2).sum(1) for c, m, i in zip(self.constant, self.means, self.inverse, strict=True)]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -30, 30)))


def _measured(pdf: pd.DataFrame) -> tuple[None, pd.DataFrame]:
    return None, pd.DataFrame({"x": [statistics(t) for t in pdf["text"]]})


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return with_ids(batches, _measured, ["doc_id"], pa.schema([("x", pa.list_(pa.float64()))]))


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, ``score`` (0 to 1) and ``predicted`` (0 or 1) for each row of ``docs``.

    ``labels`` has doc_id and quality; rows for which ``held_out``, an expression over doc_id, is true are not learnt from.
    Statistics are of whole texts.  Null, empty and blank texts have statistics of zero and are scored like any other.  Repeated rows score alike, and one of
    them, that whose statistics hash lowest, is learnt from; an empty table gives an empty result.  If the labels do not show both classes, every score is 0.5.  Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    measured = cut(rows.mapInArrow(_measure, f"doc_id {kind}, x array<double>"))
    sample = with_labels(measured, label_sample(labels, "quality", ~held_out, per_class), ["doc_id", "x"]).toPandas()
    y = (sample["label"].to_numpy(float) > 0).astype(int) if len(sample) else np.zeros(0, dtype=int)
    model = Discriminant(np.array(sample["x"].tolist()), y) if 1 < y.sum() < len(y) - 1 else None

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist())) if model else np.full(len(x), 0.5))

    scored = measured.select("doc_id", score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
