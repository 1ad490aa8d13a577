"""Language identification with bit-sliced Bloom filters over character n-grams.

One bit of a cell stands for one language, so that the cells of all languages' filters lie side by side: the AND of an
n-gram's cells is the set of all languages whose filter has it.  A text's n-grams are looked up together; the hits of each
language are counted, corrected for the share that its filter's fill lets through by chance, and set against the hits that the
language's own training texts had.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, cut
from .labels import sample_of_each, with_labels

#: Bound of the training sample: documents of each language.
SAMPLE_PER_LANGUAGE = 1500
#: n-grams that a language's filter takes at most, those of most documents first.
GRAMS_PER_LANGUAGE = 4000
#: Share of a language's documents that must have an n-gram, and the ratio to the language that has it most.
LEAST_SHARE, LEAST_RATIO = 0.004, 0.25
CELL_BITS, HASHES = 18, 3
SIZES = (2, 3, 4)
#: Characters that are looked up at once, about; longer texts go in parts.
CHUNK_CHARS = 1 << 17
UNDETERMINED = "und"


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_hashes(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each size: 64-bit hashes of the n-grams and the text each belongs to; and the number of letters of each text.

    Everything that is no letter reads as one blank.  An n-gram lies within a word and the blanks beside it.
    """
    parts = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    chars = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(p) for p in parts])
    letter = letters()[chars]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.cumsum([0] + [len(p) for p in parts])[:-1]] = True  # the blank before each text
    code, owner, letter = np.where(letter, chars, 32).astype(np.uint64)[keep], owner[keep], letter[keep]
    blank = ~letter
    n_letters = np.bincount(owner[letter], minlength=len(texts))
    hashes, owners = [], []
    for size in SIZES:
        n = len(code) - size + 1
        if n <= 0:
            hashes.append(np.zeros(0, dtype=np.uint64))
            owners.append(np.zeros(0, dtype=np.int32))
            continue
        good = owner[:n] == owner[size - 1 :]
        for j in range(1, size - 1):
            good &= ~blank[j : n + j]
        h = np.full(n, size, dtype=np.uint64)
        for j in range(size):
            h = (h ^ code[j : n + j]) * np.uint64(0x9E3779B97F4A7C15)
        h = h[good]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        hashes.append(h ^ (h >> np.uint64(32)))
        owners.append(owner[:n][good])
    return hashes, owners, n_letters


def parts_of(text: str | None, most: int) -> Iterator[str]:
    """A text in parts of about ``most`` characters, cut where a word ends, so that the parts have the text's n-grams."""
    text = text or ""
    if len(text) <= most:
        yield text
        return
    text, at = text.lower(), 0
    while at < len(text):
        end = min(at + most, len(text))
        while end < len(text) and text[end].isalpha():
            end += 1
        yield text[at:end]
        at = end


def grouped(texts: list[str | None]) -> Iterator[tuple[list[str], list[int]]]:
    """Parts of texts, and the text each belongs to, as many at a time as bound the memory they take."""
    group, whose, size = [], [], 0
    for k, text in enumerate(texts):
        for part in parts_of(text, CHUNK_CHARS):
            if group and size + len(part) > CHUNK_CHARS:
                yield group, whose
                group, whose, size = [], [], 0
            group.append(part)
            whose.append(k)
            size += len(part)
    if group:
        yield group, whose


def cells_of(hashes: np.ndarray) -> list[np.ndarray]:
    low = np.uint64((1 << CELL_BITS) - 1)
    return [((hashes >> np.uint64(j * CELL_BITS)) & low).astype(np.int64) for j in range(HASHES)]


class Filters:
    """Filters of up to 64 languages a slice; more languages take further slices."""

    def __init__(self, languages: list[str], grams: dict[str, np.ndarray]):
        self.languages = languages
        self.slices = np.zeros((-(-len(languages) // 64), 1 << CELL_BITS), dtype=np.uint64)
        for i, name in enumerate(languages):
            for cell in cells_of(grams[name]):
                self.slices[i // 64][cell] |= np.uint64(1 << (i % 64))
        self.chance = np.array([self._bit(self.slices[i // 64], i).mean() ** HASHES for i in range(len(languages))])
        self.usual = np.ones(len(languages))
        #: What nearly all of a language's own documents reach of the usual share.
        self.least = np.zeros(len(languages))

    @staticmethod
    def _bit(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks >> np.uint64(i % 64)) & np.uint64(1)

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of each text's n-grams in each language's filter (texts, languages); letters of each text."""
        out, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        n_letters = np.zeros(len(texts), dtype=np.int64)
        for parts, whose in grouped(texts):
            hashes, owners, letters_of = gram_hashes(parts)
            np.add.at(n_letters, whose, letters_of)
            h, owner = np.concatenate(hashes), np.asarray(whose)[np.concatenate(owners)]
            n += np.bincount(owner, minlength=len(texts))
            cells = cells_of(h)
            for s, masks in enumerate(self.slices):
                held = masks[cells[0]]
                for cell in cells[1:]:
                    held &= masks[cell]
                for i in range(64 * s, min(64 * s + 64, len(self.languages))):
                    out[:, i] += np.bincount(owner[self._bit(held, i).astype(bool)], minlength=len(texts))
        share = out / np.maximum(n, 1)[:, None]
        return np.clip((share - self.chance) / (1 - self.chance), 0, 1), n_letters

    def decide(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        share, n_letters = self.shares(texts)
        fit = share / self.usual
        best = [(int(b), bool(n)) for b, n in zip(fit.argmax(1), n_letters, strict=True)]
        names = [self.languages[b] if lettered else UNDETERMINED for b, lettered in best]
        return names, [float(min(1.0, own[b])) if lettered else 0.0 for own, (b, lettered) in zip(fit, best, strict=True)]


def _sample(docs: DataFrame, held_out: Column, per_language: int) -> pd.DataFrame:
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out).select("doc_id", "lang").distinct()
    return sample_of_each(rows, "lang", per_language).toPandas()


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each language that have an n-gram."""
    for pdf in batches:
        for name, own in pdf.groupby("label"):
            open_text, found = pd.DataFrame({"gram": np.zeros(0, np.int64), "owner": np.zeros(0, np.int64)}), []
            for parts, whose in grouped(list(own["text"])):
                hashes, owners, _ = gram_hashes(parts)
                seen = pd.DataFrame({"gram": np.concatenate(hashes).view(np.int64), "owner": np.asarray(whose)[np.concatenate(owners)]})
                seen = pd.concat([open_text, seen]).drop_duplicates()
                goes_on = seen["owner"] == whose[-1]  # its next part may be in the next group
                open_text = seen[goes_on]
                found.append(seen.loc[~goes_on, "gram"].value_counts())
            found.append(open_text["gram"].value_counts())
            counts = pd.concat(found).groupby(level=0).sum()
            yield pd.DataFrame({"lang": name, "gram": counts.index.to_numpy(), "n": counts.to_numpy()})


def learn_filters(docs: DataFrame, held_out: Column, per_language: int = SAMPLE_PER_LANGUAGE) -> Filters:
    """Filters of all languages that ``docs`` names, from a bounded sample of each.

    A filter takes at most ``GRAMS_PER_LANGUAGE`` n-grams, those that the largest share of the sample has.  Languages are as
    few as there are; their names, counts and filters are gathered on the driver, ``CELL_BITS`` and 64 languages a slice of 2 MB.
    A document named more than once, under several languages, counts for the first of them.
    """
    bounded_batches(docs.sparkSession)
    sample = _sample(docs, held_out, per_language).drop_duplicates("doc_id").rename(columns={"lang": "label"})
    languages = sorted(sample["label"].unique()) if len(sample) else []
    if not languages:
        return Filters([], {})
    given = cut(with_labels(docs, sample, ["doc_id", "text"]))  # small by construction; learnt from twice
    sizes = sample["label"].value_counts()
    counted = given.mapInPandas(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    size = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(float(sizes[k])))])
    share = counted.withColumn("share", F.col("n") / size[F.col("lang")])
    most = share.withColumn("most", F.max("share").over(Window.partitionBy("gram")))
    fit = most.where((F.col("share") >= LEAST_SHARE) & (F.col("share") >= LEAST_RATIO * F.col("most")) & ((F.col("n") > 1) | (size[F.col("lang")] == 1)))
    order = Window.partitionBy("lang").orderBy(F.desc("share"), "gram")
    kept = fit.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= GRAMS_PER_LANGUAGE).select("lang", "gram").toPandas()
    grams = {k: kept.loc[kept["lang"] == k, "gram"].to_numpy(np.int64).view(np.uint64) for k in languages}
    filters = Filters(languages, grams)

    def own_share(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            share, n = filters.shares(list(pdf["text"]))
            at = pdf["label"].map(languages.index).to_numpy()
            yield pd.DataFrame({"lang": pdf["label"], "share": share[np.arange(len(pdf)), at]})[n > 0]

    usual = given.mapInPandas(own_share, "lang string, share double").groupBy("lang").agg(F.median("share").alias("share"), F.percentile("share", 0.001).alias("low"))
    for name, value, low in usual.collect():  # one row a language
        filters.usual[languages.index(name)] = max(value, 1e-3)
        filters.least[languages.index(name)] = low / max(value, 1e-3)
    return filters


def identify(docs: DataFrame, filters: Filters, predicted_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """A language and a score (0 to 1) for each row of ``docs``, beside its own columns.

    Null texts and texts without a letter are ``und`` with score 0, as is every text where nothing was learnt.  Repeated rows
    get equal values; an empty table stays empty.  Columns of ``docs`` of the two
    names are replaced.  Whole texts are looked up, long ones in parts.  Of languages that fit equally well the first name wins.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = filters.decide(list(texts))
        return pd.DataFrame({"lang_pred": names, "score": scores})

    own = [c for c in docs.columns if c not in (predicted_as, score_as)]
    found = docs.select(F.struct(*own).alias("row"), predict(F.col("text")).alias("found"))
    return found.select("row.*", F.col("found.lang_pred").alias(predicted_as), F.col("found.score").alias(score_as))
