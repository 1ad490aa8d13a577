"""Documents to packed training sequences, one stage after another.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's
docs.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticemill.llm import language, mixing, near_duplicates, packing, toxicity
from noticemill.llm.common import remove_folder, shared_folder, table
from noticemill.llm.queries import vocabulary

#: Share of a text's n-grams, set against what is usual, that its best language must have, and the part of what nearly all of
#: that language's own documents have; the larger of the two decides.
LEAST_LANGUAGE_SCORE, LEAST_OF_OWN = 0.3, 0.8


def _whole(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of each row beside the whole row, so that a stage's own columns never meet the caller's."""
    return docs.select(*columns, F.struct("*").alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon does not reject; null and empty texts stay, repeated rows fare alike.

    Whole texts are scanned, of any length.  An empty table stays empty; columns of any name come back as they are.
    """
    scored = toxicity.score_toxicity(_whole(docs, "doc_id", "text"), table(spark, sf_dir, "labels"), F.lit(False))
    return scored.where(F.col("predicted") == 0).select("row.*")


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the collection names; texts without letters, null ones too, and those that fit none go.

    Where no document names a language nothing can be learnt, and all stay, as does an empty table.  Repeated rows fare alike; long
    texts are looked up whole, part by part; columns of any name come back as they are.
    """
    filters = language.learn_filters(docs, F.lit(False))
    if not filters.languages:
        return docs
    found = language.identify(_whole(docs, "text"), filters)
    least = F.lit(1.0)
    for name, own in zip(filters.languages, filters.least, strict=True):
        least = F.when(F.col("lang_pred") == name, max(LEAST_LANGUAGE_SCORE, LEAST_OF_OWN * float(own))).otherwise(least)
    return found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= least)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by five-word shingles at 80 percent; texts without words all stay.

    Rows with a null id stay; of rows that repeat an id one does.  Texts of any length are compared whole.  An empty table stays
    empty; columns of any name come back as they are.
    """
    return near_duplicates.one_of_each(docs, width=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; those without words go.

    Null sources are one source, null ids are ids.  A very long document is taken whole or not.  An empty table stays empty;
    columns of any name come back as they are.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed into sequences; a null text is one closing id.

    Repeated rows are packed each; long texts are cut into pieces of a window.  An empty table gives no pieces; only id and text
    are read.
    """
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The stages learn, sketch and tokenise; SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written once and read again, and removed when the next is written."""
    docs = table(spark, sf_dir, "documents")
    folder, before = shared_folder(spark), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
