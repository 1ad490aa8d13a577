"""Bounded, repeatable samples of labelled rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 30


def sample_of_each(rows: DataFrame, label: str, per_label: int, id_col: str = "doc_id") -> DataFrame:
    """About ``per_label`` rows of each label, those whose ids hash low; all rows of labels that have no more.

    The threshold follows from the labels' counts, so that nothing is sorted or shuffled.  A sample exceeds ``per_label`` by a
    few times its square root at most.  Rows must be distinct.
    """
    counts = [(r[0], r[1]) for r in rows.groupBy(label).count().collect()]  # one row a label
    if not counts:
        return rows.limit(0)
    limit = F.create_map(*[F.lit(x) for k, n in counts for x in (k, min(_RANGE, -(-per_label * _RANGE // n)))])
    return rows.where(F.pmod(F.xxhash64(id_col), F.lit(_RANGE)) < limit[F.col(label)])


def label_sample(labels: DataFrame, label: str, trained: Column, per_class: int, id_col: str = "doc_id") -> pd.DataFrame:
    """About ``per_class`` ids of each label value at most: columns doc_id, label.

    ``trained`` says which rows may be learnt from.  Null ids and labels are left out; an id that is labelled more than once
    counts once, with its largest label.
    """
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & trained)
    each = rows.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label).alias("label"))
    return sample_of_each(each, "label", per_class).toPandas()


def with_labels(docs: DataFrame, sample: pd.DataFrame, columns: list[str]) -> DataFrame:
    """The sample's documents with their labels; the sample is small by construction, so it travels to the documents.

    Of rows that repeat an id one is taken, that whose values hash lowest, so that the sample is bounded in rows as well.
    """
    if sample.empty:
        return docs.select(*columns).withColumn("label", F.lit(None).cast("int")).limit(0)
    small = docs.sparkSession.createDataFrame(sample[["doc_id", "label"]])
    given = docs.select(*columns).join(F.broadcast(small), "doc_id")
    rest = [c for c in given.columns if c != "doc_id"]
    return given.groupBy("doc_id").agg(F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("row")).select("doc_id", "row.*")
