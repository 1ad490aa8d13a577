"""Similarity join of documents by the n-grams they have in common, partitioned vertically.

The global order of all n-grams is that of their hashes.  It is cut into fragments, and a document's set into one segment for
each fragment.

*Candidates.*  Two sets of sizes n and m that reach the similarity J differ in at most (n + m) (1 - J) / (1 + J) n-grams.  For each
class of sizes the order is cut into more fragments than that, so that similar sets have at least one whole segment in common,
whatever the n-grams; no pair is lost.  Segments hold some nine n-grams at J = 0.9, hence frequent passages bring few documents
together.  A document meets the smallest document that it shares segments with.

*Overlaps.*  Candidate pairs are counted fragment by fragment, with fragments of bounded size: each place compares the segments of
one fragment only and tells how many n-grams are common; the sum over a pair's fragments is its exact overlap.

Linked pairs join components.  Segments that documents of different components share are then looked at again, all their members
against each other, until no pair that may be similar is left between two components: links inside a component change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import near_duplicates as nd
from .common import bounded_batches, forget, matched, stored

WIDTH, SIMILARITY = 3, 0.9
#: N-grams of a segment whose overlap is counted in one place, on average at most.
SEGMENT = 1 << 13
#: Segment keys that a task hands over at a time.
KEYS = 1 << 18
_LARGEST = 1 << 40


def size_classes(share: Fraction) -> np.ndarray:
    """Least sizes of the classes.  Sets of similar sizes lie in one class or in two that follow each other."""
    lows = [1]
    while lows[-1] < _LARGEST:
        lows.append(lows[-1] * share.denominator // share.numerator + 1)
    return np.array(lows)


def cut_of(most: int, share: Fraction) -> tuple[int, int, int]:
    """For pairs of sets of at most ``most`` n-grams: how many n-grams they may differ in, fragments, and empty ones let pass.

    At least ``spare`` + 1 of the fragments agree.  A set with no more than ``spare`` empty segments thus has one that is not empty
    among them, and need not offer its empty ones, which many sets have in common by chance.
    """
    apart = 2 * most * (share.denominator - share.numerator) // (share.denominator + share.numerator)
    spare = 1 + apart // 256
    return apart, apart + 1 + spare, spare


def segment_keys(grams: np.ndarray, lows: np.ndarray, share: Fraction) -> np.ndarray:
    """Keys of a set's segments, as a member of its own class and of the next, whose smaller sets may be like it."""
    size_class = int(np.searchsorted(lows, len(grams), "right")) - 1
    mixed, found = nd.mix(grams ^ np.uint64(nd.SEED)), []
    for scheme in (size_class, size_class + 1):
        apart, fragments, spare = cut_of(int(lows[scheme + 1]) - 1, share)
        if not apart:
            continue  # sets of these sizes are linked only if they are equal
        at = ((grams >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        name = nd.mix(at[first] + np.uint64(scheme << 44))
        found.append(nd.mix(np.add.reduceat(mixed, first) + name))
        if fragments - len(first) > spare:
            empty = np.setdiff1d(np.arange(fragments, dtype=np.uint64), at[first])
            found.append(nd.mix(nd.mix(empty + np.uint64(scheme << 44))))
    return np.concatenate([np.zeros(0, dtype=np.uint64), *found]).view(np.int64)


def sketch(docs: DataFrame, width: int, share: Fraction) -> DataFrame:
    """doc_id, identity of the set, segment keys and parity of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows = size_classes(share)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())

        def made(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([ids, *arrays], ["doc_id", *nd.SET, "keys", "parity"])

        for batch in batches:
            rows, begin, room = [], 0, KEYS
            for i, text in enumerate(batch.column("text")):
                grams = nd.shingles(text.as_py(), width)
                keys = segment_keys(grams, lows, share) if len(grams) else None
                rows.append((*nd.identity(grams), keys, nd.parity(grams)) if len(grams) else (0, 0, 0, None, None))
                room -= 0 if keys is None else len(keys)
                if room < 0 or i + 1 == batch.num_rows:
                    yield made(batch.column("doc_id").slice(begin, len(rows)), rows)
                    rows, begin, room = [], i + 1, KEYS

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, sum1 long, sum2 long, keys array<long>, parity binary")


def fragments_of(size: Column) -> Column:
    """Fragments, a power of two, that the overlap of sets of up to ``size`` n-grams is counted in."""
    return F.pow(F.lit(2), F.ceil(F.log2(F.ceil(size / SEGMENT)))).cast("long")


def segments(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """doc_id, cut, fragment and n-grams (sorted hashes) of the documents and cuts that ``wanted`` (doc_id, identity, cut) names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            identities = list(zip(*[batch.column(c).to_pylist() for c in nd.SET], strict=True))
            for i, text in enumerate(batch.column("text")):
                grams = nd.shingles(text.as_py(), width)
                if nd.identity(grams) != identities[i]:
                    continue  # another text of a repeated id
                cut, doc = batch.column("cut")[i].as_py(), batch.column("doc_id")[i].as_py()
                at = ((grams >> np.uint64(32)) * np.uint64(cut)) >> np.uint64(32)
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                parts = [p.tobytes() for p in np.split(grams, first[1:])]
                arrays = [pa.array([doc] * len(parts), pa.int64()), pa.array([cut] * len(parts), pa.int64()), pa.array(at[first].astype(np.int64)), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "cut", "fragment", "grams"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = matched(rows, wanted, ["doc_id"]).select("doc_id", "text", "cut", *nd.SET)
    return found.mapInArrow(run, "doc_id long, cut long, fragment long, grams binary")


def partial_overlaps(segments: DataFrame, ends: DataFrame) -> DataFrame:
    """x, y, common: n-grams that the pairs of ``ends`` (x, y, cut, slice, with a row x = y for each slice) share in each fragment."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub, place, last = np.zeros(0, dtype=np.uint64), None, None
        for pdf in batches:
            out = []
            for x, cut, part, fragment, y, grams in pdf.itertuples(index=False):
                own = np.frombuffer(grams, dtype=np.uint64)
                if (x, cut, part, fragment, y) == last:
                    continue  # a repeated row of one document
                last = (x, cut, part, fragment, y)
                if x == y:
                    hub, place = own, last[:4]
                elif place == last[:4]:
                    out.append((x, y, len(np.intersect1d(hub, own, assume_unique=True))))
            yield pd.DataFrame(out, columns=["x", "y", "common"], dtype="int64")

    met = matched(segments.withColumnRenamed("doc_id", "y"), ends, ["y", "cut"])
    place = ["x", "cut", "slice", "fragment"]
    dealt = met.repartition(*place).sortWithinPartitions(*place, "y")  # x < y, so that x comes first
    return dealt.select(*place, "y", "grams").mapInPandas(run, "x long, y long, common long")


class FragmentLinking(nd.Linking):
    """Confirms pairs by overlaps that are counted fragment by fragment."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, width: int, similarity: float):
        super().__init__(docs, nodes, width, similarity)
        self.share = Fraction(str(similarity))

    def texts_of(self, pairs: DataFrame) -> DataFrame:
        return self.nodes.select("doc_id", *nd.SET)

    def confirmed(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        size = lambda end: self.nodes.select(F.col("doc_id").alias(end), F.col("n_shingles").alias(f"n_{end}"))
        both = pairs.select("x", "y").join(size("x"), "x").join(size("y"), "y")
        sized = stored(both.withColumn("cut", fragments_of(F.greatest("n_x", "n_y"))))
        ends = stored(nd.with_hubs(nd.sliced(sized.select("x", "y", "cut"), ["x", "cut"])))
        wanted = stored(texts.join(ends.select(F.col("y").alias("doc_id"), "cut").distinct(), "doc_id"))
        overlaps = partial_overlaps(segments(self.docs, wanted, self.width), ends)
        sums = overlaps.groupBy("x", "y").agg(F.sum("common").alias("common"))
        common = F.coalesce("common", F.lit(0))
        linked = self.share.denominator * common >= self.share.numerator * (F.col("n_x") + F.col("n_y") - common)
        checked = stored(sized.join(sums, ["x", "y"], "left").select("x", "y", linked.alias("linked")))
        forget(sized, ends, wanted)
        return checked


def _similar_sizes(n: str, m: str, share: Fraction) -> Column:
    return F.least(n, m) * share.denominator >= F.greatest(n, m) * share.numerator


def first_pairs(met: DataFrame, share: Fraction) -> DataFrame:
    """x < y, written: each document with one of the smallest documents of its segments, that with which it shares the most."""
    least = F.min(F.struct("doc_id", "n_shingles")).alias("least")
    hubs = stored(met.groupBy("key").agg(least).select("key", F.col("least.doc_id").alias("hub"), F.col("least.n_shingles").alias("hub_n")))
    met = matched(met, hubs, ["key"])
    others = met.where((F.col("doc_id") != F.col("hub")) & _similar_sizes("n_shingles", "hub_n", share))
    counted = others.groupBy("doc_id", "hub").agg(F.count("*").alias("shared"))
    best = counted.groupBy("doc_id").agg(F.max(F.struct("shared", -F.col("hub"))).alias("best"))
    pairs = stored(best.select((-F.col("best.col2")).alias("x"), F.col("doc_id").alias("y")))
    forget(hubs)
    return pairs


def open_keys(met: DataFrame, state: nd.Linking) -> DataFrame:
    """Keys whose documents are of several components; one key for each set of documents, none for a pair that failed."""
    label = F.col("doc_id")
    if state.labels is not None:
        met = met.join(state.labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        label = F.coalesce("label", "doc_id")
    ends = {"x": F.min("doc_id"), "y": F.max("doc_id"), "low": F.min(label), "high": F.max(label)}
    of_set = {"members": F.count("*"), "set1": F.bit_xor(F.xxhash64("doc_id")), "set2": F.bit_xor(F.xxhash64("doc_id", F.lit(1)))}
    each = met.groupBy("key").agg(*[v.alias(k) for k, v in (ends | of_set).items()]).where(F.col("low") < F.col("high"))
    if state.failed is not None:
        fell = state.failed.select("x", "y", F.lit(2).cast("long").alias("members")).distinct()
        each = each.join(fell, ["x", "y", "members"], "left_anti")
    return each.groupBy("x", "y", *of_set).agg(F.min("key").alias("key")).select("key")


def _linked(docs: DataFrame, nodes: DataFrame, width: int, similarity: float) -> DataFrame | None:
    share = Fraction(str(similarity))
    keyed = nodes.select("doc_id", "n_shingles", F.explode("keys").alias("key"))
    # keys are counted alone: most are a single document's, and only the others are dealt with their documents
    shared = stored(keyed.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > 1).select("key"))
    met = stored(matched(keyed, shared, ["key"], "left_semi"))
    state = FragmentLinking(docs, nodes.drop("keys"), width, similarity)
    pairs = first_pairs(met, share)
    state.confirm(pairs)
    keys = stored(open_keys(met.select("key", "doc_id"), state))
    if not keys.isEmpty():
        rows = stored(matched(met.select("key", "doc_id"), keys, ["key"], "left_semi"))
        # the segment is the whole key: there is no second one to tell buckets apart by
        group = {"band": F.lit(0), "second": F.lit(bytes(nd.ROWS))}
        payload = ["doc_id", "n_shingles", "label", "parity", "failed"]
        state.settle(lambda n: nd.in_blocks(rows.join(n.select(*payload), "doc_id").withColumns(group)), again=True)
        forget(rows)
    forget(shared, met, pairs, keys)
    return state.close()


def jaccard_components(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles and component_id, the smallest id reachable by links.

    Documents link when common / all distinct n-grams reach ``similarity``, read as the decimal fraction that it is written as.
    Words are runs without ASCII white space, A-Z in lower case.  Texts with fewer words than ``width`` have their whole sequence as
    one n-gram; null and empty texts and those without a word have none and are linked with nothing.  Whole texts are read, of
    any length; overlaps of long ones are counted in several places.  Rows that repeat an id are one document, that of the text
    with the most n-grams; each row tells the size of its own.  A row whose id is null is linked with nothing and has no
    component.  Other columns are not read; an empty table gives an empty result.
    """
    rows = nd.Sketched(sketch(docs, width, Fraction(str(similarity))), ["keys", "parity"])
    return rows.placed(_linked(docs, rows.nodes, width, similarity))
