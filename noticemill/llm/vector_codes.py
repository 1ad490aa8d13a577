"""Vectors as codes of a product quantiser, its nearest entries found by annular pruning.

Vectors are cut into parts; each part position has a codebook of whole numbers that a few rounds of Lloyd's algorithm improve.
To find the entry nearest to a part, a codebook is sorted by norm.  An entry at distance d lies in the annulus of norms within
d of the part's own norm, so the best of a few entries of about the same norm bounds, by binary search, the interval of entries
that can be nearer or as near.  Only that annulus, its ends included, is evaluated, in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, forget, stored
from .top_k import quantised
from .whitening import matrix

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Entries of about a part's norm that are tried first, and parts of similar norms that are evaluated together.
PROBES = 8
TOGETHER = 256


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))


class Codebook:
    """Entries of one part position, sorted by norm."""

    def __init__(self, entries: list[list[int]]):
        self.entries = np.array(entries, dtype=object).reshape(len(entries), -1)
        self.largest = max(abs(v) for row in entries for v in row)
        norms = np.sqrt((self.entries * self.entries).sum(1).astype(np.float64))
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the entry nearest to each row; ties go to the lower number.

        Doubles hold all whole numbers involved below 2^53, which lets products of matrices do the work; beyond, whole numbers of
        any size are used.
        """
        exact = np.float64 if x.shape[1] * (_largest(x) + self.largest) ** 2 < 1 << 53 else object
        entries, x = self.entries[self.order].astype(exact), x.astype(exact)
        squares, own = (entries * entries).sum(1), (x * x).sum(1)
        norm = np.sqrt(own.astype(np.float64))
        probes = min(PROBES, len(entries))
        tried = np.clip(np.searchsorted(self.norms, norm) - probes // 2, 0, len(entries) - probes)
        best = own + squares[tried] - 2 * (x * entries[tried]).sum(1)
        for k in range(1, probes):
            best = np.minimum(best, own + squares[tried + k] - 2 * (x * entries[tried + k]).sum(1))
        radius = np.sqrt(best.astype(np.float64))
        radius += 1e-9 * (radius + norm + 1)  # roots are rounded; a wider annulus costs little
        low = np.searchsorted(self.norms, norm - radius, "left")
        high = np.searchsorted(self.norms, norm + radius, "right")
        number, distance = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=exact)
        by_norm = np.argsort(norm, kind="stable")
        for at in range(0, len(x), TOGETHER):
            rows = by_norm[at : at + TOGETHER]
            a, b = low[rows].min(), high[rows].max()
            d = own[rows][:, None] + squares[a:b] - 2 * (x[rows] @ entries[a:b].T)
            least = d.min(1)
            number[rows] = np.where(d == least[:, None], self.order[a:b], len(self.order)).min(1)
            distance[rows] = least
        return number, distance if exact is object else distance.astype(np.int64)


Codebooks = list[list[list[int]]]


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the ``entries`` smallest ids, in their order; of rows that repeat an id the smallest vector counts."""
    ids = vectors.select(F.col("id").alias("first")).distinct().orderBy(F.col("first").asc_nulls_last()).limit(entries)
    chosen = vectors.join(F.broadcast(ids), F.col("id").eqNullSafe(F.col("first")), "left_semi")  # at most ``entries`` rows are sent
    rows = chosen.groupBy("id").agg(F.min("q").alias("q")).orderBy(F.col("id").asc_nulls_last()).collect()
    width = len(rows[0].q) // parts
    return [[list(r.q[p * width : (p + 1) * width]) for r in rows] for p in range(parts)]


def assigned(x: np.ndarray, books: list[Codebook]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each part of the rows, with the numbers of its nearest entries and their distances."""
    width = x.shape[1] // len(books)
    for p, book in enumerate(books):
        own = x[:, p * width : (p + 1) * width]
        yield own, *book.nearest(own)


def improved(vectors: DataFrame, codebooks: Codebooks) -> Codebooks:
    """Codebooks after one round: entries become the floor of the mean of their parts, unused ones stay.

    Partitions send sums only, one row for each entry that they use; what returns is as large as the codebooks.
    """
    dims = len(codebooks) * len(codebooks[0][0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in codebooks]
        totals = [np.zeros(b.entries.shape, dtype=np.int64) for b in books]
        counts = [np.zeros(len(b.entries), dtype=np.int64) for b in books]
        room = 1 << 62  # what a sum of longs can still take
        for batch in batches:
            x = matrix(batch.column("q"), dims)
            room -= len(x) * _largest(x)
            if room < 0 and totals[0].dtype != object:
                totals = [t.astype(object) for t in totals]
            for p, (own, number, _) in enumerate(assigned(x, books)):
                np.add.at(totals[p], number, own.astype(totals[p].dtype))
                counts[p] += np.bincount(number, minlength=len(counts[p]))
        used = [(p, e) for p, c in enumerate(counts) for e in np.flatnonzero(c)]
        arrays = [
            pa.array([p for p, _ in used], pa.int32()),
            pa.array([e for _, e in used], pa.int32()),
            pa.array([counts[p][e] for p, e in used], pa.int64()),
            pa.array([[Decimal(int(v)) for v in totals[p][e]] for p, e in used], pa.list_(pa.decimal128(38, 0))),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "n", "sums"])

    partial = vectors.select("q").mapInArrow(sums, "part int, entry int, n long, sums array<decimal(38,0)>")
    each = partial.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
    whole = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    new = [[list(e) for e in b] for b in codebooks]
    for r in whole.collect():  # as many numbers as the codebooks have
        new[r.part][r.entry][r.at] = int(r.x) // r.n
    return new


def learn(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks by part, entry and position, after ``rounds`` rounds over all ``vectors`` (id, q); none for an empty table."""
    sizes = vectors.agg(F.min(F.size("q")).alias("low"), F.max(F.size("q")).alias("high")).first()
    if sizes.low is None:
        return []
    if sizes.low != sizes.high or sizes.low % parts:
        raise ValueError(f"vectors of {sizes.low} to {sizes.high} components cannot be cut into {parts} equal parts")
    codebooks = first_codebooks(vectors, parts, entries)
    for _ in range(rounds):
        codebooks = improved(vectors, codebooks)
    return codebooks


def encode(vectors: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``vectors`` (q and others) with codes array<int> and error decimal(38,0) instead of q."""
    kept = [c for c in vectors.columns if c != "q"]
    dims = len(codebooks) * len(codebooks[0][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in codebooks]
        for batch in batches:
            found = [(number, distance.astype(object)) for _, number, distance in assigned(matrix(batch.column("q"), dims), books)]
            codes = np.stack([n for n, _ in found], axis=1).astype(np.int32)
            error = sum(d for _, d in found)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, len(books)), pa.int32()), pa.array(codes.ravel()))
            exact = pa.array([Decimal(int(e)) if e < 10**38 else None for e in error], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], listed, exact], [*kept, "codes", "error"])

    kinds = ", ".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in kept)
    return vectors.mapInArrow(run, f"{kinds}, codes array<int>, error decimal(38,0)")


def with_sums(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over equal keys, nulls together.

    The sums are sent to the rows if there are at most ``BROADCAST_ROWS``.  Of more keys those with more than their share of rows
    are sent, which cannot be more than that, and only the others are dealt by key: no key gathers in one task.
    """
    sums = stored(rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(name), F.count("*").alias("_rows")))
    size = sums.agg(F.count("*").alias("keys"), F.sum("_rows").alias("rows")).first()
    same: Column = F.col(key).eqNullSafe(F.col("_key"))
    joined: Callable = lambda left, right: left.join(right, same).drop("_key", "_rows")
    if size.keys <= BROADCAST_ROWS:
        return joined(rows, F.broadcast(sums))
    hot = sums.where(F.col("_rows") * BROADCAST_ROWS > size.rows)
    rest = rows.join(F.broadcast(hot), same, "left_anti")
    return joined(rows, F.broadcast(hot)).unionByName(joined(rest, sums.where(F.col("_rows") * BROADCAST_ROWS <= size.rows)))


def digest(codebooks: Codebooks) -> str:
    """sha256 of all entries' components as decimal numbers, by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for b in codebooks for e in b for v in e).encode()).hexdigest()


def compress(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, Codebooks]:
    """The id, codes array<int>, error and label_error (decimals) of each usable row, and the codebooks.

    Components become floor(scale * x); beyond the range of a long they count as its ends.  Rows whose vector is null, empty, or
    has a null or non-finite component take no part; ids and labels may be null, and null ids sort last when the codebooks are
    begun.  With fewer ids than ``entries`` the codebooks are that much smaller.  Rows that repeat an id are coded each; ties go to
    lower entries.  An error of more than 38 digits is null.  An empty table gives an empty result and no codebooks; vectors
    of several lengths, or that cannot be cut evenly, are refused.  Other columns are not read.
    """
    named = rows.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    vectors = stored(quantised(named, "v", scale).where(F.size("q") > 0).select("id", "label", "q"))
    codebooks = learn(vectors, parts, entries, rounds)
    if codebooks:
        coded = with_sums(stored(encode(vectors, codebooks)), "label", "error", "label_error")
        forget(vectors)
    else:
        kinds = {"codes": "array<int>", "error": "decimal(38,0)", "label_error": "decimal(38,0)"}
        coded = vectors.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items()})
    return coded.select(F.col("id").alias(id_col), "codes", "error", "label_error"), codebooks
