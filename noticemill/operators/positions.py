"""Pages by position: counts of ranges of the order tell where a page lies, and only those rows are sorted.

A bounded sample gives two bounds around the page; one pass counts the rows before, between and after them; the range that holds the
page is stored and split again, until few enough rows are left.  Two bounds keep the comparisons of a row few and their code short.
Where the sample was off, the page lies in an outer range, or in several, and the next round goes on from there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..sinks import scratch

#: Ranges of a round, rows sampled for their bounds, and rows that are few enough to be sorted.
RANGES = 3
SAMPLE = 20_000
FEW = 20_000
#: Standard deviations of a sampled place that the bounds keep from the page.
SURE = 4


@dataclass(frozen=True)
class Key:
    """A part of an order; nulls come last in either direction.  The parts together must tell all rows apart."""

    column: Column
    descending: bool = False

    def sorted(self) -> Column:
        return self.column.desc_nulls_last() if self.descending else self.column.asc_nulls_last()


def _before(order: list[Key], bound: Row) -> Column:
    """Whether a row (its keys in _k0, _k1, ...) comes before ``bound``, key by key."""
    before = F.lit(False)
    for i in reversed(range(len(order))):
        own, other = F.col(f"_k{i}"), bound[i]
        if other is None:
            before = own.isNotNull() | before
        else:
            less = own > F.lit(other) if order[i].descending else own < F.lit(other)
            before = F.coalesce(less | ((own == F.lit(other)) & before), F.lit(False))
    return before


def _bounds(keyed: DataFrame, order: list[Key], rows: int, sorting: list[Column], begin: int, end: int) -> list[Row]:
    """Up to two rows of a sample, one likely to come before the place ``begin`` and one after ``end``."""
    names = [f"_k{i}" for i in range(len(order))]
    sample = keyed.select(*names).sample(min(1.0, SAMPLE / rows), seed=7).orderBy(*sorting).limit(4 * SAMPLE).collect()
    share = [min(1.0, at / rows) for at in (begin, end)]
    off = [SURE * (len(sample) * p * (1 - p)) ** 0.5 + SURE for p in share]
    around = [int(len(sample) * share[0] - off[0]), int(len(sample) * share[1] + off[1]) + 1]
    return list(dict.fromkeys(sample[i] for i in around if 0 < i < len(sample)))


def rows_at(rows: DataFrame, order: list[Key], begin: int, end: int) -> DataFrame:
    """Rows from place ``begin`` up to ``end`` (from 0) of the order.  ``rows`` is read once a round and should be a stored table."""
    names = [f"_k{i}" for i in range(len(order))]
    sorting = [Key(F.col(n), k.descending).sorted() for n, k in zip(names, order, strict=True)]
    keyed = rows.withColumns({n: k.column for n, k in zip(names, order, strict=True)})
    left = keyed.count()
    while left > max(FEW, 2 * (end - begin)):
        bounds = _bounds(keyed, order, left, sorting, begin, end)
        place = reduce(lambda a, b: a + b, [(~_before(order, b)).cast("int") for b in bounds], F.lit(0))
        counts = {r.place: r["count"] for r in keyed.groupBy(place.alias("place")).count().collect()}  # one row a range
        ahead, first, last, there = 0, None, None, 0
        for i in range(len(bounds) + 1):
            n = counts.get(i, 0)
            if n and ahead < end and ahead + n > begin:
                first, skipped = (i, ahead) if first is None else (first, skipped)
                last, there = i, there + n
            ahead += n
        if first is None or there == left:
            break  # beyond the end, or rows that the order does not tell apart
        if first:
            keyed = keyed.where(~_before(order, bounds[first - 1]))
        if last < len(bounds):
            keyed = keyed.where(_before(order, bounds[last]))
        begin, end, left = begin - skipped, end - skipped, there
        keyed = scratch.stored(keyed)  # later rounds read what is left
    return keyed.orderBy(*sorting).offset(begin).limit(end - begin).drop(*names)


def page(rows: DataFrame, order: list[Key], number: int, size: int) -> DataFrame:
    """Rows of a page (from 1), in order; a page beyond the last is the last."""
    kept = scratch.stored(rows)
    pages = max(1, -(-kept.count() // size))
    at = min(max(1, number), pages)
    return rows_at(kept, order, (at - 1) * size, at * size)
