"""Tables of pages from placed words: (page, x0, x1, top, bottom, word), as extractors of page layouts give them.

Words are put into rows by the gaps between them from top to bottom, and the first row, the header, is cut into columns by its
gaps from left to right.  Every word then falls into the column whose extent holds its left edge.  A page is read whole by one task,
with arrays over all its words; nothing is grouped by anything but the page: words that come partitioned by page are not shuffled at
all, others once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Free space, in the units of the page, that parts rows, lines of a row, and columns of the header.
ROW_GAP, LINE_GAP, COLUMN_GAP = 6.0, 0.5, 8.0
#: How far left of its header a column's text may begin.
INDENT = 4.0


def islands(rows: DataFrame, by: list[str], low: str, high: str, gap: float, name: str) -> DataFrame:
    """``rows`` with the number, from 0, of the island that [low, high] belongs to: islands have more than ``gap`` between them."""
    order = Window.partitionBy(*by).orderBy(low, high)
    reached = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = (F.col(low) > reached + gap).cast("int")
    begun = rows.withColumn("_begins", F.coalesce(begins, F.lit(0)))
    return begun.withColumn(name, F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")).drop("_begins")


def _islands(low: np.ndarray, high: np.ndarray, gap: float, group: np.ndarray | None = None) -> np.ndarray:
    """As ``islands``, each of a ``group`` if given; numbers rise from group to group.  Of what has no end, ``high`` is -inf."""
    group = np.zeros(len(low), dtype=np.int64) if group is None else group
    order = np.lexsort((high, low, group))
    ends, nth = np.unique(high[order], return_inverse=True)
    # the highest end so far of a group, as its place among all ends, groups one after another
    base = group[order] * len(ends)
    reached = ends[np.maximum.accumulate(base + nth)[:-1] - base[:-1]]
    same = group[order][1:] == group[order][:-1]
    begins = np.where(same, (low[order][1:] > reached + gap) & (reached > -np.inf), True)
    numbers = np.empty(len(low), dtype=np.int64)
    numbers[order] = np.concatenate([[0], np.cumsum(begins)])
    return numbers


def _in_order(words: pa.Array, cell: np.ndarray, line: np.ndarray, x0: np.ndarray) -> np.ndarray:
    """Places of the words by cell, line, left edge, and then by the words themselves."""
    order = np.lexsort((x0, line, cell))
    a, b = order[:-1], order[1:]
    if ((cell[a] == cell[b]) & (line[a] == line[b]) & (x0[a] == x0[b])).any():
        by_word = np.unique(np.array(words.to_pylist(), dtype=object), return_inverse=True)[1]
        order = np.lexsort((by_word, x0, line, cell))
    return order


def _lists(values: pa.Array, size: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, size), pa.int32()), values)


def _read(page: pa.Table, row_gap: float, line_gap: float, column_gap: float, indent: float) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Rows of a page below its header: their numbers, the header beside each, and their cells."""
    x0, x1, top, bottom = (page[c].to_numpy() for c in ("x0", "x1", "top", "bottom"))
    words = page["word"].combine_chunks().cast(pa.string())
    if (x1 < x0).any() or (bottom < top).any():  # words without an end: islands of equal places are told apart by all else
        by_word = np.unique(np.array(words.to_pylist(), dtype=object), return_inverse=True)[1]
        order = np.lexsort((by_word, bottom, top, x1, x0))
        x0, x1, top, bottom, words = x0[order], x1[order], top[order], bottom[order], words.take(pa.array(order))
    row = _islands(top, bottom, row_gap)
    first = row == 0
    column = np.empty(len(row), dtype=np.int64)
    column[first] = _islands(x0[first], x1[first], column_gap)
    columns = int(column[first].max()) + 1
    left = np.full(columns, np.inf)
    np.minimum.at(left, column[first], x0[first])
    column[~first] = np.searchsorted(left[1:] - indent, x0[~first], side="right")
    placed = first | (x0 < np.inf)
    row, x0, top, bottom, words = row[placed], x0[placed], top[placed], bottom[placed], words.filter(pa.array(placed))
    cell = row * columns + column[placed]
    order = _in_order(words, cell, _islands(top, bottom, line_gap, cell), x0)
    cells, begins = np.unique(cell[order], return_index=True)
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(begins, len(order)), pa.int32()), words.take(pa.array(order))), " ")
    below = np.unique(row)[1:]
    at = np.searchsorted(cells, wanted := (below[:, None] * columns + np.arange(columns)).ravel())
    found = np.append(cells, -1)[at] == wanted
    header = texts.slice(0, columns).take(pa.array(np.tile(np.arange(columns), len(below))))
    return below, _lists(header, columns), _lists(texts.take(pa.array(at, mask=~found)), columns)


def tables(words: DataFrame, row_gap: float = ROW_GAP, line_gap: float = LINE_GAP, column_gap: float = COLUMN_GAP, indent: float = INDENT) -> DataFrame:
    """page, nth, header, ord, cells of each row below a page's header; one table a page.

    Cells may be wrapped over lines of a row; header cells too.  A cell without words is null, a header without a word on a page
    means no rows.  Words left of the first column belong to it.
    """
    number = lambda c: F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))), F.lit(float("inf"))).alias(c)
    placed = words.where((F.col("word") != "") & F.col("x0").isNotNull() & F.col("top").isNotNull())
    placed = placed.select("page", *[number(c) for c in ("x0", "x1", "top", "bottom")], "word")

    def read(page: pa.Table) -> pa.Table:
        rows, header, cells = _read(page, row_gap, line_gap, column_gap, indent)
        of = page["page"].combine_chunks().take(pa.array(np.zeros(len(rows), dtype=np.int64)))
        return pa.table([of, pa.array(np.zeros(len(rows)), pa.int32()), header, pa.array(rows, pa.int32()), cells], ["page", "nth", "header", "ord", "cells"])

    return placed.groupBy("page").applyInArrow(read, f"page {placed.schema['page'].dataType.simpleString()}, nth int, header array<string>, ord int, cells array<string>")
