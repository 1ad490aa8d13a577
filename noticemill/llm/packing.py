"""Packing token sequences: window-filling combinations whose repeat counts come from non-negative least squares.

1. One pass over the texts gives *pieces*: each document's ids plus the closing id, cut at multiples of the window.  Only the
   last piece of a document is shorter than a window.
2. Piece lengths are rounded up to ``unit`` ids; those below ``SHORT`` stay as they are.  That leaves some two hundred classes,
   named by their width in ids, whatever the input's size.  The histogram of the classes is all that reaches the driver.
3. All combinations of at most ``depth`` rounded classes that fill a window exactly are enumerated.  Non-negative least squares finds
   how often to repeat each so that together they use up the histogram; the counts are rounded down.
4. What the rounding leaves over is packed greedily, largest class first.
5. Each piece gets its rank within its class (hash buckets, bucket offsets), and the rank decides sequence and slot.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, cut, with_ids
from .tokens import encoder, id_runs

WINDOW = 4096
END_ID = 2
UNIT = 32
#: Pieces of fewer ids have a class for each length.
SHORT = 64
DEPTH = 4
#: Pieces of one class that are ranked together.
BUCKET_ROWS = 20_000


def combinations(total: int, depth: int) -> np.ndarray:
    """Every multiset of at most ``depth`` classes 1..total that adds up to ``total``; one row each, filled up with zeros."""
    found: list[tuple[int, ...]] = []

    def extend(parts: tuple[int, ...], rest: int, most: int) -> None:
        if not rest:
            found.append(parts + (0,) * (depth - len(parts)))
        elif len(parts) < depth:
            for x in range(min(rest, most), (rest - 1) // (depth - len(parts)), -1):
                extend((*parts, x), rest - x, x)

    extend((), total, total)
    return np.array(found, dtype=np.int64)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """min |a x - b| with x >= 0 by the active-set method."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], dtype=bool)
    slack = 1e-9 * max(1.0, np.abs(b).max(initial=0.0))
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        if gain.max(initial=-np.inf) <= slack:
            break
        free[int(gain.argmax())] = True
        while True:
            own = np.flatnonzero(free)
            z = np.linalg.lstsq(a[:, own], b, rcond=None)[0]
            if (z > slack).all():
                x[:] = 0
                x[own] = z
                break
            low = z <= slack
            step = np.min(x[own][low] / np.maximum(x[own][low] - z[low], 1e-300))
            x[own] += step * (z - x[own])
            free[own[low & (x[own] <= slack)]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


def plan(histogram: np.ndarray, depth: int = DEPTH, unit: int = 1) -> list[tuple[list[int], int]]:
    """(widths of one sequence, number of such sequences) that use each width as often as ``histogram`` (by width) says.

    Combinations are made of the multiples of ``unit``; the greedy rest takes all widths.
    """
    left = histogram.astype(np.int64).copy()
    window = len(left) - 1
    units = window // unit
    made: list[tuple[list[int], int]] = []

    def take(parts: list[int], most: int) -> None:
        kinds, uses = np.unique(parts, return_counts=True)
        n = int(min(most, (left[kinds] // uses).min()))
        if n > 0:
            left[kinds] -= n * uses
            made.append((parts, n))

    if left.sum() > 0:
        take([window], int(left[window]))
        combos = combinations(units, depth)[1:]
        rounded = left[::unit]
        combos = combos[(np.where(combos > 0, rounded[combos], 1) > 0).all(1)]
        if len(combos):
            a = np.zeros((units + 1, len(combos)))
            for column in combos.T:
                np.add.at(a, (column, np.arange(len(combos))), column > 0)
            x = nnls(a, rounded.astype(float))
            for j in np.argsort(-x, kind="stable"):
                if x[j] < 1:
                    break
                take([unit * int(c) for c in combos[j] if c], int(x[j]))
    while left.any():
        parts, room, spare = [], window, left.copy()
        while room and (fits := np.flatnonzero(spare[: room + 1])).size:
            k = int(fits[-1])
            parts += [k] * (n := min(int(spare[k]), room // k))
            spare[k] -= n
            room -= n * k
        take(parts, int(left.max()))
    return made


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens (and ids)."""
    bounded_batches(docs.sparkSession)
    tail = np.array([end_id], dtype="<u4").tobytes()

    made = ["start", "length", "ids_crc32", "doc_tokens"]
    schema = pa.schema([*((c, pa.int64()) for c in made), *[("ids", pa.list_(pa.int64()))] * keep_ids])

    def pieces_of(pdf: pd.DataFrame) -> tuple[list[int], pd.DataFrame]:
        enc, places, rows = encoder(path), [], []
        for place, text in enumerate(pdf["text"]):
            first, at, rest = len(rows), 0, b""
            for ids in chain(id_runs(enc, text or ""), [tail]):
                rest += ids
                whole = len(rest) // (4 * window) * window
                for begin in range(0, whole, window):
                    rows.append((at + begin, rest[4 * begin : 4 * (begin + window)]))
                at, rest = at + whole, rest[4 * whole :]
            if rest:
                rows.append((at, rest))
            n = rows[-1][0] + (len(rows[-1][1]) >> 2)
            for i in range(first, len(rows)):
                at, own = rows[i]
                row = (at, len(own) >> 2, zlib.crc32(own), n)
                rows[i] = (*row, np.frombuffer(own, "<u4").astype(np.int64)) if keep_ids else row
            places += [place] * (len(rows) - first)
        return places, pd.DataFrame(rows, columns=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return with_ids(batches, pieces_of, ["doc_id"], schema)

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * keep_ids)


def pack(
    docs: DataFrame,
    path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    unit: int = UNIT,
    depth: int = DEPTH,
    keep_ids: bool = False,
) -> DataFrame:
    """Place every id of every document into exactly one sequence of at most ``window`` ids.

    Null and empty texts give the single closing id.  Long texts are encoded from one stable boundary to the next.  Rows with the same id or text are packed one by one; other columns are
    not read; an empty table gives an empty result.  Pieces of one sequence have offsets without gaps from 0.  With
    ``keep_ids`` the ids themselves are returned too.
    """
    length = F.col("length")
    width = F.when(length < SHORT, length).otherwise(F.least(unit * F.ceil(length / unit), F.lit(window)))
    made = cut(pieces(docs, path, window, end_id, keep_ids).withColumn("klass", width.cast("int")))
    histogram = np.zeros(window + 1, dtype=np.int64)
    for klass, n in made.groupBy("klass").count().collect():  # one row for each class
        histogram[klass] = n
    steps: dict[int, list[tuple[int, int, int, int]]] = {}
    used, first = np.zeros(window + 1, dtype=np.int64), 0
    for parts, n in plan(histogram, depth, unit):
        slot = 0
        for klass in sorted(set(parts), reverse=True):
            m = parts.count(klass)
            steps.setdefault(klass, []).append((int(used[klass]), first, m, slot))
            used[klass] += n * m
            slot += m
        first += n
    lookup = {k: np.array(v, dtype=np.int64) for k, v in steps.items()}
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * keep_ids]

    def placed_at(pdf: pd.DataFrame) -> tuple[None, pd.DataFrame]:
        sequence, slot = np.zeros(len(pdf), dtype=np.int64), np.zeros(len(pdf), dtype=np.int64)
        klass, rank = pdf["klass"].to_numpy(), pdf["rank"].to_numpy()
        for k in np.unique(klass):
            own = np.flatnonzero(klass == k)
            at = lookup[int(k)][np.searchsorted(lookup[int(k)][:, 0], rank[own], side="right") - 1]
            ahead = rank[own] - at[:, 0]
            sequence[own] = at[:, 1] + ahead // at[:, 2]
            slot[own] = at[:, 3] + ahead % at[:, 2]
        return None, pd.DataFrame({"sequence_id": sequence, "slot": slot})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return with_ids(batches, placed_at, columns, pa.schema([("sequence_id", pa.int64()), ("slot", pa.int64())]))

    buckets = max(1, -(-int(histogram.sum()) // BUCKET_ROWS))
    keyed = made.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    sizes = keyed.groupBy("klass", "bucket").count()
    before = Window.partitionBy("klass").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("klass", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    order = Window.partitionBy("klass", "bucket").orderBy("doc_id", "start", "ids_crc32", "length", "doc_tokens")
    ranked = keyed.withColumn("nth", F.row_number().over(order)).join(offsets, ["klass", "bucket"])
    ranked = ranked.select(*columns, "klass", (F.col("nth") - 1 + F.col("ahead")).cast("long").alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name in columns)
    placed = ranked.mapInArrow(place, schema + ", sequence_id long, slot long")
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")
    return placed.withColumn("offset", offset).drop("slot")
