"""Exact top-k inner products with a bit-sliced index.

Each component of the vectors becomes an integer.  Blocks of candidate rows are stored by bit: slice b of attribute d is a
bitmap of the rows whose (value - smallest value) has bit b set.  A query's score is a sum of slices with weights that are
powers of two, taken from the bits of its components; full adders over whole bitmaps reduce the slices of each weight to one,
which leaves the slices of the score.  From the most significant slice downward, rows are surely in, surely out or tied; ties
at the boundary, all of equal score, go to the smaller ids.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, stored

#: Rows of an index block and queries of a query block, on average.
BLOCK_ROWS = 16_384
QUERY_ROWS = 512
SCALE = 64
TOP = 20
#: Query blocks that meet an index block in one place at most.
PARTS_TOGETHER = 64
#: Tasks that the block pairs are dealt over at most.
MOST_TASKS = 10_000


def quantised(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows with ``q``: floor(scale * x) of each component as double; rows without a usable vector are left out."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    usable = rows.where(F.col(vector).isNotNull()).where(F.forall(x, finite))
    return usable.withColumn("q", F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bitmaps of a block (rows, attributes): words of all slices, smallest value and number of slices by attribute.

    The row count is filled up to whole 64-bit words.
    """
    low = values.min(0)
    shifted = values.astype(np.uint64) - low.astype(np.uint64)  # modulo 2^64, hence right for any two longs
    depth = np.array([int(m).bit_length() for m in shifted.max(0)], dtype=np.int64)
    words = -(-len(values) // 64)
    out = np.zeros((int(depth.sum()), words * 8), dtype=np.uint8)
    at = 0
    for d, n in enumerate(depth):
        for b in range(n):
            packed = np.packbits(((shifted[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
            out[at, : len(packed)] = packed
            at += 1
    return out.view("<u8"), low, depth


def add_slices(columns: list[list[np.ndarray]], words: int) -> list[np.ndarray]:
    """One bitmap for each weight: full and half adders reduce every column to one, carrying into the next."""
    out, k = [], 0
    while k < len(columns):
        column = columns[k]
        while len(column) > 2:
            a, b, c = column.pop(), column.pop(), column.pop()
            half = a ^ b
            column.insert(0, half ^ c)
            if k + 1 == len(columns):
                columns.append([])
            columns[k + 1].append((a & b) | (half & c))
        if len(column) == 2:
            a, b = column
            column[:] = [a ^ b]
            if k + 1 == len(columns):
                columns.append([])
            columns[k + 1].append(a & b)
        out.append(column[0] if column else np.zeros(words, dtype=np.uint64))
        k += 1
    return out


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(score: list[np.ndarray], there: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k highest scores, ties at the boundary to the smaller row numbers."""
    sure, tied = np.zeros_like(there), there.copy()
    for s in reversed(score):
        high = tied & s
        n = int(np.bitwise_count(sure).sum()) + int(np.bitwise_count(high).sum())
        if n > k:
            tied = high
        else:
            sure |= high
            tied &= ~s
            if n == k:
                tied[:] = 0
                break
    rows = rows_of(sure)
    if len(rows) < k:
        rows = np.concatenate([rows, rows_of(tied)[: k - len(rows)]])
    return rows


class Block:
    """One block of the index, its rows in the order of their ids."""

    def __init__(self, ids: np.ndarray, bitmaps: np.ndarray, low: np.ndarray, depth: np.ndarray):
        self.ids, self.low, self.depth, self.bitmaps = ids, low, depth, bitmaps
        self.start = np.cumsum(depth) - depth
        self.words = bitmaps.shape[1]
        self.there = np.zeros(self.words * 8, dtype=np.uint8)
        packed = np.packbits(np.ones(len(ids), dtype=np.uint8), bitorder="little")
        self.there[: len(packed)] = packed
        self.there = self.there.view("<u8")
        self.inverse = ~bitmaps

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the block's k best rows for a query."""
        columns: list[list[np.ndarray]] = [[]]
        base = sum(map(operator.mul, query.tolist(), self.low.tolist()))  # whole numbers of any size
        for d in np.flatnonzero(query):
            weight, n, at = int(query[d]), int(self.depth[d]), int(self.start[d])
            source = self.bitmaps
            if weight < 0:  # w * v = |w| * (full - v) - |w| * full
                base += weight * ((1 << n) - 1)
                source, weight = self.inverse, -weight
            shift = 0
            while weight:
                if weight & 1:
                    while len(columns) < shift + n:
                        columns.append([])
                    for b in range(n):
                        columns[shift + b].append(source[at + b])
                weight >>= 1
                shift += 1
        score = add_slices(columns, self.words)
        rows = top_rows(score, self.there, k)
        bits = np.array([(s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1) for s in score], dtype=np.int64)
        if len(score) < 62 and abs(base) < 1 << 62:
            return self.ids[rows], (bits << np.arange(len(score))[:, None]).sum(0) + base
        total = [base + sum(1 << b for b in np.flatnonzero(own).tolist()) for own in bits.T]
        return self.ids[rows], np.array(total, dtype=np.int64)  # raises if a score does not fit a long


def build_index(rows: DataFrame, blocks: int, id_col: str = "vec_id") -> DataFrame:
    """One row for each block: dims, block, ids, bitmaps, low, depth.  ``rows`` has the id and q."""
    keyed = rows.select(F.col(id_col).cast("long").alias("id"), "q", F.size("q").alias("dims"))
    keyed = keyed.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        values = np.array(pdf["q"].tolist(), dtype=np.int64)
        bitmaps, low, depth = slices_of(values)
        row = (pdf["dims"].iloc[0], pdf["block"].iloc[0], pdf["id"].to_numpy(), bitmaps.tobytes(), low, depth)
        return pd.DataFrame([row], columns=["dims", "block", "ids", "bitmaps", "low", "depth"])

    schema = "dims int, block int, ids array<long>, bitmaps binary, low array<long>, depth array<long>"
    return keyed.where(F.col("dims") > 0).groupBy("dims", "block").applyInPandas(build, schema)


def build_queries(asked: DataFrame) -> DataFrame:
    """One row for each block of queries: dims, part, ids, values (row by row, as narrow as they allow)."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.array(pdf["q"].tolist(), dtype=np.int64)
        kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= values.min() and values.max() <= np.iinfo(k).max)
        row = (pdf["dims"].iloc[0], pdf["part"].iloc[0], pdf["query_id"].to_numpy(), values.astype(kind).tobytes())
        return pd.DataFrame([row], columns=["dims", "part", "ids", "blob"])

    return asked.where(F.col("dims") > 0).groupBy("dims", "part").applyInPandas(build, "dims int, part int, ids array<long>, blob binary")


def _found(block: Block, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    for query_id, q in zip(ids.tolist(), queries, strict=True):
        own = int(np.searchsorted(block.ids, query_id, "right") - np.searchsorted(block.ids, query_id))
        rows, scores = block.search(q, k + own)
        other = rows != query_id
        rows, scores = rows[other], scores[other]
        best = np.lexsort((rows, -scores))[:k]
        yield pd.DataFrame({"query_id": query_id, "id": rows[best], "score": scores[best]})


def search(rows: DataFrame, is_query: Column, k: int = TOP, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), the id and score of the k best other rows of each query row.

    Every usable row is a candidate for every query but itself; a query meets rows of as many components as it has.  Rows with
    a null id or a vector that is null, empty or has a null or non-finite component take no part.  Fewer than k candidates
    give fewer rows, an empty table none.  Rows that repeat an id are candidates each, and not for a query of that id; such a
    query is asked once.  Components of any size are exact, as long as 64 * x and the scores returned fit a long.  Other columns
    are not read.

    Blocks of queries travel to the blocks of the index, which are much larger: an index block is sent once for ``PARTS_TOGETHER``
    query blocks.  A place is named by index block and group of query blocks, so that no key draws more than those.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    usable = stored(quantised(rows.select(id_col, vector).where(F.col(id_col).isNotNull()), vector).select(id_col, "q"))
    blocks = max(1, -(-usable.count() // BLOCK_ROWS))
    index = build_index(usable, blocks, id_col)
    asked = usable.where(is_query).select(F.col(id_col).cast("long").alias("query_id"), "q", F.size("q").alias("dims"))
    asked = asked.dropDuplicates(["query_id"])
    parts = max(1, -(-asked.count() // QUERY_ROWS))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
    together = max(1, min(PARTS_TOGETHER, parts * blocks // (2 * spark.sparkContext.defaultParallelism)))
    groups = -(-parts // together)
    nothing = F.lit(None).cast("array<long>")
    # a stated query set against all rows: each block of queries meets each block of the index
    here = build_queries(asked).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    here = here.select("dims", "block", F.floor(F.col("part") / together).cast("int").alias("group"), "part", "ids", "blob", nothing.alias("low"), nothing.alias("depth"))
    there = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    there = there.select("dims", "block", "group", F.lit(-1).alias("part"), "ids", F.col("bitmaps").alias("blob"), "low", "depth")
    place = ["dims", "block", "group"]
    met = there.unionByName(here).repartition(min(MOST_TASKS, 1 + 2 * blocks * groups), *place).sortWithinPartitions(*place, "part")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, at = None, None
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                ids = np.asarray(row.ids, dtype=np.int64)
                if row.part < 0:
                    depth = np.asarray(row.depth, dtype=np.int64)
                    bitmaps = np.frombuffer(row.blob, dtype="<u8").reshape(int(depth.sum()), -(-len(ids) // 64))
                    block, at = Block(ids, bitmaps, np.asarray(row.low, dtype=np.int64), depth), (row.dims, row.block, row.group)
                elif at == (row.dims, row.block, row.group):
                    values = np.frombuffer(row.blob, dtype=f"<i{len(row.blob) // (len(ids) * row.dims)}")
                    yield pd.concat(list(_found(block, ids, values.reshape(len(ids), -1).astype(np.int64), k)))

    found = met.mapInPandas(find, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
