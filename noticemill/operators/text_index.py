"""Substring search with an index of trigrams.

Rows are cut into blocks where they lie and numbered inside them.  For every field and every three letters in a row of a text, the index
has the rows of each block, as a list of gaps or a bitmap.  A text that is looked for selects the rows of all its trigrams; the rows of those blocks, and no others,
are read and compared.  Texts end with two marks, so that one or two letters are the beginning of some trigram too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import scratch
from .search import CELLS

#: Rows of a block: as many as a bitmap has bits.
BLOCK_ROWS = 32_768
END = "\x01\x01"
SLOTS = "slot int, block long"
GRAMS = "field string, gram string, block long, slots binary"
BITMAP_BYTES = 4096
#: Bitmaps, of 4 KB each, that may be sent to every task.
SENT_BITMAPS = 10_000


def _text(field: str) -> Column:
    """What is searched: one cell, or all of them."""
    return F.lower(F.concat_ws(" ", *CELLS)) if field == "any_text" else F.lower(F.coalesce(F.col(field), F.lit("")))


def _slots(slots: np.ndarray) -> bytes:
    """Rows of a block that have a gram: how many rows are left out before each, a byte and one of 255 for every 255 more, or a bitmap
    where that is shorter."""
    gaps = np.diff(slots, prepend=-1) - 1
    ends = np.cumsum(gaps // 255 + 1)
    if ends[-1] < BITMAP_BYTES:
        coded = np.full(ends[-1], 255, dtype=np.uint8)
        coded[ends - 1] = gaps % 255
        return coded.tobytes()
    bits = np.zeros(8 * BITMAP_BYTES, dtype=bool)
    bits[slots] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _bits(slots: bytes) -> np.ndarray:
    coded = np.frombuffer(slots, dtype=np.uint8)
    if len(slots) == BITMAP_BYTES:
        return coded
    bits = np.zeros(8 * BITMAP_BYTES, dtype=bool)
    gaps = np.cumsum(coded, dtype=np.int64)[coded < 255]
    bits[gaps + np.arange(len(gaps))] = True
    return np.packbits(bits, bitorder="little")


def _dense(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in their order, and the place of each code among them."""
    size = int(codes.max()) + 1
    if size > 1 << 24:
        return np.unique(codes, return_inverse=True)
    seen = np.zeros(size, dtype=bool)
    seen[codes] = True
    return np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - 1)[codes]


def _grams(texts: list[str], slots: np.ndarray) -> tuple[list[str], list[bytes]]:
    """All three letters in a row of a block's texts, in their order, each with the rows that have it; ``slots`` rise."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    alphabet, letters = _dense(np.frombuffer("".join(t + END for t in texts).encode("utf-32-le"), dtype="<u4"))
    starts = np.ones(len(letters), dtype=bool)
    ends = np.cumsum(lengths + len(END))
    starts[ends - 1] = starts[ends - 2] = False  # a gram begins at a letter, never at a mark
    at, n, letters = np.flatnonzero(starts), len(alphabet), letters.astype(np.int64)
    if not len(at):
        return [], []
    codes, nth = _dense((letters[at] * n + letters[at + 1]) * n + letters[at + 2])
    # rows rise within a gram: numbers of two bytes are dealt out, not compared
    order = np.argsort(nth.astype(np.uint16) if len(codes) <= 1 << 16 else nth, kind="stable")
    nth, of = nth[order], np.repeat(slots, lengths)[order]
    once = np.concatenate([[True], (nth[1:] != nth[:-1]) | (of[1:] != of[:-1])])
    cuts = np.searchsorted(nth[once], np.arange(1, len(codes)))
    three = alphabet[np.stack([codes // n // n, codes // n % n, codes % n], axis=1)].astype("<u4").tobytes().decode("utf-32-le")
    return [three[3 * i : 3 * i + 3] for i in range(len(codes))], [_slots(p) for p in np.split(of[once], cuts)]


def _index_block(rows: pa.Table, fields: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    slots, block = rows["slot"].to_numpy().astype(np.int64), rows["block"][0].as_py()
    order = np.argsort(slots)
    for field in fields:
        grams, bits = _grams(rows[f"_{field}"].take(pa.array(order)).to_pylist(), slots[order])
        columns = [pa.array([field] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array([block] * len(grams), pa.int64()), pa.array(bits, pa.binary())]
        yield pa.record_batch(columns, ["field", "gram", "block", "slots"])


def _index_blocks(fields: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The grams of the blocks of a task, one block after another; one that several tasks read has parts."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            blocks = batch["block"].to_numpy()
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and a < b and held[0]["block"][0].as_py() != blocks[a]:
                    yield from _index_block(pa.Table.from_batches(held), fields)
                    held = []
                held += [batch.slice(a, b - a)] if a < b else []
        if held:
            yield from _index_block(pa.Table.from_batches(held), fields)

    return of


@dataclass(frozen=True)
class Index:
    """Folders of the rows, by block, and of the grams, by field."""

    folder: str
    schema: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{self.schema}, {SLOTS}").parquet(f"{self.folder}/rows")

    def grams(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(GRAMS).parquet(f"{self.folder}/grams")


def build(cells: DataFrame, folder: str, fields: tuple[str, ...] = ("any_text", "company")) -> Index:
    """Write an index of ``cells`` (see ``search.cells``) under ``folder``.

    Rows are numbered by the task that has them, as they come, and written once; a block has the number of its first row.  Its grams are
    found by the tasks that read it: rows and texts are sent nowhere.
    """
    spark = cells.sparkSession
    index = Index(folder, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema))
    numbered = cells.withColumn("_number", F.monotonically_increasing_id())
    slot = F.col("_number").bitwiseAND((1 << 33) - 1) % BLOCK_ROWS  # the upper bits are the task's
    numbered = numbered.select(*cells.columns, (F.col("_number") - slot).alias("block"), slot.cast("int").alias("slot"))
    numbered.write.partitionBy("block").option("compression", "zstd").parquet(f"{folder}/rows")
    texts = index.rows(spark).select("block", "slot", *[_text(f).alias(f"_{f}") for f in fields])
    grams = texts.mapInArrow(_index_blocks(fields), GRAMS)
    grams.sortWithinPartitions("field", "gram").write.partitionBy("field").option("compression", "zstd").parquet(f"{folder}/grams")
    return index


def _has(bits: Column, slot: Column) -> Column:
    return F.getbit(F.get(bits, F.shiftright(slot, 6)), slot % 64) != 0


def _together(needed: int) -> Callable[[pa.Table], pa.Table]:
    """The rows of a block that have all of ``needed`` grams, or any gram if that is 0."""

    def of(rows: pa.Table) -> pa.Table:
        parts: dict[str, np.ndarray] = {}
        for gram, slots in zip(rows["gram"].to_pylist(), rows["slots"].to_pylist(), strict=True):
            parts[gram] = parts[gram] | _bits(slots) if gram in parts else _bits(slots)
        bits = list(parts.values())
        found = (np.bitwise_and if needed else np.bitwise_or).reduce(bits)
        if len(bits) < needed or not found.any():
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64()))], ["block", "bits"])
        return pa.table([pa.array([rows["block"][0].as_py()], pa.int64()), pa.array([found.view("<i8")], pa.list_(pa.int64()))], ["block", "bits"])

    return of


def candidates(spark: SparkSession, index: Index, field: str, text: str) -> DataFrame:
    """block, bits (64 rows a number): rows that may have ``text`` in the field; blocks without any are left out."""
    grams = sorted({text[i : i + 3] for i in range(len(text) - 2)})
    found = index.grams(spark).where(F.col("field") == field)
    found = found.where(F.col("gram").isin(grams) if grams else F.col("gram").startswith(text))
    return found.select("block", "gram", "slots").groupBy("block").applyInArrow(_together(len(grams)), "block long, bits array<bigint>")


def search(spark: SparkSession, index: Index, field: str, text: str) -> DataFrame:
    """Rows with ``text`` in the field, whatever its case; an empty text finds all rows.  Reads the blocks that may have it."""
    rows, wanted = index.rows(spark), text.lower()
    if wanted:
        chosen = scratch.stored(candidates(spark, index, field, wanted))
        blocks = [r.block for r in chosen.select("block").collect()]  # one number a block of 32,768 rows
        rows = rows.where(F.col("block").isin(blocks)).join(F.broadcast(chosen) if len(blocks) <= SENT_BITMAPS else chosen, "block")
        rows = rows.where(_has(F.col("bits"), F.col("slot")) & _text(field).contains(wanted)).drop("bits")
    return rows.drop("block", "slot")
