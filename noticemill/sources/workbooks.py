"""Workbooks (.xlsx): zipped XML, one task a file, row by row; nothing passes through the driver."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cells

GRID = "file string, sheet string, nth int, ord long, cells array<string>"
#: Rows that a task hands over at a time.
ROWS = 2000
_PLACE = re.compile(r"([A-Z]+)")


def _plain(tag: str) -> str:
    return tag.rpartition("}")[2]


def _texts(node: ElementTree.Element) -> str:
    """All runs of a text, without phonetic readings."""
    return "".join(t.text or "" for part in node for t in ([part] if _plain(part.tag) == "t" else part if _plain(part.tag) == "r" else []) if _plain(t.tag) == "t")


def _column(place: str) -> int:
    """Number, from 0, of the column of a cell such as ``AB12``."""
    n = 0
    for letter in _PLACE.match(place)[1]:  # type: ignore[index]
        n = 26 * n + ord(letter) - 64
    return n - 1


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    found = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, node in ElementTree.iterparse(part):
            if _plain(node.tag) == "si":
                found.append(_texts(node))
                node.clear()
    return found


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Names of the sheets, in their order, and the parts that hold them."""
    links = {n.get("Id"): n.get("Target", "") for n in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    out = []
    for node in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _plain(node.tag) == "sheet":
            link = next(v for k, v in node.attrib.items() if _plain(k) == "id" and k != "id")
            target = links[link].lstrip("/")
            out.append((node.get("name", ""), target if target.startswith("xl/") else f"xl/{target}"))
    return out


def _value(cell: ElementTree.Element, shared: list[str]) -> str | None:
    kind = cell.get("t")
    inner = {_plain(n.tag): n for n in cell}
    if kind == "inlineStr":
        return _texts(inner["is"]) if "is" in inner else None
    text = inner["v"].text if "v" in inner else None
    if text is None:
        return None
    return shared[int(text)] if kind == "s" else {"1": "True", "0": "False"}.get(text) if kind == "b" else text


def rows_of(data: bytes) -> Iterator[tuple[str, int, int, list[str | None]]]:
    """sheet, its number, row number (from 1), cells of a workbook's rows."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared = _shared(book)
        for nth, (name, part) in enumerate(_sheets(book)):
            at = 0
            with book.open(part) as xml:
                for _, node in ElementTree.iterparse(xml):
                    if _plain(node.tag) != "row":
                        continue
                    at = int(node.get("r") or at + 1)
                    row: list[str | None] = []
                    for cell in node:
                        place = _column(cell.get("r")) if cell.get("r") else len(row)
                        row += [None] * (place + 1 - len(row))
                        row[place] = _value(cell, shared)
                    yield name, nth, at, row
                    node.clear()


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for file, data in zip(pdf["file"], pdf["content"], strict=True):
            waiting: list[tuple] = []
            for row in rows_of(data):
                waiting.append((file, *row))
                if len(waiting) == ROWS:
                    yield pd.DataFrame(waiting, columns=["file", "sheet", "nth", "ord", "cells"])
                    waiting = []
            if waiting:
                yield pd.DataFrame(waiting, columns=["file", "sheet", "nth", "ord", "cells"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """file, sheet, nth (of the sheet), ord (of the row), cells of all sheets of all workbooks under ``path``.

    Empty rows are not there, numbers are texts as the workbook has them, dates its serial numbers.  A workbook is read by one task.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path)
    files = files.select(F.col("path").alias("file"), "content").repartition(max(1, files.select("path").count()), "file")
    return files.mapInPandas(_read, GRID)


def notices(spark: SparkSession, path: str) -> DataFrame:
    """Notices of one workbook: those of its preferred sheet."""
    grid = read(spark, path).persist()
    try:
        names = [r.sheet for r in grid.groupBy("sheet").agg(F.min("nth").alias("nth")).orderBy("nth").collect()]  # one row a sheet
        sheet = cells.choose_sheet(names) if names else "Sheet1"
        return cells.parse_grid(grid.where(F.col("sheet") == sheet).select("ord", "cells"), sheet)
    finally:
        grid.unpersist()
