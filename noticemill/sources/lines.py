"""Text files with line numbers, without a sort, and their last lines without reading the rest.

A file is read in splits, each in its order.  A line's number is the number of lines of all splits before its own, plus its place
inside: counts of lines, one row a split, are all that is added up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Splits whose counts may be sent to every task; with more of them lines are joined by split.
SENT_SPLITS = 100_000
#: Bytes of a file's end that are looked at first.
TAIL_BYTES = 1 << 16


def _before(counts: DataFrame) -> DataFrame:
    """file, start, first, ahead: lines of all earlier splits, added up by file and then over files, one row each."""
    inside = Window.partitionBy("file").orderBy("start")
    files = counts.groupBy("file").agg(F.sum("lines").alias("all"))
    earlier = files.select("file", (F.sum("all").over(Window.orderBy("file")) - F.col("all")).alias("earlier"))
    own = counts.withColumn("own", F.sum("lines").over(inside) - F.col("lines"))
    return own.join(earlier, "file").select("file", "start", "first", (F.col("own") + F.col("earlier")).alias("ahead"))


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """ord (from 0), value of all lines of the text files under ``path``: files by name, lines as they stand.

    The numbers are the same for any size of splits.  Empty files have no lines.
    """
    rows = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")
    )
    counts = rows.groupBy("file", "start").agg(F.count("*").alias("lines"), F.min("at").alias("first"))
    before = _before(counts)
    if counts.count() <= SENT_SPLITS:
        before = F.broadcast(before)
    return rows.join(before, ["file", "start"]).select((F.col("ahead") + F.col("at") - F.col("first")).alias("ord"), "value")


def _file_end(spark: SparkSession, path: str, length: int, n: int) -> list[str]:
    """The last ``n`` lines of a file, or all if there are fewer: reads back from its end, as far as needed."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        size = min(TAIL_BYTES, length)
        while True:
            stream.seek(length - size)
            data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, int(size)))
            lines = data.splitlines()[0 if size == length else 1 :]  # the first may be the end of a longer one
            if len(lines) >= n or size == length:
                return [x.decode("utf-8", "replace") for x in lines[-n:]]
            size = min(2 * size, length)
    finally:
        stream.close()


def last(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """ord (-1 is the last line), value of the last ``n`` lines under ``path``; reads the ends of the last files only.

    What is read and sent to the driver grows with ``n`` and the length of those lines, not with the files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.col("length") > 0)
    found: list[str] = []
    for file in files.select("path", "length").orderBy(F.desc("path")).limit(n).collect():  # each has a line at least
        found = _file_end(spark, file.path, file.length, n - len(found)) + found
        if len(found) == n:
            break
    return spark.createDataFrame([(i - len(found), x) for i, x in enumerate(found)], "ord long, value string")
