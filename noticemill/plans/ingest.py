"""Incremental ingestion of a folder of files, by the hash of their content.

A ledger has a line for each file: length, time and hash.  Files whose length or time changed are hashed again; content that was seen
before is not parsed again, whatever its file is called.  Parsed rows are kept by content hash, with the hashes of their
filings' keys, once: what is needed of them is read from there.  After a change the keys of the rows that went or came are *touched*; only their rows are read, from the
changed files and from those others that share a key.  Merged filings are written for touched keys alone, and monthly sums as
differences, so that what is read and written follows the change.  All tables of an ingestion are committed together.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from ..operators import merge
from ..schema import KEYS, NOTICE
from ..sinks import runs, scratch
from ..sources import cells

FIELDS = [f.name for f in NOTICE]
LEDGER = "file string, path string, length long, modified timestamp, md5 string, home string"
ROWS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in NOTICE) + ", ord string, k long, md5 string, attempt string"
MERGED = ", ".join(f"{k} string" for k in KEYS) + ", employees long, notice_date string, address string, industry string, ord string, k long, gone boolean, attempt string"
MONTHS = "month string, employees long, attempt string"
#: Changed files that are named one by one; beyond, the folder is read and the others are left out.
NAMED_FILES = 10_000
#: Numbers of 64 bits that keys are marked in to be sent to every task.
MARKS = 1 << 20


def json_lines(files: DataFrame | None, spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, ord and raw text columns of files of JSON lines."""
    schema = "ord string, " + ", ".join(f"{f} string" for f in FIELDS)
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).json(paths)
    rows = rows.select("*", F.col("_metadata.file_path").alias("file"))
    return rows if files is None else rows.join(files, "file", "left_semi")


@dataclass(frozen=True)
class Ingested:
    """What one ingestion did; no version if nothing had changed."""

    version: int | None
    changed_files: int
    parsed_files: int
    shared_files: int
    rows_read: int


def listing(spark: SparkSession, source: str) -> DataFrame:
    """file (as readers name it), path, length, modified of all files; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    return found.select(F.col("_metadata.file_path").alias("file"), "path", "length", F.col("modificationTime").alias("modified"))


def _committed(spark: SparkSession, folder: str, name: str, schema: str, attempts: list[str] | None = None) -> DataFrame:
    """Rows of a table of all committed ingestions, or of those named."""
    if not scratch.exists(spark, f"{folder}/{name}"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}")
    if attempts is not None:
        return rows.where(F.col("attempt").isin(attempts))
    return rows.join(F.broadcast(runs.commits(spark, folder).select("attempt")), "attempt", "left_semi")  # one row an ingestion


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The files of the last ingestion; ``home`` names the attempt that has their rows."""
    last = runs.commits(spark, folder).orderBy(F.desc("version")).first()
    return _committed(spark, folder, "ledger", f"{LEDGER}, attempt string", [last.attempt] if last else []).drop("attempt")


def _hashed(spark: SparkSession, source: str, files: DataFrame, n: int) -> DataFrame:
    """``files`` with the md5 of their content; only these are read."""
    paths = [r.path for r in files.select("path").collect()] if n <= NAMED_FILES else source
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.join(content.select(F.col("_metadata.file_path").alias("file"), F.md5("content").alias("md5")), "file")


def _rows_of(spark: SparkSession, folder: str, files: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Parsed rows of ``files`` (file, md5, home), read from the folders of their hashes; ``extra`` has rows not yet committed."""
    homes = [tuple(r) for r in files.select("home", "md5").distinct().limit(NAMED_FILES + 1).collect()]
    rows = _committed(spark, folder, "rows", ROWS, sorted({h for h, _ in homes}) if len(homes) <= NAMED_FILES else None)
    if len(homes) <= NAMED_FILES:
        rows = rows.where(F.col("md5").isin(sorted({m for _, m in homes})))  # folders of other hashes are not opened
    own = F.broadcast(files.select("file", "md5", F.col("home").alias("attempt"))) if len(homes) <= NAMED_FILES else files.select("file", "md5", F.col("home").alias("attempt"))
    return rows.join(own, ["md5", "attempt"]).select("file", "ord", "k", *FIELDS)


def _marked(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` (k, ...) with ``marked``, which is true of all rows whose k is one of ``keys`` and of few others.

    Where few keys are wanted most rows need not be sent to them.
    """
    number, bit = F.pmod("k", F.lit(MARKS)), F.pmod(F.shiftright("k", 32), F.lit(64)).cast("int")
    marks = keys.select(number.alias("_number"), bit.alias("_bit")).groupBy("_number").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_marks"))
    found = rows.withColumns({"_number": number, "_bit": bit}).join(F.broadcast(marks), "_number", "left")
    return found.withColumn("marked", F.coalesce(F.getbit("_marks", F.col("_bit")) == 1, F.lit(False))).drop("_number", "_bit", "_marks")


def _sharing(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` whose k is one of ``keys``."""
    return _marked(rows, keys).where("marked").drop("marked").join(keys, "k", "left_semi")


def _merged(rows: DataFrame) -> DataFrame:
    return merge.merge_duplicates(rows).withColumn("k", F.xxhash64(*KEYS))


def _months(merged: DataFrame, sign: int) -> DataFrame:
    month = values.month_key(values.as_date(F.col("effective_date")))
    return merged.select(month.alias("month"), (F.lit(sign) * F.col("employees")).alias("employees")).where(F.col("month").isNotNull())


def ingest(spark: SparkSession, source: str, folder: str, read: Callable[[DataFrame | None, SparkSession, list[str]], DataFrame] = json_lines) -> Ingested:
    """Bring the tables under ``folder`` up to date with the files under ``source``."""
    base, attempt = runs.head(spark, folder), uuid.uuid4().hex
    before = ledger(spark, folder)
    now = listing(spark, source)
    same = ["file", "path", "length", "modified"]
    kept = now.join(before, same).select(*same, "md5", "home")
    with scratch.written(now.join(before, same, "left_anti")) as suspects:
        n = suspects.count()
        known = before.select("md5", F.col("home").alias("known")).distinct()
        hashed = _hashed(spark, source, suspects, n) if n else suspects.withColumn("md5", F.lit(None).cast("string"))
        hashed = hashed.join(known, "md5", "left").select(*same, "md5", F.coalesce("known", F.lit(attempt)).alias("home"))
        with scratch.written(kept.unionByName(hashed)) as after:
            return _bring_up(spark, source, folder, base, attempt, before, after, read)


def _bring_up(spark: SparkSession, source: str, folder: str, base: int, attempt: str, before: DataFrame, after: DataFrame, read: Callable) -> Ingested:
    content = ["file", "md5"]
    gone, come = before.join(after, content, "left_anti"), after.join(before, content, "left_anti")
    changed = gone.select("file").unionByName(come.select("file")).distinct().count()
    if not changed:
        return Ingested(None, 0, 0, 0, 0)
    # one file of each new content is parsed
    new = come.where(F.col("home") == attempt).groupBy("md5").agg(F.min(F.struct("file", "path")).alias("one")).select("md5", "one.*")
    parsed = new.count()
    if parsed:
        paths = [r.path for r in new.select("path").collect()] if parsed <= NAMED_FILES else [source]
        raw = read(None if parsed <= NAMED_FILES else new.select("file"), spark, paths)
        named = new.select("file", "md5")
        rows = cells.normalise(raw).withColumn("k", F.xxhash64(*KEYS)).join(F.broadcast(named) if parsed <= NAMED_FILES else named, "file")
        # a file is read by few tasks, so that rows need not be brought together by their file
        rows.select(*FIELDS, "ord", "k", "md5").write.partitionBy("md5").option("compression", "zstd").parquet(f"{folder}/rows/attempt={attempt}")
    # files without a row have no folder; the others give keys and files that share them
    went = _rows_of(spark, folder, gone)
    came = _rows_of(spark, folder, come)
    unchanged = after.join(come.select("file"), "file", "left_anti")
    alone = unchanged.isEmpty()
    touched = went.select("k").unionByName(came.select("k")).distinct()
    if not alone:
        postings = _sharing(_committed(spark, folder, "rows", ROWS).select("k", "md5"), touched)
        unchanged = unchanged.join(postings.select("md5").distinct(), "md5", "left_semi")
    with scratch.written(unchanged) as shared:
        others = _rows_of(spark, folder, shared)
        with scratch.written(others if alone else _sharing(others, touched)) as rest:
            # filings are merged once, and read again for what is gone and for the sums
            target = f"{folder}/merged/attempt={attempt}"
            _merged(came.unionByName(rest)).withColumn("gone", F.lit(False)).write.option("compression", "zstd").parquet(target)
            fresh = spark.read.schema(MERGED).parquet(target).drop("attempt")
            with scratch.written(_merged(went.unionByName(rest)).select(*fresh.columns[:-1])) as old:
                left = old.select("k", *KEYS)
                left = (left if left.isEmpty() else left.join(fresh.select("k"), "k", "left_anti")).withColumn("gone", F.lit(True))
                sums = _months(fresh, 1).unionByName(_months(old, -1)).groupBy("month").agg(F.sum("employees").alias("employees"))
                sums.where(F.col("employees") != 0).write.parquet(f"{folder}/months/attempt={attempt}")
                fresh.where(F.lit(False)).unionByName(left, allowMissingColumns=True).write.mode("append").parquet(target)
            after.select(*[c.split()[0] for c in LEDGER.split(", ")]).write.parquet(f"{folder}/ledger/attempt={attempt}")
            read_rows = went.count() + came.count() + others.count()
            found = Ingested(runs.commit(spark, folder, attempt, f"{base + 1:020}", base), changed, parsed, shared.count(), read_rows)
    return found


def merged(spark: SparkSession, folder: str) -> DataFrame:
    """All merged filings: of each key what the last ingestion that touched it wrote."""
    versions = runs.commits(spark, folder).select("attempt", "version")
    first = versions.agg(F.min("version")).first()[0]
    rows = _committed(spark, folder, "merged", MERGED).join(F.broadcast(versions), "attempt")
    columns = [c for c in rows.columns if c not in ("attempt", "version", "k", *KEYS)]
    # filings that only the first ingestion wrote stand there once; the others are compared
    told = _marked(rows, rows.where(F.col("version") > F.lit(first)).select("k"))
    last = told.where("marked").groupBy(*KEYS).agg(F.max_by(F.struct(*columns), "version").alias("r")).select(*KEYS, "r.*")
    return last.unionByName(told.where("not marked").select(*last.columns)).where(~F.col("gone")).drop("gone")


def months(spark: SparkSession, folder: str) -> DataFrame:
    """Employees by month: the differences of all ingestions added up."""
    each = _committed(spark, folder, "months", MONTHS).groupBy("month").agg(F.sum("employees").cast("long").alias("employees"))
    return each.where(F.col("employees") != 0)
