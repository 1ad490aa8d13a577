"""Runs whose tables become visible together.

A run writes its tables under an attempt of its own, which nobody reads.  One small file, the commit, then names the attempt; its own
name is the version after the one that the run began from, and creating it fails if it exists.  So a run that stops
anywhere before has changed nothing, and of two runs that began from the same version one fails.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scratch

#: Tables as long as the notices, written as Parquet; lines for people stay JSON, and so do tables of runs from before.
COLUMNAR = ("records",)
COMMIT = "version long, run_id string, attempt string, committed_at string"


class Conflict(RuntimeError):
    """Another run was committed since this one began."""


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def head(spark: SparkSession, folder: str) -> int:
    """The last version; 0 if nothing was committed."""
    path, fs = _path(spark, f"{folder}/commits")
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)


def write(folder: str, tables: dict[str, DataFrame], attempt: str | None = None) -> str:
    """Write the tables of a run; returns the attempt to commit."""
    attempt = attempt or uuid.uuid4().hex
    for name, df in tables.items():
        if name in COLUMNAR:
            df.write.parquet(f"{folder}/{name}.parquet/attempt={attempt}")
        else:
            df.write.json(f"{folder}/{name}/attempt={attempt}")
    return attempt


def commit(spark: SparkSession, folder: str, attempt: str, run_id: str, base: int, at: str = "") -> int:
    """Make an attempt visible as the version after ``base``, which was ``head`` when the run began.

    The commit is created under its final name, which file systems with a name node do for one of several writers only.  Where
    a file is empty, its writer stopped between creating and filling it; the version is void and nothing of it visible.
    """
    version = base + 1
    if head(spark, folder) != base:
        raise Conflict(f"version {version} of {folder} was committed by another run")
    path, fs = _path(spark, f"{folder}/commits/{version:020}.json")
    line = json.dumps({"version": version, "run_id": run_id, "attempt": attempt, "committed_at": at}) + "\n"
    try:
        stream = fs.create(path, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error):
            raise Conflict(f"version {version} of {folder} was committed by another run") from error
        raise
    stream.write(bytearray(line.encode()))
    stream.close()
    return version


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """version, run_id, attempt, committed_at: the last commit of each run."""
    if not scratch.exists(spark, f"{folder}/commits"):
        return spark.createDataFrame([], COMMIT)
    rows = spark.read.schema(COMMIT).json(f"{folder}/commits").where(F.col("attempt").isNotNull())
    last = Window.partitionBy("run_id").orderBy(F.desc("version"))
    return rows.withColumn("nth", F.row_number().over(last)).where(F.col("nth") == 1).drop("nth")


def ids(spark: SparkSession, folder: str) -> list[str]:
    """Ids of all committed runs, the last first; one commit a run."""
    return [r.run_id for r in commits(spark, folder).select("run_id").orderBy(F.desc("run_id")).collect()]


def read(spark: SparkSession, folder: str, name: str, schema: T.StructType, run_id: str | None = None) -> DataFrame:
    """Rows of a table of one committed run, or of all, with the ``run_id``; no rows of runs that were not committed."""
    chosen = commits(spark, folder)
    if run_id is not None:
        chosen = chosen.where(F.col("run_id") == run_id)
    whole = T.StructType([*schema.fields, T.StructField("attempt", T.StringType())])
    found = [(at, kind) for at, kind in ((f"{folder}/{name}", "json"), (f"{folder}/{name}.parquet", "parquet")) if scratch.exists(spark, at)]
    if not found:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("run_id", T.StringType())]))
    rows = reduce(DataFrame.unionByName, [spark.read.schema(whole).option("basePath", at).format(kind).load(at) for at, kind in found])
    if run_id is not None:
        rows = rows.where(F.col("attempt").isin([r.attempt for r in chosen.collect()]))  # other runs are not opened
    return rows.join(F.broadcast(chosen.select("attempt", "run_id")), "attempt").drop("attempt")  # one row a run is sent


def vacuum(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Remove attempts that no commit names; only while no run is being written.  Returns them."""
    kept = {r.attempt for r in commits(spark, folder).collect()}  # one row a run
    gone = set()
    for name in (n for name in names for n in (name, f"{name}.parquet")):
        path, fs = _path(spark, f"{folder}/{name}")
        for found in fs.listStatus(path) if fs.exists(path) else []:
            attempt = found.getPath().getName().partition("=")[2]
            if attempt and attempt not in kept:
                fs.delete(found.getPath(), True)
                gone.add(attempt)
    return sorted(gone)
