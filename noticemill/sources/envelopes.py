"""JSON envelopes, the change log and file hashes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CHANGE, HISTORY_ENVELOPE, LATEST_ENVELOPE, NOTICE


def history(spark: SparkSession, path: str) -> DataFrame:
    """Records of all yearly envelopes under ``path``, fiscal years as text."""
    envelopes = spark.read.option("multiLine", True).schema(HISTORY_ENVELOPE).json(path)
    return envelopes.select(F.inline("records")).withColumn("fiscal_year", F.col("fiscal_year").cast("string"))


def latest(spark: SparkSession, path: str) -> DataFrame:
    """Records of a snapshot, which is an envelope or a bare list; a missing path gives none."""
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], NOTICE)
    enveloped = F.from_json("value", LATEST_ENVELOPE)["records"]
    bare = F.from_json("value", "array<" + NOTICE.simpleString() + ">")
    is_list = F.ltrim("value").startswith("[")
    return whole.select(F.inline(F.when(is_list, bare).otherwise(enveloped)))


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """name, value of a flat JSON object; a missing file gives none."""
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "name string, value string")
    return whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("name", "value"))


def log_tail(lines: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` lines (ord, value) of a change log, without those that cannot be read."""
    return log_entries(lines.orderBy(F.desc("ord")).limit(n))


def log_entries(lines: DataFrame) -> DataFrame:
    """Entries of all lines (ord, value) of a change log that can be read."""
    parsed = lines.withColumn("entry", F.from_json("value", CHANGE, {"mode": "PERMISSIVE"}))
    return parsed.where(F.col("entry.timestamp").isNotNull() | F.col("entry.new_count").isNotNull()).select("ord", "entry.*")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "length", F.md5("content").alias("md5"))
