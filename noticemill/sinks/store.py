"""Versioned snapshots, the change log and yearly files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge
from ..schema import CHANGE, LATEST_ENVELOPE, NOTICE
from . import runs

FIELDS = [f.name for f in NOTICE]


#: Tables of a run: the records, their totals, and the line of the change log.
TABLES = ("records", "totals", "changes")


def payload(notices: DataFrame, run_ts: str, source_url: str = "") -> DataFrame:
    """Totals of the records of a run."""
    return merge.payload_totals(notices).withColumns({"last_updated": F.lit(run_ts), "source_url": F.lit(source_url)})


def write_run(spark: SparkSession, folder: str, run_id: str, notices: DataFrame, totals: DataFrame, entry: DataFrame, base: int, run_ts: str = "") -> int:
    """Records, totals and change line of a run, visible together or not at all; returns the version.

    ``base`` is ``runs.head`` as the run began; another run committed since then raises ``runs.Conflict``.  A run that
    is repeated replaces what it committed before.
    """
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in NOTICE]
    tables = {"records": notices.select(*typed, "ord"), "totals": totals, "changes": entry}
    return runs.commit(spark, folder, runs.write(folder, tables), run_id, base, run_ts)


def read_snapshot(spark: SparkSession, folder: str, run_id: str | None) -> DataFrame:
    """Records of a committed run; no run, no records."""
    schema = T.StructType([*NOTICE.fields, T.StructField("ord", T.StringType())])
    return spark.createDataFrame([], schema) if run_id is None else runs.read(spark, folder, "records", schema, run_id).drop("run_id")


def read_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of all committed runs."""
    return runs.read(spark, folder, "totals", T.StructType([f for f in LATEST_ENVELOPE if f.name != "records"]))


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """Change lines of all committed runs, one each."""
    return runs.read(spark, folder, "changes", CHANGE)


def append_change(entry: DataFrame, path: str, entry_id: str) -> None:
    """Add a line under its own id; a run or batch that is repeated replaces its line and adds no second one."""
    entry.write.mode("overwrite").json(f"{path}/entry_id={entry_id}")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All lines of the change log, with the ids that they were added under."""
    return spark.read.schema(T.StructType([*CHANGE.fields, T.StructField("entry_id", T.StringType())])).json(path)


def write_years(records: DataFrame, folder: str) -> None:
    """One folder for each fiscal year."""
    records.write.mode("overwrite").partitionBy("fiscal_year").json(folder)


def write_combined(records: DataFrame, folder: str) -> None:
    records.write.mode("overwrite").json(folder)
