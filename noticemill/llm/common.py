"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of keys that may be sent to every executor; joins with more of them shuffle.
BROADCAST_ROWS = 1_000_000
#: Folders of the tables that ``stored`` has written and that are still in use.
_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``.

    Only a session in local mode, where driver and tasks share one machine, may go without it and gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix=f"checkpoint-{uuid.uuid4().hex[:8]}-"))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut`` for large intermediate tables: compressed, in columns, and ``forget`` can remove it again."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    _WRITTEN[written] = folder
    return written


#: Bytes of text that a task hands to Python at a time.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Have Arrow batches bounded in bytes, not in rows alone: ten thousand long texts at a time would be too much for a task.

    This is the session's setting, which plans read when they run; a smaller bound of the caller's stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    given = int(now.removesuffix("b")) if now and now.removesuffix("b").lstrip("-").isdigit() else None
    if now is None or given is not None and not 0 < given <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def forget(*tables: DataFrame | None) -> None:
    """Remove tables that ``stored`` has written and nobody will read again; others stay as they are."""
    for df in tables:
        if df is not None and (folder := _WRITTEN.pop(df, None)):
            remove_folder(df.sparkSession, folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def matched(rows: DataFrame, few: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``few``, which is cheap to count: sent along if it has at most ``BROADCAST_ROWS`` rows, else shuffled."""
    return rows.join(F.broadcast(few) if few.count() <= BROADCAST_ROWS else few, on, how)


def with_ids(batches: Iterator[pa.RecordBatch], made: Callable[[pd.DataFrame], tuple[list[int] | None, pd.DataFrame]], kept: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of the columns ``kept``, as they came, beside what ``made`` makes of the others.

    ``made`` gives a frame and the place of the row that each of its rows comes from (None: one each).  Ids do not go through
    pandas, which turns longs that stand beside a null into doubles.
    """
    for batch in batches:
        rest = [c for c in batch.schema.names if c not in kept]
        places, frame = made(batch.select(rest).to_pandas())
        own = [batch.column(c) if places is None else batch.column(c).take(pa.array(places, pa.int64())) for c in kept]
        own += [pa.array(frame[f.name], f.type, from_pandas=True) for f in schema]
        yield pa.RecordBatch.from_arrays(own, [*kept, *schema.names])


def fold_of(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids count as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % parts


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path beside the checkpoints, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{base}/written-{uuid.uuid4().hex}"
