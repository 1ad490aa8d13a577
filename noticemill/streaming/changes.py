"""Changes between successive snapshots as a stateful stream.

A snapshot is fed to the stream as counted rows: one for each key (company, date, employees) with the number of its rows, and at
least one for each bucket of keys, with the number of keys that the bucket has.  The stream keeps, for each bucket, the counts of
the last snapshot.  When all rows of a bucket's next snapshot are there it emits the keys whose count changed, and the
new counts become the state: what has gone is known without reading the snapshot before again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.diff import STRICT
from ..sinks import scratch

FEED = "taken long, bucket int, hash long, company string, effective_date string, employees int, rows long, keys long"
CHANGES = "taken long, company string, effective_date string, employees int, before long, after long"
STATE = "taken long, counts binary, waiting binary"
#: Keys of a bucket, on average, that a state should hold.
BUCKET_KEYS = 20_000
_COUNTS = [("hash", pa.int64()), ("company", pa.string()), ("effective_date", pa.string()), ("employees", pa.int32()), ("rows", pa.int64())]
_WAITING = [("taken", pa.int64()), *_COUNTS, ("keys", pa.int64())]


def feed(notices: DataFrame, taken: int, buckets: int) -> DataFrame:
    """A snapshot as the stream takes it.  ``taken`` numbers the snapshots in their order; ``buckets`` must stay the same."""
    spark = notices.sparkSession
    # rows are sent to their bucket once, and counted and numbered there
    hashed = notices.select(*STRICT, F.xxhash64(*STRICT).alias("hash"))
    hashed = hashed.withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int")).repartition("bucket")
    counted = hashed.groupBy("bucket", "hash", *STRICT).agg(F.count("*").alias("rows"))
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    keys = F.count("rows").over(Window.partitionBy("bucket"))
    whole = every.join(counted, "bucket", "left").withColumn("keys", keys)
    return whole.select(F.lit(taken).cast("long").alias("taken"), "bucket", F.coalesce("hash", F.lit(0)).alias("hash"), *[F.col(c) for c in STRICT], "rows", "keys")


def _packed(df: pd.DataFrame, columns: list) -> bytes:
    table = pa.Table.from_pandas(df[[c for c, _ in columns]], pa.schema(columns), preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes | None, columns: list) -> pd.DataFrame:
    table = pa.ipc.open_stream(data).read_all() if data else pa.schema(columns).empty_table()
    return table.to_pandas(types_mapper={pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype()}.get)


def changed(before: pd.DataFrame, after: pd.DataFrame) -> pd.DataFrame:
    """Keys whose number of rows differs; null parts of a key are equal to each other.

    Keys are matched by their hashes, which numbers do much faster than texts.  Keys that share a hash are matched by their texts.
    """
    if not (before["hash"].duplicated().any() or after["hash"].duplicated().any()):
        _, i, j = np.intersect1d(before["hash"].to_numpy("int64"), after["hash"].to_numpy("int64"), assume_unique=True, return_indices=True)
        one, other = before.iloc[i].reset_index(drop=True), after.iloc[j].reset_index(drop=True)
        if all((one[c].isna() == other[c].isna()).all() and (one[c].dropna() == other[c].dropna()).all() for c in STRICT):
            gone, come = np.delete(np.arange(len(before)), i), np.delete(np.arange(len(after)), j)
            moved = (one["rows"] != other["rows"]).to_numpy(bool)
            keys = [before.iloc[gone], after.iloc[come], other[moved]]
            counts = [(k["rows"], k["rows"] * 0) for k in keys[:1]] + [(k["rows"] * 0, k["rows"]) for k in keys[1:2]] + [(one["rows"][moved], other["rows"][moved])]
            parts = [k[list(STRICT)].assign(before=b, after=a) for k, (b, a) in zip(keys, counts, strict=True) if len(k)]
            return pd.concat(parts, ignore_index=True) if parts else before.iloc[:0].assign(before=before["rows"][:0], after=before["rows"][:0])
    both = before.merge(after, on=list(STRICT), how="outer", suffixes=("_before", "_after"))
    both = both.rename(columns={"rows_before": "before", "rows_after": "after"}).fillna({"before": 0, "after": 0})
    return both[both["before"] != both["after"]]


def _follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    taken, counts, waiting = state.get if state.exists else (None, None, None)
    kinds = {"hash": "Int64", "employees": "Int32", "rows": "Int64", "taken": "Int64", "keys": "Int64"}
    rows = pd.concat([_unpacked(waiting, _WAITING), *[b[[c for c, _ in _WAITING]].astype(kinds) for b in batches]], ignore_index=True)
    last = _unpacked(counts, _COUNTS)
    while len(rows):
        first = int(rows["taken"].min())
        now = rows["taken"] == first
        own = rows[now & rows["rows"].notna()]
        if own["hash"].duplicated().any():  # a part that came twice, or keys that share a hash
            own = own.drop_duplicates(list(STRICT))
        if taken is None or first > taken:  # else a snapshot that was followed already
            if len(own) < int(rows.loc[now, "keys"].max()):
                break  # the rest of it is still to come
            own = own[[c for c, _ in _COUNTS]]
            out = changed(last, own)
            if len(out):
                yield out.assign(taken=first)[["taken", *STRICT, "before", "after"]]
            taken, last = first, own
        rows = rows[~now]
    state.update((taken, _packed(last, _COUNTS), _packed(rows, _WAITING) if len(rows) else None))


def follow(spark: SparkSession, feeds: str, folder: str) -> DataFrame:
    """Take in the snapshots that have come under ``feeds`` since the last call; all changes so far, each once.

    The place in the feed, the counts and the changes are kept under ``folder``.  A batch that is repeated after a stop replaces its
    own lines.  Snapshots may come in one batch or in several, whole or in parts, but in their order.  taken, key, and the number
    of the key's rows before and after; before the first snapshot there are none.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/changes/batch={batch_id}")

    rows = spark.readStream.schema(FEED).option("recursiveFileLookup", True).parquet(feeds)
    found = rows.groupBy("bucket").applyInPandasWithState(_follow, CHANGES, STATE, "append", GroupStateTimeout.NoTimeout)
    stream = found.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{folder}/progress")
    stream.trigger(availableNow=True).start().awaitTermination()
    return scratch.read(spark, f"{folder}/changes", f"{CHANGES}, batch int").drop("batch")


def added_and_removed(changes: DataFrame) -> DataFrame:
    """One row for each change: how many rows of a key were added or removed."""
    more = F.col("after") - F.col("before")
    return changes.select("taken", *STRICT, F.when(more > 0, F.lit("added")).otherwise(F.lit("removed")).alias("change"), F.abs(more).alias("rows"))
