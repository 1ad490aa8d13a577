"""Changes between two snapshots that the caller names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..sinks import scratch
from .merge import SORT_KEY, sort_key

#: Entries that a change log keeps of each direction, and that a report lists.
LOG_ENTRIES, REPORT_ENTRIES = 50, 20
#: Keys that may be sent to every task.
SENT_KEYS = 1_000_000
#: Rows of a side that are looked at before all of them are joined with more keys than that.
FIRST_ROWS = 20_000
STRICT = ("company", "effective_date", "employees")


def _only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    # a hash in front decides nearly all comparisons; keys that come again need no grouping, which would shuffle them once more
    other = right.select(*[F.col(c).alias(f"_{c}") for c in STRICT], F.xxhash64(*STRICT).alias("_other"))
    own = left.withColumn("_own", F.xxhash64(*STRICT))
    same = [own["_own"] == other["_other"], *[own[c].eqNullSafe(other[f"_{c}"]) for c in STRICT]]
    return own.join(other, same, "left_anti").drop("_own")


def strict(new: DataFrame, baseline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(added, removed) by company, date and employees; duplicates stay, in their order."""
    return _only_in(new, baseline), _only_in(baseline, new)


def folded_key() -> dict[str, Column]:
    """Parts of the key without regard to case."""
    return {
        "k_company": F.lower(text.strip(F.coalesce(F.col("company"), F.lit("")))),
        "k_date": F.coalesce(F.col("effective_date"), F.lit("None")),
        "k_employees": F.coalesce(F.col("employees").cast("string"), F.lit("None")),
    }


def _folded_only_in(own: DataFrame, other: DataFrame) -> DataFrame:
    """One row for each key without regard to case that ``other`` lacks: the last record, at the first one's place.

    Rows of both are sent together by a hash of their keys, ``other``'s with nothing but the key's parts, and sorted once.  Keys are
    made of their parts again where they arrive.
    """
    missing = [c for c in own.columns if c not in STRICT]
    rows = own.withColumn("_other", F.lit(0)).unionByName(other.select(*STRICT, F.lit(1).alias("_other")), allowMissingColumns=True)
    key = folded_key()
    sent = rows.select(*STRICT, *missing, "_other", sort_key(*key.values())).repartition(SORT_KEY).withColumns(key)
    record = F.when(F.col("_other") == 0, F.struct(*own.columns))
    each = sent.groupBy(SORT_KEY, *key).agg(F.max("_other").alias("_other"), F.max_by(record, "ord").alias("r"), F.min("ord").alias("first_ord"))
    return each.where(F.col("_other") == 0).select("first_ord", "r.*")


def casefold(new: DataFrame, baseline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(added, removed) by name without case, date and employees; each key once."""
    return _folded_only_in(new, baseline), _folded_only_in(baseline, new)


def largest(changes: DataFrame, n: int = REPORT_ENTRIES) -> DataFrame:
    return changes.orderBy(F.desc("employees"), "first_ord").limit(n)


def totals(new: DataFrame, baseline: DataFrame) -> DataFrame:
    """Counts and sums of both snapshots and of the changes by folded keys.  Snapshots count all rows, changes each key once."""
    sides = [rows.select("company", "effective_date", "employees", F.lit(side).alias("side")) for side, rows in enumerate((new, baseline))]
    rows = lambda side: F.sum((F.col("side") == side).cast("long"))
    # the number of employees is part of the key, so that all rows of a key have the same
    keys = sides[0].unionByName(sides[1]).groupBy(*[c.alias(k) for k, c in folded_key().items()])
    keys = keys.agg(rows(0).alias("new"), rows(1).alias("old"), F.coalesce(F.max("employees"), F.lit(0)).cast("long").alias("each"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    only = lambda own, other: ((F.col(own) > 0) & (F.col(other) == 0)).cast("long")
    counts = {"latest": F.col("new"), "snapshot": F.col("old"), "added": only("new", "old"), "removed": only("old", "new")}
    whole = keys.agg(*[count(c * f).alias(f"{n}_{what}") for n, c in counts.items() for what, f in (("count", F.lit(1)), ("employees", F.col("each")))])
    delta: Column = F.col("latest_employees") - F.col("snapshot_employees")
    return whole.withColumn("employees_delta", delta)


def _entries(rows: DataFrame, only: DataFrame | None, keys: int, columns: list[str], n: int) -> list[Row]:
    """The first ``n`` rows by ``ord``, of the keys ``only`` if given: a list for the driver.

    Many keys are not sent to every task.  With many of them the first rows of all are likely to hold ``n``, which are found by
    sending those few rows to the keys; where they do not, rows are joined with the keys.
    """
    first = lambda found: [r.e for r in found.orderBy("ord").limit(n).select(F.struct(*columns).alias("e")).collect()]
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in STRICT]
    if only is None:
        return first(rows)
    if keys <= SENT_KEYS:
        return first(rows.join(F.broadcast(only), same, "left_semi"))
    with scratch.written(rows.select(*dict.fromkeys(("ord", *STRICT, *columns))).orderBy("ord").limit(FIRST_ROWS)) as head:
        wanted = F.broadcast(head.select(*STRICT).distinct())
        found = first(head.join(F.broadcast(only.join(wanted, same, "left_semi")), same, "left_semi"))
    return found if len(found) == n else first(rows.join(only, same, "left_semi"))


def change_entry(new: DataFrame, baseline: DataFrame | None, run_ts: str, columns: list[str], n: int = LOG_ENTRIES) -> DataFrame:
    """One line for the change log: counts, sums, and the first ``n`` entries of either direction.

    Without a baseline everything is new, and the line has no total of removed employees.  Sides are read for their keys and again for
    their entries, and should be stored tables; neither is copied.  The keys that only one side has are kept until the line is
    there; the line is small, with ``n`` entries a direction at most.
    """
    spark, sides = new.sparkSession, [new] if baseline is None else [new, baseline]
    tagged = [rows.select(*STRICT, F.lit(side).alias("_side")) for side, rows in enumerate(sides)]
    rows = lambda side: F.sum((F.col("_side") == side).cast("long")).alias(f"_rows{side}")
    both = tagged[0] if baseline is None else tagged[0].unionByName(tagged[1])
    only = both.groupBy(*[F.col(c).alias(f"_{c}") for c in STRICT]).agg(rows(0), rows(1)).where((F.col("_rows0") == 0) | (F.col("_rows1") == 0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    of = lambda side: [total(f"_rows{side}").alias(f"n{side}"), total(F.col(f"_rows{side}") * F.col("_employees")).alias(f"e{side}")]
    listed = [[], []]
    if baseline is None:
        found = only.agg(F.count("*").alias("keys"), *of(0), *of(1)).first()
        listed[0] = _entries(new, None, found.keys, columns, n)
    else:
        with scratch.written(only) as only:  # read for the sums and for either direction
            found = only.agg(F.count("*").alias("keys"), *of(0), *of(1)).first()
            listed = [_entries(own, only.where(F.col(f"_rows{side}") > 0), found.keys, columns, n) for side, own in enumerate(sides)]
    entry = T.ArrayType(new.select(*columns).schema)
    line = (run_ts, found.n0, listed[0], found.e0, found.n1, listed[1], found.e1 if baseline is not None else None)
    kinds = (T.StringType(), T.IntegerType(), entry, T.LongType(), T.IntegerType(), entry, T.LongType())
    names = ("timestamp", "new_count", "new_entries", "total_employees_new", "removed_count", "removed_entries", "total_employees_removed")
    return spark.createDataFrame([line], T.StructType([T.StructField(c, k) for c, k in zip(names, kinds, strict=True)]))
