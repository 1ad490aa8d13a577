"""Differences of two snapshots found by digests: rows of buckets that agree are not shuffled.

Keys are hashed into buckets.  A bucket's digest adds up the hashes of its rows, those of the new snapshot with a plus and those of
the baseline with a minus; it is zero where the two have the same keys.  Coarse buckets, as many at any size, come first.  Those
that differ are split into fine ones of a few rows each, and the rows of fine buckets that differ are all that is compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks import scratch
from . import diff

COARSE = 4096
#: Rows of both snapshots in a fine bucket, on average.
FINE_ROWS = 16
#: Buckets that may be sent to every task; with more of them rows are joined by bucket.
SENT_BUCKETS = 1_000_000


def _hashed(rows: DataFrame) -> DataFrame:
    key = list(diff.folded_key().values())
    return rows.withColumns({"h1": F.xxhash64(*key), "h2": F.xxhash64(F.lit(1), *key)})


def _digest() -> list[Column]:
    """Sums of halves of hashes with the side's sign: longs hold them for two thousand million rows of a bucket."""
    low, high = (lambda h: F.col(h).bitwiseAND(F.lit((1 << 32) - 1))), (lambda h: F.shiftright(h, 32))
    return [F.sum("sign").alias("d0"), *[F.sum(F.col("sign") * part(h)).alias(f"{h}_{i}") for h in ("h1", "h2") for i, part in enumerate((low, high))]]


def _differing(both: DataFrame, by: list[str]) -> DataFrame:
    sums = both.groupBy(*by).agg(*_digest())
    differs = F.lit(False)
    for c in sums.columns[len(by) :]:
        differs = differs | (F.col(c) != 0)
    return sums.where(differs).select(*by)


def _of(rows: DataFrame, buckets: DataFrame, by: list[str]) -> DataFrame:
    return rows.join(F.broadcast(buckets) if buckets.count() <= SENT_BUCKETS else buckets, by, "left_semi")


def _placed(coarse_first: bool, fine_buckets: int = 1) -> list[Column]:
    coarse = F.pmod("h1", F.lit(COARSE)).cast("int").alias("coarse")
    fine = F.pmod(F.shiftright("h1", 12), F.lit(fine_buckets)).alias("fine")
    return [coarse] if coarse_first else [coarse, fine]


class _Compared:
    """Both snapshots, read once for their hashes: the fine buckets that differ, and counts and sums of either side."""

    def __init__(self, new: DataFrame, baseline: DataFrame):
        self.sides = (new, baseline)
        sides = [_hashed(rows).select("h1", "h2", "employees", F.lit(sign).cast("long").alias("sign")) for rows, sign in zip(self.sides, (1, -1), strict=True)]
        with scratch.written(sides[0].unionByName(sides[1])) as both:
            total = F.coalesce(F.sum("employees"), F.lit(0)).cast("long")
            self.sums = {r.sign: (r.n, r.e) for r in both.groupBy("sign").agg(F.count("*").alias("n"), total.alias("e")).collect()}  # two rows
            keyed = both.select("h1", "h2", "sign", *_placed(True))
            with scratch.written(_differing(keyed, ["coarse"])) as differing:
                some = _of(keyed, differing, ["coarse"])
                self.fine = max(1, some.count() // (FINE_ROWS * COARSE))
                self.buckets = scratch.stored(_differing(some.select("*", _placed(False, self.fine)[1]), ["coarse", "fine"]))

    def narrowed(self) -> tuple[DataFrame, DataFrame]:
        new, old = (_of(_hashed(rows).select("*", *_placed(False, self.fine)), self.buckets, ["coarse", "fine"]).select(*rows.columns) for rows in self.sides)
        return new, old


def narrowed(new: DataFrame, baseline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both snapshots without the rows of buckets that agree; every key keeps all of its rows or none.

    What is added, removed or folded by key is the same for what is left.  Either side is read twice, first for its keys alone.
    """
    return _Compared(new, baseline).narrowed()


def casefold(new: DataFrame, baseline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``diff.casefold``."""
    return diff.casefold(*narrowed(new, baseline))


def totals(new: DataFrame, baseline: DataFrame) -> DataFrame:
    """As ``diff.totals``: whole sides are counted with their hashes, changes among the rows that differ."""
    compared = _Compared(new, baseline)
    changes = diff.totals(*compared.narrowed())
    (n1, e1), (n0, e0) = (compared.sums.get(sign, (0, 0)) for sign in (1, -1))
    whole = {"latest_count": n1, "latest_employees": e1, "snapshot_count": n0, "snapshot_employees": e0, "employees_delta": e1 - e0}
    return changes.withColumns({c: F.lit(v).cast("long") for c, v in whole.items()})
