"""MinHash near-duplicates with tensored banding, confirmed on full shingle sets.

Two small collections of band hashes are computed for each text, ``BANDS`` of ``ROWS`` minima each.  A table's key combines a
band of the first collection with one of the second: BANDS x BANDS tables from 2 x BANDS x ROWS minima.  Texts are dealt by each
band of the first collection, and inside such a group the table keys are formed by the bands of the second; only texts of one
bucket, which share the whole key, are compared.  Buckets are screened without error: sizes must allow the similarity, and a
parity sketch (each shingle flips one bit, so that two sketches never differ in more bits than the sets do in shingles) bounds
the difference of two sets from below.

A group does not emit all the pairs that pass, but a spanning forest of them.  The forest's pairs are confirmed on the full sets
and joined into components.  If all are confirmed, every other pair of the group lies inside a component already and is not
needed.  A group with a pair that fails is looked at again: among texts of different components, without the pairs that failed,
and with more forests at a time.  This goes on until no group has a failed pair, so that no pair is left out, and close groups
of thousands of copies cost a few pairs a member.  Texts with the same set of shingles are one node from the start.

Band values of more than ``GROUP`` texts are first dealt into parts, then one text of each component meets the others.  What
is still of several components, such as boilerplate that many different texts share, is dealt by whole table keys; tables that
are still too large are met block by block: every text that is not of the table's largest component meets all its parts.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded_batches, forget, matched, stored

#: Bands of each collection, and minima of a band.  At similarity 0.8 a pair shares no table once in 11,000 times.
BANDS, ROWS = 14, 3
SEED = 20
#: Forests that a group emits in the first round, and by how much that grows when pairs fail.
FORESTS, GROWTH = 1, 8
#: What a row does in its group: ask and be a candidate, or one of the two.
BOTH, ASKS, OFFERED = 0, 1, 2
#: Columns that name a group.
GROUP_KEY = ["band", "key", "part", "block"]
#: Bits of a parity sketch: from four to eight times the number of shingles, within these bounds.
LEAST_BITS, MOST_BITS = 256, 8192
#: Texts of one band value that are dealt together; larger groups are dealt into parts.
GROUP = 4096
#: Members of a bucket up to which all its pairs are listed; larger buckets are searched from one member to the next.
LISTED = 32
#: Pairs for each row up to which groups that are looked at again emit all of them.
PAIRS_PER_ROW = 64
#: Pairs of different components up to which they are listed in larger buckets as well, and that are met at a time.
MOST_LISTED = 1 << 18
#: Pairs of one text that are confirmed in one place.
SLICE = 64

_rng = np.random.default_rng(SEED)
_A = _rng.integers(1, 1 << 63, size=2 * BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, size=2 * BANDS * ROWS, dtype=np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SET = ["n_shingles", "sum1", "sum2"]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; the whole sequence if it has fewer words than ``width``."""
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(width, len(w))
    h = np.full(len(w) - size + 1, size, dtype=np.uint64)
    for j in range(size):
        h = mix(h + w[j : len(w) - size + 1 + j])
    return np.unique(h)


def minima(s: np.ndarray) -> np.ndarray:
    """The minima of a set under each hash, 32 bits each."""
    out = np.full(len(_A), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(s), 2048):
        h = (_A[:, None] * s[None, at : at + 2048] + _B[:, None]) >> np.uint64(32)
        np.minimum(out, h.min(1), out=out)
    return out.astype(np.uint32)


def parity(s: np.ndarray) -> bytes:
    """Parity sketch of a set; half of a larger sketch, folded over the other half, is the sketch of half the size."""
    bits = min(MOST_BITS, max(LEAST_BITS, 4 << max(0, len(s) - 1).bit_length()))
    flips = np.bincount((s >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def identity(s: np.ndarray) -> tuple[int, int, int]:
    """Size and two sums, which tell sets apart."""
    return len(s), int(s.sum().view(np.int64)), int(mix(s ^ np.uint64(SEED)).sum().view(np.int64))


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, identity of the set, band keys of the first collection, bands of the second, and parity of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                s = shingles(text, width)
                if not len(s):
                    rows.append((0, 0, 0, None, None, None))
                    continue
                m = minima(s)
                bands = m[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
                key = np.zeros(BANDS, dtype=np.uint64)
                for j in range(ROWS):
                    key = mix(key + bands[:, j] + np.uint64(j + 1))
                rows.append((*identity(s), key.view(np.int64), (m[BANDS * ROWS :] & 255).astype(np.uint8).tobytes(), parity(s)))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
            # ids never pass through pandas, which would round longs that stand beside a null
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *SET, "bands", "second", "parity"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, sum1 long, sum2 long, bands array<long>, second binary, parity binary")


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Positions of pairs (i, j) of 0 .. n-1 that form a spanning forest of them; stars around small numbers first."""
    label, live, chosen = np.arange(n), np.arange(len(i)), []
    while len(live):
        a, b = label[i[live]], label[j[live]]
        live, high, low = live[a != b], np.maximum(a, b)[a != b], np.minimum(a, b)[a != b]
        order = np.lexsort((low, high))
        first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])] if len(order) else order
        chosen.append(live[first])
        up = np.arange(n)
        up[high[first]] = low[first]
        while (up != up[up]).any():
            up = up[up]
        label = up[label]
    return np.concatenate([np.zeros(0, dtype=np.int64), *chosen])


class _Members:
    """Rows of whole groups, in the order of their groups, and which pairs of them may be similar."""

    def __init__(self, pdf: pd.DataFrame, similarity: float):
        self.similarity = similarity
        self.doc, self.n, self.label, self.role = (pdf[c].to_numpy() for c in ("doc_id", "n_shingles", "label", "role"))
        key = pdf[GROUP_KEY].to_numpy()
        self.group = np.cumsum(np.concatenate([[False], (key[1:] != key[:-1]).any(1)])) if len(pdf) else np.zeros(0, dtype=np.int64)
        second = np.frombuffer(b"".join(pdf["second"]), dtype=np.uint8).reshape(len(pdf), -1, ROWS).astype(np.int64)
        self.second = sum(second[:, :, r] << (8 * r) for r in range(ROWS))
        self.bits = np.array([len(p) for p in pdf["parity"]])
        self.at, self.sketches = {}, {}
        for size in np.unique(self.bits):  # a pair meets at the smaller sketch of its two
            own, twice = np.flatnonzero(self.bits == size), np.flatnonzero(self.bits == 2 * size)
            m = np.frombuffer(b"".join(pdf["parity"].iloc[own]), dtype=np.uint8).reshape(len(own), size)
            if len(twice):
                large = np.frombuffer(b"".join(pdf["parity"].iloc[twice]), dtype=np.uint8).reshape(len(twice), 2 * size)
                m = np.concatenate([m, large[:, :size] ^ large[:, size:]])
            at = np.full(len(pdf), -1)
            at[np.concatenate([own, twice])] = np.arange(len(own) + len(twice))
            self.at[size], self.sketches[size] = at, np.ascontiguousarray(m).view(np.uint64)
        self.docs, self.dense = np.unique(self.doc, return_inverse=True)
        self.failed = np.zeros(0, dtype=np.int64)
        tried = [(d, np.asarray(x)) for d, x in zip(self.dense, pdf["failed"], strict=True) if x is not None]
        if tried:
            high, low = np.repeat([d for d, _ in tried], [len(x) for _, x in tried]), np.concatenate([x for _, x in tried])
            at = np.minimum(np.searchsorted(self.docs, low), len(self.docs) - 1)
            self.fails(high[self.docs[at] == low], at[self.docs[at] == low])
        # rows of one component in one group count as joined
        _, first, inverse = np.unique(np.column_stack([self.group, self.label]), axis=0, return_index=True, return_inverse=True)
        self.joined = first[inverse.ravel()]

    def fails(self, d: np.ndarray, e: np.ndarray) -> None:
        """Leave out pairs of documents, by their dense numbers, from now on."""
        code = np.maximum(d, e) * len(self.docs) + np.minimum(d, e)
        self.failed = np.union1d(self.failed, code)

    def similar(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether pairs may reach the similarity, differ in component, may meet, and have not failed."""
        n, m = self.n[i], self.n[j]
        ok = (self.label[i] != self.label[j]) & ((self.role[i] != self.role[j]) | (self.role[i] == BOTH))
        ok &= np.minimum(n, m) >= self.similarity * np.maximum(n, m) - 1e-9
        at = np.flatnonzero(ok)
        size = np.minimum(self.bits[i[at]], self.bits[j[at]])
        most = (n[at] + m[at]) * (1 - self.similarity) / (1 + self.similarity) + 1e-6
        for s in np.unique(size):
            own = np.flatnonzero(size == s)
            for a in range(0, len(own), 1 << 14):
                part = own[a : a + (1 << 14)]
                left, right = self.at[s][i[at[part]]], self.at[s][j[at[part]]]
                apart = np.bitwise_count(self.sketches[s][left] ^ self.sketches[s][right]).sum(1, dtype=np.int64)
                ok[at[part[(left >= 0) & (right >= 0) & (apart > most[part])]]] = False
        if len(self.failed):
            at = np.flatnonzero(ok)
            d, e = self.dense[i[at]], self.dense[j[at]]
            ok[at] = ~np.isin(np.maximum(d, e) * len(self.docs) + np.minimum(d, e), self.failed)
        return ok

    def searched(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that connect a large bucket: from each member reached to all that it is similar to and that are not reached."""
        left, lefts, rights = members[np.argsort(self.doc[members], kind="stable")], [], []
        waiting: list[int] = []
        while len(left):
            if not waiting:
                waiting, left = [int(left[0])], left[1:]
            a = waiting.pop(0)
            new = self.similar(np.full(len(left), a), left)
            lefts.append(np.full(int(new.sum()), a))
            rights.append(left[new])
            new |= self.joined[left] == self.joined[a]
            waiting += left[new].tolist()
            left = left[~new]
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *lefts]), np.concatenate([none, *rights])

    def across(self, members: np.ndarray, again: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """Similar pairs of a large bucket that are of different components, met block by block; None if there are too many.

        In the first look at a group no component is known yet, so that only buckets with few pairs are listed.
        """
        whose, size = np.unique(self.joined[members], return_counts=True)
        outside = self.joined[members] != whose[size.argmax()]
        others, most = members[outside], PAIRS_PER_ROW * len(members)
        if not again and len(others) * len(members) > MOST_LISTED:
            return None
        none = np.zeros(0, dtype=np.int64)
        lefts, rights, step = [none], [none], max(1, MOST_LISTED // len(members))
        for at in range(0, len(others), step):
            block = others[at : at + step]
            i, j = np.repeat(block, len(members)), np.tile(members, len(block))
            ok = (self.joined[i] != self.joined[j]) & (~np.tile(outside, len(block)) | (i < j))
            i, j = i[ok], j[ok]
            ok = self.similar(i, j)
            lefts.append(i[ok])
            rights.append(j[ok])
            most -= int(ok.sum())
            if most < 0:
                return None
        return np.concatenate(lefts), np.concatenate(rights)

    def _merged(self, buckets: Iterable[np.ndarray]) -> list[np.ndarray]:
        """Large buckets, those that lie by half in an earlier one of their group joined with it, so that texts are not met again for each table."""
        unions: list[np.ndarray] = []  # which rows each has
        for members in sorted(buckets, key=len, reverse=True):
            home = next((u for u in unions if 2 * u[members].sum() >= len(members)), None)
            if home is None:
                unions.append(home := np.zeros(len(self.doc), dtype=bool))
            home[members] = True
        return [np.flatnonzero(u) for u in unions]

    def buckets(self, again: bool) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Pairs that share a table key, once each, of buckets small enough to be listed; members of the others."""
        codes, large, n = [], {}, len(self.doc)
        for j in range(self.second.shape[1]):
            order = np.lexsort((self.second[:, j], self.group))
            g, s = self.group[order], self.second[order, j]
            start = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])]))
            size = np.diff(np.concatenate([start, [n]]))
            for a, k in zip(start[size > LISTED], size[size > LISTED], strict=True):
                large[order[a : a + k].tobytes()] = order[a : a + k]  # copies share many tables; their bucket counts once
            left = np.repeat(np.where(size > LISTED, 0, start + size), size) - np.arange(n)  # members of the bucket from here on
            for away in range(1, LISTED):
                p = np.flatnonzero(left > away)
                if not len(p):
                    break
                a, b = order[p], order[p + away]
                codes.append(np.minimum(a, b) * n + np.maximum(a, b))
        rest = []
        for members in self._merged(large.values()):
            if (pairs := self.across(members, again)) is None:
                rest.append(members)
            else:
                codes.append(np.minimum(*pairs) * n + np.maximum(*pairs))
        code = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *codes]))
        return code // max(n, 1), code % max(n, 1), rest


def _forests(similarity: float, forests: int, again: bool) -> Callable:
    """Pairs (x, y) of each group with the group's band and key: ``forests`` spanning forests of the pairs that may be similar.

    A group that is looked at ``again`` emits all of its pairs if they are few; ``whole`` says so.
    """

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = _Members(pdf, similarity)
        i, j, large = rows.buckets(again)
        ok = rows.similar(i, j)
        i, j = i[ok], j[ok]
        band, key = pdf["band"].to_numpy(), pdf["key"].to_numpy()

        def pairs(a: np.ndarray, b: np.ndarray, whole: bool) -> pd.DataFrame:
            x, y = np.minimum(rows.doc[a], rows.doc[b]), np.maximum(rows.doc[a], rows.doc[b])
            return pd.DataFrame({"x": x, "y": y, "band": band[a], "key": key[a], "whole": whole}).drop_duplicates()

        if again and not large and len(i) <= PAIRS_PER_ROW * len(pdf):
            return pairs(i, j, True)
        out = [pairs(i[:0], j[:0], False)]
        for turn in range(forests):
            more = [rows.searched(m) for m in large]
            a, b = (np.concatenate([x, *[m[k] for m in more]]) for k, x in enumerate((i, j)))
            at = forest(rows.joined[a], rows.joined[b], len(pdf))
            if not len(at):
                break
            out.append(pairs(a[at], b[at], False))
            if turn + 1 < forests:
                rows.fails(rows.dense[a[at]], rows.dense[b[at]])
                rest = rows.similar(i, j)
                i, j = i[rest], j[rest]
        return pd.concat(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None
        for pdf in batches:
            pdf = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
            last = (pdf[GROUP_KEY] == pdf[GROUP_KEY].iloc[-1]).all(axis=1).to_numpy()
            first = len(pdf) - int(np.argmin(last[::-1])) if not last.all() else 0
            if first:
                yield found(pdf.iloc[:first].reset_index(drop=True))
            kept = pdf.iloc[first:].reset_index(drop=True)
        if kept is not None and len(kept):
            yield found(kept)

    return run


_PAYLOAD = ["doc_id", "n_shingles", "label", "second", "parity", "failed"]


def _banded(nodes: DataFrame) -> DataFrame:
    return nodes.select(*_PAYLOAD, F.posexplode("bands").alias("band", "key"))


def group_parts(nodes: DataFrame) -> DataFrame:
    """band, key and number of parts of the band values that more than one text has; parts have ``GROUP`` texts at most."""
    counted = nodes.select(F.posexplode("bands").alias("band", "key")).groupBy("band", "key").count()
    return counted.where(F.col("count") > 1).select("band", "key", F.ceil(F.col("count") / GROUP).cast("int").alias("parts"))


def candidate_pairs(groups: DataFrame, similarity: float, forests: int, again: bool) -> DataFrame:
    """x < y, band, key, whole: pairs that connect what may be similar in each group.  ``groups`` has the payload and GROUP_KEY."""
    several = groups.withColumn("several", F.count("*").over(Window.partitionBy(*GROUP_KEY))).where(F.col("several") > 1).drop("several")
    return several.sortWithinPartitions(*GROUP_KEY).mapInPandas(_forests(similarity, forests, again), "x long, y long, band int, key long, whole boolean")


def _alone() -> dict:
    return {"part": F.lit(0), "block": F.lit(0), "role": F.lit(BOTH)}


def _place(n: str):
    return F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")


def _in_parts(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """First round: all groups, large ones in parts.  A text's sketches go only where its band has company."""
    dealt = matched(_banded(nodes), shared, ["band", "key"]).withColumns(_alone())
    return dealt.withColumn("part", _place("parts")).drop("parts")


def _of_several(dealt: DataFrame) -> DataFrame:
    """Rows of the groups (band, key) that have texts of several components."""
    mixed = dealt.groupBy("band", "key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where(F.col("a") < F.col("b"))
    return matched(dealt, stored(mixed.select("band", "key")), ["band", "key"], "left_semi")


def _of_each_component(nodes: DataFrame, large: DataFrame) -> DataFrame:
    """Second round: one text of each component of the large groups, in parts where they are many."""
    dealt = matched(_banded(nodes), large.select("band", "key"), ["band", "key"], "left_semi")
    first = Window.partitionBy("band", "key", "label").orderBy("doc_id")
    ones = dealt.withColumn("nth", F.row_number().over(first)).where(F.col("nth") == 1).drop("nth")
    many = ones.groupBy("band", "key").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    return ones.join(many, ["band", "key"]).withColumns(_alone()).withColumn("part", _place("parts")).drop("parts")


def _by_tables(nodes: DataFrame, large: DataFrame) -> DataFrame:
    """Third round: large groups that are of several components still, dealt by whole table keys."""
    dealt = _of_several(matched(_banded(nodes), large.select("band", "key"), ["band", "key"], "left_semi"))
    tabled = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))))
    own = F.substring(F.col("second"), F.col("j") * ROWS + 1, F.lit(ROWS))
    tabled = tabled.withColumn("key", F.xxhash64("key", own)).withColumn("band", (BANDS * (F.col("band") + 1) + F.col("j")).cast("int")).drop("j")
    return in_blocks(tabled)


def in_blocks(tabled: DataFrame) -> DataFrame:
    """Rows (payload, band, key) of groups of several components, dealt so that all that may still be linked meet.

    Groups that are too large for one place are dealt so that all texts outside a group's largest component meet every part of it.
    """
    per_label = tabled.groupBy("band", "key", "label").count()
    main = per_label.groupBy("band", "key").agg(
        F.max_by("label", "count").alias("main"),
        F.sum("count").alias("all"),
        F.ceil(F.sum("count") / GROUP).cast("int").alias("parts"),
        F.ceil((F.sum("count") - F.max("count")) / GROUP).cast("int").alias("blocks"),
    )
    met = tabled.join(main.where(F.col("blocks") > 0), ["band", "key"])
    small = met.where(F.col("all") <= GROUP).withColumns(_alone())
    big = met.where(F.col("all") > GROUP)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    offered = big.withColumn("part", _place("parts")).withColumn("block", every("blocks")).withColumn("role", F.lit(OFFERED))
    asks = big.where(F.col("label") != F.col("main"))
    asks = asks.withColumn("block", _place("blocks")).withColumn("part", every("parts")).withColumn("role", F.lit(ASKS))
    return small.unionByName(offered).unionByName(asks).drop("parts", "blocks", "main", "all")


def packed_texts(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """doc_id and compressed text of the ids and sets that ``wanted`` names; of a repeated id the text that has the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            wanted = zip(*[batch.column(c).to_pylist() for c in SET], strict=True)
            keep = [identity(shingles(t, width)) == w for t, w in zip(texts, wanted, strict=True)]
            packed = [zlib.compress(t.encode("utf-8", "surrogatepass"), 1) for t, k in zip(texts, keep, strict=True) if k]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").filter(pa.array(keep, pa.bool_())), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = matched(rows, wanted, ["doc_id"]).select("doc_id", "text", *SET).mapInArrow(run, "doc_id long, packed binary")
    return stored(found.dropDuplicates(["doc_id"]))


def sliced(pairs: DataFrame, of: list[str]) -> DataFrame:
    """``pairs`` with a slice number: those that agree in ``of`` are dealt into slices of about ``SLICE``."""
    many = pairs.groupBy(*of).agg(F.ceil(F.count("*") / SLICE).alias("slices")).where(F.col("slices") > 1)
    part = F.pmod(F.xxhash64("y"), F.coalesce("slices", F.lit(1))).cast("int")
    return pairs.join(many, of, "left").withColumn("slice", part).drop("slices")


def with_hubs(slices: DataFrame) -> DataFrame:
    """The rows of ``sliced`` pairs (x, slice, y and others), and for each slice one with x itself as y."""
    rest = [c for c in slices.columns if c != "y"]
    return slices.unionByName(slices.select(*rest).distinct().withColumn("y", F.col("x")))


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """x, y and whether the full shingle sets reach the similarity, exactly, as the decimal fraction that it is written as.

    The pairs of one x are checked in slices: its text travels once a slice, and that of y once a pair.
    """
    share = Fraction(str(similarity))

    def items(packed: bytes) -> np.ndarray:
        return shingles(zlib.decompress(packed).decode("utf-8", "surrogatepass"), width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub = None
        for pdf in batches:
            out = []
            for x, y, packed in zip(pdf["x"], pdf["y"], pdf["packed"], strict=True):
                if x == y:
                    hub = items(packed)
                    continue
                s = items(packed)
                common = len(np.intersect1d(hub, s, assume_unique=True))
                out.append((x, y, share.denominator * common >= share.numerator * (len(hub) + len(s) - common)))
            yield pd.DataFrame(out, columns=["x", "y", "linked"]).astype({"x": "int64", "y": "int64", "linked": bool})

    ends = stored(with_hubs(sliced(pairs.select("x", "y"), ["x"])))
    met = matched(texts.withColumnRenamed("doc_id", "y"), ends, ["y"])
    dealt = met.repartition("x", "slice").sortWithinPartitions("x", "slice", "y")  # x < y, so that x comes first
    checked = stored(dealt.select("x", "y", "packed").mapInPandas(run, "x long, y long, linked boolean"))
    forget(ends)
    return checked


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable from each node that has a link; smallest neighbours with pointer jumping."""
    ways = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    both = stored(links.select(F.inline(ways)).distinct())
    labels = stored(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("low")).select("node", F.least("node", "low").alias("label")))
    total, before = None, None
    while True:
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]  # labels only ever fall
        forget(before)
        if now is None or now == total:
            forget(both)
            return labels
        total, before = now, labels
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = labels.join(up, "label", "left").select("node", F.least("label", "above").alias("label"))
        seen = both.join(jumped.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("low"))
        labels = stored(jumped.join(seen, "node", "left").select("node", F.least("label", "low").alias("label")))


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links: only the components that the links touch are looked at again."""
    merged = components(_between(links, labels))
    up = merged.select(F.col("node").alias("label"), F.col("label").alias("above"))
    old = labels.join(up, "label", "left").select("node", F.coalesce("above", "label").alias("label"))
    whole = stored(old.unionByName(merged.join(labels, "node", "left_anti")))
    forget(labels, merged)
    return whole


def between_components(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
    ends = pairs.join(of("x"), "x", "left").join(of("y"), "y", "left")
    return ends.withColumns({"x_label": F.coalesce("x_label", "x"), "y_label": F.coalesce("y_label", "y")}).where(F.col("x_label") != F.col("y_label"))


def _between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of components, as x and y, that ``pairs`` connects."""
    return between_components(pairs, labels).select(F.col("x_label").alias("x"), F.col("y_label").alias("y"))


class Linking:
    """Labels of the nodes so far, the texts that are needed to confirm pairs, and the pairs that failed."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, width: int, similarity: float):
        self.docs, self.nodes, self.width, self.similarity = docs, nodes, width, similarity
        self.labels: DataFrame | None = None
        self.failed: DataFrame | None = None
        self.texts: list[DataFrame] = []
        self.spent: list[DataFrame] = []

    def texts_of(self, pairs: DataFrame) -> DataFrame:
        """Texts of all ends of ``pairs``, and of earlier ones."""
        ids = pairs.select(F.explode(F.array("x", "y")).alias("doc_id")).distinct()
        for have in self.texts:
            ids = ids.join(have.select("doc_id"), "doc_id", "left_anti")
        wanted = stored(self.nodes.select("doc_id", *SET).join(ids, "doc_id", "left_semi"))
        if not wanted.isEmpty():
            self.texts.append(packed_texts(self.docs, wanted, self.width))
        forget(wanted)
        return functools.reduce(DataFrame.unionByName, self.texts)

    def confirmed(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """x, y, linked of each pair, written."""
        return confirmed(pairs, texts, self.width, self.similarity)

    def _check(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        checked = self.confirmed(pairs, texts)
        self.spent.append(checked)
        links = checked.where("linked").select("x", "y")
        if self.labels is None:
            self.labels = components(links)
        elif not links.isEmpty():
            self.labels = joined(self.labels, links)
        fell = checked.where(~F.col("linked")).select("x", "y")
        self.failed = fell if self.failed is None else self.failed.unionByName(fell)
        return checked

    def confirm(self, pairs: DataFrame) -> None:
        """Join the components that ``pairs`` link.  Of each y one pair goes first; the others only if they still connect two."""
        if pairs.isEmpty():
            return
        texts = self.texts_of(pairs)
        checked = self._check(pairs.groupBy("y").agg(F.min("x").alias("x")).select("x", "y"), texts)
        rest = stored(between_components(pairs.join(checked, ["x", "y"], "left_anti"), self.labels).select("x", "y"))
        if not rest.isEmpty():
            self._check(rest, texts)
        forget(rest)

    def labelled(self) -> DataFrame:
        """The nodes with their labels and, at the larger end, the pairs that failed."""
        if self.labels is None:
            return self.nodes.withColumns({"label": F.col("doc_id"), "failed": F.lit(None).cast("array<long>")})
        nodes = self.nodes.join(self.labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        failed = self.failed.groupBy(F.col("y").alias("doc_id")).agg(F.collect_set("x").alias("failed"))
        return nodes.join(failed, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))

    def settle(self, deal: Callable[[DataFrame], DataFrame], again: bool = False) -> None:
        """Confirm forests of the groups that ``deal`` makes of the labelled nodes until no group has a failed pair to make up for.

        ``again`` says that the groups have been looked at before, so that few pairs are left in them.
        """
        forests, open_groups, emitted = FORESTS, None, None
        while True:
            groups = deal(self.labelled())
            if open_groups is not None:
                groups = matched(groups, open_groups, ["band", "key"], "left_semi")
            forget(emitted)
            emitted = stored(candidate_pairs(groups, self.similarity, forests, again))
            forget(open_groups)
            before, pairs = self.failed, stored(emitted.select("x", "y").distinct())
            self.confirm(pairs)
            forget(pairs)
            if self.failed is None or self.failed is before:
                break
            # forests that lost a pair: their groups may have other pairs that connect the same texts
            lost = between_components(self.failed, self.labels).select("x", "y").distinct()
            open_groups = stored(emitted.where(~F.col("whole")).join(lost, ["x", "y"], "left_semi").select("band", "key").distinct())
            if open_groups.isEmpty():
                forget(open_groups)
                break
            forests, again = forests * GROWTH, True
        forget(emitted)

    def close(self) -> DataFrame | None:
        """node, label of the nodes that have a link (None: there are no pairs at all); everything else is removed."""
        forget(*self.texts, *self.spent)
        return self.labels


def _linked(docs: DataFrame, nodes: DataFrame, width: int, similarity: float) -> DataFrame | None:
    shared = stored(group_parts(nodes))
    state = Linking(docs, nodes, width, similarity)
    if not shared.isEmpty():
        state.settle(lambda n: _in_parts(n, shared))
        large = shared.where(F.col("parts") > 1)
        if not large.isEmpty():
            state.settle(lambda n: _of_each_component(n, large))
            state.settle(lambda n: _by_tables(n, large))
    forget(shared)
    return state.close()


class Sketched:
    """Sketches of all rows, one node for each different set of shingles, and which document is which node.

    ``columns`` of the sketches go with the nodes.  Rows that repeat an id are one document, that of the largest set.  Nodes are
    rows of the sketches, picked out by their places, so that sketches are written once and not dealt again.
    """

    def __init__(self, sketches: DataFrame, columns: list[str]):
        self.sketches = stored(sketches.withColumn("at", F.monotonically_increasing_id()))
        usable = self.sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        largest = F.max(F.struct(*SET, "at")).alias("own")
        self.own = stored(usable.groupBy("doc_id").agg(largest).select("doc_id", "own.*"))
        self.first = self.own.groupBy(*SET).agg(F.min(F.struct("doc_id", "at")).alias("one"), F.count("*").alias("copies"))
        self.first = stored(self.first.select(*SET, F.col("one.doc_id").alias("node"), F.col("one.at").alias("at"), "copies"))
        self.nodes = matched(self.sketches.where(F.col("n_shingles") > 0), self.first.select("at"), ["at"], "left_semi").select("doc_id", *SET, *columns)

    def _with_nodes(self) -> DataFrame:
        """doc_id and node of every document.  Sets of very many copies are sent to them, so that none is dealt to one task."""
        own, sets = self.own.select("doc_id", *SET), self.first.select(*SET, "node", "copies")
        size = sets.agg(F.count("*").alias("sets"), F.sum("copies").alias("rows")).first()
        if size.sets <= BROADCAST_ROWS:
            return own.join(F.broadcast(sets), SET).select("doc_id", "node")
        hot = F.col("copies") * BROADCAST_ROWS > size.rows  # no more sets than may be sent
        rest = own.join(F.broadcast(sets.where(hot)), SET, "left_anti").join(sets.where(~hot), SET)
        return own.join(F.broadcast(sets.where(hot)), SET).unionByName(rest).select("doc_id", "node")

    def placed(self, labels: DataFrame | None) -> DataFrame:
        """doc_id, n_shingles, component_id of every row; the sketches themselves are removed, but for the columns needed."""
        placed = self._with_nodes()
        if labels is not None:
            placed = placed.join(labels, "node", "left").select("doc_id", F.coalesce("label", "node").alias("node"))
        found = self.sketches.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id"))
        whole = stored(found.select("doc_id", "n_shingles", component.alias("component_id")))
        forget(self.sketches, self.own, self.first, labels)
        return whole


def near_duplicates(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id and kept.

    Words are runs without ASCII white space, A-Z in lower case.  Null and empty texts, and texts without a word, have no
    shingles and are linked with nothing.  Rows that repeat an id are one document; if their texts differ, that of most
    shingles is linked (ties: by the sums of its hashes), while each row tells the size of its own.  A row whose id is null is
    linked with nothing, has no component and is kept.  Whole texts are read, of any length.  Other columns are not read; an empty table gives an empty result.
    """
    rows = Sketched(sketch(docs, width), ["bands", "second", "parity"])
    found = rows.placed(_linked(docs, rows.nodes, width, similarity))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id; rows with null ids stay.

    Of rows that repeat an id one stays, that whose text hashes lowest.  All columns of ``docs`` come back as they are.
    """
    found = near_duplicates(docs, width, similarity).where(F.col("doc_id").isNotNull())
    each = stored(found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("rows")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), F.struct("*").alias("row"))
    # texts need not move as long as the ids that go, or are repeated, are few enough to be sent to them
    single = matched(rows, each.where(~F.col("kept") | (F.col("rows") > 1)).select("doc_id"), ["doc_id"], "left_anti")
    repeated = matched(rows, each.where(F.col("kept") & (F.col("rows") > 1)).select("doc_id"), ["doc_id"], "left_semi")
    repeated = repeated.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id").orderBy("hash"))).where(F.col("nth") == 1)
    return single.select("row").unionByName(repeated.select("row")).select("row.*")
