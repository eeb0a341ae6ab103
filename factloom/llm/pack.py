"""Filling containers of fixed capacity with items of varying length, leaving as little room as possible.

What fits together is planned on the histogram of lengths, which is bounded by the capacity whatever the
number of items: gaps are closed exactly by single lengths, pairs and triples that add up to them, as many
times as all of them are available; what has no exact complement is placed best fit. Items then find their
container by their rank within their length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import shared_dir, shuffle_partitions


def _sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which sums of one length of ``a`` and one of ``b`` there are, up to the same greatest length."""
    n = 1 << (2 * len(a) - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(a.astype(float), n) * np.fft.rfft(b.astype(float), n), n)[: len(a)] > 0.5


class Complements:
    """Available lengths, and an index of the gaps that one, two or three of them fill exactly.

    ``free`` counts the copies of each length; ``pairs`` and ``triples`` tell of each gap whether two or three
    lengths add up to it. Copies are only ever used up, so a gap that fails once is struck out for good, and all
    failures together cost no more than one look-up for each gap.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.free = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.free[length] = n
        there = self.free > 0
        self.below = [x if there[x] else x - 1 for x in range(capacity + 1)]  # the way down to the next length there may be
        self.pairs = _sums(there, there)
        self.triples = _sums(self.pairs, there)

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.free[gap] > 0 else None

    def _pair(self, gap: int) -> tuple[int, ...] | None:
        half = gap // 2
        copies = np.minimum(self.free[1 : half + 1], self.free[gap - half : gap][::-1])
        if gap % 2 == 0:
            copies[-1] = self.free[half] // 2
        k = int(copies.argmax())
        return (gap - k - 1, k + 1) if copies[k] > 0 else None

    def pair(self, gap: int) -> tuple[int, ...] | None:
        """The pair with the most copies available."""
        found = self._pair(gap) if self.pairs[gap] else None
        self.pairs[gap] = found is not None
        return found

    def triple(self, gap: int) -> tuple[int, ...] | None:
        """The triple of the longest length whose rest is a pair."""
        if self.triples[gap]:
            for c in np.flatnonzero((self.free[: gap - 1] > 0) & self.pairs[2 : gap + 1][::-1])[::-1]:
                rest = gap - int(c)
                self.free[c] -= 1
                found = self._pair(rest)
                self.free[c] += 1
                if found:
                    return (int(c), *found)
                self.pair(rest)  # struck out unless only the copy of c was lacking
            self.triples[gap] = False
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        return self.single(gap) or (self.pair(gap) if gap > 1 else None) or (self.triple(gap) if gap > 2 else None)

    def largest(self, gap: int) -> int | None:
        """Best fit: the longest available length within a gap. Ways down over used-up lengths are shortened."""
        at, passed = gap, []
        while at > 0 and self.free[at] == 0:
            passed.append(at)
            at = self.below[at] if self.below[at] < at else at - 1
        for x in passed:
            self.below[x] = at
        return at if at > 0 else None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one container, number of such containers), using up every length.

    From the longest length down. A container that no exact complement can close takes the longest item
    that fits and is tried again. Each pattern is repeated while all its lengths last, so there are about as
    many patterns as lengths.
    """
    stock = Complements(counts, capacity)
    out = []
    top = capacity
    while True:
        if (top := stock.largest(top)) is None:
            return out
        held = [top]
        stock.free[top] -= 1
        gap = capacity - top
        while gap > 0:
            if closing := stock.exact(gap):
                held += closing
                for x in closing:
                    stock.free[x] -= 1
                break
            if (x := stock.largest(gap)) is None:
                break
            held.append(x)
            stock.free[x] -= 1
            gap -= x
        more = min(int(stock.free[x]) // k for x, k in Counter(held).items())
        for x in held:
            stock.free[x] -= more
        out.append((tuple(held), 1 + more))


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Runs of equal-length slots: length, first rank, end rank, first container, slots a container."""
    rows, used, base = [], Counter(), 0
    for held, times in patterns:
        for length, k in Counter(held).items():
            rows.append((length, used[length], used[length] + k * times, base, k))
            used[length] += k * times
        base += times
    return pd.DataFrame(rows, columns=["length", "start", "end", "base", "k"]).sort_values(["length", "start"], ignore_index=True)


def pack(items: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(container, key, piece, size) of all items with a positive size.

    An item larger than the capacity is cut: full pieces have a container each, the remainder is placed like
    any other item, and ``piece`` counts from 0. Null sizes, zero and less are not placed. Equal items are
    interchangeable; which of them goes where follows from a hash of the key. No container exceeds the
    capacity. An empty input gives no rows.
    """
    spark = items.sparkSession
    shared_dir(spark)
    n = F.col(size).cast("bigint")
    pieces = (
        items.where(n > 0)
        .select(F.col(key).alias("key"), n.alias("n"), F.explode(F.sequence(F.lit(0), F.floor((n - 1) / capacity).cast("int"))).alias("piece"))
        .select("key", "piece", F.least(F.lit(capacity), F.col("n") - F.col("piece").cast("bigint") * capacity).cast("int").alias("length"))
        # a hot length is ranked in buckets of the key, not in one task
        .withColumn("bucket", F.pmod(F.xxhash64("key", "piece"), F.lit(4 * shuffle_partitions(spark))).cast("int"))
        .checkpoint()
    )
    per_bucket = pieces.groupBy("length", "bucket").count()
    histogram = {r["length"]: r["n"] for r in per_bucket.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    table = slots(plan(histogram, capacity))
    sent = spark.sparkContext.broadcast(table)

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("length", "bucket").orderBy("key", "piece")
    ranked = pieces.withColumn("r", F.row_number().over(within) - 1).join(offsets, ["length", "bucket"]).select("key", "piece", "length", (F.col("r") + F.col("offset")).alias("rank"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = sent.value
        wide = np.int64(1) << 44
        starts = t["length"].to_numpy(np.int64) * wide + t["start"].to_numpy(np.int64)
        base, first, k = (t[c].to_numpy(np.int64) for c in ("base", "start", "k"))
        for b in batches:
            rank = b["rank"].to_numpy(np.int64)
            at = np.searchsorted(starts, b["length"].to_numpy(np.int64) * wide + rank, side="right") - 1
            yield pd.DataFrame({"container": base[at] + (rank - first[at]) // k[at], key: b["key"], "piece": b["piece"], size: b["length"]})

    kind = items.schema[key].dataType.simpleString()
    return ranked.mapInPandas(place, f"container long, `{key}` {kind}, piece int, `{size}` int")
