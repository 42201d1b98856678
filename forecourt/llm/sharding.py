"""Operator 5: contiguous shards of minimax size.

Equal texts form an atomic group.  Groups are ordered by a 63-bit hash of their text (texts of one
hash stay together, which can only join groups) and cut into ``shards`` contiguous runs so that the
largest run is as small as contiguous cuts allow.  The smallest feasible capacity is found by binary
search; a capacity is feasible if filling shards greedily, each up to the capacity or with one larger group
alone, needs no more than ``shards`` of them.  So a hot group does not raise the capacity of the others.
The groups larger than that capacity are shards of their own, the others between them are searched again
with the shards that remain, of which the segment with the largest mean load gets the next.  Where no
group is larger, each cut is the possible one nearest to an even share.

*At scale.*  The groups never meet in one place.  The driver works on the sizes of hash ranges: at
first 4,096 equal ranges of the hash line.  The search needs to know more only where an end falls
inside a range, so those ranges and their neighbours are split into 4,096 again, by one aggregate over the
group table limited to them, until every range that decides an end is a single group.  The driver holds some
tens of thousands of numbers at any size of the input; all counts and sums are made by Spark.

``slot`` numbers the rows of a shard from 0 in the order of a hash of the row (``rank_in_groups``), so
no task holds a shard.  Texts are read once, for their hash, size and CRC; only those travel.

Cases: a null text has no bytes and groups with the empty one (size 1, CRC 0); a null id is kept;
repeated rows are rows; a group larger than the capacity of the others fills a shard alone and the others
share the rest; with fewer groups than shards the last shards are empty; an empty table gives an empty
result.  Columns of ``docs`` named like the results are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import rank_in_groups, staged, utf8_bytes

#: Each step splits a range of the hash line into so many.
FAN_BITS = 12
LINE_BITS = 63
#: Ranges split by one aggregate, so that the driver gets 262,144 rows at most.
SPLIT_AT_ONCE = 64


@dataclass(frozen=True)
class Range:
    """Groups whose hash is in lo .. lo + 2**bits - 1, and their size; bits 0: one group."""

    lo: int
    bits: int
    size: int


class _Cuts:
    """The cuts for ranges taken as groups; ``unknown``: the ranges of more than one group that decide any of them."""

    def __init__(self, ranges: list[Range], shards: int):
        self.ranges, self.unknown = ranges, set()
        self.upto = list(accumulate((r.size for r in ranges), initial=0))
        self.cuts = self._even(0, len(ranges), shards)[1:] if ranges else []

    def _ask(self, i: int) -> None:
        if i < len(self.ranges) and self.ranges[i].bits:
            self.unknown.add(i)

    def _floor(self, value: int) -> int:
        """The last end at or before a value."""
        i = bisect_right(self.upto, value) - 1
        if self.upto[i] < value:
            self._ask(i)
        return i

    def _runs(self, lo: int, hi: int, capacity: int, most: int, asked: bool = False) -> int:
        """Runs of the greedy filling, more than ``most`` if these do not reach the end."""
        n = 0
        while lo < hi and n <= most:
            n += 1
            if self.ranges[lo].size > capacity:
                if asked:
                    self._ask(lo)
                lo += 1
            else:
                reach = min(self.upto[lo] + capacity, self.upto[hi])
                lo = self._floor(reach) if asked else bisect_right(self.upto, reach) - 1
        return n

    def _even(self, lo: int, hi: int, shards: int) -> list[int]:
        """First range of each shard."""
        low, high = 0, self.upto[hi] - self.upto[lo]
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self._runs(lo, hi, mid, shards) <= shards else (mid + 1, high)
        # With all ranges known that these two meet, the first is feasible and the second not.
        self._runs(lo, hi, low, shards, True)
        if low:
            self._runs(lo, hi, low - 1, shards, True)
        hot = [i for i in range(lo, hi) if self.ranges[i].size > low]
        if not hot:
            return self._nearest(lo, hi, shards, low)
        edges = [lo - 1, *hot, hi]
        parts = [(a + 1, b) for a, b in zip(edges, edges[1:], strict=False) if a + 1 < b]
        given = [self._runs(a, b, low, shards) for a, b in parts]
        for _ in range(shards - len(hot) - sum(given)):
            room = [k for k, (a, b) in enumerate(parts) if b - a > given[k]]
            if not room:
                break
            given[max(room, key=lambda k: (self.upto[parts[k][1]] - self.upto[parts[k][0]]) / given[k])] += 1
        return sorted(hot + [i for (a, b), k in zip(parts, given, strict=True) for i in self._even(a, b, k)])

    def _nearest(self, lo: int, hi: int, shards: int, capacity: int) -> list[int]:
        """No range is larger than the capacity: ends as near to even shares as it allows."""
        first = [hi]  # of the last shards, filled from the end
        for _ in range(shards - 1):
            value = max(self.upto[lo], self.upto[first[-1]] - capacity)
            self._floor(value)
            first.append(bisect_left(self.upto, value))
        first.reverse()
        out, start, size = [lo], self.upto[lo], self.upto[hi] - self.upto[lo]
        for k in range(1, shards):
            if out[-1] + 1 >= hi:
                break
            aim = start + size * k // shards
            i = self._floor(aim)
            if i < hi and 2 * (aim - self.upto[i]) > self.ranges[i].size:
                i += 1
            least = max(first[k - 1], out[-1] + 1)
            most = min(self._floor(min(self.upto[out[-1]] + capacity, self.upto[hi])), max(out[-1] + 1, hi - (shards - k)))
            out.append(max(least, min(i, most)))
        return [i for i in out if i < hi]


def _split(groups: DataFrame, ranges: list[Range]) -> list[Range]:
    """The groups in these ranges (of one width), by ranges 4,096 times finer: one aggregate."""
    finer = max(0, ranges[0].bits - FAN_BITS)
    spans: list[list[int]] = []
    for r in ranges:
        if spans and spans[-1][1] + 1 == r.lo:
            spans[-1][1] += 1 << r.bits
        else:
            spans.append([r.lo, r.lo + (1 << r.bits) - 1])
    inside = reduce(or_, (F.col("h").between(lo, hi) for lo, hi in spans))
    rows = (
        groups.filter(inside).groupBy(F.shiftrightunsigned("h", finer).alias("k"))
        .agg(F.sum("size").alias("size"), F.min("h").alias("lo"), F.max("h").alias("hi")).collect()
    )
    return [Range(r.lo, 0, r.size) if r.lo == r.hi else Range(r.k << finer, finer, r.size) for r in rows]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """First hash of the second, third, ... shard, and the largest load, for ``groups(h, size)``."""
    ranges = sorted(_split(groups, [Range(0, LINE_BITS, 0)]), key=lambda r: r.lo)
    while True:
        found = _Cuts(ranges, shards)
        if not found.unknown:
            ends = [found.upto[i] for i in [0, *found.cuts, len(ranges)]]
            return [ranges[i].lo for i in found.cuts], max(b - a for a, b in zip(ends, ends[1:], strict=False))
        # The largest first: one that holds a hot group decides most.  Neighbours too: ends move as ranges are split.
        widest = max(ranges[i].bits for i in found.unknown)
        near = {j for i in found.unknown if ranges[i].bits == widest for j in range(max(0, i - 2), min(len(ranges), i + 3)) if ranges[j].bits == widest}
        chosen = set(sorted(near, key=lambda i: (i not in found.unknown, -ranges[i].size))[:SPLIT_AT_ONCE])
        finer = _split(groups, [ranges[i] for i in sorted(chosen)])
        ranges = sorted([r for i, r in enumerate(ranges) if i not in chosen] + finer, key=lambda r: r.lo)


def shards(docs: DataFrame, n: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, crc, shard, slot)`` of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"), (utf8_bytes(text) + 1).alias("size"), F.crc32(text).alias("crc"),
            F.shiftrightunsigned(F.xxhash64(text), 1).alias("h"),
        ), "sizes",
    )
    groups = staged(rows.groupBy("h").agg(F.sum("size").alias("size")), "groups")
    cuts, _ = minimax_cuts(groups, n)
    shard = F.size(F.filter(F.array(*(F.lit(c) for c in cuts)).cast("array<bigint>"), lambda c: c <= F.col("h")))
    dealt = rows.select("id", "size", "crc", shard.alias("shard"), F.xxhash64("id", "h").alias("r"))
    return rank_in_groups(dealt, ["shard"], [F.col("r"), F.col("id"), F.col("crc")], "slot").drop("r")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def contract_rows(docs: DataFrame) -> DataFrame:
    return shards(docs, 8).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
