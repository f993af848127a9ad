"""Best-fit packing of pieces into sequences by exact-complement hashing.

Only how many pieces have each length decides how they are packed, and there are
at most ``capacity`` lengths. So the counts are collected (never more rows than
``capacity``), a plan is made over lengths, and the pieces find their places in the
plan by their number within their length.

The plan opens sequences with the longest length left. An index of the sums of one,
two and three available lengths tells which combinations fill a gap exactly; a
combination is taken as often as its lengths are available. Where no combination
fits exactly, the longest length that fits goes in (best fit) and the smaller gap
is tried again. Each step handles all equal sequences together and uses up a length
or fills its sequences, so the plan has few entries, however many pieces there are.

Pieces are numbered within their length by buckets of a bounded number of rows, so
a length that a third of all pieces share is spread over many tasks.

Defined results: equal rows are pieces of their own; NULL lengths and lengths
outside 1 to ``capacity`` are an error; an empty table gives an empty table. Other
columns stay; a column named like an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import materialize

# Pieces numbered together by one task.
BUCKET_ROWS = 256
# Lengths that may run out before the sums are indexed anew.
_STALE = 64


class SumIndex:
    """Sums of one, two and three available lengths, and combinations for a sum.

    The sums of two and three may be out of date, but only by naming too many:
    lengths run out and never come back. Every combination given is available.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.ran_out = 0
        self._index()

    def _index(self) -> None:
        size = len(self.counts)
        one = (self.counts > 0).astype(np.float64)
        two = np.convolve(one, one)[:size] > 0.5
        three = np.convolve(two.astype(np.float64), one)[:size] > 0.5
        self.two, self.three, self.ran_out = two, three, 0

    def take(self, length: int, number: int) -> None:
        self.counts[length] -= number
        if self.counts[length] == 0:
            self.ran_out += 1
            if self.ran_out > _STALE:
                self._index()

    def _pair(self, gap: int, most: int, used: int = 0) -> tuple[int, int] | None:
        """The pair that sums to ``gap`` with the longest part of at most ``most``."""
        low = np.arange((gap + 1) // 2, min(gap - 1, most) + 1)
        fits = low[(self.counts[low] > (low == used)) & (self.counts[gap - low] > 0)]
        for long in fits[::-1].tolist():
            short = gap - long
            need = (long == short) + (short == used) + 1
            if self.counts[short] >= need and self.counts[long] >= 1 + (long == used):
                return long, short
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """Up to three available lengths that fill a gap exactly, the longest first."""
        if self.counts[gap] > 0:
            return (gap,)
        if self.two[gap]:
            pair = self._pair(gap, gap)
            if pair:
                return pair
        if self.three[gap]:
            first = np.arange((gap + 2) // 3, gap - 1)
            for long in first[(self.counts[first] > 0) & self.two[gap - first]][::-1].tolist():
                pair = self._pair(gap - long, long, long)
                if pair:
                    return long, *pair
        return None

    def longest(self, gap: int) -> int:
        """The longest available length that fits a gap; 0 if none does."""
        fits = np.flatnonzero(self.counts[1 : gap + 1])
        return int(fits[-1]) + 1 if len(fits) else 0


Pattern = list[tuple[int, int]]


def plan(counts: np.ndarray, capacity: int) -> list[tuple[int, Pattern]]:
    """How often which lengths go together: (sequences, [(length, times), ...]).

    ``counts[n]`` is the number of pieces of length n, for 0 to ``capacity``.
    """
    counts = counts.astype(np.int64).copy()
    index = SumIndex(counts)
    done: list[tuple[int, Pattern]] = []
    anchor = capacity
    while True:
        anchor = index.longest(anchor)
        if not anchor:
            return done
        number = int(counts[anchor])
        index.take(anchor, number)
        # Groups of equal sequences: how many, the gap left, what is in them.
        groups = [(number, capacity - anchor, [(anchor, 1)])]
        while groups:
            number, gap, held = groups.pop()
            parts = index.exact(gap) if gap else None
            longest = index.longest(gap) if gap and not parts else 0
            if parts:
                needed = {p: parts.count(p) for p in parts}
            elif longest:
                needed = {longest: 1}
            else:
                done.append((number, held))
                continue
            ready = min(number, *(int(counts[p]) // n for p, n in needed.items()))
            if not parts:
                # As many of the longest as each of these sequences can take.
                needed[longest] = min(gap // longest, int(counts[longest]) // ready)
            for part, times in needed.items():
                index.take(part, ready * times)
            if ready < number:
                groups.append((number - ready, gap, held))
            rest = gap - sum(part * times for part, times in needed.items())
            groups.append((ready, rest, held + list(needed.items())))


def slots(patterns: list[tuple[int, Pattern]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: intervals of their numbers within the length.

    Piece ``first + q`` of an interval goes to sequence ``sequence + q // times`` at
    ``offset + q % times * length``.
    """
    given: dict[int, int] = {}
    rows = []
    sequence = 0
    for number, pattern in patterns:
        offset = 0
        for length, times in pattern:
            first = given.get(length, 0)
            given[length] = first + number * times
            rows.append((length, first, sequence, times, offset))
            offset += length * times
        sequence += number
    rows.sort()
    table = np.asarray(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "times", "offset"), table.T, strict=True))


def _place(table: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray):
    """Sequence and offset of pieces by length and number within the length."""
    sequence, offset = np.empty_like(rank), np.empty_like(rank)
    for value in np.unique(length):
        low, high = np.searchsorted(table["length"], [value, value + 1])
        own = length == value
        at = low + np.searchsorted(table["first"][low:high], rank[own], "right") - 1
        past = rank[own] - table["first"][at]
        sequence[own] = table["sequence"][at] + past // table["times"][at]
        offset[own] = table["offset"][at] + past % table["times"][at] * value
    return sequence, offset


def _numbered(df: DataFrame, counts: DataFrame, length: str, order: list[str]) -> DataFrame:
    """Add ``_rank``, the number of a row within its length, from 0."""
    df = df.join(F.broadcast(counts), F.col(length) == F.col("_length")).drop("_length")
    buckets = F.ceil(F.col("_count") / BUCKET_ROWS)
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), buckets)).drop("_count")
    # A bucket's first number is the count of rows in the buckets before it; there is one
    # row for some 256 pieces.
    before = Window.partitionBy(length).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = df.groupBy(length, "_bucket").agg(F.count("*").alias("_n"))
    firsts = firsts.select(
        F.col(length).alias("_l"),
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
    )
    within = F.row_number().over(Window.partitionBy(length, "_bucket").orderBy(*order))
    df = df.withColumn("_within", within)
    df = df.join(firsts, (F.col(length) == F.col("_l")) & (F.col("_bucket") == F.col("_b")))
    return df.withColumn("_rank", F.col("_first") + F.col("_within") - 1).drop(
        "_l", "_b", "_first", "_within", "_bucket"
    )


def pack(df: DataFrame, capacity: int, order: list[str], length: str = "length") -> DataFrame:
    """Add the sequence of each row and its place there.

    ``order`` names columns that tell rows apart as well as can be; rows alike in
    all of them may stand in for each other. ``df`` is read several times and should
    be a written table.
    """
    kept = [c for c in df.columns if c.lower() not in ("sequence_id", "offset")]
    df = df.select(*kept)
    counts = df.groupBy(F.col(length).alias("_length")).agg(F.count("*").alias("_count"))
    histogram = np.zeros(capacity + 1, np.int64)
    # One row for each length: the limit only stops a table of lengths out of range.
    for row in counts.limit(capacity + 2).collect():
        if row["_length"] is None or not 1 <= row["_length"] <= capacity:
            raise ValueError(f"length {row['_length']} is not between 1 and {capacity}")
        histogram[row["_length"]] = row["_count"]
    table = df.sparkSession.sparkContext.broadcast(slots(plan(histogram, capacity)))
    numbered = _numbered(df, counts, length, order)
    added = [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")]
    names = [*kept, *(field.name for field in added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch[length].to_numpy(zero_copy_only=False).astype(np.int64)
            ranks = batch["_rank"].to_numpy(zero_copy_only=False).astype(np.int64)
            placed = [pa.array(a) for a in _place(table.value, lengths, ranks)]
            yield pa.record_batch([*(batch[c] for c in kept), *placed], names)

    return numbered.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), *added]))


def pack_table(df: DataFrame, capacity: int, order: list[str], length: str = "length") -> DataFrame:
    """``pack`` for rows that are dear to make: they are written to the shared folder once."""
    return pack(materialize(df, "pieces"), capacity, order, length)
