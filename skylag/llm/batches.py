"""Small helpers for work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa

# Rows handed to one call, and bytes of input gathered before a batch is passed on.
ROWS = 512
BYTES = 8 << 20


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows and some ``BYTES`` bytes.

    A single row is never cut, however long it is.
    """
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            take = min(rows, batch.num_rows - start)
            while take > 1 and batch.slice(start, take).nbytes > BYTES:
                take = (take + 1) // 2
            yield batch.slice(start, take)
            start += take


def texts(column: pa.Array) -> list[str]:
    """Values of a text column; NULL reads as the empty text."""
    return ["" if value is None else value for value in column.to_pylist()]


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; NULL reads as the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if value is None else value for value in column.cast(kind).to_pylist()]


class Memo(dict):
    """A bounded memo of a pure function: ``memo[key]`` computes what it does not hold.

    Two generations keep it bounded: when the young one is full it becomes the
    old one, and keys asked for again move back. Keys beyond ``longest`` are
    computed each time, so memory is bounded by ``2 * entries`` short keys.
    """

    def __init__(self, make: Callable, entries: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.entries, self.longest = make, entries, longest
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        """Remember a value."""
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value

    def forget(self) -> None:
        """Give up all that is held; workers outlive their tasks."""
        self.clear()
        self.old = {}

    def lacks(self, keys: set) -> set:
        """The keys that are not held."""
        # One lookup a key; a set's own difference would walk through all that is held.
        return {key for key in keys if key not in self and key not in self.old}
