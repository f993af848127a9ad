"""Packed token-id matrices by best-fit decreasing with a segment tree of capacities.

The documents are dealt out evenly to tasks of some ``TASK_BYTES`` of text, however
small the partitions they come in. Each task encodes its share and cuts those longer than
a sequence into pieces, without losing an id. Pieces are gathered until they hold
``GROUP_TOKENS`` ids. Then, longest first, each piece goes to the open sequence with
the least room that still takes it; a segment tree over the possible room finds that
sequence in steps that grow with the logarithm of the capacity. Well-filled
sequences are passed on; the others' pieces wait for the next group, the emptiest
first, so that mostly the last sequences of a task stay less full. Texts are shuffled
once, and a task's memory is bounded by a group and one document. Ids are those of the
tiktoken library, which encodes all texts but those with a run of white space so long
that its search for the pattern could overflow; these go through ``bpe``, to the same ids.

A row is one line of the id matrix: ``ids``, always ``capacity`` little-endian
unsigned 32-bit numbers padded with ``pad_id``; ``segment_ends``, the cumulative
lengths from 0; ``positions``, as many 32-bit numbers that start from 0 again in each
segment (0 in the padding); and for each segment its document, the document's ids
before it and so the way back to every document.

Defined results: NULL and empty texts are the end id alone; equal rows are packed
each; an empty table gives no sequence; other columns are left out. Which documents
share a sequence hangs on how the input is split into tasks; a task that runs again
gives the same rows.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import slices, texts
from .bpe import codec, read_ranks
from .tokens import cut

# Text of a task, so that its last sequences are few among all of its own.
TASK_BYTES = 8_000_000
# Ids gathered before they are packed, and ids that may wait for the next group.
GROUP_TOKENS = 3_000_000
WAITING_TOKENS = 500_000
# Sequences with less room than one part of this many are passed on at once.
_FILLED = 64
# White space on which the library's search for the pattern may run out of stack.
_LONG_SPACE = re.compile(r"\s{1000}")


@functools.lru_cache(maxsize=2)
def _library(content: bytes, pattern: str) -> tiktoken.Encoding:
    """The library's encoding of a rank file's content; a worker builds it once."""
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=read_ranks(content), special_tokens={}
    )


def text_ids(content: bytes, pattern: str, text: str) -> bytes:
    """Ids of a whole text as little-endian 32-bit numbers."""
    if _LONG_SPACE.search(text):
        encoder = codec(content, pattern)
        try:
            return encoder.encode(text)
        finally:
            encoder.units.forget()
    return np.asarray(_library(content, pattern).encode_ordinary(text), "<u4").tobytes()


class RoomTree:
    """Open sequences by the room they have left: a segment tree over 0 to ``capacity``."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove a sequence with the least room of at least ``length``; its room and number."""
        count, node = self.count, length + self.size
        # Up until a right neighbour has sequences, then down along its left side.
        while not count[node]:
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:
            node *= 2
            if not count[node]:
                node += 1
        room = node - self.size
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """The numbers of the pieces in each sequence; lengths lie between 1 and ``capacity``."""
    tree, sequences = RoomTree(capacity), []
    for at in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[at])
        if found is None:
            found = capacity, len(sequences)
            sequences.append([])
        room, sequence = found
        sequences[sequence].append(at)
        if room > lengths[at]:
            tree.add(room - lengths[at], sequence)
    return sequences


Piece = tuple[object, int, bytes]  # document, its ids before the piece, ids


def _emit(key_type: pa.DataType, first: int, sequences: list[list[Piece]], capacity: int, pad_id: int):
    """A batch of matrix rows."""
    ids = np.full((len(sequences), capacity), pad_id, "<u4")
    positions = np.zeros((len(sequences), capacity), "<u4")
    ends, tokens = [], []
    for row, sequence in enumerate(sequences):
        at = 0
        ends.append([0])
        for _, _, own in sequence:
            length = len(own) // 4
            ids[row, at : at + length] = np.frombuffer(own, "<u4")
            positions[row, at : at + length] = np.arange(length)
            at += length
            ends[-1].append(at)
        tokens.append(at)
    return [
        pa.array(np.arange(first, first + len(sequences))),
        pa.array(tokens, pa.int32()),
        pa.array([row.tobytes() for row in ids], pa.binary()),
        pa.array(ends, pa.list_(pa.int32())),
        pa.array([row.tobytes() for row in positions], pa.binary()),
        pa.array([[p[0] for p in s] for s in sequences], pa.list_(key_type)),
        pa.array([[p[1] for p in s] for s in sequences], pa.list_(pa.int64())),
    ]


def packed_matrices(
    df: DataFrame,
    rank_file: str,
    pattern: str,
    end_id: int,
    capacity: int = 4096,
    pad_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rows of packed id matrices of all texts, each text followed by ``end_id``."""
    with open(rank_file, "rb") as file:
        content = df.sparkSession.sparkContext.broadcast(file.read())
    end = np.asarray([end_id], "<u4").tobytes()
    schema = T.StructType(
        [
            T.StructField("sequence_id", T.LongType()),
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("segment_ends", T.ArrayType(T.IntegerType())),
            T.StructField("positions", T.BinaryType()),
            T.StructField("segment_docs", T.ArrayType(df.schema[key].dataType)),
            T.StructField("segment_starts", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = TaskContext.get().partitionId() << 32
        waiting: list[Piece] = []
        held = 0
        key_type = pa.null()

        def packed(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal given, waiting, held
            sequences = best_fit_decreasing([len(p[2]) // 4 for p in waiting], capacity)
            ready, later, late = [], [], 0
            sizes = [sum(len(waiting[i][2]) // 4 for i in s) for s in sequences]
            for size, sequence in sorted(zip(sizes, sequences, strict=True)):
                own = [waiting[i] for i in sequence]
                if last or (capacity - size) * _FILLED <= capacity or late >= WAITING_TOKENS:
                    ready.append(own)
                else:
                    later.extend(own)
                    late += size
            waiting, held = later, late
            for start in range(0, len(ready), 128):
                some = ready[start : start + 128]
                columns = _emit(key_type, given, some, capacity, pad_id)
                yield pa.record_batch(columns, schema.fieldNames())
                given += len(some)

        for batch in slices(batches, 128):
            key_type = batch[key].type
            rows = zip(batch[key].to_pylist(), texts(batch[text]), strict=True)
            for document, whole in rows:
                ids = text_ids(content.value, pattern, whole) + end
                for start, length in cut(len(ids) // 4, capacity):
                    waiting.append((document, start, ids[4 * start : 4 * (start + length)]))
                held += len(ids) // 4
                if held >= GROUP_TOKENS:
                    yield from packed(last=False)
        if waiting:
            yield from packed(last=True)

    rows = df.select(key, text)
    total = rows.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return rows.repartition(max(1, -(-total // TASK_BYTES))).mapInArrow(run, schema)


def unpacked(matrices: DataFrame) -> DataFrame:
    """The pieces of packed matrices again: document, start, and ids as bytes."""
    segment = F.explode(F.arrays_zip("segment_docs", "segment_starts", "index")).alias("s")
    index = F.sequence(F.lit(0), F.size("segment_docs") - 1)
    rows = matrices.withColumn("index", index).select("ids", "segment_ends", segment)
    begin = F.get("segment_ends", F.col("s.index"))
    length = F.get("segment_ends", F.col("s.index") + 1) - begin
    return rows.select(
        F.col("s.segment_docs").alias("doc"),
        F.col("s.segment_starts").alias("start"),
        F.substring(F.col("ids"), 4 * begin + 1, 4 * length).alias("ids"),
    )


def write_matrices(matrices: DataFrame, path: str) -> None:
    """Write packed matrices as Parquet; a path that exists is an error."""
    matrices.write.parquet(path)
