"""Clean vectors for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import slices


def usable(cells: list) -> list[bytes | None]:
    """Each vector as little-endian doubles; None for one that takes no part.

    NULL vectors, vectors with a NULL or non-finite component, zero vectors and empty
    ones take no part. Single-precision components are doubles exactly.
    """
    out: list[bytes | None] = []
    for cell in cells:
        if cell is None or any(x is None for x in cell):
            out.append(None)
            continue
        # Adding zero makes -0.0 and 0.0 the same vector.
        vector = np.asarray(cell, "<f8") + 0.0
        good = vector.any() and np.isfinite(vector).all()
        out.append(vector.tobytes() if good else None)
    return out


def cleaned(df: DataFrame, key: str, vector: str, *others: str) -> DataFrame:
    """key, others, vec (doubles as bytes, NULL if unusable), dim and a digest of vec."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            vectors = usable(batch[vector].to_pylist())
            dims = [None if v is None else len(v) // 8 for v in vectors]
            digests = [None if v is None else xxhash.xxh3_128_digest(v) for v in vectors]
            made = [
                pa.array(vectors, pa.binary()),
                pa.array(dims, pa.int32()),
                pa.array(digests, pa.binary()),
            ]
            kept = [batch[c] for c in (key, *others)]
            yield pa.record_batch([*kept, *made], names)

    schema = T.StructType(
        [
            *(df.schema[c] for c in (key, *others)),
            T.StructField("vec", T.BinaryType()),
            T.StructField("dim", T.IntegerType()),
            T.StructField("digest", T.BinaryType()),
        ]
    )
    names = schema.fieldNames()
    return df.select(key, vector, *others).mapInArrow(run, schema)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """One row for each vector; all must have the same number of components."""
    cells = column.to_pylist()
    return np.frombuffer(b"".join(cells), "<f8").reshape(len(cells), -1)
