"""Near-duplicate vectors by cross-polytope hashing with multiprobe buckets.

Each of ``tables`` hash tables turns a unit vector ``hashes`` times by fast Hadamard
rotations (random signs and a Hadamard transform, three times) and takes the nearest
corner of the cross-polytope each time: the axis of the largest component and its
sign. The corners together are the vector's main bucket. Its further probes replace
one of the corners by the second nearest. Two vectors are candidates if the main
bucket of one is a main bucket or a probe of the other in any table.

Equal vectors of a label are one class, by aggregation, before anything is paired.
Buckets are cut into blocks of ``BLOCK`` members, so that a bucket of any size is
compared block against block by many tasks. The cosine of every candidate pair is
verified in double precision. A pair is counted only in the first bucket that it
shares; and a block gives for each member a count, and for each group of linked members
as many links as hold it together, instead of all its pairs.

Defined results: rows link only within a label that is not NULL; vectors that are
NULL, zero, or hold NULL or non-finite components link with nothing, nor do vectors of
different numbers of components; copies link with each other; equal rows count as
vectors of their own; an empty table gives an empty table. A NULL key links with
nothing. Only the three named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .batches import slices
from .components import components
from .vectors import cleaned, matrix

BLOCK = 512


def hadamard(values: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row; the row length is a power of two."""
    rows, size = values.shape
    step = 1
    while step < size:
        pairs = values.reshape(rows, size // (2 * step), 2, step)
        values = np.stack(
            [pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2
        ).reshape(rows, size)
        step *= 2
    return values


def corners(units: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest and second nearest corner after one random rotation, and what the second loses."""
    size = 1 << max(0, units.shape[1] - 1).bit_length()
    turned = np.zeros((len(units), max(size, 2)))
    turned[:, : units.shape[1]] = units
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (3, turned.shape[1]))
    for row in signs:
        turned = hadamard(turned * row)
    strength = np.abs(turned)
    two = np.argpartition(-strength, 1, axis=1)[:, :2]
    at = np.arange(len(units))
    swap = strength[at, two[:, 0]] < strength[at, two[:, 1]]
    two[swap] = two[swap][:, ::-1]
    codes = 2 * two + (turned[at[:, None], two] < 0)
    return codes[:, 0], codes[:, 1], strength[at, two[:, 0]] - strength[at, two[:, 1]]


def buckets(units: np.ndarray, tables: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Main bucket (rows, tables) and probes (rows, tables, hashes) of unit vectors."""
    main = np.zeros((len(units), tables), np.int64)
    probes = np.zeros((len(units), tables, hashes), np.int64)
    for table in range(tables):
        drawn = [corners(units, table * hashes + h) for h in range(hashes)]
        place = 4 * units.shape[1] + 4  # more than the number of corners
        for h, (first, _, _) in enumerate(drawn):
            main[:, table] = main[:, table] * place + first
            for p in range(hashes):
                code = drawn[h][1] if p == h else first
                probes[:, table, p] = probes[:, table, p] * place + code
    return main, probes


def _hashed(classes: DataFrame, tables: int, hashes: int) -> DataFrame:
    """rep, main and probes of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            dims = np.asarray(batch["dim"])
            main = np.zeros((len(dims), tables), np.int64)
            probes = np.zeros((len(dims), tables, hashes), np.int64)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                units = matrix(batch["vec"].take(pa.array(own)))
                units = units / np.linalg.norm(units, axis=1, keepdims=True)
                main[own], probes[own] = buckets(units, tables, hashes)
            lists = pa.list_(pa.int64())
            flat = probes.reshape(len(dims), -1)
            columns = [batch["rep"], pa.array(list(main), lists), pa.array(list(flat), lists)]
            yield pa.record_batch(columns, ["rep", "main", "probes"])

    schema = "rep long, main array<long>, probes array<long>"
    return classes.select("rep", "vec", "dim").mapInArrow(run, schema)


def _first_shared(main: np.ndarray, probes: np.ndarray, i: np.ndarray, j: np.ndarray):
    """Table and bucket in which each pair (i, j) first meets."""
    tables = main.shape[1]
    none = np.iinfo(np.int64).max
    a, b = main[i], main[j]
    in_b = (probes[j] == a[:, :, None]).any(axis=2) | (a == b)
    in_a = (probes[i] == b[:, :, None]).any(axis=2)
    code = np.minimum(np.where(in_b, a, none), np.where(in_a, b, none))
    table = (code != none).argmax(axis=1)
    return table, code[np.arange(len(i)), table], tables


def _block(block: dict, least: float) -> tuple[list, list]:
    """(rep, linked vectors) and (rep, rep) rows of one block of a bucket."""
    units, left = block["units"], np.flatnonzero(block["side"] & 1)
    right = np.flatnonzero(block["side"] & 2)
    close = (units[left] @ units[right].T) >= least
    close &= block["own"][left][:, None] | block["own"][right][None, :]
    close &= left[:, None] != right[None, :]
    row, column = np.nonzero(close)
    if not len(row):
        return [], []
    i, j = left[row], right[column]
    within = bool((block["side"] == 3).any())
    table, code, _ = _first_shared(block["main"], block["probes"], i, j)
    first = (table == block["table"]) & (code == block["code"])
    # Within one block a pair comes up from both sides; across blocks it comes up once.
    counts = np.bincount(i[first], block["size"][j[first]], len(units))
    if not within:
        counts += np.bincount(j[first], block["size"][i[first]], len(units))
    # Least members reachable within the block hold each linked group together.
    label = np.arange(len(units))
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            break
    reps = block["rep"]
    tied = np.flatnonzero(label != np.arange(len(units)))
    return (
        [(int(reps[m]), int(counts[m])) for m in np.flatnonzero(counts)],
        [(int(reps[m]), int(reps[label[m]])) for m in tied],
    )


def _compared(members: DataFrame, least: float, tables: int, hashes: int) -> DataFrame:
    """a, b, n: a count of linked vectors of a (b NULL), or a link (n NULL)."""
    order = ["label", "dim", "table", "code", "i", "j"]
    dealt = members.repartition(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compared(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            # Whole blocks, one after the other.
            table = pa.Table.from_batches(rows).combine_chunks()
            n = table.num_rows
            column = {c: table[c].to_numpy() for c in (*order, "rep", "size", "side", "own")}
            main = np.asarray(table["main"].combine_chunks().flatten()).reshape(n, tables)
            probes = np.asarray(table["probes"].combine_chunks().flatten())
            probes = probes.reshape(n, tables, hashes)
            cuts = np.flatnonzero(
                np.any([column[c][1:] != column[c][:-1] for c in order], axis=0)
            )
            counts, links = [], []
            for start, end in zip([0, *(cuts + 1)], [*(cuts + 1), n], strict=True):
                if end - start < 2:
                    continue
                own = slice(start, end)
                vectors = matrix(table["vec"].slice(start, end - start))
                block = {c: column[c][own] for c in ("rep", "size", "side", "own")}
                block |= {"table": column["table"][start], "code": column["code"][start]}
                block |= {"main": main[own], "probes": probes[own]}
                block["units"] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                more, tied = _block(block, least)
                counts += more
                links += tied
            a = [c[0] for c in counts] + [x[0] for x in links]
            b = [None] * len(counts) + [x[1] for x in links]
            c = [c[1] for c in counts] + [None] * len(links)
            columns = [pa.array(x, pa.int64()) for x in (a, b, c)]
            return pa.record_batch(columns, ["a", "b", "n"])

        def block_of(batch: pa.RecordBatch, at: int) -> tuple:
            return tuple(batch[c][at].as_py() for c in order)

        # A block has at most 2 * BLOCK rows; the last one of a batch may go on in the next.
        for batch in slices(batches, 4 * BLOCK):
            last, start = block_of(batch, batch.num_rows - 1), batch.num_rows - 1
            while start and block_of(batch, start - 1) == last:
                start -= 1
            if start:
                yield compared([*held, batch.slice(0, start)])
                held = []
            elif held and block_of(held[-1], 0) != last:
                yield compared(held)
                held = []
            held.append(batch.slice(start))
        if held:
            yield compared(held)

    return dealt.mapInArrow(run, "a long, b long, n long")


def near_duplicate_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.93,
    tables: int = 16,
    hashes: int = 2,
) -> DataFrame:
    """(key, n_links, component_id, kept) of each row."""
    rows = df.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("v")
    )
    rows = materialize(cleaned(rows, "vec_id", "v", "label"), "vectors")
    usable = rows.filter("vec IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL")
    classes = usable.groupBy("label", "digest").agg(
        F.min("vec_id").alias("rep"),
        F.count("*").alias("size"),
        F.first("vec").alias("vec"),
        F.first("dim").alias("dim"),
    )
    classes = materialize(classes, "classes")
    hashed = materialize(_hashed(classes, tables, hashes), "hashed")

    # One row for each main bucket (own) and probe of each class.
    own = F.transform("main", lambda c, t: F.struct(t.alias("table"), c.alias("code"), F.lit(True).alias("own")))
    probe = F.transform(
        "probes",
        lambda c, p: F.struct(
            F.floor(p / hashes).cast("int").alias("table"), c.alias("code"), F.lit(False).alias("own")
        ),
    )
    placed = hashed.join(classes.select("rep", "label", "dim"), "rep").select(
        "rep", "label", "dim", F.inline(F.concat(own, probe))
    )
    bucket = ["label", "dim", "table", "code"]
    # A second corner may equal the first of another table's hash, never its own: no doubles.
    sizes = placed.groupBy(*bucket).agg(
        F.count("*").alias("members"), F.bool_or("own").alias("any_own")
    )
    sizes = sizes.filter("members > 1 AND any_own").withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK).cast("int")
    )
    sizes = materialize(sizes.select(*bucket, "blocks"), "buckets")
    shared = placed.join(sizes, bucket)
    shared = shared.withColumn("at", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    blocks = F.expr(
        """transform(sequence(0, blocks - 1), x -> struct(
             least(at, x) AS i, greatest(at, x) AS j,
             IF(x = at, 3, IF(at < x, 1, 2)) AS side))"""
    )
    members = shared.select(*bucket, "rep", "own", F.inline(blocks))
    members = members.join(hashed, "rep").join(classes.select("rep", "size", "vec"), "rep")
    found = materialize(_compared(members, least, tables, hashes), "found")

    counts = found.filter("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("linked"))
    groups = components(found.filter("b IS NOT NULL").select("a", "b"))
    of_class = (
        classes.select("label", "digest", "rep", "size")
        .join(counts.withColumnRenamed("a", "rep"), "rep", "left")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label",
            "digest",
            (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    of_class = materialize(of_class, "classes")
    out = rows.join(of_class, ["label", "digest"], "left")
    alone = F.col("vec_id").isNull() | F.col("component_id").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("vec_id").alias(key),
        F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
