"""Connected components of links, as Spark jobs over written tables.

Each task first joins what it sees by union-find, so that many links between the
same nodes become few. Then two steps alternate until nothing changes: every node
ties its larger neighbours to its smallest one, and every node ties its smaller
neighbours and itself to the smallest of them. The number of rounds grows with the
logarithm of the longest path. Minima are taken by partial aggregation and written,
so that the joins are plain ones whose hot keys adaptive execution can split. Links
and components never meet on the driver; it sees a count and a checksum a round.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize

# Links that a task joins by union-find at a time.
CHUNK = 500_000


class UnionFind:
    """Components of the nodes seen so far, each named by its smallest node."""

    def __init__(self):
        self.above: dict = {}

    def find(self, node):
        above = self.above
        root = node
        while (up := above.get(root, root)) != root:
            root = up
        while node != root:
            above[node], node = root, above.get(node, node)
        return root

    def join(self, a, b) -> bool:
        """Join two components; whether they were apart."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.above[max(a, b)] = min(a, b)
        return True

    def links(self) -> Iterator[tuple]:
        """(node, smallest node of its component) of all others."""
        for node in list(self.above):
            root = self.find(node)
            if root != node:
                yield node, root


def _local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task, each node tied to the smallest it reaches here."""

    def out(found: UnionFind) -> pa.RecordBatch:
        pairs = list(found.links())
        columns = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
        return pa.record_batch(columns, ["u", "v"])

    found = UnionFind()
    for batch in batches:
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist(), strict=True):
            found.join(u, v)
        if len(found.above) > CHUNK:
            yield out(found)
            found = UnionFind()
    yield out(found)


def _tied(links: DataFrame, both_ways: bool) -> DataFrame:
    """One step: (x, y) of a node and a neighbour; the smallest y of x is tied to."""
    if both_ways:
        ways = F.array(
            F.struct(F.col("u").alias("x"), F.col("v").alias("y")),
            F.struct(F.col("v").alias("x"), F.col("u").alias("y")),
        )
        sides = links.select(F.inline(ways))
    else:
        sides = links.select(F.col("u").alias("x"), F.col("v").alias("y"))
    least = sides.groupBy("x").agg(F.min("y").alias("m"))
    least = least.select("x", F.least("x", "m").alias("m"))
    least = materialize(least, "least")
    tied = sides.join(least, "x")
    if both_ways:
        tied = tied.filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:
        tied = tied.select(F.col("y").alias("u"), F.col("m").alias("v"))
        tied = tied.unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v")))
    return tied.filter("u != v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; a component is its smallest node.

    Links have no direction; repeated links and loops do no harm, and a link with a
    NULL end is none. Nodes without a link to another are not in the result. The
    result is a written table.
    """
    links = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    links = links.filter("u != v").mapInArrow(_local, "u long, v long")
    links = materialize(links, "links")
    before = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = mark
        links = _tied(materialize(_tied(links, both_ways=True), "links"), both_ways=False)
        links = materialize(links, "links")
