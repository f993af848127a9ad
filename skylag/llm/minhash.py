"""Near-duplicate documents by SuperMinHash signatures, banding and verified links.

A document is the set of its distinct shingles: runs of ``words`` words of its text,
where A to Z are lower-cased and words are what stands between ASCII white space.
With fewer words the whole sequence is its only shingle; without words the set is
empty and linked with nothing.

Signatures: every shingle seeds a random permutation of the signature's places and,
for each rank in it, a random fraction. A place holds the least rank plus fraction
that any shingle brings to it. As the ranks of one shingle are all different, places
are correlated in the way that lowers the variance of the estimated similarity. Rank
by rank, a document stops as soon as no later rank can lower any of its places,
which for long documents is after a few ranks.

Equal sets are collapsed before banding, so copies never meet in pairs. Documents
that agree in a band of ``rows`` places are candidates; every link is confirmed on
the full sets of the whole texts. Candidates of a band bucket are not paired with each other.
First each is compared with one document of its bucket (the pivot), for ``rounds``
pivots in turn; the links are grouped by union-find. Buckets whose documents then lie
in one group are finished, as more links could not change it. In the others, all
documents outside the largest group are compared with all that lie in another group,
in blocks of ``BLOCK`` documents a task, so that no candidate pair between groups is
left out and no bucket meets in one task.

Defined results: NULL and empty texts have no shingles, link with nothing and are
kept; of equal sets the smallest key represents all; equal rows get one result each;
a row with a NULL key links with nothing; an empty table gives an empty table. Rows with
different texts under one key are documents of their own: links go by sets, and keys
only name the groups, so a key may come up in several. Keys may be of any type that has
an order. Only the key and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .batches import raw_texts, slices
from .components import UnionFind, components

# Documents of one side of a block, and shingles compared with one pivot by one task.
BLOCK = 128
PIVOT_SHINGLES = 500_000
# Shingles whose ranks are drawn together.
_ELEMENTS = 1 << 16
# Odd constants of the public splitmix64 generator, fixed values.
_STEP, _MIX1, _MIX2 = (
    np.uint64(0x9E3779B97F4A7C15),
    np.uint64(0xBF58476D1CE4E5B9),
    np.uint64(0x94D049BB133111EB),
)


def mixed(values: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit numbers of 64-bit numbers, one to one."""
    values = (values ^ (values >> np.uint64(30))) * _MIX1
    values = (values ^ (values >> np.uint64(27))) * _MIX2
    return values ^ (values >> np.uint64(31))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit digests of the distinct shingles of a whole text."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, parts)), ">u8").astype(np.uint64)
    size = min(words, len(parts))
    count = len(parts) - size + 1
    out = np.full(count, size, np.uint64)
    for i in range(size):
        out = mixed((out ^ digests[i : i + count]) + _STEP)
    return np.unique(out)


def super_minhash(sets: list[np.ndarray], places: int) -> np.ndarray:
    """Signatures of non-empty sets: one row of ``places`` numbers each."""
    least = np.full((len(sets), places), np.inf)
    flat = least.reshape(-1)
    every = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    low = np.uint64(0xFFFFFFFF)
    with np.errstate(over="ignore"):
        for begin in range(0, len(every), _ELEMENTS):
            seed, owner = every[begin : begin + _ELEMENTS], owners[begin : begin + _ELEMENTS]
            order = np.tile(np.arange(places, dtype=np.uint16), (len(seed), 1))
            for rank in range(places):
                # A place above this rank can still be lowered; other documents are done.
                active = least.max(axis=1)[owner] > rank
                if not active.all():
                    seed, owner, order = seed[active], owner[active], order[active]
                    if not len(seed):
                        break
                drawn = mixed(seed + np.uint64(rank + 1) * _STEP)
                other = rank + (((drawn & low) * np.uint64(places - rank)) >> np.uint64(32)).astype(
                    np.int64
                )
                row = np.arange(len(seed))
                place = order[row, other]
                order[row, other] = order[:, rank]
                value = rank + (drawn >> np.uint64(32)).astype(np.float64) * 2.0**-32
                np.minimum.at(flat, owner * places + place, value)
    return least


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` places of each signature."""
    words = signatures.view(np.uint64).reshape(len(signatures), -1, rows)
    with np.errstate(over="ignore"):
        keys = np.tile(np.arange(words.shape[1], dtype=np.uint64), (len(words), 1))
        for i in range(rows):
            keys = mixed((keys ^ words[:, :, i]) + _STEP)
    return keys.view(np.int64)


def signatures(df: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """Key, version, n_shingles, a digest of the set, and the band keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            with np.errstate(over="ignore"):
                sets = [shingle_set(value, words) for value in raw_texts(batch["text"])]
            full = [s for s in sets if len(s)]
            keys = None
            if full:
                keys = iter(band_keys(super_minhash(full, bands * rows), rows))
            yield pa.record_batch(
                [
                    batch["name"],
                    batch["version"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                        pa.binary(),
                    ),
                    pa.array(
                        [next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())
                    ),
                ],
                ["name", "version", "n_shingles", "set_key", "bands"],
            )

    kind = df.schema["name"].dataType.simpleString()
    schema = f"name {kind}, version long, n_shingles long, set_key binary, bands array<long>"
    return df.select("name", "version", "text").mapInArrow(run, schema)


def similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether 100 times the intersection is at least ``percent`` times the union."""
    small, large = sorted((one, other), key=len)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(one) + len(other) - common)


def _with_pivots(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar; b's text is compared with its pivot a's.

    Rows are dealt by pivot and part and sorted so that the pivot comes first; a task
    holds the pivot's set and one small batch.
    """
    sized = pairs.groupBy("a").agg(F.sum("n").alias("all"))
    parts = F.ceil(F.col("all") / PIVOT_SHINGLES).cast("int")
    sized = materialize(sized.select("a", parts.alias("parts")), "pivots")
    others = pairs.join(sized, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b"
    )
    heads = sized.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    one = heads.withColumn("b", F.col("a")).withColumn("role", F.lit(0))
    every = one.unionByName(others.withColumn("role", F.lit(1)))
    rows = every.join(texts.select(F.col("doc").alias("b"), "text"), "b")
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, base = None, None
        with np.errstate(over="ignore"):
            for batch in slices(batches):
                found = []
                columns = [batch[c].to_pylist() for c in ("a", "b", "role")]
                for (a, b, role), value in zip(
                    zip(*columns, strict=True), raw_texts(batch["text"]), strict=True
                ):
                    own = shingle_set(value, words)
                    if role == 0:
                        pivot, base = a, own
                    elif pivot == a and similar(base, own, percent):
                        found.append((a, b))
                yield pa.record_batch(
                    [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"]
                )

    return rows.mapInArrow(run, "a long, b long")


def _linked_in_block(block: pa.Table, words: int, percent: int) -> list[tuple[int, int]]:
    """Links of a block that join groups; groups already joined are not compared again."""
    docs = block["doc"].to_pylist()
    groups = block["component"].to_pylist()
    side = block["side"].to_pylist()
    bands = np.asarray(block["bands"].to_pylist(), np.int64)
    own_band = np.asarray(block["band"].to_pylist(), np.int64)
    values = raw_texts(block["text"].combine_chunks())
    sets = [shingle_set(v, words) for v in values]
    joined, found = UnionFind(), []
    left = [i for i, s in enumerate(side) if s & 1]
    right = np.asarray([i for i, s in enumerate(side) if s & 2], np.int64)
    for i in left:
        # A pair is the business of the first band that it shares.
        first = (bands[right] == bands[i]).argmax(axis=1) == own_band[i]
        for j in right[first].tolist():
            # Within a block each pair comes up from both sides.
            twice = side[i] == 3 and j <= i
            if twice or joined.find(groups[i]) == joined.find(groups[j]):
                continue
            if similar(sets[i], sets[j], percent):
                joined.join(groups[i], groups[j])
                found.append((docs[i], docs[j]))
    return found


def _across_groups(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Similar pairs of documents that share a bucket and lie in different groups.

    ``members``: value, band, doc, bands, component. The largest group of a bucket is
    only compared with the others, and these with each other.
    """
    counts = members.groupBy("value", "component").agg(F.count("*").alias("n"))
    largest = counts.groupBy("value").agg(
        F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all")
    )
    largest = materialize(
        largest.select(
            "value",
            F.col("top.component").alias("main"),
            F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("rest_blocks"),
            F.ceil(F.col("top.n") / BLOCK).cast("int").alias("main_blocks"),
        ),
        "largest",
    )
    placed = members.join(largest, "value").withColumn("rest", F.expr("component != main"))
    own = F.when(F.col("rest"), F.col("rest_blocks")).otherwise(F.col("main_blocks"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("doc"), own).cast("int"))
    # Blocks (i, j): rest i against rest j >= i, or rest i against main j (numbered below 0).
    # side 1 stands on the left, 2 on the right, 3 on both.
    of_rest = F.expr(
        """concat(
          transform(sequence(own, rest_blocks - 1),
                    j -> struct(own AS i, j AS j, IF(j = own, 3, 1) AS side)),
          transform(filter(sequence(0, own), i -> i < own), i -> struct(i AS i, own AS j, 2 AS side)),
          transform(sequence(1, main_blocks), j -> struct(own AS i, -j AS j, 1 AS side)))"""
    )
    of_main = F.expr(
        "transform(sequence(0, rest_blocks - 1), i -> struct(i AS i, -1 - own AS j, 2 AS side))"
    )
    blocks = placed.select(
        "value", "band", "doc", "bands", "component",
        F.inline(F.when(F.col("rest"), of_rest).otherwise(of_main)),
    )
    rows = blocks.join(texts.select("doc", "text"), "doc")

    def run(table: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            found = _linked_in_block(table, words, percent)
        return pa.table({n: pa.array([f[i] for f in found], pa.int64()) for i, n in enumerate("ab")})

    return rows.groupBy("value", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    bands: int = 30,
    rows: int = 5,
    rounds: int = 2,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of each row.

    Documents are linked if their sets share at least ``percent`` hundredths of their
    union. At that share exactly, the default bands miss seven links in a million.
    ``component_id`` is the smallest key reachable over links; it is kept.
    """
    whole = df.select(
        F.col(key).alias("name"), F.col(text).alias("text"), F.xxhash64(text).alias("version")
    )
    signed = materialize(signatures(whole, words, bands, rows), "signatures")
    present = signed.filter("set_key IS NOT NULL AND name IS NOT NULL")
    classes = present.groupBy("set_key").agg(
        F.min(F.struct("name", "version", "n_shingles", "bands")).alias("first")
    )
    # Each set has a number, its node in what follows; it is settled by being written.
    classes = classes.select("set_key", "first.*", F.monotonically_increasing_id().alias("doc"))
    classes = materialize(classes, "classes")
    banded = classes.select(
        "doc", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "value")
    )
    shared = banded.groupBy("value").agg(F.count("*").alias("size"))
    shared = materialize(shared.filter("size > 1").select("value"), "buckets")
    members = materialize(banded.join(shared, "value"), "members")
    wanted = classes.join(members.select("doc").distinct(), "doc", "left_semi")
    wanted = wanted.select("doc", "name", "version")
    texts = whole.join(wanted, ["name", "version"]).dropDuplicates(["doc"]).select("doc", "text")
    texts = materialize(texts, "texts")

    links, groups = None, members.select("doc").distinct().withColumn("component", F.col("doc"))
    groups = materialize(groups, "groups")
    for number in range(rounds + 1):
        grouped = members.join(groups, "doc")
        # Buckets that hold more than one group, and a pivot of each.
        pivot = F.min(F.struct(F.xxhash64("doc", F.lit(number)), "doc", "component", "n"))
        open_buckets = grouped.groupBy("value").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), pivot.alias("p")
        )
        open_buckets = materialize(
            open_buckets.filter("low < high").select(
                "value",
                F.col("p.doc").alias("a"),
                F.col("p.component").alias("of_a"),
                F.col("p.n").alias("n_a"),
            ),
            "open",
        )
        if open_buckets.isEmpty():
            break
        candidates = grouped.join(open_buckets, "value")
        if number < rounds:
            pairs = candidates.filter("component != of_a").filter(
                100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")
            )
            pairs = pairs.select("a", F.col("doc").alias("b"), "n").distinct()
            found = _with_pivots(materialize(pairs, "pairs"), texts, words, percent)
        else:
            with_bands = candidates.join(classes.select("doc", "bands"), "doc")
            found = _across_groups(with_bands, texts, words, percent)
        found = materialize(found, "found")
        links = found if links is None else links.unionByName(found)
        linked = components(links)
        groups = materialize(
            groups.select("doc")
            .join(linked.withColumnRenamed("node", "doc"), "doc", "left")
            .select("doc", F.coalesce("component", "doc").alias("component")),
            "groups",
        )
    # A group bears the smallest key of its sets.
    least = groups.join(classes.select("doc", "name"), "doc").groupBy("component")
    least = materialize(least.agg(F.min("name").alias("component_id")), "least")
    of_group = groups.join(least, "component").select("doc", "component_id")
    named = classes.select("set_key", "doc", "name").join(of_group, "doc", "left")
    named = named.select("set_key", F.coalesce("component_id", "name").alias("component_id"))
    named = materialize(named, "named")
    out = signed.join(named, "set_key", "left")
    component = F.when(F.col("name").isNotNull(), F.coalesce("component_id", "name"))
    return out.select(
        F.col("name").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("name") == component, F.lit(True)).alias("kept"),
    )
