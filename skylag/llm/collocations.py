"""Phrases whose words stand together more often than apart, by prefix-free parsing.

Texts are lower-cased (A-Z), and each becomes one sequence of words with a mark wherever a
piece ends. The sequence is cut where the content says so: at each place where the hash of
the next ``max_words - 1`` words is divisible by ``every``. A chunk runs from one such place
to the end of the words that trigger the next, so neighbours overlap by exactly those words,
equal passages give equal chunks wherever they stand, and no chunk is a prefix of another.
Distinct chunks with their frequencies form the dictionary; a phrase that begins in the
overlap belongs to the later chunk alone, so each occurrence is counted once, as the sum
over distinct chunks of occurrences times frequency.

Phrases are counted in blocks of distinct chunks inside tasks. A block hands on its counts
in buckets, as lines of one text for each bucket, which takes far less room on disk than a
row for each phrase. There are as many buckets as the bytes of all texts ask for, so each
stays small at any size; a bucket is summed up by itself. Only phrases that occur ``least``
times go on, and all that candidates need is among them, as parts occur no less often than
the whole. The rest is joins of these few.

Defined results: NULL and empty texts have no words, a NULL language counts as ``und``.
Repeated rows count each time. Empty tables give no rows. Of other columns none is read, so
none can clash. A task holds one text, or one block, or one bucket at a time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .batches import raw_texts, slices

# Words counted together, and bytes of text for which there is a bucket.
BLOCK_WORDS = 400_000
BUCKET_BYTES = 4 << 20

UNKNOWN = "und"
_MARK = b"\n"
# Lower case for A-Z, piece ends become marks, tabs blanks.
_MAPPED = bytes(
    ord(_MARK) if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)
_WORDS = re.compile(rb"\n|[^ \n]+")


def parsed(text: bytes, overlap: int, every: int) -> list[bytes]:
    """Chunks of one text: words and marks, each ended by a blank but the last.

    The last chunk ends with ``overlap`` marks, so that in every chunk the phrases that
    begin before its last ``overlap`` words are its own.
    """
    words = _WORDS.findall(text.decode("utf-8", "replace").encode().translate(_MAPPED))
    if not words:
        return []
    codes = np.fromiter(map(zlib.crc32, words), "<u8", len(words))
    mixed = np.zeros(max(len(words) - overlap + 1, 0), "<u8")
    for k in range(overlap):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(words) - overlap + 1 + k]
    mixed ^= mixed >> np.uint64(29)
    cuts = np.flatnonzero(mixed % np.uint64(every) == 0).tolist()
    words += [_MARK] * overlap
    begins = [0, *(c for c in cuts if c)]
    ends = [*(b + overlap for b in begins[1:]), len(words)]
    return [b" ".join(words[b:e]) for b, e in zip(begins, ends, strict=True)]


def dictionary(
    df: DataFrame, text: str, lang: str, overlap: int = 2, every: int = 16
) -> DataFrame:
    """(lang, chunk, weight): the distinct chunks of all texts and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            chunks = [parsed(value, overlap, every) for value in raw_texts(batch["text"])]
            rows = np.repeat(np.arange(batch.num_rows), [len(c) for c in chunks])
            flat = pa.array([c for own in chunks for c in own], pa.binary())
            yield pa.record_batch([batch["lang"].take(pa.array(rows)), flat], ["lang", "chunk"])

    named = df.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(text).alias("text"),
    )
    chunks = named.mapInArrow(run, "lang string, chunk binary")
    return chunks.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("weight"))


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + right
    return mixed ^ (mixed >> np.uint64(32))


def counted_block(
    lang: str, chunks: pa.Array, weights: np.ndarray, max_words: int, buckets: int
) -> pa.RecordBatch:
    """(lang, bucket, lines) of some distinct chunks of one language.

    A line is a phrase, a tab and its count; the lines of a bucket are compressed together.
    """
    lists = pc.split_pattern(chunks, " ")
    coded = lists.flatten().dictionary_encode()
    code = coded.indices.to_numpy().astype("<i8")
    vocabulary = coded.dictionary
    names = vocabulary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), "<u8", len(names))
    mark = names.index("\n") if "\n" in names else -1
    sizes = np.diff(lists.offsets.to_numpy())
    ends = np.cumsum(sizes)
    own = np.arange(len(code)) < np.repeat(ends - (max_words - 1), sizes)
    at = np.flatnonzero(own & (code != mark))
    weight = np.repeat(weights, sizes)[at]

    ids, texts, mixed, lines, marks = np.zeros(len(at), "<i8"), None, None, [], []
    for size in range(max_words):
        word = code[at + size]
        whole = word != mark
        at, ids, word, weight = at[whole], ids[whole], word[whole], weight[whole]
        keys, ids = np.unique(ids * len(names) + word, return_inverse=True)
        before, last = keys // len(names), keys % len(names)
        own_texts, own_mixed = vocabulary.take(pa.array(last)), hashes[last]
        if texts is not None:
            own_texts = pc.binary_join_element_wise(texts.take(pa.array(before)), own_texts, " ")
            own_mixed = _mix(mixed[before], own_mixed)
        texts, mixed = own_texts, own_mixed
        # Sums of a block stay far below 2 to the 53rd, where doubles are exact.
        counts = np.bincount(ids, weight, len(keys)).astype("<i8")
        numbers = pa.array(counts).cast(pa.string())
        lines.append(pc.binary_join_element_wise(texts, numbers, "\t"))
        marks.append(mixed)

    place = np.concatenate(marks) % np.uint64(buckets)
    order = np.argsort(place, kind="stable")
    place = place[order]
    edges = np.flatnonzero(np.diff(place, prepend=place[:1] + np.uint64(1)))
    dealt = pa.concat_arrays(lines).take(pa.array(order))
    bounds = pa.array(np.append(edges, len(place)), pa.int32())
    squeeze = zstandard.ZstdCompressor().compress
    lines = pc.binary_join(pa.ListArray.from_arrays(bounds, dealt), "\n").cast(pa.binary())
    made = [
        pa.array([lang] * len(edges), pa.string()),
        pa.array(place[edges].astype("<i8")),
        pa.array([squeeze(line) for line in lines.to_pylist()], pa.binary()),
    ]
    return pa.record_batch(made, ["lang", "bucket", "lines"])


def bucket_counts(chunks: DataFrame, max_words: int, buckets: int) -> DataFrame:
    """Counts of all phrases of distinct chunks, as lines in buckets, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Table]] = {}
        room = 0

        def blocks() -> Iterator[pa.RecordBatch]:
            for lang, tables in held.items():
                table = pa.concat_tables(tables)
                column = pa.concat_arrays(table["chunk"].chunks)
                yield counted_block(lang, column, table["weight"].to_numpy(), max_words, buckets)
            held.clear()

        for batch in slices(batches, 4096):
            table = pa.table(
                [batch["lang"], batch["chunk"].cast(pa.string()), batch["weight"]],
                ["lang", "chunk", "weight"],
            )
            for lang in pc.unique(table["lang"]).to_pylist():
                own = table.filter(pc.equal(table["lang"], lang))
                held.setdefault(lang, []).append(own.drop_columns("lang"))
            room += pc.sum(pc.count_substring(table["chunk"], " ")).as_py() or 0
            if room >= BLOCK_WORDS:
                yield from blocks()
                room = 0
        if held:
            yield from blocks()

    return chunks.mapInArrow(run, "lang string, bucket long, lines binary")


def summed_bucket(lines: list[bytes]) -> pa.Table:
    """(phrase, f) out of the compressed lines of one bucket."""
    opened = zstandard.ZstdDecompressor().decompress
    texts = pa.array([opened(part) for part in lines], pa.binary()).cast(pa.string())
    cells = pc.split_pattern(pc.split_pattern(texts, "\n").flatten(), "\t").flatten()
    even = pa.array(np.arange(0, len(cells), 2))
    table = pa.table(
        {
            "phrase": cells.take(even),
            "f": cells.take(pc.add(even, 1)).cast(pa.int64()),
        }
    )
    return table.group_by("phrase").aggregate([("f", "sum")]).rename_columns(["phrase", "f"])


def phrase_counts(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = 3,
    least: int = 10,
    every: int = 16,
) -> DataFrame:
    """(lang, phrase, f) of the phrases of up to ``max_words`` words that occur ``least`` times.

    One more row a bucket, with a NULL phrase, holds the sum over all its single words,
    however rare.
    """
    if max_words < 2:
        raise ValueError("phrases have two words at least")
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = -(-size // BUCKET_BYTES) or 1
    chunks = dictionary(df, text, lang, max_words - 1, every)
    packed = bucket_counts(chunks, max_words, buckets).select("bucket", "lang", "lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lines = None, []

        def done() -> pa.RecordBatch:
            table = summed_bucket(lines)
            single = pc.equal(pc.count_substring(table["phrase"], " "), 0)
            words = pc.sum(table["f"].filter(single)).as_py() or 0
            kept = table.filter(pc.greater_equal(table["f"], least))
            phrases = [*kept["phrase"].to_pylist(), None]
            made = [
                pa.array([held[1]] * len(phrases), pa.string()),
                pa.array(phrases, pa.string()),
                pa.array([*kept["f"].to_pylist(), words], pa.int64()),
            ]
            return pa.record_batch(made, ["lang", "phrase", "f"])

        for batch in batches:
            for bucket, lang, part in zip(*batch.to_pydict().values(), strict=True):
                if (bucket, lang) != held and lines:
                    yield done()
                    lines = []
                held = bucket, lang
                lines.append(part)
        if lines:
            yield done()

    # Rows of a bucket stand together, so a task sums up one bucket after the other.
    dealt = packed.repartition("bucket", "lang").sortWithinPartitions("bucket", "lang")
    return dealt.mapInArrow(run, "lang string, phrase string, f long")


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = 3,
    least: int = 10,
    covered: int = 50,
    keep: int = 2000,
    every: int = 16,
) -> DataFrame:
    """The ``keep`` best phrases of 2 to ``max_words`` words of each language.

    A phrase that occurs ``a`` times scores ``floor(1000000 a a / (l r))`` at its worst cut into
    two parts that occur ``l`` and ``r`` times, ties to the earliest cut. Phrases inside a
    longer one that occurs at least ``covered`` percent as often are dropped.
    Gives lang, rank, phrase, a, l, r, n (words of the language) and score.
    """
    counts = materialize(
        phrase_counts(df, text, lang, max_words, least, every), "phrase-counts"
    )
    totals = counts.filter("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    known = counts.filter("phrase IS NOT NULL")
    words = F.split("phrase", " ")
    phrases = known.select("lang", "phrase", F.col("f").alias("a"), words.alias("words")).filter(
        F.size("words") > 1
    )

    def part(first, count):
        return F.concat_ws(" ", F.slice("words", first, count))

    size = F.size("words")
    cuts = phrases.select(
        "lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        part(F.lit(1), F.col("k")).alias("head"),
        part(F.col("k") + 1, size - F.col("k")).alias("tail"),
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    exact = [F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")]
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .withColumns(dict(zip(("da", "dl", "dr"), exact, strict=True)))
        .withColumn("score", F.expr("CAST((da * da * 1000000) DIV (dl * dr) AS LONG)"))
    )
    worst = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a").agg(worst).select("lang", "phrase", "a", "cut.*")
    # Every shorter phrase inside a candidate, with the most frequent that holds it.
    inside = (
        phrases.filter(size > 2)
        .select("lang", "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
        .select(
            "lang", "a", "words", "m",
            F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("first"),
        )
        .groupBy("lang", part(F.col("first"), F.col("m")).alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    free = best.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        free.withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= keep)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def oracle(max_words: int = 3, least: int = 10, covered: int = 50, keep: int = 2000) -> str:
    """The same by plain grouping of all phrases, for DuckDB."""
    sizes = "\nUNION ALL\n".join(
        f"SELECT lang, {k} AS size, array_to_string(w[i:i + {k - 1}], ' ') AS phrase"
        f" FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces WHERE len(w) >= {k})"
        for k in range(1, max_words + 1)
    )
    return f"""
WITH pieces AS (
  SELECT lang, string_split_regex(trim(translate(p, chr(9), ' '), ' '), ' +') AS w FROM (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
    FROM documents WHERE text IS NOT NULL) WHERE trim(translate(p, chr(9), ' '), ' ') <> ''),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM ({sizes}) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS w FROM counts
  WHERE size > 1 AND f >= {least}),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
scored AS (SELECT c.lang, c.phrase, c.a, k, h.f AS l, t.f AS r,
    ((1000000::HUGEINT * c.a * c.a) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head
    JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, m, unnest(range(1, size - m + 2)) AS i
    FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates)) GROUP BY ALL),
free AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < {covered} * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, score FROM free) JOIN totals USING (lang) WHERE rank <= {keep}
"""
