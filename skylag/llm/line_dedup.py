"""Remove passages that were seen before, by winnowing over the words of lines.

A text is a row of words, whatever white space or line ends stand between them. A word
goes if it lies in a run of ``min_words`` words that also stands at an earlier place: in
a smaller document, or higher up in the same one without lapping over into the run. What
stands first stays. A repeated run of any greater length is made of such runs, one for
each word by which it is longer, so it goes as a whole, from its first word to its last,
also where it begins and ends inside lines; shorter ones stay.

1. Texts that are alike are one; their later documents repeat it from end to end. Texts are
   numbered in the order of their first documents, so that a place is one number.
2. Winnowing: each run of ``min_words`` words has one fingerprint, a gram of some words in
   it. It is the first of its grams whose words draw it, one in 16, else in 8, else in 4, else
   in 2, else the first of all. It depends on the run's own words only, so equal runs have equal
   fingerprints at equal places. Runs in a row that have one fingerprint make a stretch.
3. Joined positions: only stretches whose fingerprint comes up twice go on.
4. Matches are extended both ways: stretches are compared by a digest of all their words, from
   the first run to the last. Of equal ones the first stays, and the others go whole. Where a
   fingerprint has unlike stretches, or ones that lap, the runs of the first of each are
   compared one by one. Runs that go are joined where they touch.

Fingerprint and digest, 64 bits each, hold together. All steps are plain DataFrame
functions. Fingerprints and digests are aggregated before they meet, and their joins are
between written tables, so hot ones are split. Texts are shuffled twice, to the single runs
and to what goes, and never written; these joins build tables of the small side's part. Cuts
and shuffle files go when no later step reads them.

Defined results: documents are ordered by key, and rows alike in key and text count as
one, whose result all of them get. A NULL key comes first. NULL texts stay NULL. The white
space after a removed word goes with it; where a removed run held a line end, what stays
around it is still in two lines. Other columns stay, ``n_removed`` (words) is added and
replaces one of that name. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.row_ids import with_row_id
from ..sources.tables import materialize, owned_cuts, released_shuffles

# A place is the number of a text times this and a number of a word; no array holds as many words.
_PLACES = 1 << 31
# The lower half of a number of 64 bits.
_LOW = (1 << 32) - 1
# White space beside blanks and line feeds.
_RARE_WHITE = "\t\r\f\u000b"


def _pieces(text: Column) -> Column:
    """Words with the white space after them; that before the first word is a piece of its own."""
    return F.split(text, r"(?<=\s)(?=\S)")


def _words(text: Column) -> Column:
    """The words. One kind of white space and a split at it take no regular expression.

    Replacing walks a text some four times as long as looking for one sign does, so kinds that few
    texts have are looked for first.
    """
    spaced = F.replace(text, F.lit("\n"), F.lit(" "))
    other, rare = spaced, F.lit(False)
    for white in _RARE_WHITE:
        other = F.replace(other, F.lit(white), F.lit(" "))
        rare = rare | F.contains(text, F.lit(white))
    return F.array_remove(F.split(F.when(rare, other).otherwise(spaced), " "), "")


def _bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), make), 0)


def _widths(min_words: int) -> tuple[int, int]:
    """Words of a gram, and how many grams a run of ``min_words`` words has."""
    gram = max(1, min(8, min_words // 2))
    return gram, min_words - gram + 1


def _drawn(h: Column, after: Column, before: Column, window: int, masks: list[int], whole: bool) -> Column:
    """after, at, before: of each gram drawn between two others, by places.

    A window of grams has the first of its grams that the first mask draws; where that draws none,
    the next mask is tried there. The last mask draws every gram. The row of a gram ``at`` says
    between which two grams the windows are that have it; one row has no ``at``. ``whole``
    says that the two grams are those around all of a text.
    """
    # The choice looks at two words, both of the gram if it has two.
    mixed = lambda own, i: own.bitwiseXOR(F.shiftright(F.get(h, i + 1), 7))
    draws = lambda own, i: mixed(own, i).bitwiseAND(F.lit(masks[0]).cast("long")) == 0
    if not masks[0]:
        places = F.sequence(after + 1, before - 1)
    elif whole:
        numbers = F.transform(h, lambda own, i: F.when(draws(own, i) & (i < before), i).otherwise(-1))
        places = F.array_remove(numbers, -1)
    else:
        places = F.filter(F.sequence(after + 1, before - 1), lambda i: draws(F.get(h, i), i))

    def of_places(places: Column) -> Column:
        found = F.arrays_zip(
            F.concat(F.array(after), places).alias("after"),
            places.alias("at"),
            F.array_repeat(before, F.size(places) + 1).alias("before"),
        )
        return found if len(masks) == 1 else _bound(found, of_found)

    def of_found(found: Column) -> Column:
        end = lambda s: F.coalesce(s["at"], before)
        gaps = F.filter(found, lambda s: end(s) - s["after"] > window)
        inside = F.transform(gaps, lambda s: _drawn(h, s["after"], end(s), window, masks[1:], False))
        return F.concat(found, F.flatten(inside))

    return _bound(places, of_places)


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _of(start: str, length: Column | int) -> Column:
    """Some of ``h``, the column of the hashes of a text's words."""
    return F.slice("h", F.col(start) + 1, length)


def _stretches(whole: DataFrame, min_words: int, once: bool = True) -> DataFrame:
    """one, two, print, digest, from, n: of each fingerprint of a text, the stretch of the n runs that have it.

    The first ``upper`` of the runs hold the two words half a window ahead of the gram, the others
    those half a window behind it; ``sides`` has a hash of either two, of 32 bits.
    Without ``once``, a text of many rows gives them for each row; no row is shuffled then.
    None where a text is shorter than a run. Arrays are walked for the places only; the words of
    stretches are hashed row by row, which Spark compiles.
    """
    width, window = _widths(min_words)
    masks = [15, 7, 3, 1, 0] if width > 1 else [0]

    def of_hashes(h: Column) -> Column:
        drawn = _drawn(h, F.lit(-1), F.size(h) - (width - 1), window, masks, True)
        return F.struct(h.alias("h"), F.when(F.size(h) >= min_words, drawn).alias("drawn"))

    found = whole.select("one", "two", _bound(_hashes(_words(F.col("text"))), of_hashes).alias("found"))
    found = found.select("one", "two", "found.h", F.inline("found.drawn"))
    begin = F.greatest(F.col("at") - (window - 1), F.col("after") + 1)
    end = F.least(F.col("at"), F.col("before") - window)
    found = found.withColumns({"from": begin, "to": end}).filter("at IS NOT NULL AND from <= to")
    length = F.col("to") - F.col("from") + min_words
    # A run has half of the words around its gram on one side of it at least. Where there are no
    # such words, no run needs them.
    half = window // 2
    n = F.col("to") - F.col("from") + 1
    upper = F.least(F.greatest(F.col("at") - half - F.col("from") + 1, F.lit(0)), n)
    # More words than two made this stage slower by more than the runs they rule out.
    two = lambda first: F.hash(F.get("h", first), F.get("h", first + 1)).cast("long")
    ahead, behind = two(F.col("at") - half), two(F.col("at") + min_words - half - 2)
    found = found.select(
        "one",
        "two",
        F.xxhash64(_of("at", width)).alias("print"),
        F.xxhash64(F.col("at") - F.col("from"), _of("from", length)).alias("digest"),
        "from",
        n.alias("n"),
        upper.alias("upper"),
        F.shiftleft(ahead, 32).bitwiseOR(behind.bitwiseAND(F.lit(_LOW))).alias("sides"),
    )
    return _once(found) if once else found


def _once(stretches: DataFrame) -> DataFrame:
    """Rows of one text give the same stretches. A maximum takes no flag along, as ``first`` does."""
    place = ["one", "two", "from"]
    same = [F.max(name).alias(name) for name in stretches.columns if name not in place]
    return stretches.groupBy(*place).agg(*same)


def _halves(stretches: DataFrame) -> DataFrame:
    """print, half, digest, laps, and place and n of the runs of a stretch that have one ``half``."""
    # Hashes of the words behind lie above those of the words ahead.
    behind = F.col("sides").bitwiseAND(F.lit(_LOW)) + F.lit(_LOW)
    upper = {"place": F.col("place"), "n": F.col("upper"), "half": F.shiftright("sides", 32)}
    lower = {"place": F.col("place") + F.col("upper"), "n": F.col("n") - F.col("upper"), "half": behind}
    both = [F.struct(*[c.alias(name) for name, c in half.items()]) for half in (upper, lower)]
    return stretches.select("print", "digest", "laps", F.inline(F.array(*both))).filter("n > 0")


def _runs(rows: DataFrame, min_words: int) -> DataFrame:
    """number, print, from and a digest of all words, of each run of some ``stretches`` of a ``text``."""
    found = rows.select("number", "stretches", _hashes(_words(F.col("text"))).alias("h"))
    found = found.select("number", "h", F.inline("stretches"))
    ends = F.col("from") + F.col("n") - 1
    found = found.select("number", "h", "print", F.explode(F.sequence("from", ends)).alias("from"))
    return found.select("number", "print", "from", F.xxhash64(_of("from", min_words)).alias("digest"))


def repeated_runs(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50
) -> DataFrame:
    """doc, one, two (digests of the text), and runs of repeated words: (from, to) arrays.

    ``whole`` says that the text is a later copy, of which all words are one run.
    What is written on the way is deleted as soon as no later step reads it.
    """
    if min_words < 3:
        raise ValueError("passages have three words or more")
    spark = df.sparkSession
    whole = df.select(F.col(key).alias("doc"), F.col(text).alias("text")).filter("text IS NOT NULL")
    whole = whole.withColumns({"one": F.xxhash64("text"), "two": F.xxhash64(F.lit("second"), "text")})
    with released_shuffles(spark), owned_cuts(spark) as kept:
        copies = materialize(whole.select("doc", "one", "two").distinct(), "copies")
        texts = copies.groupBy("one", "two").agg(F.min(F.struct("doc")).alias("owner"))
        # Texts are numbered in the order of their first documents, so a place is one number.
        texts = with_row_id(materialize(texts, "owners"), ["owner", "one", "two"], "number")
        texts = materialize(texts, "texts")
        lengths, repeats = _repeats(whole, texts, min_words)
        # Later documents of a text repeat all of it.
        owned = texts.join(lengths, ["one", "two"]).join(repeats, "number", "left")
        every = F.array(F.struct(F.lit(0).alias("from"), (F.col("n") - 1).alias("to")))
        of_copies = copies.join(materialize(owned, "owned"), ["one", "two"])
        is_owner = F.col("doc").eqNullSafe(F.col("owner.doc"))
        of_copies = of_copies.withColumn("runs", F.when(is_owner, F.col("runs")).otherwise(every))
        of_copies = of_copies.withColumn("whole", ~is_owner).filter("runs IS NOT NULL")
        return kept(of_copies.select("doc", "one", "two", "runs", "whole"), "repeats")


def _repeats(whole: DataFrame, texts: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """n of a text that has runs, by its digests, and the runs that stand earlier, by its number."""
    number = lambda place: F.expr(f"{place} div {_PLACES}L")
    spark = whole.sparkSession
    with owned_cuts(spark) as kept:
        prints = materialize(_stretches(whole, min_words, once=False), "prints")
        ends = F.max(F.col("from") + F.col("n")) + (min_words - 1)
        lengths = kept(prints.groupBy("one", "two").agg(ends.alias("n")), "lengths")
        # Rows of one text count as one here; only what is left is brought down to one of each.
        places = prints.select("print", F.xxhash64("one", "two", "from").alias("at"))
        twice = places.groupBy("print").agg(F.min("at").alias("least"), F.max("at").alias("most"))
        twice = materialize(twice.filter("least != most").select("print"), "twice")
        place = F.col("number") * F.lit(_PLACES) + F.col("from")
        again = _once(prints.join(twice.hint("shuffle_hash"), "print"))
        again = again.join(texts.drop("owner").hint("shuffle_hash"), ["one", "two"])
        again = kept(again.withColumn("place", place).drop("one", "two", "from", "number"), "stretches")

    firsts = again.groupBy("print", "digest").agg(F.min("place").alias("first"))
    again = again.join(materialize(firsts, "firsts").hint("shuffle_hash"), ["print", "digest"])
    apart = (number("place") != number("first")) | (F.col("place") >= F.col("first") + min_words)
    again = materialize(again.withColumn("settled", apart), "settled")
    # Only where stretches of a fingerprint differ, or lap, can single runs tell more, and only
    # those runs that have the same words on the side of their gram where they have enough.
    single = _halves(again.filter("NOT settled").withColumn("laps", F.col("place") != F.col("first")))
    alike = ["print", "half"]
    unlike = (F.min("digest") != F.max("digest")) | F.max("laps")
    unlike = single.groupBy(*alike).agg(unlike.alias("unlike")).filter("unlike").select(*alike)
    single = single.join(materialize(unlike, "unlike").hint("shuffle_hash"), alike, "left_semi")
    single = single.select(
        number("place").alias("number"), "print", (F.col("place") % _PLACES).cast("int").alias("from"), "n"
    )
    single = single.groupBy("number").agg(F.collect_list(F.struct("print", "from", "n")).alias("stretches"))
    single = materialize(single.join(texts, "number"), "single").alias("s")

    same = (F.col("s.one") == whole["one"]) & (F.col("s.two") == whole["two"])
    found = whole.join(single.hint("shuffle_hash"), same & F.col("s.owner.doc").eqNullSafe(whole["doc"]))
    found = _runs(found, min_words)
    found = found.select((F.col("number") * F.lit(_PLACES) + F.col("from")).alias("place"), "print", "digest")
    found = materialize(found, "runs")
    first = found.groupBy("print", "digest").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    first = materialize(first.filter("first != last").drop("last"), "first")
    later = found.join(first.hint("shuffle_hash"), ["print", "digest"]).filter(apart).select("place", F.lit(1).alias("n"))
    later = later.unionByName(again.filter("settled").select("place", "n"))
    # Runs that overlap or touch become one.
    begin = (F.col("place") % _PLACES).cast("int")
    last = begin + F.col("n") + (min_words - 2)
    later = later.select(number("place").alias("number"), begin.alias("from"), last.alias("to"))
    upward = Window.partitionBy("number").orderBy("from", "to")
    before = F.max("to").over(upward.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("from") > before + 1, F.lit(True))
    later = later.withColumn("starts", starts.cast("int"))
    later = later.withColumn("run", F.sum("starts").over(upward.rowsBetween(Window.unboundedPreceding, 0)))
    runs = later.groupBy("number", "run").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    return lengths, runs.groupBy("number").agg(
        F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs")
    )


def without_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50
) -> DataFrame:
    """The rows with repeated passages taken out of the text, and ``n_removed``, how many words."""
    kept = [c for c in df.columns if c.lower() != "n_removed"]
    runs = repeated_runs(df, key, text, min_words).select(
        *[F.col(name).alias(f"__{name}") for name in ("doc", "one", "two", "runs", "whole")]
    )
    rows = df.select(
        *kept, F.xxhash64(text).alias("__v"), F.xxhash64(F.lit("second"), text).alias("__w")
    )
    same = (F.col("__one") == F.col("__v")) & (F.col("__two") == F.col("__w"))
    rows = rows.join(runs.hint("shuffle_hash"), F.col(key).eqNullSafe(F.col("__doc")) & same, "left")
    has = F.col("__runs").isNotNull()
    # Of a later copy nothing stays but white space ahead; it is not taken to pieces without.
    nothing = F.col("__whole") & ~F.substring(text, 1, 1).rlike(r"\s")
    new_text = F.when(nothing, F.lit("")).when(
        has, _bound(_pieces(F.col(text)), lambda pieces: _rest(F.col(text), pieces, F.col("__runs")))
    ).otherwise(F.col(text))
    removed = F.aggregate("__runs", F.lit(0).cast("long"), lambda a, r: a + r["to"] - r["from"] + 1)
    return rows.select(
        *(new_text.alias(text) if c == text else c for c in kept),
        F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
    )


def _rest(text: Column, pieces: Column, runs: Column) -> Column:
    """What stays between the runs; a line end inside a run still parts what stands around it."""
    # White space before the first word is a piece ahead of the words.
    ahead = F.when(text.rlike(r"^\s"), 1).otherwise(0)
    part = lambda start, size: F.array_join(F.slice(pieces, start, size), "")
    ends = F.concat(F.array(F.lit(-1) - ahead), runs["to"])
    begins = F.concat(runs["from"], F.array(F.size(pieces) - ahead))
    gone_to = F.concat(runs["to"], F.array(F.lit(-1)))
    gaps = F.arrays_zip(ends.alias("e"), begins.alias("b"), gone_to.alias("t"))

    def stays(g: Column) -> Column:
        own = part(g["e"] + 2 + ahead, g["b"] - g["e"] - 1)
        gone = part(g["b"] + 1 + ahead, F.greatest(g["t"] - g["b"] + 1, F.lit(0)))
        cut = F.contains(gone, F.lit("\n")) & (own != "") & ~F.endswith(own, F.lit("\n"))
        return F.concat(own, F.when(cut, "\n").otherwise(""))

    return F.array_join(F.transform(gaps, stays), "")


def oracle(min_words: int = 50) -> str:
    """The same for DuckDB, by comparing the words of all runs themselves."""
    white = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
    space = r"[ \t\n\r\f\v]"
    word = r"[^ \t\n\r\f\v]"
    return f"""
WITH whole AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS place, * FROM whole),
split AS (SELECT place, regexp_extract_all(text, '{word}+{space}*') AS ps,
    regexp_extract(text, '^{space}*') AS ahead FROM numbered),
pieces AS (SELECT place, unnest(ps) AS piece, generate_subscripts(ps, 1) AS i FROM split),
coded AS (SELECT *, dense_rank() OVER (ORDER BY rtrim(piece, {white})) AS word FROM pieces),
runs AS (SELECT place, i, list(word) OVER (PARTITION BY place ORDER BY i
    ROWS BETWEEN CURRENT ROW AND {min_words - 1} FOLLOWING) AS content FROM coded),
marked AS (SELECT place, i, min((place, i)) OVER (PARTITION BY content) AS first
    FROM runs WHERE len(content) = {min_words}),
later AS (SELECT place, i FROM marked
    WHERE place > first[1] OR (place = first[1] AND i >= first[2] + {min_words})),
gone AS (SELECT DISTINCT place, unnest(generate_series(i, i + {min_words - 1})) AS i FROM later),
flagged AS (SELECT p.place, p.i, p.piece, g.i IS NOT NULL AS cut
  FROM pieces p LEFT JOIN gone g ON p.place = g.place AND p.i = g.i),
begun AS (SELECT *, cut AND NOT lag(cut, 1, false) OVER w AS head, lag(piece) OVER w AS before,
  p_lines FROM (SELECT *, contains(piece, chr(10)) AS p_lines FROM flagged) WINDOW w AS (PARTITION BY place ORDER BY i)),
runned AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY place ORDER BY i) AS run FROM begun),
spread AS (SELECT *, bool_or(p_lines AND cut) OVER (PARTITION BY place, run) AS lines FROM runned),
emitted AS (SELECT s.place, s.i, s.cut, CASE WHEN NOT s.cut THEN s.piece
    WHEN s.head AND s.lines AND coalesce(s.before, split.ahead) <> ''
      AND NOT ends_with(coalesce(s.before, split.ahead), chr(10)) THEN chr(10) ELSE '' END AS part
  FROM spread s JOIN split ON s.place = split.place),
rest AS (SELECT place, string_agg(part, '' ORDER BY i) AS rest, count(*) FILTER (cut) AS n FROM emitted GROUP BY place)
SELECT d.doc_id, CASE WHEN coalesce(rest.n, 0) = 0 THEN d.text ELSE split.ahead || rest.rest END AS text,
  CAST(coalesce(rest.n, 0) AS BIGINT) AS n_removed
FROM documents d
LEFT JOIN numbered ON d.doc_id IS NOT DISTINCT FROM numbered.doc_id AND d.text = numbered.text
LEFT JOIN split ON numbered.place = split.place LEFT JOIN rest ON numbered.place = rest.place"""  # noqa: E501
