import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).parent.parent))
sys.path.insert(0, str(Path(__file__).parent))
from compare import connect, differences  # noqa: E402
from llm_cases import DOCUMENTS, saved  # noqa: E402

from skylag.llm import collocations  # noqa: E402
from skylag.llm.queries import ORACLE, QUERIES  # noqa: E402


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in (re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)) if w]


def counted(texts, longest):
    counts = Counter()
    for words in (w for text in texts for w in pieces(text)):
        for size in range(1, longest + 1):
            counts.update(" ".join(words[i : i + size]) for i in range(len(words) - size + 1))
    return counts


def by_force(rows, longest=3, least=10, covered=50, keep=2000):
    out = []
    for lang in sorted({lang or "und" for _, lang in rows}):
        counts = counted([t for t, other in rows if (other or "und") == lang], longest)
        n = sum(f for phrase, f in counts.items() if " " not in phrase)
        found = {p: f for p, f in counts.items() if " " in p and f >= least}
        best = []
        for phrase, a in found.items():
            words = phrase.split(" ")
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[" ".join(words[:k])], counts[" ".join(words[k:])]
                cuts.append((1000000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            if not any(
                len(p) > len(phrase) and f" {phrase} " in f" {p} " and 100 * f >= covered * a
                for p, f in found.items()
            ):
                best.append((-score, -a, phrase.encode(), phrase, left, right))
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(best)[:keep], 1):
            out.append((lang, rank, phrase, -a, left, right, n, -score))
    return sorted(out)


def rows_of(df):
    return sorted(
        (r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB .,\n\té", max_size=80), st.integers(1, 4), st.integers(1, 6))
def test_chunks_overlap_and_own_each_phrase_once(text, overlap, every):
    chunks = [c.decode().split(" ") for c in collocations.parsed(text.encode(), overlap, every)]
    whole = [w for own in chunks for w in own[:-overlap]]
    marked = re.findall(r"\n|[^ \n]+", re.sub(r"[.,;:!?\n\x0b-\x0d]", "\n", text.lower()).replace("\t", " "))
    assert whole == marked
    for one, other in zip(chunks, chunks[1:], strict=False):
        assert one[-overlap:] == other[:overlap]


def test_equal_passages_give_equal_chunks():
    rnd = random.Random(5)
    passage = " ".join(f"w{rnd.randint(0, 99)}" for _ in range(400))
    one, other = (
        set(collocations.parsed(f"{before} {passage} end".encode(), 2, 16)) for before in ("a", "x y z")
    )
    assert len(one & other) >= len(one) - 2 and len(one) > 10


@pytest.mark.parametrize("longest", [2, 3, 4])
@pytest.mark.parametrize("every", [1, 3, 50])
def test_equals_brute_force(spark, longest, every):
    rnd = random.Random(longest * 100 + every)
    texts = ["".join(rnd.choice(["a", "b", "Ab", "é", " ", " ", " ", ". ", "\t", "\n"]) for _ in range(400)) for _ in range(20)]
    rows = [(t, rnd.choice(["en", None, "und", "x y"])) for t in texts] + [("a b " * 500, "en")] * 6
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    found = collocations.collocations(df, max_words=longest, least=4, keep=25, every=every)
    assert rows_of(found) == by_force(rows, longest, 4, 50, 25)


def test_blocks_and_buckets_do_not_change_counts(spark, sf_dir, monkeypatch):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = rows_of(collocations.collocations(df, least=5))
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 500)
    monkeypatch.setattr(collocations, "BUCKET_BYTES", 5000)
    assert rows_of(collocations.collocations(df, least=5)) == whole


def test_odd_rows(spark, tmp_path):
    texts = [None, "", " \t ", "...\n", "A b" * 3, "X  y\tz. x Y z", "x y z " * 3000, "é\x1cü é\x1cü"]
    rows = [(i % 5 or None, t, lang, None, None) for i, t in enumerate(texts * 3) for lang in ("en", None)]
    folder = saved(spark, tmp_path, rows, DOCUMENTS)
    found = QUERIES["op13_collocations"](spark, folder)
    assert rows_of(found) == by_force([(r[1], r[2]) for r in rows])


def test_empty_tables_and_null_texts_give_no_rows(spark):
    schema = "text string, lang string, phrase int, a int, weight int"
    nothing = spark.createDataFrame([], schema)
    assert collocations.collocations(nothing).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, "en", 1, 2, 3)], schema)).count() == 0
    with pytest.raises(ValueError):
        collocations.collocations(nothing, max_words=1)


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts as of a corpus of 10 ** 12 words."""
    big = 10**12
    counts = [("en", "a b", big), ("en", "a", big + 7), ("en", "b", 3 * big), ("en", None, 5 * big)]
    table = spark.createDataFrame(counts, "lang string, phrase string, f long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: table)
    (row,) = rows_of(collocations.collocations(table))
    assert row == ("en", 1, "a b", big, big + 7, 3 * big, 5 * big, 10**6 * big * big // ((big + 7) * 3 * big))


def test_equals_sql(spark, sf_dir):
    mine = QUERIES["op13_collocations"](spark, sf_dir).toPandas()
    assert differences(mine, connect(sf_dir).execute(ORACLE["op13_collocations"]).df()) == []
