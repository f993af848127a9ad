import re
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCUMENTS, documents, saved, table  # noqa: E402

from skylag.llm import minhash  # noqa: E402
from skylag.llm.components import components  # noqa: E402
from skylag.llm.queries import QUERIES  # noqa: E402


def shingles(text, words):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    parts = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not parts:
        return set()
    size = min(words, len(parts))
    return {tuple(parts[i : i + size]) for i in range(len(parts) - size + 1)}


def by_force(rows, words=2, percent=80):
    """(doc, set size, component) of each row, by comparing all pairs."""
    sets = [shingles(r[1], words) for r in rows]
    above = list(range(len(rows)))

    def find(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            small, large = sorted((len(a), len(b)))
            if small and 100 * small >= percent * large:
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    above[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        root = find(i)
        least[root] = min(least.get(root, r[0]), r[0])
    return sorted((r[0], len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets)))


def check(found, rows, words=2):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found)
    assert got == by_force(rows, words)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_query_equals_brute_force(spark, sf_dir):
    rows = table(sf_dir, "documents")
    check(QUERIES["op8_superminhash_dedup"](spark, sf_dir).collect(), rows)


def test_odd_texts(spark, tmp_path):
    texts = [
        "", None, " \n", "one", "ONE", "one\x0b", "one two", "One Two", "é É", "É é", "x " * 4000,
        "x " * 9000, "a\x1cb c", "same words here", "same words here", "same words there",
    ]
    folder = saved(spark, tmp_path, documents(texts), DOCUMENTS)
    check(QUERIES["op8_superminhash_dedup"](spark, folder).collect(), documents(texts))


def chained(seed=1, groups=6, size=40, length=30):
    """Groups of near copies at about the threshold, so that links are chains, not cliques."""
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(groups):
        words = [f"w{n}" for n in rng.integers(0, 10_000, length)]
        for _ in range(size):
            texts.append(" ".join(words))
            for at in rng.integers(0, length, rng.integers(1, 4)):
                words[at] = f"w{rng.integers(0, 10_000)}"
    return texts


@pytest.mark.parametrize("rounds,block", [(0, 8), (1, 8), (2, 128)])
def test_chains_are_followed_whole(spark, monkeypatch, rounds, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "PIVOT_SHINGLES", 100)
    rows = documents(chained())
    df = spark.createDataFrame(rows, DOCUMENTS)
    check(minhash.near_duplicates(df, words=2, rounds=rounds).collect(), rows)


def test_null_keys_repeated_rows_and_an_empty_table(spark):
    df = spark.createDataFrame(
        [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "a b c")], "doc_id long, text string"
    )
    found = sorted((str(r.doc_id), r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert found == [("1", 1, True), ("1", 1, True), ("2", 1, False), ("None", None, True)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_texts_under_one_key_keep_their_own_links(spark):
    near = [" ".join(f"w{i}" for i in range(80)) + end for end in ("", " x", " x y")]
    rows = [(1, "quite another text"), (1, near[0]), (2, near[1]), (3, near[2]), (4, "apart"), (2, "apart")]
    for order in (rows, rows[::-1], [*rows[3:], *rows[:3], rows[0]]):
        df = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        check(minhash.near_duplicates(df, words=2).collect(), order)


def test_keys_of_text(spark):
    rows = [("b", "a b c d"), ("a", "a b c d"), ("c", "d e f g"), ("é", "D E F G")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    check(minhash.near_duplicates(df, words=2).collect(), rows)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for a, b in ((1000, 200), (60, 15), (5000 // 2, 300), (8, 2)):
        one, other = np.unique(pool[:a]), np.unique(pool[b : a + b])
        true = (a - b) / (a + b)
        signed = minhash.super_minhash([one, other], 256)
        assert abs((signed[0] == signed[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / 256)
    # Places of one set hold different ranks of different elements, and never stay empty.
    assert np.isfinite(minhash.super_minhash([pool[:1], pool[:2]], 150)).all()


def test_signatures_do_not_hang_on_the_batch(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 700, 3, 90, 2000)]
    together = minhash.super_minhash(sets, 100)
    monkeypatch.setattr(minhash, "_ELEMENTS", 64)
    alone = np.concatenate([minhash.super_minhash([s], 100) for s in sets])
    assert (together == alone).all()


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    odd = [(5000, 5000), (6001, 6000), (6000, 6001), (None, 3), (7, None)]
    df = spark.createDataFrame(path + star + odd, "a long, b long").repartition(7)
    found = {r.node: r.component for r in components(df).collect()}
    want = {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(400)} | {6000: 6000, 6001: 6000}
    assert found == want
