import inspect
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import saved, table  # noqa: E402

from skylag.llm import embedding_dedup, neighbours  # noqa: E402
from skylag.llm.queries import QUERIES  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def good(v):
    return v is not None and None not in v and np.isfinite(v).all() and np.any(v)


def nearest_by_force(rows, k=20):
    rows = [(i, np.asarray(v, "f4").astype("f8")) for i, v, _ in rows if i is not None and good(v)]
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            scores = [(-float((x * y).sum()), i) for i, y in rows if i != q and len(x) == len(y)]
            out[q] = sorted(scores)[:k]
    return out


def check_nearest(found, rows, k=20):
    want = nearest_by_force(rows, k)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert {q: [i for _, i in v] for q, v in got.items()} == {
        q: [i for _, i in v] for q, v in want.items() if v
    }
    for q, pairs in got.items():
        assert np.allclose([s for s, _ in pairs], [s for s, _ in want[q]], rtol=0, atol=1e-12)


def random_rows(n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.normal(size=dim)
        if i % 3 == 0 and rows:
            v = np.asarray(rows[rng.integers(len(rows))][1]) + rng.normal(size=dim) * 0.03
        rows.append((i, [float(x) for x in np.asarray(v, "f4")], int(rng.integers(3))))
    return rows


ODD = [
    (0, None, 1), (20, [0.0] * 4, 1), (40, [1.0, None, 2.0, 1.0], 1), (60, [NAN, 1.0, 1.0, 1.0], 1),
    (80, [INF, 1.0, 1.0, 1.0], 1), (100, [], 1), (1, [1.0, 0.0, 0.0, 0.0], None), (120, [1.0, 2.0], 1),
    (140, [1.0, 0.0, 0.0, 0.0], 1), (2, [1.0, -0.0, 0.0, 0.0], 1), (3, [2.0, 0.0, 0.0, 0.0], 1),
    (4, [1.0, 0.0, 0.0, 0.0], 2), (160, [1.0, 2.0], 1), (None, [1.0, 0.0, 0.0, 0.0], 1),
    (5, [0.93, 0.36756, 0.0, 0.0], 1),
] + [(1000 + i, [0.5, 0.5, 0.5, 0.5], 1) for i in range(60)]


def test_nearest_query(spark, sf_dir):
    check_nearest(QUERIES["op6_nearest_vectors"](spark, sf_dir).collect(), table(sf_dir, "embeddings"))


def test_nearest_of_odd_vectors(spark, tmp_path):
    folder = saved(spark, tmp_path, ODD, SCHEMA, "embeddings")
    check_nearest(QUERIES["op6_nearest_vectors"](spark, folder).collect(), ODD)


def test_nearest_over_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 300)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 20)
    monkeypatch.setattr(neighbours, "LEAF", 16)
    rows = random_rows(1500) + [(9000 + i, [3.0] * 16, 0) for i in range(400)]
    df = spark.createDataFrame(rows + rows[:50], SCHEMA)
    check_nearest(neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect(), rows)


def test_nearest_of_an_empty_table(spark):
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0


@pytest.mark.parametrize("factor", [1.0, 1.1, 1.3])
def test_relaxed_pruning_keeps_recall_and_one_is_exact(factor):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8))
    points = np.concatenate([c + rng.normal(size=(100, 8)) * 0.2 for c in centres])
    queries = points[::40]
    got = neighbours.VantageTree(points).search(queries, 10, factor)
    want = np.argsort(-(queries @ points.T), axis=1)[:, :10]
    recall = np.mean([len(set(g) & set(w)) / 10 for g, w in zip(got, want, strict=True)])
    assert recall == 1.0 if factor == 1.0 else recall >= 0.9


def groups_by_force(rows, least=0.93):
    usable = [i for i, (k, v, label) in enumerate(rows) if k is not None and label is not None and good(v)]
    links, above = {i: 0 for i in range(len(rows))}, {i: i for i in range(len(rows))}

    def find(i):
        while above[i] != i:
            i = above[i]
        return i

    for a in usable:
        for b in usable:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.asarray(rows[i][1], "f8") for i in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    above[find(a)] = find(b)
    least_of = {}
    for i in usable:
        root = find(i)
        least_of[root] = min(least_of.get(root, rows[i][0]), rows[i][0])
    return [
        (rows[i][0], links[i], least_of[find(i)] if i in usable else rows[i][0])
        for i in range(len(rows))
    ]


def check_groups(found, rows):
    want = sorted(groups_by_force(rows), key=str)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_near_dedup_query(spark, sf_dir):
    check_groups(QUERIES["op7_vector_near_dedup"](spark, sf_dir).collect(), table(sf_dir, "embeddings"))


def test_near_dedup_of_odd_and_repeated_vectors(spark, tmp_path):
    rows = ODD + [(7, [3.0, 1.0, 0.0, 2.0], 1)] * 3
    folder = saved(spark, tmp_path, rows, SCHEMA, "embeddings")
    check_groups(QUERIES["op7_vector_near_dedup"](spark, folder).collect(), rows)


def test_near_dedup_of_large_groups_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(3, 16))
    rows = [
        (i, [float(x) for x in np.asarray(base[i % 3] + rng.normal(size=16) * 0.22, "f4")], i % 2)
        for i in range(240)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    found = embedding_dedup.near_duplicate_vectors(df, tables=12).collect()
    want = groups_by_force(rows)
    linked = sum(w[1] for w in want)
    assert linked > 2000
    # Hashing may miss a pair; none is made up.
    assert 0.99 * linked <= sum(r.n_links for r in found) <= linked
    assert {r.vec_id: r.component_id for r in found} == {w[0]: w[2] for w in want}


def test_near_dedup_of_an_empty_table(spark):
    assert embedding_dedup.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    y = embedding_dedup.hadamard(x)
    assert np.allclose((y * y).sum(1), 64 * (x * x).sum(1))
    assert np.allclose(embedding_dedup.hadamard(y), 64 * x)


def test_pairs_at_the_threshold_meet_by_the_query_s_own_parameters():
    own = inspect.signature(embedding_dedup.near_duplicate_vectors).parameters
    least, tables, hashes = (own[n].default for n in ("least", "tables", "hashes"))
    rng, missed, pairs = np.random.default_rng(5), 0, 20_000
    for _ in range(2):
        a, b = rng.normal(size=(2, pairs // 2, 64))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b *= np.sqrt(1 - least**2) / np.linalg.norm(b, axis=1, keepdims=True)
        (ma, pa), (mb, pb) = (embedding_dedup.buckets(x, tables, hashes) for x in (a, least * a + b))
        meet = (ma == mb) | (pb == ma[:, :, None]).any(axis=2) | (pa == mb[:, :, None]).any(axis=2)
        missed += (~meet.any(axis=1)).sum()
    assert missed <= 2
