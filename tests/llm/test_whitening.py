import math
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import saved, table  # noqa: E402

from skylag.llm import whitening  # noqa: E402
from skylag.llm.queries import QUERIES  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, label int"
RNG = np.random.default_rng(7)


def symmetric(values):
    basis = np.linalg.qr(RNG.normal(size=(len(values), len(values))))[0]
    made = (basis * values) @ basis.T
    return (made + made.T) / 2


SPECTRA = {
    "gaps": lambda n: np.sort(RNG.exponential(size=n)),
    "two values": lambda n: np.where(np.arange(n) % 3, 5.0, 2.0),
    "equal": lambda n: np.ones(n),
    "two of rank": lambda n: np.where(np.arange(n) < 2, np.arange(n) + 1.0, 0.0),
    "close": lambda n: 1 + 1e-9 * np.arange(n),
    "falling fast": lambda n: 10.0 ** -np.arange(n),
    "negative too": lambda n: np.arange(n) - n / 2,
}


@pytest.mark.parametrize("kind", SPECTRA)
@pytest.mark.parametrize("size", [1, 2, 3, 8, 64, 130])
def test_components_of_a_matrix(kind, size):
    a = symmetric(SPECTRA[kind](size))
    values, vectors = whitening.leading_components(a, 4)
    wanted = np.linalg.eigvalsh(a)[::-1][:4]
    scale = np.linalg.norm(a)
    assert np.abs(values - wanted).max() <= 1e-13 * scale
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(wanted))).max() <= 1e-13


def test_the_zero_matrix():
    values, vectors = whitening.leading_components(np.zeros((3, 3)), 2)
    assert values.tolist() == [0, 0] and vectors.shape == (3, 2)


def test_the_polar_factor():
    a = symmetric(np.asarray([-3.0, -1e-6, 2.0, 1e-9, 5.0]))
    u = whitening.polar_factor(a)
    assert np.abs(u @ u - np.eye(5)).max() < 1e-12
    h = u @ a
    assert np.abs(h - h.T).max() < 1e-12 and np.linalg.eigvalsh(h).min() > -1e-12


def by_force(rows):
    """The contract in plain Python and one call of eigh: id, then rows of results."""
    kept = [
        (key, [math.floor(256 * float(c)) for c in vector])
        for key, vector in rows
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector)
    ]
    fit = sorted({tuple(x) for _, x in kept})
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(dim)]
    mean = np.asarray([s / n for s in sums])
    away = np.asarray(fit, float) - mean
    covariance = away.T @ away / n
    values, vectors = np.linalg.eigh(covariance)
    out = {}
    for key, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for number in range(1, min(4, dim) + 1):
            e = values[-number]
            if e <= dim * np.finfo(float).eps * np.trace(covariance):
                continue
            score = (np.asarray(x, float) - mean) @ vectors[:, -number] / math.sqrt(e)
            out.setdefault((key, number), []).append((n, deviation, score, e / np.trace(covariance)))
    return out


def check(found, wanted):
    got = {}
    for r in found:
        got.setdefault((r.vec_id, r.component), []).append(r)
    assert set(got) == set(wanted)
    # One sign for each component, taken from its largest score.
    signs = {}
    for (key, number), rows in wanted.items():
        if abs(rows[0][2]) > abs(signs.get(number, (0, 0))[0]):
            signs[number] = (rows[0][2], 1 if rows[0][2] * got[key, number][0].whitened > 0 else -1)
    for place, rows in wanted.items():
        assert len(rows) == len(got[place])
        for (n, deviation, score, share), r in zip(rows, got[place], strict=True):
            assert (r.n, r.deviation) == (n, deviation)
            assert r.whitened * signs[place[1]][1] == pytest.approx(score, abs=1e-9)
            assert r.explained == pytest.approx(share, rel=1e-9)
            assert r.identity_error < 1e-9


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r[0], r[1]) for r in table(sf_dir, "embeddings")]
    found = QUERIES["op11_whitening"](spark, sf_dir).collect()
    check(found, by_force(rows))


def test_odd_vectors_copies_and_null_keys(spark, tmp_path):
    vectors = [[float(x) for x in RNG.normal(size=3) * (9, 3, 1)] for _ in range(40)]
    odd = [None, [1.0, None, 2.0], [math.nan, 1.0, 1.0], [math.inf, 0.0, 0.0], [0.0, 0.0, 0.0], [-0.0, 0.0, 0.0]]
    given = [*vectors, *odd, *[vectors[0]] * 30, *[vectors[1]] * 5]
    rows = [(i, v, 1) for i, v in enumerate(given)]
    rows += [(None, vectors[2], None), (3, vectors[3], None)]
    folder = saved(spark, tmp_path, rows, VECTORS, "embeddings")
    read = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    found = QUERIES["op11_whitening"](spark, folder).collect()
    check(found, by_force([(r.vec_id, r.embedding) for r in read]))


def test_no_variance_no_rows_and_empty_tables(spark, tmp_path):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whitened(one).count() == 0
    assert whitening.whitened(one.limit(0)).count() == 0
    assert whitening.whitened(one.filter("vec_id > 5")).columns == whitening.whitened(one).columns


def test_other_lengths_clashing_columns_large_values_and_flat_directions(spark):
    rows = [(i, [float(i * i % 7), 2.0 * (i * i % 7), 5e5 * (i % 5)], 0) for i in range(30)]
    rows += [(90, [1.0], 1), (91, [], 2), (92, [1e300, 1.0, 1.0], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long").withColumn(
        "component", F.lit("x")
    )
    found = whitening.whitened(df).collect()
    wanted = by_force([r[:2] for r in rows[:30]])
    assert {r.component for r in found} == {1, 2} and len(found) == 60
    assert None in {r.deviation for r in found}
    for r in found:
        n, deviation, _, share = wanted[r.vec_id, r.component][0]
        assert r.deviation == (deviation if deviation < 1 << 63 else None)
        assert r.n == n and r.identity_error < 1e-4


def test_sums_are_exact(spark):
    grid = RNG.integers(-(2**40), 2**40, size=(1000, 2))
    n, *parts = whitening._limbs(grid).tolist()
    sums = [parts[i] + (parts[2 + i] << 20) + (parts[4 + i] << 40) for i in range(2)]
    assert n == 1000 and sums == [sum(map(int, grid[:, i].tolist())) for i in range(2)]


def test_only_tasks_sums_reach_the_driver(spark, sf_dir):
    rows = whitening.on_grid(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", 256.0)
    plan = rows.select("grid").distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
