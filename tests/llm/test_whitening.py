"""Embedding whitening against numpy on all rows, with exact deviations."""

import random

import numpy as np
import pytest

from tillwork.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, whitened string, x string"


def rows_of(seed=3, n=300, d=12):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n, d)) @ rnd.normal(size=(d, d)) * 0.2
    base[: n // 3] = base[0]  # a third of the rows are one vector
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(base)]


def numpy_model(rows, weights=None):
    c = np.array([v for _, v in rows])
    x = np.floor(64 * c).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0) if weights == "one" else x
    n, s = len(fit), fit.sum(axis=0)
    cov = np.cov(fit.T, bias=True)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return n, deviation, (x - s / n) @ v / np.sqrt(e), e / np.trace(cov)


def check(got, rows, weights=None, components=32):
    n, deviation, white, explained = numpy_model(rows, weights)
    k = min(components, len(rows[0][1]))
    table = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(table) == len(rows) * k
    sign = None
    for place, (i, _) in enumerate(rows):
        mine = [table[i, c + 1] for c in range(k)]
        assert {r.n for r in mine} == {n} and {r.deviation for r in mine} == {deviation[place]}
        assert np.allclose([r.explained for r in mine], explained[:k], rtol=1e-9)
        w = np.array([r.whitened for r in mine])
        sign = np.sign(w * white[place][:k]) if sign is None else sign
        assert np.allclose(w * sign, white[place][:k], atol=1e-9)
    assert {r.identity_error for r in got}.pop() < 1e-9


def test_against_numpy(spark):
    rows = rows_of()
    bad = [(900, None), (901, []), (902, [float("nan")] * 12), (903, [1.0] * 11 + [None]), (904, [float("-inf")] + [0.0] * 11), (905, [0.5] * 3)]
    df = spark.createDataFrame([(i, v, 1, "a", "b") for i, v in rows + bad], SCHEMA)
    check(whitening.whiten(df).collect(), rows)
    check(whitening.whiten(df, components=5, use_counts=False).collect(), rows, "one", 5)


def test_result_does_not_hang_on_partitions(spark):
    rows = rows_of(seed=8, n=90, d=5)
    df = spark.createDataFrame([(i, v, 1, "a", "b") for i, v in rows], SCHEMA)
    for parts in (1, 7):
        check(whitening.whiten(df.repartition(parts)).collect(), rows)


def test_repeated_and_null_ids_keep_their_rows(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.5, 2.0]), (None, [3.0, 0.25]), (None, [3.0, 0.25])]
    df = spark.createDataFrame([(i, v, 1, "a", "b") for i, v in rows], SCHEMA)
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id is None, r.component) for r in got) == sorted([(False, 1), (False, 2), (True, 1), (True, 2)] * 2)


def test_no_variance_and_empty_table(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, "a", "b") for i in range(5)], SCHEMA)
    assert whitening.whiten(same).collect() == []
    one_way = spark.createDataFrame([(i, [float(i), 2.0], 1, "a", "b") for i in range(5)], SCHEMA)
    assert {r.component for r in whitening.whiten(one_way).collect()} == {1}


def test_large_entries(spark):
    """Exact beyond 64 bits, null where no long holds the deviation."""
    df = spark.createDataFrame([(i, [v, 0.0], 1, "a", "b") for i, v in enumerate([1e30, -1e30, 0.0])], SCHEMA)
    got = whitening.whiten(df).collect()
    assert [r.deviation is None for r in sorted(got, key=lambda r: r.vec_id)] == [True, True, False]
    assert {r.n for r in got} == {3} and all(np.isfinite(r.whitened) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_deviation_is_exact(seed):
    rnd = random.Random(seed)
    x = np.array([[rnd.randrange(-(10**6), 10**6) for _ in range(6)] for _ in range(40)], np.int64)
    for n in (1, 40, 10**5, 10**9):
        sums = tuple(int(s) * n // 40 for s in x.sum(axis=0))
        model = whitening.Whitener(n, sums, np.empty((6, 0)), np.empty(0), 0.0)
        exact = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
        assert model.deviation(x) == [v if v < 2**63 else None for v in exact]
