"""Whitening against numpy's eigenvectors, and the merge against one decomposition of all rows."""

import math

import numpy as np
import pytest

from weftline.llm import whitening


def table(spark, rows, parts=5):
    return spark.createDataFrame([(i, v, 1, "x", [1.0]) for i, v in rows], "vec_id long, embedding array<float>, v int, w string, sums array<double>").repartition(parts)


def exact(vectors):
    x = np.floor(np.array(vectors, np.float32).astype(float) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    d = n * x - s
    c = d / n
    e, v = np.linalg.eigh(c.T @ c / n)
    return n, (d.astype(object) ** 2).sum(axis=1), c, e[::-1], v[:, ::-1]


def vectors(n, dims=12, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, dims)) * np.linspace(1, 3, dims) + 5).astype(np.float32).tolist()


def check(df, rows, k=8, tol=1e-7):
    n, far, c, e, v = exact([r[1] for r in rows])
    got = {(r.vec_id, r.component): r for r in df.collect()}
    k = min(k, c.shape[1])
    assert len(got) == n * k
    for comp in range(k):
        mine = np.array([got[i, comp + 1].whitened for i, _ in rows])
        want = c @ v[:, comp] / math.sqrt(e[comp])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < tol
    for (i, _), f in zip(rows, far):
        assert got[i, 1].deviation == f and got[i, 1].n == n
    some = got[rows[0][0], 2]
    assert abs(some.explained - e[1] / e.sum()) < 1e-9 and some.identity_error < 1e-9


def test_same_as_numpy(spark):
    rows = list(enumerate(vectors(300)))
    check(whitening.whiten(table(spark, rows)), rows)


def test_rows_without_a_usable_vector_go(spark):
    good = list(enumerate(vectors(60)))
    bad = [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] + [0.0] * 11), (904, [float("inf")] * 12), (905, [1.0, 2.0]), (906, [2.0**60] * 12)]
    check(whitening.whiten(table(spark, good + bad)), good)


def test_merging_is_lossless(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.integers(99_000, 101_000, (500, 9))
    whole = whitening.Summary(9)
    whole.add_rows(x)
    parts = []
    for some in np.array_split(x, [1, 3, 40, 41, 300]):
        s = whitening.Summary(9)
        s.add_rows(some)
        parts.append(s)
    merged = whitening.Summary(9)
    for s in parts:
        merged.add(s.n, s.sums, s.mean, s.parts)
    assert merged.n == 500 and merged.sums == [int(t) for t in x.sum(axis=0)]
    c = x - x.mean(axis=0)
    for s in (whole, merged):
        assert np.allclose(s.parts.T @ s.parts, c.T @ c, rtol=1e-11)


def test_many_levels_of_merging(spark):
    rows = list(enumerate(vectors(120, 4)))
    df = table(spark, rows, 40)
    found, dims = whitening.usable(df)
    one = whitening.merged(whitening.summaries(found.repartition(40), dims), dims, fan=2).collect()
    assert len(one) == 1 and one[0].n == 120
    check(whitening.whiten(df), rows)


def test_fewer_dimensions_than_components(spark):
    rows = list(enumerate(vectors(50, 3)))
    check(whitening.whiten(table(spark, rows)), rows)


def test_components_without_variance_are_null(spark):
    rows = [(k, [float(k % 5), 1.0, 2.0]) for k in range(20)]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 60
    for r in got:
        assert (r.whitened is not None) == (r.component == 1) and r.identity_error < 1e-9
    assert {round(r.explained, 9) for r in got if r.component > 1} == {0.0}


def test_one_vector_and_none(spark):
    got = whitening.whiten(table(spark, [(7, [1.0, 2.0])])).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.identity_error) for r in got] == [(7, 1, 0, None, None)] * 2
    empty = whitening.whiten(table(spark, []).limit(0))
    assert empty.count() == 0 and "identity_error" in empty.columns
    assert whitening.whiten(table(spark, [(1, None)])).count() == 0


def test_repeated_rows_count_each(spark):
    base = list(enumerate(vectors(30)))
    again = whitening.whiten(table(spark, base + [(100, base[0][1])] * 10))
    assert again.where("vec_id = 100").count() == 80 and again.first().n == 40


def test_deviation_beyond_64_bits():
    model = whitening.Whitener(2**33, [0], np.array([[1.0]]))
    d = model.deviations(np.array([[2**52]], np.int64))
    assert d.dtype == object and int(d[0, 0]) == 2**85


@pytest.mark.parametrize("name", ["n", "deviation", "whitened", "explained", "identity_error"])
def test_columns(spark, name):
    assert name in whitening.whiten(table(spark, list(enumerate(vectors(10, 3))))).columns
