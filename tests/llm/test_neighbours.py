"""Nearest neighbours against brute force: recall, scores, ties, and every defined case."""

import numpy as np
from pyspark.sql import functions as F

from weftline.llm import neighbours


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, leaf int, v string").repartition(5)


def brute(rows, every, k=20):
    good = sorted({(i, tuple(np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and v})
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % every:
            continue
        score = neighbours.dots(np.repeat(np.array([v]), len(x), axis=0), x)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def clustered(n, dims=24, groups=30, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    return [(k, (centres[k % groups] + 0.4 * rng.normal(size=dims)).astype(np.float32).tolist()) for k in range(n)]


def test_recall_over_parts(spark):
    rows = clustered(3000)
    got = found(neighbours.search(table(spark, rows), F.col("vec_id") % 20 == 0, leaf=300, sample=1500))
    want = brute(rows, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    exact = {q: dict(v) for q, v in brute(rows, 20, len(rows)).items()}
    assert all(abs(exact[q][i] - s) < 1e-12 for q, v in got.items() for i, s in v)


def test_two_levels_of_models(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "FAN", 4)
    rows = clustered(2000)
    df, dims = neighbours.usable(table(spark, rows))
    models, mass = neighbours.fit(df, dims, leaf=100, sample=1000)
    assert models.levels == 2 and len(models.weights) > 1
    leaves = models.leaves(np.array([v for _, v in rows]))
    assert len(set(leaves.tolist())) > 4
    some, p = models.probable(np.array([v for _, v in rows[:50]]))
    assert np.allclose(p.sum(axis=1), 1) and set(leaves[:50]) <= set(some.ravel().tolist())


def test_clusters_need_few_parts(spark):
    rows = clustered(3000)
    df, dims = neighbours.usable(table(spark, rows))
    models, mass = neighbours.fit(df, dims, leaf=300, sample=2000)
    routed = neighbours.route(df.where("vec_id % 20 = 0"), dims, models, mass)
    parts = next(iter(models.weights.values())).shape[1]
    assert routed.count() < 0.6 * parts * 150


def test_small_tables_are_searched_whole(spark):
    rows = clustered(200)
    got = found(neighbours.search(table(spark, rows), F.col("vec_id") % 20 == 0))
    want = brute(rows, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert got == want


def test_ties_copies_and_few_rows(spark):
    v, w = [0.1, 0.7, 0.3], [0.5, -0.2, 0.1]
    rows = [(k, v) for k in range(100, 0, -1)] + [(200, w), (200, w), (203, [9.0, 9.0, 9.0])]
    got = found(neighbours.search(table(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == brute(rows, 20)
    assert [i for i, _ in got[20]] == [203] + [k for k in range(1, 21) if k != 20]
    few = found(neighbours.search(table(spark, [(0, v), (1, w)]), F.col("vec_id") % 20 == 0))
    assert [i for i, _ in few[0]] == [1]
    assert found(neighbours.search(table(spark, [(0, v)]), F.col("vec_id") % 20 == 0)) == {}


def test_unusable_rows_take_no_part(spark):
    good = [(k, [1.0 * k, 2.0, -1.0]) for k in range(1, 50)]
    bad = [(0, None), (60, []), (80, [0.0, 0.0, 0.0]), (61, [None, 1.0, 1.0]), (62, [float("nan"), 1.0, 1.0]), (63, [float("inf"), 1.0, 1.0]), (64, [9.0, 9.0]), (None, [9.0, 9.0, 9.0])]
    got = found(neighbours.search(table(spark, good + bad), F.col("vec_id") % 20 == 0))
    assert got == brute(good, 20)


def test_an_id_with_two_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0])] + [(k, [float(k), 1.0]) for k in range(1, 6)]
    got = neighbours.search(table(spark, rows), F.col("vec_id") % 20 == 0)
    assert got.count() == 10 and got.where("vec_id = 0").count() == 0


def test_blocks_of_a_hot_part(spark):
    rows = clustered(400, groups=1)
    df, dims = neighbours.usable(table(spark, rows))
    placed = neighbours.place(df, dims, neighbours.Models({}, 0))
    asked = placed.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    whole, parted = (neighbours.rerank(placed, asked, dims, k=5, block=b) for b in (10_000, 30))
    best = lambda df: {(r.query_id, r.vec_id): r.score for r in df.collect()}
    one, many = best(whole), best(parted)
    assert len(one) == 20 * 5 and one.items() <= many.items() and len(many) > len(one)


def test_balance(spark):
    x = np.random.default_rng(0).normal(size=(1000, 8)).astype(np.float32)
    x[:400] = x[0]
    label = neighbours.balanced_parts(x, neighbours.neighbour_graph(x), 8)
    size = np.bincount(label, minlength=8)
    assert size.max() <= 1000 / 8 * neighbours.SLACK + 1 and size.min() >= 1000 / 8 / neighbours.SLACK - 2


def test_empty(spark):
    got = neighbours.search(table(spark, []).limit(0), F.col("vec_id") % 20 == 0)
    assert got.count() == 0 and got.columns == ["query_id", "rank", "vec_id", "score"]
