"""Approximate nearest neighbours by learned partitions, by largest inner product.

The space is parted by what a bounded sample's neighbour graph looks like: the
graph is cut into balanced parts that keep neighbours together, and a small
classifier (softmax regression) learns, for a vector, the shares of its
neighbours in each part. The classifier alone then places every row, and for a
query it says how probable each part is; the query goes to the most probable
parts and all rows there are reranked. How much probability the parts that are
visited must hold is measured beforehand on queries of the sample that the
classifier wasn't fitted on, so that REACH of their true neighbours lie there;
on data without structure that takes most parts, on clustered data few.

The number of parts follows from the number of rows (LEAF rows in a part), FAN
parts in a model at most; beyond FAN * LEAF rows each part is parted again by
a model of its own, LEVELS deep at most. Larger tables have larger parts,
never fewer candidates: a part is worked on in blocks of its rows against blocks
of its queries, both of bounded size, so a part of any size is many tasks.

Of vectors that are equal entry by entry only the K + 1 with the smallest ids
are candidates: by the rule for ties no other can be among a query's K nearest.
So copies, however many, cost one shuffle and no task holds them. Within a block
a matrix product finds what may be among the K best; those pairs are scored
again with compensated sums, which don't depend on place or order.

Bounds: a model is fitted on SAMPLE rows in expectation, in one task; the models
come to the driver and are broadcast, at most (FAN + 1) of FAN * (dims + 1)
numbers of 4 bytes each. Every row is indexed and every query asked.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
entries take no part, nor do those of another length than most, nor rows with a
null id; an id is a query with each of its different vectors; rows that repeat
id and vector are one; rows of a query's own id are none of its candidates; ties
go to the smaller id; a table with too few rows to part is searched whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.vectors import matrix, usable
from weftline.scratch import materialize

K = 20
#: Rows of a part, about; models' parts at most; depth of models at most.
LEAF, FAN, LEVELS = 4096, 128, 2
#: Rows on which a model is fitted, in expectation; of these, a share is kept back to measure.
SAMPLE, HELD = 8192, 0.05
#: Share of true neighbours that the visited parts must hold, on queries kept back.
REACH = 0.97
#: Neighbours of a row in the graph, and rounds of moving rows between parts and of fitting.
DEGREE, ROUNDS, STEPS = 10, 12, 150
#: How much larger than the mean a part of the sample may be.
SLACK = 1.05
#: Rows and queries that one task compares, in expectation.
BLOCK = 4096


def _order(x, y, k: int):
    """Positions of the k rows of y with the largest inner product with each row of x, unsorted, a slice of x at a time."""
    import numpy as np

    out = [np.argpartition(-(x[at : at + 1024] @ y.T), min(k, len(y)) - 1, axis=1)[:, :k] for at in range(0, len(x), 1024)]
    return np.concatenate(out) if out else np.zeros((0, k), np.int64)


def neighbour_graph(x, degree: int = DEGREE):
    """Positions of the nearest rows of each row, itself left out."""
    import numpy as np

    degree = min(degree, len(x) - 1)
    out = np.empty((len(x), degree), np.int64)
    for at in range(0, len(x), 1024):
        score = x[at : at + 1024] @ x.T
        score[np.arange(len(score)), np.arange(at, at + len(score))] = -np.inf
        out[at : at + 1024] = np.argpartition(-score, degree - 1, axis=1)[:, :degree] if degree else 0
    return out


def balanced_parts(x, graph, parts: int, rounds: int = ROUNDS):
    """The part of each row: halves along principal directions to begin with, then rows move to where more of their neighbours are, parts staying balanced."""
    import numpy as np

    label = np.zeros(len(x), np.int64)
    at = 1
    while at < parts:
        for part in range(at):
            own = np.flatnonzero(label == part)
            c = x[own] - x[own].mean(axis=0)
            along = c @ np.linalg.svd(c[:512], full_matrices=False)[2][0] if len(own) > 1 else np.zeros(len(own))
            label[own[np.argsort(along, kind="stable")[len(own) // 2 :]]] += at
        at *= 2
    most, least = int(np.ceil(len(x) / parts * SLACK)), int(len(x) / parts / SLACK)
    size = np.bincount(label, minlength=parts)
    for _ in range(rounds):
        # neighbours of a row in each part, edges taken both ways
        near = np.zeros((len(x), parts), np.int32)
        np.add.at(near, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph.ravel()]), 1)
        np.add.at(near, (graph.ravel(), np.repeat(label, graph.shape[1])), 1)
        best = near.argmax(axis=1)
        gain = near[np.arange(len(x)), best] - near[np.arange(len(x)), label]
        movers = np.argsort(-gain, kind="stable")
        moved = 0
        waiting: dict[tuple[int, int], list[int]] = {}
        for row in movers[: np.count_nonzero(gain > 0)]:
            a, b = int(label[row]), int(best[row])
            if size[b] < most and size[a] > least:
                size[a], size[b] = size[a] - 1, size[b] + 1
                label[row], moved = b, moved + 1
            elif waiting.get((b, a)):  # two rows that want each other's part change places
                other = waiting[b, a].pop()
                label[row], label[other], moved = b, a, moved + 2
            else:
                waiting.setdefault((a, b), []).append(int(row))
        if moved < len(x) // 200:
            break
    return label


def _softmax(z):
    import numpy as np

    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def with_one(x):
    import numpy as np

    return np.hstack([x, np.ones((len(x), 1), x.dtype)])


def classifier(x, target, steps: int = STEPS):
    """Weights (dims + 1, parts) of a softmax regression on shares, by Adam on all rows."""
    import numpy as np

    a = with_one(x).astype(np.float32)
    a[:, :-1] /= max(1e-30, float(np.sqrt((x * x).sum(axis=1).mean())))
    w = np.zeros((a.shape[1], target.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        slope = a.T @ (_softmax(a @ w) - target) / len(a) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
        w -= 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w[:-1] /= max(1e-30, float(np.sqrt((x * x).sum(axis=1).mean())))
    return w


def fit_model(x, parts: int):
    """Weights of a classifier into balanced parts of x's neighbour graph."""
    import numpy as np

    x = x.astype(np.float32)
    graph = neighbour_graph(x)
    label = balanced_parts(x, graph, parts)
    near = np.hstack([graph, np.arange(len(x))[:, None]])
    target = np.zeros((len(x), parts), np.float32)
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), label[near.ravel()]), 1.0 / near.shape[1])
    return classifier(x, target)


class Models:
    """The classifiers of all nodes; a node's children are numbered from node * FAN + 1."""

    def __init__(self, weights: dict[int, tuple], levels: int) -> None:
        self.weights, self.levels = weights, levels

    def leaves(self, x):
        """The leaf in which each row is placed."""
        import numpy as np

        at = np.zeros(len(x), np.int64)
        a = with_one(np.asarray(x, np.float32))
        for _ in range(self.levels):
            for node in np.unique(at):
                if (w := self.weights.get(int(node))) is not None:
                    own = np.flatnonzero(at == node)
                    at[own] = node * FAN + 1 + (a[own] @ w).argmax(axis=1)
        return at

    def probable(self, x):
        """Leaves of each row and their probabilities, most probable first: two matrices."""
        import numpy as np

        a = with_one(np.asarray(x, np.float32))
        leaves, p = np.zeros(1, np.int64), np.ones((len(x), 1), np.float64)
        for _ in range(self.levels):
            below, shares = [], []
            for k, node in enumerate(leaves):
                w = self.weights.get(int(node))
                below.append(np.array([node]) if w is None else node * FAN + 1 + np.arange(w.shape[1]))
                shares.append(p[:, k : k + 1] if w is None else p[:, k : k + 1] * _softmax((a @ w).astype(np.float64)))
            leaves, p = np.concatenate(below), np.hstack(shares)
        order = np.argsort(-p, axis=1, kind="stable")
        return leaves[order], np.take_along_axis(p, order, axis=1)


def reach_of(models: Models, base, asked, k: int = K, reach: float = REACH) -> float:
    """The probability that visited parts must hold, in order, so that a share ``reach`` of the true neighbours lies in them."""
    import numpy as np

    if not len(base) or not len(asked):
        return 1.0
    found = _order(np.asarray(asked, np.float32), np.asarray(base, np.float32), min(k, len(base)))
    leaf = models.leaves(base)
    needs = []
    for at in range(0, len(asked), 64):
        leaves, p = models.probable(asked[at : at + 64])
        before = np.cumsum(p, axis=1) - p
        for row in range(len(leaves)):
            mass = dict(zip(leaves[row].tolist(), before[row].tolist()))
            needs += [mass[int(leaf[f])] for f in found[at + row]]
    return float(np.quantile(needs, reach, method="higher"))


def _sample(rows: DataFrame, size: int) -> DataFrame:
    """About ``size`` rows of each node, by a hash of the vector."""
    rates = materialize(rows.groupBy("node").agg(F.count("*").alias("n")), "ann-nodes")
    u = F.pmod(F.xxhash64("v"), F.lit(1 << 30))
    return rows.join(rates, "node").where(u * F.col("n") < F.lit(size << 30)).select("node", "n", "v", u.alias("u"))


def fit(rows: DataFrame, dims: int, leaf: int = LEAF, sample: int = SAMPLE) -> tuple[Models, float]:
    """Classifiers for rows (vec_id, v) and the probability to visit. Each level is fitted on a sample of each of its nodes, one task a node."""
    import numpy as np

    weights: dict[int, tuple] = {}
    n, levels = rows.count(), 0
    kept_back = lambda u: u % 1000 < HELD * 1000

    def train(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        group = group[~kept_back(group["u"])]
        x = np.stack(group.sort_values("u")["v"].to_numpy()) if len(group) else np.zeros((0, dims))
        parts = 1 << max(0, int(np.ceil(np.log2(max(1.0, float(group["n"].iloc[0]) / leaf)))) if len(group) else 0)
        parts = min(parts, FAN, 1 << int(np.log2(max(1, len(x) // 16))))
        if parts < 2:
            return pd.DataFrame({"node": [], "w": [], "parts": []})
        return pd.DataFrame({"node": [int(key[0])], "w": [fit_model(x, parts).tobytes()], "parts": [parts]})

    while levels < LEVELS and n > leaf * FAN**levels:
        placed = rows.withColumn("node", F.lit(0).cast("long")) if not levels else place(rows, dims, Models(weights, levels)).withColumnRenamed("leaf", "node")
        found = _sample(placed, sample).groupBy("node").applyInPandas(train, "node long, w binary, parts int").collect()
        if not found:
            break
        weights |= {r.node: np.frombuffer(r.w, np.float32).reshape(dims + 1, r.parts) for r in found}
        levels += 1
    models = Models(weights, levels)
    if not levels:
        return models, 1.0

    def measure(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        v, held = np.stack(group.sort_values("u")["v"].to_numpy()), kept_back(group.sort_values("u")["u"]).to_numpy()
        return pd.DataFrame({"mass": [reach_of(models, v[~held], v[held])]})

    whole = _sample(rows.withColumn("node", F.lit(0).cast("long")), sample)
    return models, whole.groupBy("node").applyInPandas(measure, "mass double").first().mass


_here: dict[str, Models] = {}


def _shared(df: DataFrame, models: Models):
    """A function that gives a task the models."""
    sent, name = df.sparkSession.sparkContext.broadcast((models.weights, models.levels)), uuid.uuid4().hex

    def get() -> Models:
        if name not in _here:
            _here.clear()
            _here[name] = Models(*sent.value)
        return _here[name]

    return get


def place(rows: DataFrame, dims: int, models: Models) -> DataFrame:
    """leaf, vec_id, v of each row."""
    get = _shared(rows, models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = get().leaves(matrix(batch.column("v"), dims))
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), batch.column("vec_id"), batch.column("v")], names=["leaf", "vec_id", "v"])

    return rows.select("vec_id", "v").mapInArrow(run, "leaf long, vec_id long, v array<double>")


def route(asked: DataFrame, dims: int, models: Models, mass: float) -> DataFrame:
    """leaf, query_id, v: each query with the most probable leaves, until those before hold more than ``mass``."""
    get = _shared(asked, models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                leaves, p = get().probable(matrix(some.column("v"), dims))
                row, place = np.nonzero(np.cumsum(p, axis=1) - p <= mass + 1e-12)
                yield pa.RecordBatch.from_arrays([pa.array(leaves[row, place], pa.int64()), some.column("vec_id").take(pa.array(row)), some.column("v").take(pa.array(row))], names=["leaf", "query_id", "v"])

    return asked.select("vec_id", "v").mapInArrow(run, "leaf long, query_id long, v array<double>")


def dots(a, b):
    """Inner products of the rows of a with those of b, in compensated sums that don't depend on where a row lies."""
    import numpy as np

    total, lost = np.zeros(len(a)), np.zeros(len(a))
    for k in range(a.shape[1]):
        x = a[:, k] * b[:, k]
        s = total + x
        back = s - total
        lost += (total - (s - back)) + (x - back)
        total = s
    return total + lost


def nearest_in(rows, row_ids, asked, asked_ids, k: int):
    """(position of the query, position of the row, score) of what may be among each query's k best of these rows."""
    import numpy as np

    at_q, at_r = [], []
    for at in range(0, len(asked), 256):
        score = asked[at : at + 256] @ rows.T
        score[asked_ids[at : at + 256, None] == row_ids[None, :]] = -np.inf
        edge = -np.partition(-score, min(k, len(rows)) - 1, axis=1)[:, min(k, len(rows)) - 1]
        # what rounding can't tell from the last one comes along
        near = 1e-13 * rows.shape[1] * np.abs(asked[at : at + 256]).max(axis=1) * np.abs(rows).max()
        q, r = np.nonzero((score >= (edge - near)[:, None]) & (score > -np.inf))
        at_q.append(q + at)
        at_r.append(r)
    q, r = np.concatenate(at_q), np.concatenate(at_r)
    score = np.concatenate([dots(asked[q[i : i + 50_000]], rows[r[i : i + 50_000]]) for i in range(0, len(q), 50_000)]) if len(q) else np.zeros(0)
    order = np.lexsort((row_ids[r], -score, asked_ids[q], q))
    q, r, score = q[order], r[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], r[place < k], score[place < k]


def rerank(members: DataFrame, asked: DataFrame, dims: int, k: int = K, block: int = BLOCK) -> DataFrame:
    """query_id, v (the query's), vec_id, score: the k best of each block of each leaf that a query visits.

    members has leaf, vec_id, v; asked leaf, query_id, v. Both are dealt to
    blocks by a hash; each block of rows meets each block of queries of its leaf.
    """
    blocks = lambda df, name: df.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias(name))
    grid = materialize(blocks(members, "m_blocks").join(blocks(asked, "q_blocks"), "leaf"), "ann-grid")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = members.join(grid, "leaf").withColumn("mb", F.pmod(F.xxhash64("vec_id", "v"), "m_blocks")).withColumn("qb", every("q_blocks")).select("leaf", "mb", "qb", "vec_id", "v")
    right = asked.join(grid, "leaf").withColumn("qb", F.pmod(F.xxhash64("query_id", "v"), "q_blocks")).withColumn("mb", every("m_blocks")).select(*[F.col(c).alias(f"q_{c}") for c in ("leaf", "mb", "qb")], F.col("query_id").alias("asked_id"), F.col("v").alias("asked_v"))

    def best(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        names = ["query_id", "v", "vec_id", "score"]
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.int64(), pa.float64()]
        if not mine.num_rows or not theirs.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        column = lambda t, c: pa.concat_arrays(t.column(c).chunks)
        row_ids, asked_ids = column(mine, "vec_id").to_numpy(), column(theirs, "asked_id").to_numpy()
        q, r, score = nearest_in(matrix(column(mine, "v"), dims), row_ids, matrix(column(theirs, "asked_v"), dims), asked_ids, k)
        return pa.table([pa.array(asked_ids[q]), column(theirs, "asked_v").take(pa.array(q)), pa.array(row_ids[r]), pa.array(score)], names=names)

    return left.groupBy("leaf", "mb", "qb").cogroup(right.groupBy("q_leaf", "q_mb", "q_qb")).applyInArrow(best, "query_id long, v array<double>, vec_id long, score double")


def candidates(rows: DataFrame, k: int = K) -> DataFrame:
    """rows once each, and of equal vectors those k + 1 with the smallest ids."""
    once = rows.select("vec_id", "v").distinct()
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return once.withColumn("place", place).where(F.col("place") <= k + 1).select("vec_id", "v")


def search(table: DataFrame, is_query: Column, k: int = K, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row of (vec_id, embedding) where ``is_query``, over vec_id, holds."""
    rows, dims = usable(table, also=F.col("vec_id").isNotNull() & F.exists("v", lambda x: x != 0))
    index = materialize(candidates(rows, k), "ann-rows")
    models, mass = fit(index, dims, leaf, sample)
    members = materialize(place(index, dims, models), "ann-members")
    asked = materialize(route(rows.where(is_query).select("vec_id", "v").distinct(), dims, models, mass), "ann-queries")
    found = rerank(members, asked, dims, k)
    order = Window.partitionBy("query_id", "v").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
