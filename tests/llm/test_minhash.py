import hashlib
from itertools import combinations

import numpy as np

from weftline.llm import minhash

from .conftest import corpus, make


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, percent=80):
    """component of each id; rows of one id are one document."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in sets}


def test_against_brute_force(docs):
    rows = [(i, t) for i, t, *_ in corpus()]
    for n in (4, 5):
        want = brute(rows, n)
        got = minhash.near_duplicates(docs, n).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.component_id == want.get(r.doc_id)
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles) for r in got) == sorted((-1 if i is None else i, len(shingles(t, n))) for i, t in rows)


def test_big_buckets_lose_no_pair(docs, monkeypatch):
    """With every bucket taken for a big one, prefixes of sets find what the buckets' pairs do."""
    monkeypatch.setattr(minhash, "BIG", 1)
    want = brute([(i, t) for i, t, *_ in corpus()], 5)
    assert all(r.component_id == want.get(r.doc_id) for r in minhash.near_duplicates(docs, 5).collect())


def boilerplate(n, rng):
    """Documents that share two thirds of their words and are no near copies, and a few that are."""
    shared = " ".join(f"b{k}" for k in range(60))
    texts = [shared + " " + " ".join(f"u{rng.integers(10**9)}" for _ in range(25)) for _ in range(n)]
    near = [t + " end" for t in texts[:5]]
    return [(k, t) for k, t in enumerate(texts + near)]


def test_a_bucket_of_unlike_documents_stays_linear(spark, monkeypatch):
    """One passage in 3000 documents: few pairs meet, and the links are those of brute force."""
    rows = boilerplate(3000, np.random.default_rng(5))
    met = []
    whole = minhash.prefix_pairs

    def counted(*args):
        out = whole(*args)
        met.append((args[0].count(), out.count()))
        return out

    monkeypatch.setattr(minhash, "prefix_pairs", counted)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(make(spark, [(i, t, None, None) for i, t in rows])).collect()}
    assert got == {i: i if i < 3000 else i - 3000 for i, _ in rows}
    assert met[0][0] > 2000 and met[0][1] < met[0][0]


def test_sketches_rule_out_unlike_candidates(spark):
    """How many of the first round's candidates on sf0.01 the sketch rules out, at this margin and at a wider one; every link stays."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sketches = minhash.sketch(docs, 4).where("n_shingles > 0").collect()
    sets = {r.doc_id: shingles(t, 4) for r, t in zip(docs.collect(), [x.text for x in docs.collect()])}
    by_band, odd, pairs = {}, {r.doc_id: r.odd for r in sketches}, set()
    for r in sorted(sketches, key=lambda r: r.doc_id):
        for band in r.bands:
            first = by_band.setdefault(band, r.doc_id)
            if first != r.doc_id and sets[first] != sets[r.doc_id]:
                pairs.add((first, r.doc_id))
    estimate = lambda a, b: 1 + np.log(1 - min(0.999, sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(odd[a], odd[b])) * 2 / minhash.ODD_BITS)) * (minhash.ODD_BITS / 2) / (2 * minhash.SAMPLES)
    out = lambda margin: {p for p in pairs if estimate(*p) < 0.8 - margin}
    links = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert links and not out(minhash.MARGIN) & links
    assert len(out(minhash.MARGIN)) > len(out(0.30)), (len(pairs), len(out(0.30)), len(out(minhash.MARGIN)))


def test_chain_of_small_edits(spark):
    """Neighbours in a chain are linked while its ends are not alike."""
    words = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(30):
        texts.append(" ".join(words))
        words[4 * k % 120] = f"x{k}"
    rows = [(500 - k, t) for k, t in enumerate(texts)]
    want = brute(rows, 5)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(make(spark, [(i, t, None, None) for i, t in rows])).collect()}
    assert got == want and len(set(want.values())) < 30


def test_keep_one(docs, empty):
    out = minhash.keep_one(docs)
    assert out.schema == docs.schema
    vertices = sorted({(i, hashlib.sha256(t.encode()).hexdigest() if t is not None else "", t) for i, t, *_ in corpus() if i is not None}, key=lambda v: v[:2])
    want = brute([(k, v[2]) for k, v in enumerate(vertices)], 5)
    rows = out.collect()
    stay = [(vertices[k][0], vertices[k][2]) for k, c in want.items() if k == c]
    assert sorted(((r.doc_id, r.text) for r in rows if r.doc_id is not None), key=str) == sorted(stay, key=str)
    assert [r.doc_id for r in rows].count(None) == 2
    assert minhash.keep_one(empty).count() == 0 and minhash.near_duplicates(empty).count() == 0


def test_keep_one_of_repeated_ids(spark):
    """A text that copies another document goes; an unlike text under the same id stays."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a, "s", None), (2, a, "s", None), (2, b, "s", None), (2, b, "s", None), (3, c, "s", None)]
    for n_rows in (rows, rows[:2] + rows[4:]):
        got = sorted((r.doc_id, r.text) for r in minhash.keep_one(make(spark, n_rows)).collect())
        assert got == sorted({(i, t) for i, t, *_ in n_rows} - {(2, a)})


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 90), (90, 80), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in minhash.components(edges).collect()}
    assert got == {k: 1 for k in range(2, 61)} | {100: 80, 90: 80}


def test_odd_sketch_estimates_high_similarity(spark):
    rng = np.random.default_rng(1)
    sk = minhash.sketcher(5)
    for share in (0.7, 0.8, 0.9, 1.0):
        found = []
        for _ in range(20):
            both = rng.integers(0, 2**63, 600).astype(np.uint64)
            extra = int(round(600 * (1 - share) / share / 2))
            a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, extra).astype(np.uint64)])) for _ in range(2))
            apart = sum(bin(int(x) & (2**64 - 1)).count("1") for x in sk.odd(sk.samples(a)) ^ sk.odd(sk.samples(b)))
            found.append(1 + np.log(1 - 2 * apart / minhash.ODD_BITS) * (minhash.ODD_BITS / 2) / (2 * minhash.SAMPLES))
        assert abs(np.mean(found) - share) < 0.03
