"""The audit against brute force on small tables with every defined case."""

import random
import re
from collections import Counter, defaultdict

from weftline.llm import divergence


def brute(rows, min_docs=3, top=200):
    docs = [(r[2] or "", r[3] or "", r[1] or "") for r in rows]
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    of = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(fold))
    in_docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        groups[lang].add(source)
        counts[lang, source].update(of(text))
        in_docs[lang].update(set(of(text)))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in in_docs[lang].items() if n >= min_docs)
        total = Counter()
        for s in sources:
            total.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(total)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = sorted(((o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s), key=lambda x: (-x[1], x[0].encode()))
            terms = sorted(((t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]), key=lambda x: (-x[1], x[0].encode()))[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_same_as_brute_force(spark, docs):
    from .conftest import corpus

    assert rows_of(divergence.audit(docs)) == brute(corpus())


def test_terms_of_odd_texts_and_a_low_limit(spark):
    from .conftest import make

    rng = random.Random(5)
    words = ["Ärger", "ärger", "don't", "a1b", "É", "x\x85y", "１２", "日本", "ZZ", "zz", "İ", "\U0001f642", "K"]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 9))), rng.choice(["en", None, ""]), rng.choice(["b", "a", "é", None, "￿", "\U00010000"])) for k in range(60)]
    rows += [(1, None, "xx", "only"), (2, "", "xx", "other"), (3, "alone alone alone", "yy", "s"), (3, "alone alone alone", "yy", "s"), (3, "alone", "yy", "s")]
    got = divergence.audit(make(spark, rows), top=3)
    assert rows_of(got) == brute(rows, top=3)
    assert ("xx", "only", "pair", "other", 0, 1) in rows_of(got)


def test_full_tables_of_a_task_are_handed_on(spark, docs, monkeypatch):
    whole = sorted(map(tuple, divergence.term_counts(docs).collect()))
    monkeypatch.setattr(divergence, "ENTRIES", 50)
    assert sorted(map(tuple, divergence.term_counts(docs).collect())) == whole


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    n = 10**13 + 7
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(3 * 10**13), F.lit(11)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 1) // (3 * 10**13 + 11)


def test_vectors_are_fewer_than_terms_and_counted(spark, docs):
    groups = divergence.groups_of(docs)
    kept = divergence.kept_terms(divergence.term_counts(docs), groups)
    vectors = divergence.distinct_vectors(kept)
    assert vectors.agg({"terms": "sum"}).first()[0] == kept.count() > vectors.count()


def test_empty(spark, empty):
    got = divergence.audit(empty)
    assert got.count() == 0 and got.columns == ["lang", "source", "part", "item", "value", "rank"]
