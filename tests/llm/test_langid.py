import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from weftline.llm import langid, queries
from weftline.llm.common import table

from .conftest import corpus, make

SF = "/root/testdata/sf0.01"


def slow_length(counts, text):
    """Code length by recursion over contexts, counts: context -> Counter."""
    known = {}

    def p(context, b):
        if (context, b) not in known:
            known[context, b] = q(context, b)
        return known[context, b]

    def q(context, b):
        if context is None:
            return 1 / 256
        seen, shorter = counts.get(context), context[1:] if context else None
        if not seen:
            return p(shorter, b)
        total, kinds = sum(seen.values()), len(seen)
        if b in seen:
            return seen[b] / (total + kinds)
        left = sum(p(shorter, x) for x in range(256) if x not in seen)
        return kinds / (total + kinds) * p(shorter, b) / left

    data = b"\n" * langid.ORDER + text
    return -sum(math.log2(p(data[k - langid.ORDER : k], data[k])) for k in range(langid.ORDER, len(data)))


def test_tables_against_recursion():
    train = {"en": b"the cat sat on the mat", "de": b"die katze sa\xc3\x9f auf der matte"}
    rows, trees = [], {}
    for lang, data in train.items():
        data = b"\n" * langid.ORDER + data
        grams = Counter(data[k : k + langid.ORDER + 1] for k in range(len(data) - langid.ORDER))
        rows += [(lang, g, n) for g, n in grams.items()]
        trees[lang] = defaultdict(Counter)
        for g, n in grams.items():
            for k in range(langid.ORDER + 1):
                trees[lang][g[langid.ORDER - k : langid.ORDER]][g[langid.ORDER]] += n
    model = langid.Model(rows)
    for text in (b"the mat", b"auf der", b"zebra \xff!", b""):
        got = model.lengths([text])[0]
        for lang, value in zip(model.langs, got):
            assert abs(value - slow_length(trees[lang], text)) < 1e-3


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents").select("doc_id", "lang")
    got = queries.op10_language_id(spark, SF).join(docs, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.98


def test_cases(spark, docs, empty):
    counts = langid.fit(docs.where(~langid.held_out(F.col("doc_id"), 3, 1)))
    got = {r.doc_id: r for r in langid.predict(docs, counts).collect()}
    assert got[62].lang_pred == "und" and got[63].lang_pred == "und" and got[64].lang_pred == "und" and got[70].lang_pred in ("en", "de", "fr")
    assert all(0 <= r.score <= 1 for r in got.values()) and langid.predict(docs, counts).count() == len(corpus())
    assert langid.predict(empty, counts).count() == 0
    nothing = langid.fit(empty)
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_no_language_is_lost_to_the_sample(spark):
    rows = [(k, f"{k} " + "the cat sat on the mat " * 10, "en", None) for k in range(300)]
    rows += [(1000 + k, "die katze sa\u00df auf der matte " * 2500, "de", None) for k in range(3)]
    rows += [(2000 + k, "le chat dort sur la table " * 2300, "fr", None) for k in range(40)] + [(3000, "", "xx", None), (3001, None, "yy", None)]
    df = make(spark, rows)
    got = {r.lang: (r.n, r.size, r.most) for r in langid.sample(df, sample_bytes=20_000).groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"), F.max(F.octet_length("text")).alias("most")).collect()}
    assert got.keys() == {"en", "de", "fr"} and got["fr"][0] == 1
    assert all(most <= langid.ROW_BYTES and 10_000 < size < 20_000 + most for _, size, most in got.values())
    found = {r.doc_id: r.lang_pred for r in langid.predict(df, langid.fit(df)).collect()}
    assert found[1000] == "de" and found[2000] == "fr" and found[0] == "en"


def test_copies_of_a_text_are_sampled_once(spark):
    """A text that most rows repeat, first in the order of hashes or not, is one row of the sample, and ids don't matter."""
    rows = [(k, f"text number {k % 7} of the corpus, with some words", "en", None) for k in range(400)] + [(900 + k, "ein text der sich oft wiederholt", "de", None) for k in range(400)]
    for size in (10, 100, 10_000):
        got = langid.sample(make(spark, rows), sample_bytes=size).collect()
        assert len(got) == len({(r.lang, r.text) for r in got}) and {r.lang for r in got} == {"en", "de"}
    again = langid.sample(make(spark, [(10_000 - i, *r) for i, *r in rows]).repartition(3), sample_bytes=100).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, langid.sample(make(spark, rows), sample_bytes=100).collect()))


def test_folds(spark):
    df = make(spark, [(k, "x", None, None) for k in range(50)])
    got = {r[0]: r[1] for r in df.select("doc_id", langid.held_out(F.col("doc_id"), 3, 1)).collect()}
    assert got == {k: zlib.crc32(str(k).encode()) % 3 == 1 for k in range(50)}


def test_long_text_is_scored_whole(monkeypatch):
    rows = [("a", b"\n\n\nx", 5), ("a", b"\n\nxx", 5), ("a", b"\nxxx", 5), ("a", b"xxxx", 50), ("b", b"\n\n\ny", 5), ("b", b"yyyy", 50)]
    text = b"xxyyx" * 500
    whole = langid.Model(rows).lengths([text, b"x", text])
    monkeypatch.setattr(langid, "GROUP_BYTES", 64)
    assert abs(langid.Model(rows).lengths([text, b"x", text]) - whole).max() < 1e-3
