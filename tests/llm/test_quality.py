import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.llm import quality

from .conftest import corpus, make

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {p for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_measures_against_brute_force(docs):
    rows = quality.ledger(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, rows), key=key) == sorted([(i, *brute(t)) for i, t, *_ in corpus()], key=key)


def test_windows_that_overlap_and_touch(spark):
    eight = "a b c d e f g h"
    cases = [eight + " " + eight, eight + " x " + eight, "z " * 9, "z " * 8, "z " * 30, eight + " y " + eight[2:] + " a b", " ".join(f"w{k}" for k in range(50))]
    got = {r.doc_id: r.n_repeat_words for r in quality.ledger(make(spark, [(k, t, None, None) for k, t in enumerate(cases)])).collect()}
    assert got == {k: brute(t)[4] for k, t in enumerate(cases)}


def test_policies_and_ablations(spark, docs):
    book = quality.ledger(docs)
    kept = {r.doc_id for r in quality.apply_policy(book, quality.BASE).where("kept").collect()}
    assert 69 not in kept and 70 in kept and 62 not in kept
    rows = book.select("failed").collect()
    for r in quality.ablations(book, quality.STANDARD).collect():
        bit = quality.BIT[r.rule]
        assert r.n_failed == sum(bool(x.failed & bit) for x in rows) and r.n_only == sum(x.failed == bit for x in rows) and r.n_kept_without == sum(x.failed & ~bit == 0 for x in rows)


def test_filter_keeps_columns_and_rows(docs, empty):
    out = quality.filter_docs(docs)
    assert out.schema == docs.schema
    want = quality.apply_policy(quality.ledger(docs), quality.STANDARD).where("kept").count()
    assert out.count() == want > 0
    assert quality.filter_docs(empty).count() == 0 and quality.ledger(empty).count() == 0 and quality.ablations(quality.ledger(empty), quality.BASE).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = spark._jvm.PythonSQLUtils.explainString(quality.ledger(docs)._jdf.queryExecution(), "formatted")
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan and "struct<doc_id:bigint,text:string>" in plan


def test_stored_ledger_serves_other_policies_and_refuses_other_books(spark, docs):
    book = quality.store(docs)
    assert sorted(map(str, book.collect())) == sorted(map(str, quality.ledger(docs).collect()))
    for policy in (quality.BASE, quality.STANDARD, quality.STRICT):
        kept = quality.apply_policy(book, policy).where("kept").count()
        assert kept == sum(not r.failed & policy.mask for r in book.select("failed").collect())
        rows = {r.rule: r for r in quality.ablations(book, policy).collect()}
        assert set(rows) == set(policy.rules) and all(r.n_kept_without == kept + r.n_only for r in rows.values())
    old = book.withColumn("rule_book", F.lit("rules-1"))
    with pytest.raises(Exception, match="not for a ledger of rules-1"):
        quality.apply_policy(old, quality.STANDARD).select("kept").collect()


def test_lists_ellipses_and_letters(spark):
    cases = ["- a b\n  * c\n\u2022 d\nplain", "it goes on...\nand on\u2026 \nends. ..x", "12 34 5a -- \u00e9 \u4f60", "", None]
    got = {r.doc_id: (r.n_lines, r.n_bullets, r.n_ellipses, r.n_lettered) for r in quality.ledger(make(spark, [(k, t, None, None) for k, t in enumerate(cases)])).collect()}
    assert got == {0: (4, 3, 0, 5), 1: (3, 0, 2, 7), 2: (1, 0, 0, 3), 3: (0, 0, 0, 0), 4: (0, 0, 0, 0)}
