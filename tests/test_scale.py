"""What keeps work from growing with more than the rows: expressions worked out once, rows dealt before they are sorted, no pass that isn't needed."""

import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import firm
from weftline.functions.fuzzy import Compared, score
from weftline.operators import domains, gates, order, people, resolve
from weftline.operators.keyed_store import KeyedStore
from weftline.plans import catalogue
from weftline.scratch import settled
from weftline.sources.adapters import logical

SF = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_settled_columns_are_worked_out_once(spark):
    long = spark.createDataFrame([("a-b",), (None,)], "t string").select(F.regexp_replace("t", "[^a-z]", "+").alias("x"))
    read = lambda df: df.where("x IS NOT NULL AND x <> ''").select(F.concat("x", "x").alias("y"))
    assert optimized(read(long)).count("[^a-z]") > 1
    assert optimized(read(settled(long))).count("[^a-z]") == 1
    assert [r.y for r in read(settled(long)).collect()] == ["a+ba+b"]


def test_a_listing_gets_its_domain_once(spark):
    assert optimized(resolve.parts(resolve.with_keys(logical(spark, SF, "listings"), 2026))).count(domains.LABEL) == 1


def test_counters_do_not_work_out_domains_again(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "_keyed", lambda *_: 1 / 0)
    monkeypatch.setattr(catalogue, "_gated", lambda *_: spark.createDataFrame([("a.in", True, 3), ("b.in", False, 4)], "domain string, gate_pass boolean, n_listings long"))
    n = logical(spark, SF, "listings").count()
    assert [tuple(r) for r in catalogue.QUERIES["build_counters"](spark, SF).collect()] == [(n, 2, 1, 0, n - 7)]


def test_people_are_dealt_before_they_are_sorted(spark):
    rows = spark.createDataFrame([("a", 2, 7), ("a", 1, 8), ("b", 3, 9)], "domain string, ordinal long, n long").groupBy("domain", "ordinal").agg(F.max("n").alias("n"))
    top = people.top(rows, 1)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Sort [domain") < plan.index("Exchange hashpartitioning(domain")
    assert sorted((r.domain, r.n) for r in top.collect()) == [("a", 8), ("b", 9)]


def test_first_change_of_a_store_is_gone_through_once(spark, tmp_path, monkeypatch):
    new = lambda: KeyedStore(spark, f"file://{tmp_path}/s", "k int, v string, created_at long", ["k"], 4)
    rows = spark.createDataFrame([(1, "a", 1, 1), (1, "b", 2, 2), (2, "c", 3, 3)], "k int, v string, created_at long, ordinal long")
    touched = KeyedStore._touched
    monkeypatch.setattr(KeyedStore, "_touched", lambda *_: 1 / 0)
    new().put(rows, "ordinal")
    monkeypatch.setattr(KeyedStore, "_touched", touched)
    new().put(rows.where("k = 2").withColumn("v", F.lit("d")), "ordinal")
    new().put(rows.limit(0), "ordinal")
    assert sorted(map(tuple, new().rows().collect())) == [(1, "b", 1), (2, "d", 3)]


def test_texts_are_split_without_a_pattern_for_each_row(spark):
    rows = domains.registered(spark.createDataFrame([(" b\u2003 a  b\x1c", "x。firm-1．co.in")], "t string, w string"), F.col("w"))
    cut = rows.select(gates._tokens("t").alias("ts"), gates._core("t").alias("core"), "domain")
    signs = re.findall(r"split\(.*?, ([^,]*), -1\)", cut._jdf.queryExecution().executedPlan().toString())
    assert len(signs) >= 2 and "+" not in "".join(signs) and "[" not in "".join(signs)
    assert [tuple(r) for r in cut.collect()] == [(["a", "b"], "a b", "firm-1.co.in")]


def test_pairs_read_no_table_for_their_tokens(spark):
    pairs = spark.createDataFrame([("", "b a", "a  c")], "block string, x string, y string")
    found = gates._with_tokens(pairs)
    assert "Join" not in optimized(found)
    assert [tuple(r) for r in found.collect()] == [("", "b a", "a  c", ["a", "b"], 3, ["a", "c"], 3)]


def test_only_pairs_that_edits_leave_open_are_counted_in_python(spark, monkeypatch):
    rows = lambda c, texts: spark.createDataFrame([("k", t) for t in texts], f"k string, {c} string")
    a, b = ["abcdefghij", "abcdefghijk", "abcdefgijh z", "p q"], ["abcdefghij", "abcdefghi", "abcdefghji z", "q p r"]
    counted = spark.sparkContext.accumulator(0)

    @F.pandas_udf(T.IntegerType())
    def common(x: pd.Series, y: pd.Series) -> pd.Series:
        from weftline.functions.fuzzy import common_lengths

        counted.add(len(x))
        return pd.Series(common_lengths(x, y), dtype="int32")

    monkeypatch.setattr(gates, "common_length", common)
    met = {(r.x, r.y): r.score for r in gates.fuzzy_matches(rows("x", a), rows("y", b), 80.0, "k").collect()}
    assert met == {(x, y): score(x, y) for x in a for y in b if score(x, y) >= 80}
    assert 0 < counted.value < len(met)


def test_listings_are_not_aggregated_by_what_few_share(spark):
    parts = resolve.parts(resolve.with_keys(logical(spark, SF, "listings"), 2026))
    assert "Aggregate" not in optimized(parts)


def test_people_are_made_in_as_many_tasks_as_shuffles_have(spark):
    plan = optimized(logical(spark, SF, "people"))
    assert re.search(r"RepartitionByExpression \[l_orderkey#\d+L\], 8\n", plan) and re.search(r"RepartitionByExpression \[o_orderkey#\d+L\], 8\n", plan)
    assert logical(spark, SF, "people").count() == logical(spark, SF, "orders").join(logical(spark, SF, "lineitem"), F.expr("o_orderkey = l_orderkey")).select("o_custkey", "l_suppkey").distinct().count()


def test_names_are_matched_only_where_they_decide(spark, monkeypatch):
    firms = spark.createDataFrame(
        [("a.in", "Alpha Works", 2010, "50-249", "60"), ("b.in", "Beta Works", 2024, "50-249", "60"), ("c.in", "Gamma Works", 2010, "<10", "5"), ("d.in", "Delta Works", 2010, "50-249", "60"), ("e.in", "Delta Works", 2010, "50-249", "60"),
         ("f.in", None, 2010, "50-249", "60"), ("g.in", "Blocked Epsilon", 2010, "50-249", "60"), ("h.in", "Blocked Beta Works", None, None, None), ("i.in", "Alpha Works", 2010, "50-249", "60")],
        "domain string, company_name string, founded_year int, size_band string, size_source string",
    ).withColumns({"founded_note": F.when(F.col("domain") == "d.in", "a note"), "hq_country": F.lit(None).cast("string")})
    known = spark.createDataFrame([(1, "Alpha"), (2, "Alpha Works")], "ordinal long, name string")
    rest = spark.createDataFrame([("e.in",)], "domain string"), known, spark.createDataFrame([(1, "Blocked"), (2, "alpha works")], "ordinal long, term string")
    asked, whole = {}, {r.domain: r for r in gates.apply_gates(firms, *rest).collect()}
    for f in (gates.match_known, gates.match_blocklist):
        monkeypatch.setattr(gates, f.__name__, lambda names, found, f=f: [asked.update({f.__name__: sorted(r.name for r in names.collect())}), f(names, found)][1])
    verdicts = {r.domain: r for r in gates.apply_gates(firms, *rest, reasons=False).collect()}
    assert asked == {"match_known": ["Alpha Works", "Blocked Epsilon", "Delta Works"], "match_blocklist": ["Blocked Epsilon", "Delta Works"]}
    assert {d for d, r in whole.items() if r.gate_pass} == {"d.in", "f.in"} and whole["h.in"].gate_reason.startswith("blocklisted outsourcer (Blocked); ")
    assert {d: r.asDict() for d, r in verdicts.items()} == {d: r.asDict() | {"gate_reason": r.gate_reason if r.gate_pass else None} for d, r in whole.items()}


def test_queries_that_ask_verdicts_ask_no_reasons(spark, monkeypatch):
    from weftline.plans import deliver

    asked, gate = [], gates.apply_gates
    monkeypatch.setattr(gates, "apply_gates", lambda *a, **k: [asked.append(k.get("reasons", True)), gate(*a, **k)][1])
    for f in (catalogue.QUERIES["gate_pass_scan"], catalogue.QUERIES["build_counters"], deliver._rows):
        f(spark, SF)
    assert asked == [False] * 3


def test_sizes_are_read_once(spark):
    bands = spark.createDataFrame([("10 - 49",), ("1,000+",), ("none",), (None,), ("9 to 60",)], "t string").select(firm.size_band(F.col("t")).alias("b"))
    assert optimized(bands).count("regexp_extract_all") == 1
    assert [r.b for r in bands.collect()] == ["10-49", "250+", None, None, "<10"]


def test_people_with_a_full_profile_are_not_scored(spark, monkeypatch):
    """The first of the profiles that score 100 in name and company is taken as it is; only who has none, and large firms, are scored."""
    asked = [("d", "Asha Rao", "Velo Tech"), ("d", "Ben Das", "Velo"), ("d", " ", "velo"), ("e", "Cy", "Quantal")]
    listed = [("d", "u1", "Asha Rau", ["velo tech"], 1), ("d", "u2", "Rao  Asha K", [None, "TECH velo"], 5), ("d", "u3", "asha rao", ["other", "velo tech"], 3), ("d", "u4", "rao", ["velo tech", None], 2), ("d", "u5", "asha rao", None, 0),
              ("d", "u6", "Das", ["velo labs"], None), ("d", "u7", " ", ["velo"], 0), ("e", "u8", "cy", ["quantal"], 1), ("f", "u9", "Asha Rao", ["velo tech"], 0)]
    a, b = spark.createDataFrame(asked, "domain string, name string, company_name string"), spark.createDataFrame(listed, "domain string, uid string, full_name string, companies array<string>, ordinal int")
    want = {("d", "Asha Rao"): "u4", ("d", "Ben Das"): "u6", ("e", "Cy"): "u8"}
    got = lambda: {(r.domain, r["name"]): r.uid for r in people.best_profile(a, b).collect()}
    scored, match = [], people.fuzzy_matches
    monkeypatch.setattr(people, "fuzzy_matches", lambda x, *rest: [scored.append(sorted(r["name"] for r in x.collect())), match(x, *rest)][1])
    assert got() == want and scored == []
    monkeypatch.setattr(gates, "DIRECT", 10)
    assert got() == want and scored == [[" ", "Asha Rao", "Ben Das"]]
    monkeypatch.setattr(people, "large_blocks", lambda *_: a.select("domain").limit(0))
    listed[6] = ("d", "u7", "Dab", ["velo"], 0)
    listed[5] = ("d", "u6", "Den Das", ["velo labs"], None)
    b = spark.createDataFrame(listed, "domain string, uid string, full_name string, companies array<string>, ordinal int")
    assert got() == want and scored[1:] == [["Ben Das"]]


def founders(rows):
    """What merging gives, by comparing all names."""
    out, firms = [], {}
    for turn, (domain, _, name, role, source) in rows:
        known = firms.setdefault(domain, [])
        hit = next((p for p in known if turn and score((p[1] or "").lower(), (name or "").lower()) >= people.AGREE), None)
        if hit is None:
            known.append([len(known), name, role, [source]])
        else:
            hit[2], hit[3] = hit[2] or role, hit[3] + [source] * (source not in hit[3])
    return sorted([domain or "", *p] for domain, known in firms.items() for p in known)


def test_founders_of_small_firms_are_not_paired_in_tables(spark, monkeypatch):
    """Names of a firm meet in one task, without tables of pairs or components; those of a firm with many by components, with the same result, also where there is no firm."""
    draw = random.Random(6)
    name = lambda: draw.choice([None, "", " ", f"person{draw.randrange(40)} of {draw.randrange(3)}", f"P{draw.randrange(40)} Person of", "x" * 80 + str(draw.randrange(3))])
    rows = lambda turn, n, source: [(turn, (d, k, name(), draw.choice([None, "", "CEO"]), source)) for d in ("a", "b", None) for k in range(n)]
    every = rows(0, 6, "registry") + rows(1, 14, "site")
    cols = "domain string, ordinal long, name string, role string, source string"
    sides = [spark.createDataFrame([r for turn, r in every if turn == k], cols) for k in (0, 1)]
    got = lambda: sorted([r.domain or "", r.ordinal, r["name"], r.role, r.sources] for r in people.merge_founders(*sides).collect())
    plain = lambda found: sorted(found, key=lambda r: r[:2])
    paired, match = [], people.fuzzy_matches
    monkeypatch.setattr(people, "fuzzy_matches", lambda *a: [paired.append(a), match(*a)][1])
    assert plain(got()) == plain(founders(every)) and not paired
    monkeypatch.setattr(gates, "DIRECT", 10)
    monkeypatch.setattr(order, "WHOLE", 5)
    assert plain(got()) == plain(founders(every)) and len(paired) == 1


def test_targets_of_groups_of_any_size(monkeypatch):
    draw = random.Random(7)
    texts = [f"person{draw.randrange(300)} of {draw.randrange(3)}" for _ in range(150)]
    starts, turn = np.array([0, 1, 40, 41]), np.array([draw.randrange(3) > 0 for _ in texts]).astype(int)
    want = list(range(len(texts)))
    for x in range(len(texts)):
        begin = starts[starts <= x].max()
        if turn[x]:
            want[x] = next((y for y in range(begin, x) if want[y] == y and score(texts[x], texts[y]) >= 88), x)
    for pairs, some in ((500_000, 10_000), (30, 7)):
        monkeypatch.setattr(people, "PAIRS", pairs)
        monkeypatch.setattr(people, "SOME", some)
        assert list(people._targets(texts, turn, starts, 88.0)) == want
    assert 0 < sum(x != y for x, y in enumerate(want)) < sum(turn)


def test_compared_texts_are_those_that_score():
    draw = random.Random(8)
    words = ["asha", "ashaa", "rao", "o'neil", "é\U0001F600x", "x" * 40, "y" * 70, "a\0b", "k1", "person12", "person21", "of", "3", "", " "]
    texts = [" ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 2, 3, 3, 10]))) for _ in range(90)] + [f"person{draw.randrange(3000)} of {draw.randrange(7)}" for _ in range(90)]
    i, j = np.divmod(np.arange(len(texts) ** 2), len(texts))
    for threshold in (80.0, 88.0):
        assert list(Compared(texts, threshold).close(i, j)) == [score(texts[a], texts[b]) >= threshold for a, b in zip(i, j)]
    assert len(Compared([], 88.0).close(i[:0], j[:0])) == 0


def test_small_groups_are_numbered_like_large_ones(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 5), (None, 9), (None, 8)], "g string, k int")
    want = {("a", 1): 1, ("a", 2): 2, ("a", 3): 3, ("b", 5): 1, (None, 8): 1, (None, 9): 2}
    for whole in (100, 1):
        monkeypatch.setattr(order, "WHOLE", whole)
        assert {(r.g, r.k): r.n for r in order.numbered_each(rows, "g", [F.col("k")], "n").collect()} == want
