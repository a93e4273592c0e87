"""Operators against brute force and literals."""

import datetime as dt
import itertools
import random
import re

from pyspark.sql import functions as F

from weftline.functions import fuzzy
from weftline.operators import crm, gates, graph, ledger, merge, order, people


def names(n, seed):
    rng = random.Random(seed)
    out = {" ".join(sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(1, 3))})) for _ in range(n)}
    return sorted(out)


def test_fuzzy_join_loses_no_pair(spark):
    a, b = names(80, 1), names(80, 2)
    b += [x[:-1] + "z" for x in a[:25] if len(x) > 6] + [x.replace(" ", "") for x in a[:25]]
    b = sorted(set(b))
    for threshold in (80.0, 90.0, 92.0):
        got = gates.fuzzy_matches(spark.createDataFrame([(x,) for x in a], "x string"), spark.createDataFrame([(y,) for y in b], "y string"), threshold).select("x", "y").collect()
        assert {tuple(r) for r in got} == {(x, y) for x in a for y in b if fuzzy.score(x, y) >= threshold}


def test_fuzzy_join_does_not_meet_on_a_common_token(spark):
    rng = random.Random(5)
    a = sorted({f"firm {rng.randint(1, 99999)}" for _ in range(150)} | {"firm", "firm zq 7", "abc mid", "kk firm long word"})
    b = sorted({f"firm {rng.randint(1, 99999)}" for _ in range(150)} | {x[:-1] for x in a[:40] if len(x) > 6} | {"zbc mid", "firm zqq 7", "kk firm longer word"})
    da, db = spark.createDataFrame([(x,) for x in a], "x string"), spark.createDataFrame([(y,) for y in b], "y string")
    for threshold in (80.0, 90.0, 92.0):
        want = {(x, y) for x in a for y in b if fuzzy.score(x, y) >= threshold}
        assert {tuple(r) for r in gates.fuzzy_matches(da, db, threshold).select("x", "y").collect()} == want
    assert gates.candidates(da, db, 92.0).count() < len(a) * len(b) / 4


def test_listings_against_exclusions(spark):
    from weftline.plans.catalogue import QUERIES
    from weftline.sources.adapters import logical

    sf = "/root/testdata/sf0.001"
    names = sorted({r[0] for r in logical(spark, sf, "listings").select("company_name").collect()})
    known = sorted(tuple(r) for r in logical(spark, sf, "exclusions").select("ordinal", "name").collect())
    both = spark.createDataFrame([(x,) for x in {*names, *(n for _, n in known)}], "name string")
    core = {r["name"]: r.core for r in both.withColumn("core", gates._core("name")).collect()}
    close = lambda x, y: x == y or (min(len(x), len(y)) >= gates.SHORTEST_CORE and fuzzy.score(x, y) >= gates.KNOWN_SCORE)
    want = {n: next((k for _, k in known if core[n] and core[k] and close(core[n], core[k])), None) for n in names}
    assert {r["name"]: r.known for r in QUERIES["known_fuzzy"](spark, sf).collect()} == {n: k for n, k in want.items() if k}
    blocked = lambda x, y: bool(re.search(rf"\b{re.escape(y)}\b", x)) or fuzzy.score(x, y) >= gates.BLOCK_SCORE
    want = {n: next((k for _, k in known if n.strip() and blocked(n.strip().lower(), k.strip().lower())), None) for n in names}
    assert {r["name"]: r.term for r in QUERIES["blocklist_match"](spark, sf).collect()} == {n: k for n, k in want.items() if k}


def test_known_firm_first_match_wins(spark):
    known = spark.createDataFrame([(1, "Quantal Labs"), (2, "Velotex Systems"), (3, "Velotex")], "ordinal long, name string")
    asked = spark.createDataFrame([("Velotex Technologies Pvt Ltd",), ("Velotexx Ltd",), ("Some Solutions",), ("IT Services India",)], "name string")
    got = {r["name"]: r.known for r in gates.match_known(asked, known).collect()}
    assert got == {"Velotex Technologies Pvt Ltd": "Velotex Systems", "Velotexx Ltd": "Velotex Systems"}


def test_blocklist_words_and_fuzzy(spark):
    terms = spark.createDataFrame([(1, "Bigco"), (2, "Tall Tower Services")], "ordinal long, term string")
    asked = spark.createDataFrame([("Bigco India",), ("Bigcopter",), ("tall tower services ltd",), ("Tall Towr Services",), (" ",)], "name string")
    got = {r["name"]: r.term for r in gates.match_blocklist(asked, terms).collect()}
    assert got == {"Bigco India": "Bigco", "tall tower services ltd": "Tall Tower Services", "Tall Towr Services": "Tall Tower Services"}


def test_blocklist_terms_with_signs(spark):
    """Names and terms with hyphens, dots, ampersands and letters beyond ASCII, against the plain test of every pair."""
    terms = ["T-Systems", "Cap-Gemini", " Cap-Gemini ", "A&B", "& Co", "A.B.", "söhne", "Größe", "x_y", "&&", "日本", "C++", r"a\Eb", "(uk)", "", "\tTab Works\n"]
    names = ["T-Systems, India", "The Cap-Gemini. Group of Pune Works Ltd", "BigT-Systems", "T Systems", "A&B Works", "xA&B", "Meier & Co", "Meier& Co", "A.B.Works", "A.B. and more of it", "zA.B.x", "Meier Söhne Bau", "GRÖSSE alt", "Größe neu", "x_y z w v",
             "a&&b of far away", "a && b of far away", "in 日本 today it is", "日本語", "C++ house of many", "C++x", r"say a\Eb or so", "firm(uk)ltd", "firm (uk) ltd and others", " tab works pune", " ", ""]
    asked = spark.createDataFrame([(n,) for n in names], "name string")
    listed = spark.createDataFrame(list(enumerate(terms)), "ordinal long, term string")
    got = {r["name"]: r.term for r in gates.match_blocklist(asked, listed).collect()}
    hit = lambda n, t: bool(t) and bool(n) and (bool(re.search(rf"\b{re.escape(t)}\b", n)) or fuzzy.score(n, t) >= gates.BLOCK_SCORE)
    want = {n: next((t for t in terms if hit(n.strip().lower(), t.strip().lower())), None) for n in names}
    assert got == {n: t for n, t in want.items() if t}
    assert got["T-Systems, India"] == "T-Systems" and got["The Cap-Gemini. Group of Pune Works Ltd"] == "Cap-Gemini" and "BigT-Systems" not in got


def test_founders_fold_in_order(spark):
    cols = "domain string, ordinal long, name string, role string, source string"
    a = spark.createDataFrame([("d", 1, "Asha Rao", None, "registry"), ("d", 2, "Ben Das", "Director", "registry")], cols)
    b = spark.createDataFrame([("d", 1, "rao asha", "CEO", "company_site"), ("d", 2, "Cy Roy", "CTO", "company_site"), ("e", 1, "Di", None, "company_site")], cols)
    got = {(r.domain, r["name"]): (r.role, r.sources) for r in people.merge_founders(a, b).collect()}
    assert got == {("d", "Asha Rao"): ("CEO", ["registry", "company_site"]), ("d", "Ben Das"): ("Director", ["registry"]), ("d", "Cy Roy"): ("CTO", ["company_site"]), ("e", "Di"): (None, ["company_site"])}


def test_override_replaces_in_place(spark):
    cols = "domain string, ordinal long, name string, name_source string, notes string, linkedin_url string, linkedin_confirmed boolean"
    row = lambda d, k, name, source, notes=None: (d, k, name, source, notes, None, None)
    rows = [
        row("d", 1, "Asha Rao", "registry"), row("d", 2, "Ben Das", "directory"), row("d", 3, "Rao Asha", "directory"), row("e", 1, "Cy", "directory"), row("f", 1, "Di Roy", "site", "x; sources: Registry, company_site"),
        row("f", 2, "Ed Fox", "registry", "sources: directory"), row("f", 3, "Flo", "directory", "Sources: directory, company_site"), row("f", 4, "(verify)", "directory"), row("f", 5, None, None), row("f", 6, "Gus", "Directory", "call"),
    ]
    out = people.override_aggregator(spark.createDataFrame(rows, cols).repartition(4)).orderBy("domain", "ordinal").collect()
    got = {(r.domain, r.ordinal): (r["name"], r.overridden, r.notes, r.confidence) for r in out}
    note = "registry-vs-aggregator override: dropped aggregator name '%s'"
    assert len(out) == len(rows) and {k for k, v in got.items() if v[1]} == {("d", 2), ("f", 2), ("f", 4), ("f", 6)}
    assert got["d", 2] == ("(verify)", True, note % "Ben Das", "red") and got["f", 6] == ("(verify)", True, "call; " + note % "Gus", "red")
    assert got["d", 3][0] == "Rao Asha" and got["e", 1] == ("Cy", False, None, "red") and got["f", 2][2] == "sources: directory; " + note % "Ed Fox"


def crowd(rng, n, firms="de"):
    """People of two firms, one with nearly all: names that are close, the same tokens in another order, blanks and nulls."""
    first, second = ["asha", "ashaa", "ben", "bent", "cy", "di", "dimitri"], ["rao", "raoo", "das", "roy", "long name", "o'neil"]
    name = lambda: rng.choice([None, "", " ", "(verify)"]) if rng.random() < 0.05 else " ".join(rng.sample([rng.choice(first), rng.choice(second), f"k{rng.randint(0, 30)}"], 3)).title()
    return [(firms[0] if rng.random() < 0.9 else firms[1], name(), k) for k in range(n)]


def test_best_candidate_is_that_of_all_pairs(spark):
    rng = random.Random(8)
    asked, found = crowd(rng, 120), crowd(rng, 150)
    got = people.best_candidate(
        spark.createDataFrame(asked, "domain string, name string, k int").repartition(3), spark.createDataFrame([(d, n, f"u{k}", k // 2) for d, n, k in found], "domain string, candidate string, url string, ordinal int").repartition(4), 90.0,
    ).collect()
    want = {}
    for d, n, _ in asked:
        best = [(-fuzzy.score(n.lower(), c.lower()), k // 2, f"u{k}") for e, c, k in found if n is not None and c is not None and e == d and fuzzy.score(n.lower(), c.lower()) >= 90]
        if best:
            want[d, n] = min(best)
    assert {(r.domain, r["name"]) for r in got} == set(want) and len(got) == len(want)
    by_url = {f"u{k}": (k // 2, c) for _, c, k in found}
    for r in got:
        least, place, _ = want[r.domain, r["name"]]
        assert by_url[r.url][0] == place and -fuzzy.score(r["name"].lower(), by_url[r.url][1].lower()) == least


def test_best_profile_is_that_of_all_pairs(spark):
    rng = random.Random(9)
    firms = ["velo tech", "velo", "quantal labs", "other", None]
    asked = [(d, n, rng.choice(firms)) for d, n, _ in crowd(rng, 60)]
    listed = [(d, f"u{k}", n, rng.choice([None, [], rng.sample(firms, 2), rng.sample(firms, 3)]), k) for d, n, k in crowd(rng, 90)]
    got = people.best_profile(spark.createDataFrame(asked, "domain string, name string, company_name string"), spark.createDataFrame(listed, "domain string, uid string, full_name string, companies array<string>, ordinal int")).collect()
    want = {}
    for d, n, firm in asked:
        for e, uid, full, companies, k in listed:
            if d != e or n is None or full is None or (one := fuzzy.score(n.lower(), full.lower())) < 85:
                continue
            c = max([fuzzy.score(firm, x) for x in companies or [] if x is not None and firm is not None], default=0.0)
            total = int((2 * one + c) // 3)
            if total >= 70:
                want[d, n] = min(want.get((d, n), (0, 0, "")), (-total, k, uid))
    assert {(r.domain, r["name"]): r.uid for r in got} == {key: v[2] for key, v in want.items()}


def test_founders_of_a_second_source_bring_uid_and_title(spark):
    cols = "domain string, ordinal long, name string, role string, source string"
    a = spark.createDataFrame([("d", 1, "Asha Rao", None, "registry"), ("d", 2, "Ben Das", "Director", "registry")], cols)
    b = spark.createDataFrame([("d", 1, "Cy Roy", "", "company_site")], cols)
    once = people.merge_founders(a, b).withColumn("source", F.lit("unused"))
    c = spark.createDataFrame([("d", 1, "rao asha", "CEO", "provider", "u1"), ("d", 2, "Asha Rao", "Chair", "provider", "u2"), ("d", 3, "roy cy", "CTO", "provider", None), ("d", 4, "Roy Cy", None, "provider", "u4"), ("d", 5, "Di Fox", None, "provider", ""), ("e", 9, "Ed", "CFO", "provider", "u9")], cols + ", uid string")
    got = {(r.domain, r["name"]): (r.ordinal, r.role, r.sources, r.uid) for r in people.merge_founders(once.drop("source"), c).collect()}
    assert got == {
        ("d", "Asha Rao"): (0, "CEO", ["registry", "provider"], "u1"), ("d", "Ben Das"): (1, "Director", ["registry"], None), ("d", "Cy Roy"): (2, "CTO", ["company_site", "provider"], "u4"),
        ("d", "Di Fox"): (3, None, ["provider"], None), ("e", "Ed"): (0, "CFO", ["provider"], "u9"),
    }


def test_founders_of_one_firm_are_spread_over_groups(spark):
    """A firm with nearly all rows: the fold by components is the fold of the whole firm."""
    rng = random.Random(12)
    rows = lambda n, source: [(d, k, name, rng.choice([None, "", "CEO", "CTO"]), source) for d, name, k in crowd(rng, n)]
    a, b = rows(40, "registry"), rows(160, "company_site")
    want = []
    for d in "de":
        out = []
        for turn, group in ((0, a), (1, b)):
            for domain, _, name, role, source in group:
                if domain != d:
                    continue
                hit = next((p for p in out if turn and fuzzy.score((p[2] or "").lower(), (name or "").lower()) >= people.AGREE), None)
                if hit is None:
                    out.append([d, len(out), name, role, [source]])
                else:
                    hit[3] = hit[3] or role
                    hit[4] += [source] if source not in hit[4] else []
        want += out
    cols = "domain string, ordinal long, name string, role string, source string"
    got = people.merge_founders(spark.createDataFrame(a, cols).repartition(3), spark.createDataFrame(b, cols).repartition(5))
    assert sorted(map(list, got.select("domain", "ordinal", "name", "role", "sources").collect()), key=lambda r: (r[0], r[1])) == want


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(100 + k, 101 + k) for k in range(40)] + [(7, 7), (200, 200)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for x, y in edges:
        a, b = sorted((root(x), root(y)))
        parent[b] = a
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in got} and {x for e in edges for x in e if e[0] != e[1]} == set(got)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fair_share_and_limits(spark):
    df = spark.createDataFrame([(4000, 0, dt.date(2026, 7, 14)), (4000, 3000, dt.date(2026, 7, 31)), (10, 20, dt.date(2026, 7, 1))], "b int, u int, d date")
    assert [r[0] for r in df.select(ledger.fair_share(F.col("b"), F.col("u"), F.col("d"))).collect()] == [223, 1000, 0]
    limits = spark.createDataFrame([(100,), (1,), (None,)], "x int")
    assert [r[0] for r in limits.select(ledger.effective_limit(F.col("x"))).collect()] == [80, 1, None]


def test_transitions_and_escalation(spark):
    calls = [(1, 5, None), (2, 5, "M1V2"), (3, 5, "M1V1"), (4, 1, ""), (5, 2, "M1V2"), (6, 9, "")]
    got = {r.k: (r.stage, r.version, r.task) for r in crm.step(spark.createDataFrame(calls, "k int, outcome int, previous string")).collect()}
    assert got == {
        1: ("M1V2 Sent", "M1V2", "CALL"), 2: ("M1V1 Sent", "M1V1", "CALL"), 3: ("Dead - No Response", None, None), 4: ("M1V1 Sent", "M1V1", "CALL"), 5: ("Dead - Rejected", None, None), 6: (None, None, None),
    }
    t = dt.datetime(2026, 1, 1)
    rows = [(k, 7, t + dt.timedelta(hours=k), 5) for k in range(3)]
    out = crm.escalate(spark.createDataFrame(rows, "event_id long, deal_id long, ts timestamp_ntz, outcome int")).first()
    assert (out.n, out.stage) == (3, "Dead - No Response")


def test_escalation_is_combined_before_the_shuffle(spark):
    rules = {(o, p): (stage, version) for o, p, stage, version, *_ in crm.TRANSITIONS}
    t, rows, want = dt.datetime(2026, 1, 1), [], {}
    for deal, calls in enumerate(itertools.chain.from_iterable(itertools.product(range(1, 6), repeat=n) for n in range(1, 5))):
        version = stage = ""
        for k, outcome in enumerate(calls):
            rows.append((k % 2 * 1000 - k, deal, t + dt.timedelta(hours=k // 2, minutes=k % 2), outcome))
            stage, sent = rules.get((outcome, version)) or rules[outcome, "any"]
            version = sent or version
        want[deal] = (len(calls), stage, version)
    random.Random(1).shuffle(rows)
    out = crm.escalate(spark.createDataFrame(rows, "event_id long, deal_id long, ts timestamp_ntz, outcome int").repartition(7))
    assert {r.deal_id: (r.n, r.stage, r.version) for r in out.collect()} == want
    assert "Pandas" not in spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")


def test_unknown_outcomes_are_put_aside(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [(1, 7, t, 5), (2, 7, t + dt.timedelta(hours=1), 9), (3, 7, t + dt.timedelta(hours=2), None), (4, 8, t, 0), (5, 7, t + dt.timedelta(hours=3), 5)]
    df = spark.createDataFrame(rows, "event_id long, deal_id long, ts timestamp_ntz, outcome int")
    assert [tuple(r) for r in crm.escalate(df).collect()] == [(7, 2, "M1V1 Sent", "M1V1")]
    assert sorted(r.event_id for r in crm.unknown_outcomes(df).collect()) == [2, 3, 4]


def test_running_sums_over_ranges(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["big", "big", "big", "small", None]), k, rng.randint(0, 5)) for k in range(400)]
    df = spark.createDataFrame(rows, "g string, k int, cost int").repartition(6)
    want, total = {}, {}
    for g, k, cost in rows:
        total[g] = want[k] = total.get(g, 0) + cost
    assert {r.k: r.n for r in order.running_within(df, "g", [F.col("k")], "cost", "n").collect()} == want
    assert {r.k for r in ledger.budget_prefix(df, "g", "k", "cost", 100).collect()} == {k for k, n in want.items() if n <= 100}
    assert order.running_within(df.limit(0), "g", [F.col("k")], "cost", "n").count() == 0


def test_notes_with_any_entity(spark):
    import html

    from weftline.functions import notes

    raw = ["a &amp; b", "&amp;lt;b&amp;gt;", "&lt;x&gt; &eacute;&#8211; &copy 1", "x &nbsp;y", "no &such; thing &", "&amp;eacute;", "<p>q<br>&quot;r&quot;</p>", "", None, "AT&T &#39;s"]
    got = {r.k: r.t for r in notes.plain(spark.createDataFrame(list(enumerate(raw)), "k int, body string"), "body", "t").collect()}
    bare = lambda x: re.sub("<[^>]+>", "", re.sub(r"(?i)<br\s*/?>", "\n", x or ""))
    assert got == {k: html.unescape(bare(x)) for k, x in enumerate(raw)}


def test_site_text_takes_three_pages(spark):
    from weftline.operators import snapshots

    page = lambda site, k, n, c="x": (site, k, f"/p{k}", c * n)
    rows = [page("a", k, 60 + k) for k in range(9, 0, -1)] + [page("b", 1, 20), page("b", 2, 51)] + [page(None, 3, 8995), page(None, 4, 100), page(None, 5, 100), page("c", 1, 50)] + [page("a", 1, 60 + 1)] * 5
    got = {r.site: r.text for r in snapshots.site_text(spark.createDataFrame(rows, "site string, priority int, path string, text string").repartition(4)).collect()}
    assert got == {"a": "[/p1] " + "x" * 61 + "\n\n[/p2] " + "x" * 62 + "\n\n[/p3] " + "x" * 63, "b": "[/p2] " + "x" * 51, None: ("[/p3] " + "x" * 8995)[:9000]}


def test_founders_fold_names_not_rows(spark):
    rng = random.Random(2)
    known = ["Asha Rao", "Rao Asha", "asha rao", "Ben Das", "Ben Dass", "Cy Roy", "Cy Roi", "Di", " ", "Di Maria Long", "Di Maria Longg"]
    row = lambda turn, k: (rng.choice("de"), k, rng.choice(known), rng.choice([None, "", "", "CEO", "CTO"]), rng.choice(["registry"] if not turn else ["company_site", "directory", "registry"]))
    a, b = [row(0, k) for k in range(14)], [row(1, k) for k in range(120)]
    want = []
    for d in "de":
        out = []
        for turn, rows in ((0, a), (1, b)):
            for domain, _, name, role, source in rows:
                if domain != d:
                    continue
                hit = next((p for p in out if turn and fuzzy.score(p[2].lower(), name.lower()) >= people.AGREE), None)
                if hit is None:
                    out.append([d, len(out), name, role, [source]])
                else:
                    hit[3] = hit[3] or role
                    hit[4] += [source] if source not in hit[4] else []
        want += out
    cols = "domain string, ordinal long, name string, role string, source string"
    out = people.merge_founders(spark.createDataFrame(a, cols).repartition(3), spark.createDataFrame(b, cols).repartition(5))
    assert sorted(map(list, out.select("domain", "ordinal", "name", "role", "sources").collect()), key=lambda r: (r[0], r[1])) == want


def test_merge_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, "x")], "k string, created_at int, v string")
    new = spark.createDataFrame([("a", 5, "y", 1), ("a", 6, "z", 2), ("b", 7, "w", 1)], "k string, created_at int, v string, o int")
    once = merge.upsert(old, new, "k", "o")
    assert sorted(map(tuple, once.collect())) == [("a", 1, "z"), ("b", 7, "w")]
    assert sorted(map(tuple, merge.upsert(once, new, "k", "o").collect())) == [("a", 1, "z"), ("b", 7, "w")]
    empty = new.limit(0)
    assert sorted(map(tuple, merge.upsert(old, empty, "k", "o").collect())) == [("a", 1, "x")]


def test_sliding_count_against_brute_force(spark):
    """Slots of 16 windows each; edges of windows and slots, equal times, a key with nearly all rows, no time."""
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    edges = [start + dt.timedelta(seconds=160 * k + e) for k in range(4) for e in (-10, -1, 0, 9, 10, 150, 151)]
    times = edges + [start + dt.timedelta(seconds=rng.randint(-400, 900), microseconds=rng.choice([0, 1, 999999])) for _ in range(300)]
    rows = [(k, "hot" if k % 20 else "cold", t) for k, t in enumerate(times)] + [(1000, "hot", None), (1001, "hot", None)]
    got = {r.i: r.in_window for r in ledger.sliding_count(spark.createDataFrame(rows, "i int, key string, ts timestamp").repartition(4), "key", "ts", 10).collect()}
    width = dt.timedelta(seconds=10)
    near = lambda a, b: a is b if a is None or b is None else b - width < a <= b
    assert got == {i: sum(k == key and near(x, t) for _, k, x in rows) for i, key, t in rows}


def test_numbers_over_ranges(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["big", "big", "big", "small", None]), rng.randint(0, 50), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, score int, k int").repartition(6)
    got = {r.k: r.n for r in order.numbered(df, [F.desc("score"), F.col("k")], "n").collect()}
    assert got == {r[2]: n for n, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])), 1)}
    within = {r.k: r.n for r in order.numbered_within(df, "g", [F.desc("score"), F.col("k")], "n").collect()}
    want = {}
    for g in {r[0] for r in rows}:
        want |= {r[2]: n for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1)}
    assert within == want
    assert order.numbered(df.limit(0), [F.col("k")], "n").count() == 0
