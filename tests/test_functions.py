"""Literal cases of the scalar library."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weftline.functions import cells, contact, dates, firm, fuzzy, provenance
from weftline.operators import domains


def values(spark, make, cases, kind="string"):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(cases)], f"k int, x {kind}")
    return [r[0] for r in df.orderBy("k").select(make(F.col("x"))).collect()]


def domains_of(spark, cases, **kw):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(cases)], "k int, w string")
    return [r.domain for r in domains.registered(df, F.col("w"), **kw).orderBy("k").collect()]


def test_registered_domains(spark):
    want = {
        "a.gov.in": "a.gov.in", "x.foo.ac.in": "foo.ac.in", "https://a.b.org.in/p": "b.org.in", "co.in": None, "http://gov.in/": None, "x.de": "x.de", "firm.tech": "firm.tech", "www.firm.app?y": "firm.app", "a.firm.in": "a.firm.in",
        "shop.acme.co.nz": "acme.co.nz", "acme.com.de": "com.de", "a.b.ck": "a.b.ck", "b.ck": None, "x.www.ck": "www.ck", "www.ck": "www.ck", "x.unknowntld": None, "192.0.2.7": None, "com": None, "ftp://u:p@deep.er.acme.com.au:8080/x": "acme.com.au",
        "b\u00fccher.de": "b\u00fccher.de", "acme..com": None, "": None, "localhost": None, "HTTPS://WWW.Acme.com/path?q=1": "acme.com", "https://sub.acme.co.uk/x": "acme.co.uk", "http://not a url": None, "user@mail.acme.io:80": "acme.io", "acme.com.": "acme.com",
    }
    assert dict(zip(want, domains_of(spark, list(want)))) == want
    assert domains_of(spark, [None, "acme.com", "acme.com"]) == [None, "acme.com", "acme.com"]


def test_second_level_of_any_country_is_no_firm(spark):
    suffixes = "com.vn com.ph com.pl co.at com.co com.eg com.qa com.gh com.ua com.kw com.bd insure dental or.at org.pl pvt.k12.ma.us nom.br sch.uk".split()
    for s in suffixes:
        want = [f"firm-a.{s}", f"firm-b.{s}"]
        if s in ("nom.br", "sch.uk"):  # wildcards: the next label belongs to the suffix too
            assert domains_of(spark, [f"https://x.firm-a.town.{s}", f"firm-a.{s}"]) == [f"firm-a.town.{s}", None]
        else:
            assert domains_of(spark, [f"https://www.firm-a.{s}/", f"firm-b.{s}", s]) == [*want, None]
    assert domains_of(spark, ["firm.city.kawasaki.jp", "city.kawasaki.jp", "a.b.kawasaki.jp", "b.kawasaki.jp"]) == ["city.kawasaki.jp", "city.kawasaki.jp", "a.b.kawasaki.jp", None]
    # names beyond ASCII in both forms, and suffixes of private registries, which are none of a country's
    assert domains_of(spark, ["firm.\u516c\u53f8.cn", "firm.xn--55qx5d.cn", "a.firm.blogspot.com"]) == ["firm.\u516c\u53f8.cn", "firm.xn--55qx5d.cn", "blogspot.com"]


def test_a_list_of_ones_own(spark, tmp_path):
    path = tmp_path / "rules.txt"
    path.write_text("// few\nzz\n*.zz\n!keep.zz\nb.c.d.e.zz\n")
    assert domains_of(spark, ["a.b.zz", "b.zz", "x.keep.zz", "f.com", "a.b.c.d.e.zz", "b.c.d.e.zz"], path=str(path)) == ["a.b.zz", None, "keep.zz", None, "a.b.c.d.e.zz", None]


def test_other_columns_stay(spark):
    df = spark.createDataFrame([("a.co.in", "old", 1)], "website_raw string, domain string, labels int")
    out = domains.registered(df, F.col("website_raw"))
    assert out.columns == ["website_raw", "labels", "domain"] and out.first().domain == "a.co.in"


def test_founded(spark):
    got = values(spark, lambda c: firm.founded(c, 2026), ["2015", "since 2015", "Founded 2013", "11+ years", "two decades", "", None, "100 years", "long ago"])
    assert [(r.year, r.approx) for r in got] == [(2015, False), (2015, False), (2013, False), (2015, True), (2006, True), (None, False), (None, False), (2026, True), (None, False)]
    assert got[3].note == "approx from '11+ years'" and got[8].note == "unparsed founded 'long ago'"


def test_sizes(spark):
    assert values(spark, firm.size_band, ["50 - 249", "10 to 49 employees", "1,000+", "Freelancer (1)", None, "none"]) == ["50-249", "10-49", "250+", "<10", None, None]
    head = lambda band: lambda c: firm.size_headcount(c, F.lit(band))
    assert values(spark, head(None), ["50 - 249", "250 - 999", "10 - 49", "300", "10000+", None]) == [149, 624, 29, 300, 10000, None]
    assert values(spark, head("50-249"), [None]) == [150]
    assert values(spark, firm.size_bucket, [1, 100, 101, 500, 501, 1000, 1001, None], "int") == ["1-100", "1-100", "100-500", "100-500", "500-1000", "500-1000", None, None]


def test_core(spark):
    assert values(spark, firm.core_tokens, ["Velo Technologies Pvt. Ltd", "velo (india)", "", None]) == [["velo"], ["velo"], [], None]


def test_phone(spark):
    cases = ["9876543210", "09876543210", "+91 98765 43210", "00919876543210", "919876543210", "12345", None, "", "+1"]
    want = ["+919876543210"] * 5 + [None, None, None, "+1"]
    assert values(spark, contact.e164, cases) == want


def test_name_split(spark):
    got = values(spark, contact.name_split, ["Asha Rao", "Asha", " Asha  Devi Rao ", "", None])
    assert [(r.first, r.last) for r in got] == [("Asha", "Rao"), ("Asha", ""), ("Asha", "Devi Rao"), ("", ""), ("", "")]


def test_confidence(spark):
    rows = [
        ("Asha", "sources: registry, company_site", None, None, False), ("Asha", None, "registry", None, False), ("Asha", "sources: registry, company_site", None, "u", False),
        ("Asha", "sources: registry, company_site; x", None, "u", True), ("(verify)", "sources: registry, company_site", None, None, False), ("Asha", "Sources: directory", None, None, False), ("Asha", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "name string, notes string, src string, li string, ok boolean")
    got = df.select(provenance.confidence(F.col("name"), provenance.sources(F.col("notes"), F.col("src")), F.col("li"), F.col("ok"))).collect()
    assert [r[0] for r in got] == ["green", "amber", "amber", "green", "red", "red", "amber"]


def test_calendar(spark):
    friday, wednesday = dt.datetime(2026, 7, 17, 12), dt.datetime(2026, 7, 15, 12)
    assert values(spark, lambda c: dates.next_business_day(c, 1), [friday], "timestamp_ntz") == [dt.datetime(2026, 7, 20, 5)]
    assert values(spark, lambda c: dates.next_business_day(c, 2), [wednesday], "timestamp_ntz") == [dt.datetime(2026, 7, 17, 5)]
    assert values(spark, dates.local_day, [dt.datetime(2026, 1, 1, 18, 29), dt.datetime(2026, 1, 1, 18, 30)], "timestamp_ntz") == ["2026-01-01", "2026-01-02"]
    sat, mon = dt.date(2026, 7, 18), dt.date(2026, 7, 20)
    assert values(spark, lambda c: dates.working_days(c, F.lit(mon)), [sat, mon, dt.date(2026, 7, 21)], "date") == [1, 1, 1]
    with pytest.raises(ValueError):
        dates.window_key(F.col("x"), "rolling")


def test_cells(spark):
    assert values(spark, lambda c: cells.hyperlink(F.lit("u"), c), ['a "b"']) == ['=HYPERLINK("u","a ""b""")']
    assert [tuple(r) for r in values(spark, cells.unwrap_hyperlink, ['=HYPERLINK("u","a")', "plain", None])] == [("a", "u"), ("plain", None), (None, None)]
    assert values(spark, lambda c: cells.percent(c, F.lit(8)), [1, 3], "int") == ["12%", "38%"]
    assert values(spark, lambda c: cells.resolver_url(F.lit(""), c, F.lit("Pune"), "s?q="), ["A~*"]) == ["s?q=A~%2A+Pune+software+company"]
    assert values(spark, cells.noisy_json, ['```json\n{"a": 1}\n```', 'so: {"a":1} ok', "none"]) == ['{"a":1}', '{"a":1}', None]
    assert values(spark, cells.region_bucket, ["x India", "INDONESIA india", "", None]) == ["India", "Indonesia", None, None]
    assert values(spark, cells.number_or_zero, ["1.5", "x", "", None]) == [1.5, 0.0, 0.0, 0.0]


def test_fuzzy_score():
    assert fuzzy.score("", "a") == 0 and fuzzy.score("a b", "b a") == 100 and fuzzy.score("acme", "acme labs") == 100
    assert fuzzy.score("acme", "zzzz") == 0 and fuzzy.score("asha rao", "asha rau") == 87.5


def _lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_subsequence_against_table():
    import random

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 14))) for _ in range(2))
        assert fuzzy._common(a, b) == _lcs(a, b)
