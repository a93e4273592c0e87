"""Cards of pages, the order of a crawl, list files and the outbox, against literals and plain loops."""

import random

from pyspark.sql import functions as F

from weftline.operators import cards, crawl, exclusions, outbox
from weftline.operators.cards import Selector, read_page
from weftline.sources import lists


def site(name):
    return {field: Selector(text) for field, text in cards.SITES[name].items()}


def test_a_card_of_each_site():
    page = '<li class="a firm-wrapper"><h3 class="firm-name"><a>  Velo\n Tech &amp; Co </a></h3><div class="firm-urls"><a class="visit-website" href="/out?u=https://velo.in/x y">go</a></div><div class="firm-location"><span>Pune</span><span>2</span></div><div class="firm-employees"><span>50 <b>- 249</b></span></div><div class="firm-short-description">Apps<br>and <i>more</i></div>'
    assert read_page(page, site("site-1"), "Delhi") == [{"name": "Velo Tech & Co", "website": "https://velo.in/x", "city": "Pune", "founded": None, "size": "50 - 249", "segment": "Apps and more"}]
    page = '<ul class="directory-list"><li><div><a class="company_title">A</a></div></li><div><li><a class="company_title">not a direct child</a></li></div><li class="x"><span class="company-name"><a>B</a></span><a data-link-type="website" href="b.in">w</a></li></ul>'
    assert [(r["name"], r["website"], r["city"]) for r in read_page(page, site("site-2"), "Delhi")] == [("A", None, "Delhi"), ("B", "b.in", "Delhi")]
    page = '<div class="co-box"><p class="co-box__name">Quantal <span class="verified--ico">Verified <b>Company</b></span>Labs</p><span class="co-box__loc-itm">Pune , India</span><span class="co-box__loc-itm">x</span><p class="co-box__descr">text</p></div>'
    assert read_page(page, site("site-3"), None) == [{"name": "Quantal Labs", "website": None, "city": "Pune", "founded": None, "size": None, "segment": "text"}]
    page = '<div class="agency-listing"><h3><a>A</a></h3><a target="_blank" rel="me nofollow" href="https://a.in">w</a><a target="_blank" rel="nofollowing" href="https://b.in">w</a></div>'
    assert [(r["name"], r["website"]) for r in read_page(page, site("site-5"), None)] == [("A", "https://a.in")]


def test_what_is_no_card():
    for page in (None, "", "<p>text", "<!-- <div class='member-card'><h3><a>x</a></h3></div> -->", "<div class='member-card'><h3><a> </a></h3></div>", "<script>'<div class=member-card><h3><a>x</a>'</script>"):
        assert read_page(page, site("site-6"), "c") == []
    nested = "<div class='member-card'><div class='member-card'><b class='member-name'>in</b></div><b class='member-name'>out</b></div>"
    assert [r["name"] for r in read_page(nested, site("site-6"), "c")] == ["in", "in"]
    assert [r["name"] for r in read_page("<div class='member-card'><b class='member-name'>a</div><div class='member-card'><b class='member-name'>b", site("site-6"), "c")] == ["a", "b"]


def test_cards_of_a_table(spark):
    pages = [(1, "site-6", "c", "<div class='member-card'><h3><a>x</a></h3></div>" * 3), (2, "unknown", "c", "<div class='member-card'><h3><a>x</a></h3></div>"), (3, None, None, None), (4, "site-6", None, "<li class='member'><h3><a>y</a></h3>")]
    got = cards.parse_cards(spark.createDataFrame(pages, "page_id long, site string, city string, html string"))
    assert sorted((r.page_id, r.pos, r["name"], r.city) for r in got.collect()) == [(1, 0, "x", "c"), (1, 1, "x", "c"), (1, 2, "x", "c"), (4, 0, "y", None)]


def crawled(pages):
    """The loop over sources, cities and pages."""
    taken, out = set(), {}
    by = {(s, c, p): (status, n) for s, c, p, status, n in pages}
    for s in {p[0] for p in pages}:
        st = out.setdefault(s, [0, 0, False, 0])
        for c in sorted({p[1] for p in pages if p[0] == s}):
            p = 1
            while (s, c, p) in by:
                status, n = by[s, c, p]
                if status == "blocked":
                    st[2] = True
                    break
                if status == "failed":
                    st[3] += 1
                    break
                taken.add((s, c, p))
                st[0], st[1] = st[0] + 1, st[1] + (n or 0)
                if not n:
                    break
                p += 1
            if st[2]:
                break
    return taken, out


def test_crawl_is_the_loop(spark):
    rng = random.Random(3)
    pages = [(f"s{s}", c, p, rng.choices(["ok", "failed", "blocked"], [30, 2, 1])[0], rng.choice([0, None, 5, 7, 9, 9, 9])) for s in range(12) for c in range(1, 9) for p in range(1, rng.randint(2, 9))]
    pages += [("calm", 1, 1, "ok", 3), ("shut", 1, 1, "blocked", 3), ("shut", 2, 1, "ok", 3)]
    df = spark.createDataFrame(pages, "source string, place int, page int, status string, n_rows int").withColumn("city", F.concat(F.lit("c"), "place")).repartition(5)
    taken, out = crawled(pages)
    assert {(r.source, r.place, r.page) for r in crawl.visited(df).collect()} == taken
    assert {r.source: [r.pages, r.n_rows, r.blocked, r.skipped] for r in crawl.stats(df).collect()} == out


def test_lists_out_of_a_folder(spark, tmp_path):
    put = lambda name, data: (tmp_path / name).parent.mkdir(parents=True, exist_ok=True) or (tmp_path / name).write_bytes(data)
    put("a/master.csv", "﻿no,Company Name,Website\n1,Velo Tech,https://www.velo.co.in/x\n\n2,\"Quantal, \"\"Labs\"\"\nPune\",\n".encode())
    put("a/second.csv", b"X,Y\nz, velo tech \n")
    put("a/one.csv", b"firm\nSolo\n")
    put("a/broken.csv", b"Company\n\xff\xfe\xfa\n")
    put("a/quotes.csv", b'Company\n"never closed\n')
    put("a/empty.csv", b"")
    put("a/exports/out.csv", b"#,Company\n7,Delivered\n")
    put("a/domains.txt", b"# comment\nwww.acme.com\n\n  beta.com.vn/x \n")
    put("b/more.txt", b"acme.com\nnot a domain\n\xff\n")
    at = lambda p: f"{tmp_path}/{p}"
    paths = [at("a"), at("a/../a/master.csv"), f"file://{tmp_path}/a/one.csv", at("absent.csv"), at("a/exports"), at("a/exports/out.csv")]
    assert lists.wanted([*paths, at("a/exportsx")], at("a/exports/")) == [at("a"), at("a/master.csv"), at("a/one.csv"), at("absent.csv"), at("a/exportsx")]
    rows = lists.read_rows(spark, paths, at("a/exports"))
    got = {(r.file.rsplit("/", 1)[-1], r["name"]): r.domains for r in exclusions.from_lists(rows).collect()}
    assert got == {("master.csv", "Velo Tech"): ["velo.co.in"], ("master.csv", 'Quantal, "Labs"\nPune'): [], ("second.csv", "velo tech"): [], ("one.csv", "Solo"): []}
    lines = lists.read_lines(spark, [at("a"), at("b/more.txt"), at("nowhere")], at("a/exports"))
    assert {r.domain for r in exclusions.from_lines(lines).collect()} == {"acme.com", "beta.com.vn"}
    assert lists.read_rows(spark, [at("absent.csv")]).count() == 0 and lists.read_lines(spark, []).count() == 0


def test_template_from_the_file_itself(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text("#, Company ,Status\n3,a,x\n12,b,\nx7,c,\n,d,\n")
    (tmp_path / "bare.csv").write_text("Company\na\n")
    (tmp_path / "late.csv").write_text("Company,#\na,4\nb,  9 \n")
    got = {r.file.rsplit("/", 1)[-1]: (r.header, r.width, r.next_index) for r in lists.template(lists.read_rows(spark, [str(tmp_path)])).collect()}
    assert got == {"sheet.csv": (["#", "Company", "Status"], 3, 13), "bare.csv": (["Company"], 1, 1), "late.csv": (["Company", "#"], 2, 10)}


def test_mail_is_sent_once(spark, tmp_path):
    deals = spark.createDataFrame(
        [(1, "M1V1 Sent", "a.in", None), (2, "M1V2 Sent", "a.in", "M1V1"), (3, "M1V1 Sent", "b.in", "M1V1"), (4, "M1V1 Sent", "c.in", ""), (5, "Interested", "a.in", None), (6, "M1V1 Sent", "d.in", None), (7, "M1V1 Sent", None, None)],
        "deal_id long, stage string, domain string, sent_version string",
    )
    firms = spark.createDataFrame([("a.in", "Velo"), ("b.in", "B"), ("c.in", "C")], "domain string, company_name string")
    who = spark.createDataFrame([("a.in", 1, "Asha Devi Rao", "a@a.in"), ("a.in", 2, "Ben", "b@a.in"), ("b.in", 1, "Cy", "c@b.in"), ("c.in", 1, "(verify)", ""), ("d.in", 1, "Di", "d@d.in")], "domain string, rank int, name string, email string")
    templates = spark.createDataFrame([("M1V1", "Hi {{contact.firstname}}", "{{company.name}} {{owner.first_name}} [CALENDLY_LINK]"), ("M1V2", "{{company.name}}", "x")], "version string, subject string, body string")
    due = outbox.due(deals, firms, who, templates, "Me", "https://l")
    got = {r.deal_id: (r.version, r.skip, r.email, r.subject, r.body, r.properties) for r in due.collect()}
    assert got == {
        1: ("M1V1", None, "a@a.in", "Hi Asha", "Velo Me https://l", {"email_version_sent": "M1V1", "calendly_link_sent": "true"}), 2: ("M1V2", None, "a@a.in", "Velo", "x", {"email_version_sent": "M1V2"}),
        3: ("M1V1", "already sent", None, None, None, None), 4: ("M1V1", "no contact", None, None, None, None), 6: ("M1V1", "no contact", None, None, None, None), 7: ("M1V1", "no contact", None, None, None, None),
    }
    box = outbox.outbox(spark, f"file://{tmp_path}/box")
    outbox.post(box, due, "monday")
    first = outbox.pending(box)
    assert {(r.deal_id, r.version, r.txn) for r in first.collect()} == {(1, "M1V1", "monday"), (2, "M1V2", "monday")}
    outbox.post(box, due, "monday")  # the same batch again, before its messages were sent
    assert outbox.pending(box).count() == 2
    outbox.acknowledge(box, first, "monday")
    for txn in ("monday", "tuesday"):
        outbox.post(box, due, txn)
        assert outbox.pending(box).count() == 0 and box.rows().count() == 2


def test_elements_are_tried_on_few_selectors(monkeypatch):
    """An element whose tag and attributes end no path isn't held against the stack, and one like it isn't looked at again."""
    from weftline.operators.cards import SITES, Selector, Site, read_page

    calls = []
    whole = Selector._path
    monkeypatch.setattr(Selector, "_path", lambda self, *a: calls.append(1) or whole(self, *a))
    rules = Site({field: Selector(text) for field, text in SITES["site-6"].items()})
    card = "<div class='member-card'><b class='member-name'>a</b>" + "<p class='x'>t</p>" * 500 + "</div>"
    assert [r["name"] for r in read_page(card, rules, "c")] == ["a"]
    assert len(calls) < 20 and len(rules.seen) == 3
