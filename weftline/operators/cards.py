"""Listing pages to rows: the cards of a page by a table of what each site's markup looks like.

Pages are independent, so Spark parts them by rows and each is read by the
standard library's parser in one pass; what a site's cards and their fields are
is data (:data:`SITES`, or a table of one's own), not code.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

FIELDS = ("name", "website", "city", "founded", "size", "segment")
# The selectors of six directories' cards and fields. A field's text is taken, of website the address; badge is left out of the name; place is a city with its country behind a comma.
SITES: dict[str, dict[str, str]] = {
    "site-1": {"card": "li.firm-wrapper", "name": "h3.firm-name a", "website": ".firm-urls a.visit-website, a.visit-website", "city": ".firm-location span", "founded": ".firm-founded span", "size": ".firm-employees span", "segment": ".firm-short-description"},
    "site-2": {
        "card": "li.provider-row, div.provider, ul.directory-list > li", "name": "h3.company_info a, .company-name a, a.company_title", "website": "a.website-link__item, a.visit-website, a[data-link-type='website']",
        "city": ".locality, .provider__highlights-item--location, .location", "founded": ".founded, li.provider__highlights-item--founded", "size": ".employees, li.provider__highlights-item--employees, .company-size",
        "segment": ".tagline, .provider__description-text-more, .service-focus",
    },
    "site-3": {"card": ".co-box", "name": "p.co-box__name", "badge": ".verified--ico", "website": "a.btn-website", "place": "span.co-box__loc-itm", "segment": "p.co-box__descr"},
    "site-4": {
        "card": "li.provider-row, div.provider-card, ul.directory-list > li", "name": "h3 a, .company-name a, a.company_title", "website": "a.website-link__item, a.visit-website, a[data-link-type='website']", "city": ".locality, .location",
        "founded": ".founded, li.founded", "size": ".employees, .company-size", "segment": ".tagline, .service-focus",
    },
    "site-5": {
        "card": "div.agency-listing, li.agency, .agencies-list .agency", "name": ".agency-name a, h3 a, .company-name", "website": "a.visit-website, a.agency-website, a[target='_blank'][rel~='nofollow']", "city": ".agency-location, .location",
        "founded": ".agency-founded, .founded", "size": ".agency-employees, .employees, .company-size", "segment": ".agency-services, .tagline, .services",
    },
    "site-6": {
        "card": "div.member-card, li.member, .members-list .member", "name": ".member-name, h3 a, .company-name", "website": "a.member-website, a.visit-website, a[target='_blank'][rel~='nofollow']", "city": ".member-location, .location, .city",
        "founded": ".member-founded, .founded", "size": ".member-employees, .employees, .company-size", "segment": ".member-category, .segment, .services",
    },
}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_PART = re.compile(r"""(?P<tag>^[\w-]+)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w-]+)(?P<op>~?=)'(?P<value>[^']*)'\]""")


class Selector:
    """A list of alternatives, each a path of elements by tag, classes and attributes, within or (>) directly under one another."""

    def __init__(self, text: str) -> None:
        self.paths = []
        for one in text.split(","):
            steps, direct = [], False
            for word in one.split():
                if word == ">":
                    direct = True
                    continue
                parts = [m.groupdict() for m in _PART.finditer(word)]
                steps.append((direct, parts))
                direct = False
            self.paths.append(steps)

    @staticmethod
    def _is(element: tuple, parts: list[dict]) -> bool:
        tag, attrs = element
        words = lambda name: (attrs.get(name) or "").split()
        return all(p["tag"] == tag if p["tag"] else p["cls"] in words("class") if p["cls"] else p["value"] in words(p["attr"]) if p["op"] == "~=" else attrs.get(p["attr"]) == p["value"] for p in parts)

    def _path(self, stack: list[tuple], steps: list, at: int, k: int) -> bool:
        if not self._is(stack[at], steps[k][1]):
            return False
        if k == 0:
            return True
        above = range(at - 1, at - 2, -1) if steps[k][0] else range(at - 1, -1, -1)
        return any(a >= 0 and self._path(stack, steps, a, k - 1) for a in above)

    def ends(self, element: tuple) -> bool:
        """Whether an element, wherever it stands, is the last of a path."""
        return any(self._is(element, steps[-1][1]) for steps in self.paths)

    def __call__(self, stack: list[tuple]) -> bool:
        """Whether the innermost element of a stack is selected."""
        return any(self._path(stack, steps, len(stack) - 1, len(steps) - 1) for steps in self.paths)


class Site(dict):
    """Field -> selector, and of which fields an element may be the last of a path, worked out once for each tag and what selectors read of it."""

    #: Different elements that are kept.
    MOST = 10_000

    def __init__(self, rules: dict[str, Selector]) -> None:
        super().__init__(rules)
        self.read = ("class", *sorted({p["attr"] for s in self.values() for steps in s.paths for _, parts in steps for p in parts if p["attr"]}))
        self.seen: dict[tuple, frozenset] = {}

    def may_be(self, tag: str, attrs: dict) -> frozenset:
        key = (tag, *map(attrs.get, self.read))
        found = self.seen.get(key)
        if found is None:
            if len(self.seen) >= self.MOST:
                self.seen.clear()
            found = self.seen[key] = frozenset(field for field, s in self.items() if s.ends((tag, attrs)))
        return found


class _Page(HTMLParser):
    """Cards in the order in which they begin; of each field of a card the first element."""

    def __init__(self, site: dict[str, Selector]) -> None:
        super().__init__(convert_charrefs=True)
        self.site, self.stack, self.cards, self.open_cards = site if isinstance(site, Site) else Site(site), [], [], []
        self.taking: list[tuple[int, dict, str]] = []  # depth, card, field
        self.quiet: list[int] = []  # depths of what has no text: scripts, styles

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.stack.append((tag, dict(attrs)))
        depth = len(self.stack)
        may = self.site.may_be(*self.stack[-1])
        taken = [field for field in self.site if field in may and field not in ("card", "badge") and self.site[field](self.stack)] if may and self.open_cards else ()
        for card in self.open_cards:
            for field in taken:
                if field in card["at"]:
                    continue
                card["at"][field] = []
                if field == "website":
                    card["website"] = self.stack[-1][1].get("href")
                self.taking.append((depth, card, field))
        # a badge is left out of the name it stands in, the first one of each
        if "badge" in may and self.site["badge"](self.stack):
            for _, card, field in self.taking:
                if field == "name" and "badge" not in card:
                    card["badge"] = depth
        if "card" in may and self.site["card"](self.stack):
            card = {"at": {}, "depth": depth}
            self.cards.append(card)
            self.open_cards.append(card)
        if tag in ("script", "style"):
            self.quiet.append(depth)
        if tag in VOID:
            self._close(depth)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(len(self.stack))

    def handle_endtag(self, tag: str) -> None:
        at = next((k for k in range(len(self.stack), 0, -1) if self.stack[k - 1][0] == tag), None)
        if at:
            self._close(at)

    def _close(self, depth: int) -> None:
        del self.stack[depth - 1 :]
        self.taking = [t for t in self.taking if t[0] < depth]
        self.quiet = [q for q in self.quiet if q < depth]
        self.open_cards = [c for c in self.open_cards if c["depth"] < depth]
        for card in self.open_cards:
            if card.get("badge", 0) >= depth:
                card["badge"] = 0

    def handle_data(self, data: str) -> None:
        if self.quiet or not data.strip():
            return
        for _, card, field in self.taking:
            if not (field == "name" and card.get("badge")):
                card["at"][field].append(data.strip())


def read_page(html: str | None, site: dict[str, Selector], city: str | None) -> list[dict]:
    """The cards of a page that have a name: name, website, city (the page's own where a card has none), founded, size, segment."""
    page = _Page(site)
    page.feed(html or "")
    page.close()
    text = lambda card, field: re.sub(r"\s+", " ", " ".join(card["at"].get(field, []))).strip()
    out = []
    for card in page.cards:
        if not text(card, "name"):
            continue
        raw = (card.get("website") or "").strip()
        found = re.search(r"https?://[^\s\"'<>]+", raw)
        place = text(card, "place").split(",")[0].strip() if "place" in site else text(card, "city")
        out.append({"name": text(card, "name"), "website": found[0] if found else raw or None, "city": place or city, **{f: text(card, f) or None for f in ("founded", "size", "segment")}})
    return out


def parse_cards(pages: DataFrame, sites: dict[str, dict[str, str]] = SITES) -> DataFrame:
    """page_id, site, pos (from 0, of the named cards) and FIELDS of the cards of pages (page_id, site, city, html).

    Defined cases: a null page, one of a site that isn't known and one without cards have no rows; a card without a
    name is skipped; a field that a card lacks is null; elements that are never closed end with the page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {name: Site({field: Selector(text) for field, text in rules.items()}) for name, rules in sites.items()}
        schema = pa.schema([("page_id", pa.int64()), ("site", pa.string()), ("pos", pa.int32()), *[(f, pa.string()) for f in FIELDS]])
        for batch in batches:
            out = []
            for page_id, site, city, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "site", "city", "html"))):
                for pos, card in enumerate(read_page(html, known[site], city) if site in known else []):
                    out.append({"page_id": page_id, "site": site, "pos": pos, **card})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return pages.select("page_id", "site", "city", "html").mapInArrow(run, "page_id long, site string, pos int, " + ", ".join(f"{f} string" for f in FIELDS))
