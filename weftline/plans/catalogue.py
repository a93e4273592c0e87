"""One query for each operator that is built (README names the others), over logical tables derived from the driver's, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import cells, contact, dates, firm, provenance
from weftline.operators import crm, domains, funnel, gates, ledger, merge, order, people, resolve
from weftline.scratch import materialize
from weftline.sources.adapters import logical as T
from weftline.sources.adapters import with_tables
from weftline.streaming import quota

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
AS_OF = 2026
DAY_FROM, DAY_TO = "2024-01-08", "2024-01-14"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = with_tables(sql)
        return f

    return add


# The same pieces of SQL in several oracles.
_HOST = r"regexp_extract(lower(trim(website_raw)), '^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]+)', 1)"
# The registered domain of the hosts that the listings have, from literals and not from the list of suffixes that Spark reads: those that take two labels, those that take one.
_LABELS = f"string_split({_HOST}, '.')"
_LAST = f"{_LABELS}[-1]"
_PAIR = f"(coalesce({_LABELS}[-2], '') || '.' || {_LAST})"
_SUFFIX_N = f"""(CASE WHEN {_PAIR} = 'kawasaki.jp' AND {_LABELS}[-3] = 'city' THEN 2 WHEN {_PAIR} = 'kawasaki.jp' THEN 3
  WHEN {_PAIR} IN ('co.in', 'ac.in', 'com.au', 'com.vn', 'com.ph', 'com.pl', 'co.at', 'com.co', 'com.eg', 'com.qa', 'com.gh') OR {_LAST} = 'np' THEN 2
  WHEN {_LAST} IN ('in', 'tech', 'de', 'com', 'insure', 'dental', 'vn', 'at') THEN 1 END)"""
_DOMAIN = f"(CASE WHEN len({_LABELS}) > {_SUFFIX_N} THEN array_to_string({_LABELS}[len({_LABELS}) - {_SUFFIX_N}:len({_LABELS})], '.') END)"
_NUMS = r"list_transform(regexp_extract_all(replace(coalesce(size_raw, ''), ',', ''), '\d+'), lambda x: x::INTEGER)"
_BAND = f"CASE WHEN len({_NUMS}) = 0 THEN NULL WHEN list_min({_NUMS}) < 10 THEN '<10' WHEN list_min({_NUMS}) < 50 THEN '10-49' WHEN list_min({_NUMS}) < 250 THEN '50-249' ELSE '250+' END"
_HEAD = f"(CASE WHEN len({_NUMS}) >= 2 THEN ({_NUMS}[1] + {_NUMS}[2]) // 2 WHEN len({_NUMS}) = 1 THEN {_NUMS}[1] END)::INTEGER"
_BUCKET = "CASE WHEN headcount <= 100 THEN '1-100' WHEN headcount <= 500 THEN '100-500' WHEN headcount <= 1000 THEN '500-1000' END"
_YEAR = r"nullif(regexp_extract(lower(trim(founded_raw)), '\b(19\d{2}|20\d{2})\b', 1), '')::INTEGER"
_AGO = r"nullif(regexp_extract(lower(trim(founded_raw)), '(\d{1,2})\s*\+?\s*years?', 1), '')::INTEGER"
_DEC = "(CASE WHEN lower(founded_raw) LIKE '%one decade%' OR lower(founded_raw) LIKE '%a decade%' THEN 10 WHEN lower(founded_raw) LIKE '%two decade%' THEN 20 WHEN lower(founded_raw) LIKE '%three decades%' THEN 30 WHEN lower(founded_raw) LIKE '%four decades%' THEN 40 END)"
_NOTE = f"""(CASE WHEN coalesce(founded_raw, '') = '' OR {_YEAR} IS NOT NULL THEN NULL WHEN {_AGO} IS NOT NULL THEN 'approx from ''' || trim(founded_raw) || ''''
  WHEN {_DEC} IS NOT NULL THEN '~' || ({AS_OF} - {_DEC}) || ' (verify) from ''' || trim(founded_raw) || '''' ELSE 'unparsed founded ''' || trim(founded_raw) || '''' END)"""
_KEYED = f"""k AS (SELECT *, {_DOMAIN} AS domain, {_BAND} AS band, coalesce({_YEAR}, {AS_OF} - {_AGO}, {AS_OF} - {_DEC})::INTEGER AS fyear, ({_YEAR} IS NULL AND coalesce({_AGO}, {_DEC}) IS NOT NULL) AS approx, {_NOTE} AS note FROM listings)"""
_GENERIC = "[" + ",".join(f"'{t}'" for t in firm.GENERIC_TOKENS) + "]"


def _core_sql(c: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split_regex(regexp_replace(lower({c}), '[^a-z0-9 ]', ' ', 'g'), ' +'), lambda t: t <> '' AND NOT list_contains({_GENERIC}, t))))"


_COMPANIES = f"""{_KEYED},
nm AS (SELECT domain, arg_max(name, r) AS company_name FROM (SELECT domain, trim(company_name) AS name, {{'n': count(*), 'l': length(trim(company_name)), 'o': -min(ordinal)}} AS r FROM k WHERE domain IS NOT NULL AND trim(company_name) <> '' GROUP BY 1, 2) GROUP BY 1),
sr AS (SELECT domain, list(source ORDER BY seen) AS sources FROM (SELECT domain, source, min(ordinal) AS seen FROM k WHERE domain IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT domain, arg_min(website_raw, ordinal) FILTER (WHERE coalesce(website_raw, '') <> '') AS website, arg_min(city, ordinal) FILTER (WHERE coalesce(city, '') <> '') AS city,
   arg_min(segment_raw, ordinal) FILTER (WHERE coalesce(segment_raw, '') <> '') AS segment, arg_min(hq_raw, ordinal) FILTER (WHERE coalesce(hq_raw, '') <> '') AS hq_country,
   arg_min(struct_pack(y := fyear, n := note, r := founded_raw), (CASE WHEN approx THEN 1 ELSE 0 END) * 1000000000000 + ordinal) FILTER (WHERE fyear IS NOT NULL) AS f,
   arg_min(struct_pack(b := band, r := size_raw), ordinal) FILTER (WHERE band IS NOT NULL) AS s, count(*) AS n_listings FROM k WHERE domain IS NOT NULL GROUP BY domain),
c AS (SELECT g.domain, website, city, segment, hq_country, f.y AS founded_year, f.r AS founded_source, f.n AS founded_note, s.b AS size_band, s.r AS size_source, n_listings, company_name, sources FROM g LEFT JOIN nm USING (domain) LEFT JOIN sr USING (domain))"""


def _common(a: str, b: str) -> str:
    """Length of the longest common subsequence of two short texts: the longest of all selections of a that b holds in order."""
    picked = f"list_transform(list_filter(range(0, length({a})), lambda i: ((m >> i) & 1) = 1), lambda i: substr({a}, (i + 1)::INTEGER, 1))"
    return f"list_max(list_transform(range(0, 1 << length({a})), lambda m: CASE WHEN {b} LIKE '%' || array_to_string({picked}, '%') || '%' THEN bit_count(m) ELSE 0 END))"


# Cores are a number and a word here, so the score of close ones follows from the common subsequence of the numbers alone.
_KNOWN_NAMES = f"""kx AS (SELECT name, x, regexp_extract(x, '^([0-9]+) firm$', 1) AS dx FROM (SELECT name, array_to_string({_core_sql('name')}, ' ') AS x FROM asked)),
ky AS (SELECT ordinal, name, y, regexp_extract(y, '^([0-9]+) firm$', 1) AS dy FROM (SELECT ordinal, name, array_to_string({_core_sql('name')}, ' ') AS y FROM exclusions)),
kd AS (SELECT dx, dy FROM (SELECT DISTINCT dx FROM kx WHERE dx <> ''), (SELECT DISTINCT dy FROM ky WHERE dy <> '') WHERE 200.0 * (5 + {_common('dx', 'dy')}) / (10 + length(dx) + length(dy)) >= 92),
kn AS (SELECT name, arg_min(known, ordinal) AS known FROM (SELECT kx.name, ky.ordinal, ky.name AS known FROM kx JOIN ky ON x = y WHERE x <> '' UNION ALL SELECT kx.name, ky.ordinal, ky.name FROM kd JOIN kx USING (dx) JOIN ky USING (dy)) GROUP BY name)"""
_WORDISH = r"[\p{L}\p{N}_]"
_EDGE_SQL = lambda sign, at: f"CASE WHEN regexp_matches(y, '{'^' + sign if at else sign + '$'}') THEN '{'(^|[^' if at else '($|[^'}\\p{{L}}\\p{{N}}_])' ELSE '{sign}' END"
_BLOCKED_NAMES = f"""bx AS (SELECT name, x, string_split_regex(x, ' +') AS tx, regexp_extract(x, '^firm ([0-9]+) technologies$', 1) AS dx FROM (SELECT name, lower(trim(name)) AS x FROM asked) WHERE x <> ''),
by_ AS (SELECT ordinal, term, lower(trim(term)) AS y, string_split_regex(lower(trim(term)), ' +') AS ty, regexp_extract(lower(trim(term)), '^firm ([0-9]+) technologies$', 1) AS dy FROM outsourcers),
bp AS (SELECT *, {_EDGE_SQL(_WORDISH, True)} || regexp_escape(y) || {_EDGE_SQL(_WORDISH, False)} AS pattern FROM by_),
bn AS (SELECT name, arg_min(term, ordinal) AS term FROM bx JOIN bp ON (contains(x, y) AND regexp_matches(x, pattern)) OR list_has_all(tx, ty) OR list_has_all(ty, tx) OR (dx <> '' AND dy <> '' AND (200.0 * (18 + {_common('dx', 'dy')}) / (36 + length(dx) + length(dy)) >= 90 OR 200.0 * 17 / (35 + least(length(dx), length(dy))) >= 90)) GROUP BY name)"""
_GATED = f"""{_COMPANIES},
asked AS (SELECT DISTINCT company_name AS name FROM c WHERE company_name IS NOT NULL),
{_KNOWN_NAMES},
{_BLOCKED_NAMES},
x AS (SELECT DISTINCT domain FROM exclusions WHERE domain IS NOT NULL),
h AS (SELECT c.* REPLACE (coalesce(hq_country, 'India') AS hq_country), x.domain IS NOT NULL AS known, kn.known AS known_name, bn.term, {_HEAD.replace("size_raw", "size_source")} AS headcount
  FROM c LEFT JOIN x ON c.domain = x.domain LEFT JOIN kn ON c.company_name = kn.name LEFT JOIN bn ON c.company_name = bn.name),
b AS (SELECT *, {_BUCKET} AS size_bucket FROM h),
r AS (SELECT *, list_filter([CASE WHEN known THEN 'already-known firm (domain)' END, 'already-known firm (' || known_name || ')', 'blocklisted outsourcer (' || term || ')',
  CASE WHEN founded_year IS NULL THEN 'founded year unknown' WHEN founded_year > 2020 THEN 'founded ' || founded_year || ' > 2020' END,
  CASE WHEN headcount IS NULL THEN 'size unknown' WHEN headcount < 30 THEN 'size ~' || headcount || ' below floor 30' WHEN size_bucket IS NULL THEN 'size ~' || headcount || ' above ceiling 1000' END], lambda v: v IS NOT NULL) AS reasons,
  list_filter([founded_note, CASE WHEN lower(trim(hq_country)) <> 'india' THEN 'foreign-incorporated (' || hq_country || '); India-delivery assumed' END, CASE WHEN headcount BETWEEN 900 AND 1000 THEN 'near 1000 headcount ceiling' END], lambda v: v IS NOT NULL) AS notes FROM b),
gated AS (SELECT domain, website, city, segment, hq_country, founded_year, founded_source, founded_note, size_band, size_source, n_listings, company_name, sources, size_bucket, len(reasons) = 0 AS gate_pass, nullif(array_to_string(list_concat(reasons, notes), '; '), '') AS gate_reason FROM r)"""


def _keyed(spark, d):
    return resolve.with_keys(T(spark, d, "listings"), AS_OF)


def _companies(spark, d):
    return resolve.dedupe(T(spark, d, "listings"), AS_OF)


def _gated(spark, d, reasons=True, also=None):
    """Gated firms; without reasons for those of whom only verdicts are asked, and with ``also`` only with what gates read of them and these columns."""
    known, firms = T(spark, d, "exclusions"), _companies(spark, d)
    firms = firms if also is None else firms.select(*gates.READ, *also)
    return gates.apply_gates(firms, known.where("domain IS NOT NULL"), known.select("ordinal", "name"), T(spark, d, "outsourcers"), reasons=reasons)


# Scans and sources


@query("SELECT ordinal, source, source_url, company_name, website_raw, city, founded_raw, size_raw, segment_raw, hq_raw FROM listings")
def scan_listings(spark, d):
    return T(spark, d, "listings")


@query(f"WITH {_GATED} SELECT domain, company_name, size_bucket FROM gated WHERE gate_pass")
def gate_pass_scan(spark, d):
    return _gated(spark, d, False, ()).where("gate_pass").select("domain", "company_name", "size_bucket")


@query(f"WITH {_COMPANIES} SELECT e.ordinal, c.domain, c.company_name FROM exclusions e JOIN c ON e.domain = c.domain")
def company_lookup(spark, d):
    return T(spark, d, "exclusions").join(_companies(spark, d), "domain").select("ordinal", "domain", "company_name")


@query("""SELECT s.source, lower(replace(trim(n_name), ' ', '-')) AS slug, p.page::INTEGER AS page, 'https://' || s.source || '.example/' || CASE WHEN trim(n_name) = 'UNITED STATES' THEN 'usa' ELSE lower(replace(trim(n_name), ' ', '-')) END || '?page=' || (CASE WHEN s.source = 'south' THEN p.page - 1 ELSE p.page END) AS url
FROM (SELECT unnest(['north', 'south', 'east']) AS source) s, nation, (SELECT unnest(range(1, 13)) AS page) p WHERE s.source <> 'east' OR p.page = 1""")
def page_url_grid(spark, d):
    """Sources, cities and pages: a configured grid, made by nested sequences in one row's expression."""
    cities = T(spark, d, "nation").select(F.trim("n_name").alias("city"))
    grid = cities.select("city", F.explode(F.array(*map(F.lit, ("north", "south", "east")))).alias("source"))
    grid = grid.select("city", "source", F.explode(F.sequence(F.lit(1), F.when(F.col("source") == "east", 1).otherwise(12))).alias("page"))
    number = F.when(F.col("source") == "south", F.col("page") - 1).otherwise(F.col("page"))
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), firm.city_slug(F.col("city"), {"united states": "usa"}), F.lit("?page="), number.cast("string"))
    return grid.select("source", firm.city_slug(F.col("city"), {}).alias("slug"), "page", url.alias("url"))


# Texts that give a bot check away.
BLOCK_MARKERS = ("cf-browser-verification", "Checking your browser before accessing", "Just a moment...", "Attention Required! | Cloudflare", "Please enable JavaScript and cookies")
_BLOCKED = " OR ".join(f"contains(substr(html, 1, 4000), '{m}')" for m in BLOCK_MARKERS)


@query(f"SELECT page_id, coalesce({_BLOCKED}, false) AS blocked FROM pages")
def page_blocked_filter(spark, d):
    head = F.substr("html", F.lit(1), F.lit(4000))
    hit = F.exists(F.array(*map(F.lit, BLOCK_MARKERS)), lambda m: F.contains(head, m))
    return T(spark, d, "pages").select("page_id", F.coalesce(hit, F.lit(False)).alias("blocked"))


@query("""WITH p AS (SELECT o_orderstatus AS source, o_custkey AS city, row_number() OVER (PARTITION BY o_orderstatus, o_custkey ORDER BY o_orderkey) AS page, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 48 END AS n FROM orders),
e AS (SELECT source, city, min(page) AS stop FROM p WHERE n = 0 GROUP BY 1, 2)
SELECT p.source, p.city, count(*)::BIGINT AS pages, sum(n)::BIGINT AS n_rows FROM p LEFT JOIN e ON p.source = e.source AND p.city = e.city WHERE e.stop IS NULL OR p.page < e.stop GROUP BY 1, 2""")
def pagination_cutoff(spark, d):
    w = Window.partitionBy("source", "city").orderBy("o_orderkey")
    rows = T(spark, d, "orders").select(F.col("o_orderstatus").alias("source"), F.col("o_custkey").alias("city"), "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, 0).otherwise(F.col("o_orderkey") % 48).alias("n"))
    paged = rows.withColumn("page", F.row_number().over(w)).withColumn("stop", F.min(F.when(F.col("n") == 0, F.col("page"))).over(Window.partitionBy("source", "city")))
    return paged.where("stop IS NULL OR page < stop").groupBy("source", "city").agg(F.count("*").alias("pages"), F.sum("n").alias("n_rows"))


@query(r"""SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '\s+', ' ', 'g')), '') AS title, nullif(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]+)', 1), '') AS host,
len(regexp_extract_all(html, '<a href="'))::BIGINT AS n_links FROM pages""")
def page_title_parse(spark, d):
    title = F.trim(F.regexp_replace(F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1), r"\s+", " "))
    return T(spark, d, "pages").select("page_id", F.nullif(title, F.lit("")).alias("title"), F.nullif(F.regexp_extract(F.lower(F.trim("url")), firm.HOST, 1), F.lit("")).alias("host"), F.regexp_count("html", F.lit('<a href="')).cast("long").alias("n_links"))


@query(r"""SELECT page_id, u.pos AS pos, regexp_extract(u.card, 'href="([^"]*)"', 1) AS href, trim(regexp_replace(regexp_replace(u.card, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS label
FROM (SELECT page_id, unnest(list_transform(regexp_extract_all(html, '<li>.*?</li>'), lambda x, i: struct_pack(card := x, pos := (i - 1)::INTEGER))) AS u FROM pages)
WHERE trim(regexp_replace(regexp_replace(u.card, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) <> ''""")
def card_parse(spark, d):
    """List cards of a page as rows; cards without a label go."""
    cards = T(spark, d, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit("<li>.*?</li>"), F.lit(0))).alias("pos", "card"))
    label = F.trim(F.regexp_replace(F.regexp_replace("card", "<[^>]*>", ""), r"\s+", " "))
    return cards.select("page_id", "pos", F.regexp_extract("card", 'href="([^"]*)"', 1).alias("href"), label.alias("label")).where("label <> ''")


# Scalars over listings


@query(f"SELECT ordinal, {_DOMAIN} AS domain FROM listings")
def canonical_domain(spark, d):
    return domains.registered(T(spark, d, "listings").select("ordinal", "website_raw"), F.col("website_raw")).select("ordinal", "domain")


@query(f"WITH {_KEYED} SELECT ordinal, fyear AS year, approx, note FROM k")
def founded_normalize(spark, d):
    return _keyed(spark, d).select("ordinal", "founded.year", "founded.approx", "founded.note")


@query(f"SELECT ordinal, {_BAND} AS band FROM listings")
def size_band(spark, d):
    return T(spark, d, "listings").select("ordinal", firm.size_band(F.col("size_raw")).alias("band"))


@query(f"WITH k AS (SELECT ordinal, coalesce({_HEAD}, CASE WHEN ordinal % 2 = 0 THEN 150 END)::INTEGER AS headcount FROM listings) SELECT * FROM k")
def size_headcount(spark, d):
    band = F.when(F.col("ordinal") % 2 == 0, "50-249")
    return T(spark, d, "listings").select("ordinal", firm.size_headcount(F.col("size_raw"), band).alias("headcount"))


@query(f"WITH k AS (SELECT ordinal, {_HEAD} AS headcount FROM listings) SELECT ordinal, {_BUCKET} AS bucket FROM k")
def size_bucket(spark, d):
    return T(spark, d, "listings").select("ordinal", firm.size_bucket(firm.size_headcount(F.col("size_raw"), F.lit(None).cast("string"))).alias("bucket"))


@query(f"SELECT ordinal, {_core_sql('company_name')} AS core FROM listings")
def company_core_tokens(spark, d):
    return T(spark, d, "listings").select("ordinal", firm.core_tokens(F.col("company_name")).alias("core"))


@query("SELECT ordinal, coalesce(nullif(regexp_extract(website_raw, '(https?://[^\\s\"''<>]+)', 1), ''), nullif(trim(website_raw), '')) AS website FROM listings")
def clean_website(spark, d):
    return T(spark, d, "listings").select("ordinal", firm.clean_website(F.col("website_raw")).alias("website"))


@query("SELECT ordinal, trim(split_part(city, ',', 1)) AS city FROM listings")
def city_first_token(spark, d):
    return T(spark, d, "listings").select("ordinal", firm.city_first_token(F.col("city")).alias("city"))


@query("SELECT ordinal, sha1(source || '|' || source_url) AS key FROM listings")
def content_key(spark, d):
    return T(spark, d, "listings").select("ordinal", firm.content_key(F.col("source"), F.col("source_url")).alias("key"))


# Scalars over people

_E164 = """CASE WHEN p = '' OR p IS NULL THEN NULL WHEN phone_raw LIKE '+%' THEN '+' || p WHEN p LIKE '00%' THEN '+' || substr(p, 3) WHEN p LIKE '91%' AND length(p) > 10 THEN '+' || p
WHEN p LIKE '0%' AND length(p) = 11 THEN '+91' || substr(p, 2) WHEN length(p) = 10 THEN '+91' || p END"""
_PHONES = f"q AS (SELECT *, {_E164} AS phone FROM (SELECT *, regexp_replace(phone_raw, '[^0-9]', '', 'g') AS p FROM people))"
_HAS = "(name NOT IN ('', '(verify)')) AS f1, coalesce(linkedin_url, '') <> '' AS f2, coalesce(phone, '') <> '' AS f3, coalesce(email, '') <> '' AS f4"


def _phoned(rows):
    return rows.withColumn("phone", contact.e164(F.col("phone_raw")))


def _people(spark, d):
    return _phoned(T(spark, d, "people"))


def _firsts(spark, d):
    """The first person of each firm; phones are read after the choice."""
    return _phoned(people.ranked(T(spark, d, "people")).where("is_primary"))


@query(f"WITH {_PHONES} SELECT domain, ordinal, phone FROM q")
def phone_e164(spark, d):
    return _people(spark, d).select("domain", "ordinal", "phone")


@query(f"WITH {_PHONES} SELECT domain, ordinal, CASE WHEN phone LIKE '+%' THEN '''' || phone ELSE coalesce(phone, '') END AS cell FROM q")
def safe_phone(spark, d):
    return _people(spark, d).select("domain", "ordinal", contact.sheet_phone(F.col("phone")).alias("cell"))


@query(f"WITH {_PHONES} SELECT domain, ordinal, list_filter([CASE WHEN NOT f1 THEN 'Founder' END, CASE WHEN NOT f2 THEN 'LinkedIn' END, CASE WHEN NOT f3 THEN 'Phone' END, CASE WHEN NOT f4 THEN 'Email' END], lambda x: x IS NOT NULL) AS missing FROM (SELECT *, {_HAS} FROM q)")
def missing_fields(spark, d):
    return _people(spark, d).select("domain", "ordinal", contact.missing_fields(*map(F.col, ("name", "linkedin_url", "phone", "email"))).alias("missing"))


_RANKED = f"{_PHONES}, rk AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ordinal)::INTEGER AS rank, {_HAS} FROM q)"


@query(f"WITH {_RANKED} SELECT domain, name FROM rk WHERE rank = 1 AND f1 AND f2 AND f3 AND f4")
def qualified_filter(spark, d):
    return _firsts(spark, d).where(contact.is_full(*map(F.col, ("name", "linkedin_url", "phone", "email")))).select("domain", "name")


@query("SELECT domain, ordinal, split_part(trim(name), ' ', 1) AS first, CASE WHEN contains(trim(name), ' ') THEN substr(trim(name), strpos(trim(name), ' ') + 1) ELSE '' END AS last FROM people")
def name_split(spark, d):
    return T(spark, d, "people").select("domain", "ordinal", contact.name_split(F.col("name")).alias("n")).select("domain", "ordinal", "n.first", "n.last")


_SOURCES = r"(CASE WHEN len(l) > 0 THEN l WHEN coalesce(name_source, '') <> '' THEN [lower(name_source)] ELSE [] END)"
_SRC = r"""s AS (SELECT *, list_filter(list_transform(string_split(regexp_extract(coalesce(notes, ''), '(?i)sources:\s*([a-z_,\s]+)', 1), ','), lambda x: lower(trim(x))), lambda x: x <> '') AS l FROM people),
t AS (SELECT *, list_sort(list_distinct(CASE WHEN len(l) > 0 THEN l ELSE [lower(name_source)] END)) AS sources FROM s),
sc AS (SELECT *, CASE WHEN trim(name) IN ('', '(verify)') OR (len(sources) > 0 AND len(list_filter(sources, lambda x: x <> 'directory')) = 0) THEN 'red'
  WHEN len(list_filter(sources, lambda x: x IN ('registry', 'company_site'))) >= 2 AND NOT (coalesce(linkedin_url, '') <> '' AND NOT coalesce(linkedin_confirmed, false)) THEN 'green' ELSE 'amber' END AS confidence FROM t)"""


@query(f"WITH {_SRC} SELECT domain, ordinal, sources FROM sc")
def provenance_sets(spark, d):
    return people.scored(T(spark, d, "people")).select("domain", "ordinal", "sources")


@query(f"WITH {_SRC} SELECT domain, ordinal, confidence FROM sc")
def confidence_score(spark, d):
    return people.scored(T(spark, d, "people")).select("domain", "ordinal", "confidence")


@query(f"WITH {_SRC} SELECT confidence, count(*)::BIGINT AS n FROM sc GROUP BY 1")
def tier_counts(spark, d):
    return people.scored(T(spark, d, "people")).groupBy("confidence").agg(F.count("*").alias("n"))


@query("SELECT domain, ordinal, array_to_string(list_filter(list_transform(string_split(coalesce(notes, ''), ';'), lambda x: trim(x)), lambda x: x <> '' AND NOT starts_with(lower(x), 'sources:')), '; ') AS note FROM people")
def strip_sources(spark, d):
    return T(spark, d, "people").select("domain", "ordinal", provenance.strip_sources(F.col("notes")).alias("note"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ordinal) AS rank FROM people) SELECT domain, rank::INTEGER AS rank, name, rank = 1 AS is_primary FROM r WHERE rank <= 2")
def top2_people(spark, d):
    return people.top(T(spark, d, "people")).select("domain", "rank", "name", "is_primary")


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ordinal) AS rank FROM people) SELECT domain, ordinal, rank = 1 AS is_primary FROM r")
def primary_flag(spark, d):
    return people.ranked(T(spark, d, "people")).select("domain", "ordinal", "is_primary")


@query(f"WITH {_RANKED} SELECT domain, max(name) FILTER (WHERE rank = 1) AS name1, max(phone) FILTER (WHERE rank = 1) AS phone1, max(linkedin_url) FILTER (WHERE rank = 1) AS linkedin1, max(name) FILTER (WHERE rank = 2) AS name2, max(phone) FILTER (WHERE rank = 2) AS phone2 FROM rk WHERE rank <= 2 GROUP BY domain")
def people_pivot(spark, d):
    at = lambda c, r: F.max(F.when(F.col("rank") == r, F.col(c))).alias(f"{c.split('_')[0]}{r}")
    return _phoned(people.top(T(spark, d, "people"))).groupBy("domain").agg(at("name", 1), at("phone", 1), at("linkedin_url", 1), at("name", 2), at("phone", 2))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ordinal) AS rank FROM people)
SELECT domain, string_agg(CASE WHEN name IN ('', '(verify)') THEN '(verify)' WHEN coalesce(role, '') <> '' THEN name || ' (' || role || ')' ELSE name END, '; ' ORDER BY rank) AS cell FROM r WHERE rank <= 2 GROUP BY domain""")
def founders_cell(spark, d):
    two = people.top(T(spark, d, "people")).groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("rank", "name", "role"))).alias("p"))
    return two.select("domain", cells.founders_cell(F.col("p")).alias("cell"))


# Dedupe and gates


@query(f"WITH {_COMPANIES} SELECT domain, company_name FROM nm")
def dedupe_best_name(spark, d):
    return resolve.best_names(resolve.parts(_keyed(spark, d)))


@query(f"WITH {_COMPANIES} SELECT domain, website, city, segment FROM c")
def dedupe_first_nonempty(spark, d):
    return _companies(spark, d).select("domain", "website", "city", "segment")


@query(f"WITH {_COMPANIES} SELECT domain, founded_year, founded_source, founded_note FROM c")
def dedupe_founded_priority(spark, d):
    return _companies(spark, d).select("domain", "founded_year", "founded_source", "founded_note")


@query(f"WITH {_COMPANIES} SELECT domain, sources FROM sr")
def dedupe_sources_list(spark, d):
    return resolve.sources(resolve.parts(_keyed(spark, d)))


@query(f"WITH {_GATED} SELECT * FROM gated")
def build_companies(spark, d):
    """Flagship: listings to gated firms."""
    return _gated(spark, d)


@query(f"WITH {_GATED} SELECT domain, gate_pass, gate_reason FROM gated")
def gate_reasons(spark, d):
    return _gated(spark, d).select("domain", "gate_pass", "gate_reason")


@query(f"WITH {_KEYED} SELECT DISTINCT company_name, city, source, source_url FROM k WHERE domain IS NULL")
def quarantine_distinct(spark, d):
    return resolve.quarantine(T(spark, d, "listings"), AS_OF)


@query(f"WITH {_GATED} SELECT (SELECT count(*) FROM listings)::BIGINT AS raw, count(*)::BIGINT AS unique_firms, count(*) FILTER (WHERE gate_pass)::BIGINT AS passing, count(*) FILTER (WHERE known)::BIGINT AS already_known, (SELECT count(*) FROM k WHERE domain IS NULL)::BIGINT AS no_domain FROM gated JOIN (SELECT domain, known FROM b) USING (domain)")
def build_counters(spark, d):
    raw = T(spark, d, "listings").agg(F.count("*").alias("raw"))
    known = T(spark, d, "exclusions").where("domain IS NOT NULL").select("domain").distinct().withColumn("known", F.lit(True))
    built = _gated(spark, d, False, ["n_listings"]).join(known, "domain", "left").agg(F.count("*").alias("unique_firms"), F.count_if(F.col("gate_pass")).alias("passing"), F.count_if(F.coalesce("known", F.lit(False))).alias("already_known"), F.coalesce(F.sum("n_listings"), F.lit(0)).alias("with_domain"))
    names = ("raw", "unique_firms", "passing", "already_known", "no_domain")
    both = raw.unionByName(built, allowMissingColumns=True)  # a row of each
    # listings without a domain are those that no firm counts, so domains are worked out once
    return both.agg(*[F.max(c).alias(c) for c in ("with_domain", *names[:-1])]).withColumn("no_domain", F.col("raw") - F.col("with_domain")).select(*names)


@query(f"WITH {_COMPANIES} SELECT c.domain FROM c WHERE NOT EXISTS (SELECT 1 FROM exclusions e WHERE e.domain = c.domain)")
def exclude_domain_anti(spark, d):
    return _companies(spark, d).join(T(spark, d, "exclusions"), "domain", "left_anti").select("domain")


@query(f"""WITH a AS (SELECT DISTINCT company_name AS name, array_to_string({_core_sql('company_name')}, ' ') AS core FROM listings), b AS (SELECT array_to_string({_core_sql('name')}, ' ') AS core, min(ordinal) AS ordinal FROM exclusions GROUP BY 1)
SELECT a.name, b.ordinal FROM a JOIN b ON a.core = b.core WHERE a.core <> ''""")
def known_core_equi(spark, d):
    return gates.known_by_core(T(spark, d, "listings").select(F.col("company_name").alias("name")), T(spark, d, "exclusions"))


@query(f"WITH asked AS (SELECT DISTINCT company_name AS name FROM listings), {_KNOWN_NAMES} SELECT name, known FROM kn")
def known_fuzzy(spark, d):
    """Names against known firms, equal cores and close ones together; also held against brute force in the tests."""
    return gates.match_known(T(spark, d, "listings").select(F.col("company_name").alias("name")), T(spark, d, "exclusions"))


@query(f"WITH asked AS (SELECT DISTINCT company_name AS name FROM listings), {_BLOCKED_NAMES} SELECT name, term FROM bn")
def outsourcer_match(spark, d):
    """Names of listings against the list of outsourcers."""
    return gates.match_blocklist(T(spark, d, "listings").select(F.col("company_name").alias("name")), T(spark, d, "outsourcers"))


@query()
def blocklist_match(spark, d):
    """Names of listings against the excluded names as terms; held against brute force in the tests."""
    return gates.match_blocklist(T(spark, d, "listings").select(F.col("company_name").alias("name")), T(spark, d, "exclusions").select("ordinal", F.col("name").alias("term")))


# Joins


@query("SELECT c.domain, c.company_name, p.ordinal, p.name FROM (SELECT DISTINCT 'firm-' || o_custkey || '.co.in' AS domain, 'Firm ' || o_custkey AS company_name FROM orders) c LEFT JOIN people p ON c.domain = p.domain")
def company_people_join(spark, d):
    firms = T(spark, d, "orders").select("o_custkey").distinct().select(F.concat(F.lit("firm-"), F.col("o_custkey").cast("string"), F.lit(".co.in")).alias("domain"), F.concat(F.lit("Firm "), F.col("o_custkey").cast("string")).alias("company_name"))
    return firms.join(T(spark, d, "people"), "domain", "left").select("domain", "company_name", "ordinal", "name")


@query("""WITH m AS (SELECT lower(trim(email)) AS email, min(domain) AS domain FROM people WHERE coalesce(email, '') <> '' GROUP BY 1) SELECT f.ordinal, m.domain FROM feedback f LEFT JOIN m ON lower(trim(f.email)) = m.email WHERE trim(f.email) <> ''""")
def feedback_domain_join(spark, d):
    by_mail = T(spark, d, "people").where(firm.filled(F.col("email"))).groupBy(F.lower(F.trim("email")).alias("email")).agg(F.min("domain").alias("domain"))
    return T(spark, d, "feedback").where(F.trim("email") != "").select("ordinal", F.lower(F.trim("email")).alias("email")).join(by_mail, "email", "left").select("ordinal", "domain")


@query("SELECT coalesce(nullif(call_outcome, ''), '(notes only)') AS outcome, count(*)::BIGINT AS n FROM feedback WHERE coalesce(call_outcome, '') <> '' OR call_notes <> '' GROUP BY 1")
def feedback_histogram(spark, d):
    touched = T(spark, d, "feedback").where(firm.filled(F.col("call_outcome")) | firm.filled(F.col("call_notes")))
    return touched.groupBy(F.coalesce(F.nullif("call_outcome", F.lit("")), F.lit("(notes only)")).alias("outcome")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT p.domain FROM people p WHERE NOT EXISTS (SELECT 1 FROM deals x WHERE x.domain = lower(p.domain) AND x.stage_id <> 'unknown')")
def create_missing_deals(spark, d):
    have = T(spark, d, "deals").where("stage_id <> 'unknown'").select("domain")
    return T(spark, d, "people").select(F.lower("domain").alias("domain")).distinct().join(have, "domain", "left_anti")


@query("SELECT x.deal_id AS from_id, p.ordinal AS to_id FROM deals x JOIN people p ON x.domain = p.domain WHERE coalesce(p.email, '') <> ''")
def association_edges(spark, d):
    return T(spark, d, "deals").join(T(spark, d, "people").where(firm.filled(F.col("email"))), "domain").select(F.col("deal_id").alias("from_id"), F.col("ordinal").alias("to_id"))


@query(f"WITH {_COMPANIES} SELECT c.domain FROM c WHERE NOT EXISTS (SELECT 1 FROM exclusions e WHERE e.domain = c.domain) AND NOT EXISTS (SELECT 1 FROM exclusions e WHERE lower(e.name) = lower(c.company_name)) AND c.company_name IS NOT NULL")
def net_new_anti(spark, d):
    ex = T(spark, d, "exclusions")
    named = _companies(spark, d).where("company_name IS NOT NULL").withColumn("lower_name", F.lower("company_name"))
    return named.join(ex.select("domain"), "domain", "left_anti").join(ex.select(F.lower("name").alias("lower_name")), "lower_name", "left_anti").select("domain")


@query("SELECT x.deal_id, p.name, p.email, CASE WHEN p.name IS NULL THEN 'no person' WHEN coalesce(p.email, '') = '' THEN 'no email' END AS skip FROM deals x LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ordinal) AS rank FROM people) p ON x.domain = p.domain AND p.rank = 1 WHERE x.stage_id IN ('click', 'signup')")
def mail_candidates_join(spark, d):
    first = people.ranked(T(spark, d, "people")).where("is_primary").select("domain", "name", "email")
    skip = F.when(F.col("name").isNull(), "no person").when(~firm.filled(F.col("email")), "no email")
    return T(spark, d, "deals").where(F.col("stage_id").isin("click", "signup")).join(first, "domain", "left").select("deal_id", "name", "email", skip.alias("skip"))


@query("SELECT deal_id, owner FROM deals WHERE domain IN (SELECT domain FROM people)")
def crm_semi_join(spark, d):
    return T(spark, d, "deals").join(T(spark, d, "people"), "domain", "left_semi").select("deal_id", "owner")


@query("SELECT 'firm-' || o_custkey || '.co.in' AS key, CASE WHEN o_custkey % 3 = 0 THEN 'hit' ELSE 'miss' END AS state FROM (SELECT DISTINCT o_custkey FROM orders) ")
def cache_probe(spark, d):
    wanted = T(spark, d, "orders").select(F.concat(F.lit("firm-"), F.col("o_custkey").cast("string"), F.lit(".co.in")).alias("key")).distinct()
    # what an earlier run has cached: the firms that the SQL calls hits
    cache = T(spark, d, "orders").where("o_custkey % 3 = 0").select(F.concat(F.lit("firm-"), F.col("o_custkey").cast("string"), F.lit(".co.in")).alias("key")).distinct()
    return wanted.join(cache, "key", "left_semi").withColumn("state", F.lit("hit")).unionByName(wanted.join(cache, "key", "left_anti").withColumn("state", F.lit("miss")))


@query("SELECT conv_id, text FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations WHERE trim(coalesce(text, '')) <> '') WHERE r = 1")
def latest_note(spark, d):
    return T(spark, d, "conversations").where(F.trim(F.coalesce("text", F.lit(""))) != "").groupBy("conv_id").agg(F.max_by("text", "turn").alias("text"))


# Funnel

_DAY = "strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d')"
_FACT = f"fact AS (SELECT DISTINCT h.deal_id, m.metric, {_DAY} AS day, h.actor FROM stage_history h JOIN stage_dim s ON h.stage_id = s.stage_id JOIN metric_dim m ON s.label = m.stage_label WHERE s.is_won OR h.source_type = 'CRM_UI')"


def _fact(spark, d):
    return funnel.metric_events(*(T(spark, d, t) for t in ("stage_history", "stage_dim", "metric_dim")))


@query(f"WITH {_FACT} SELECT * FROM fact")
def metric_events(spark, d):
    return _fact(spark, d)


@query(f"WITH {_FACT} SELECT metric, count(*)::BIGINT AS n FROM fact WHERE day BETWEEN '{DAY_FROM}' AND '{DAY_TO}' GROUP BY 1")
def metric_counts(spark, d):
    return funnel.counts(_fact(spark, d), DAY_FROM, DAY_TO)


@query(f"WITH {_FACT} SELECT metric, actor, count(*)::BIGINT AS n FROM fact WHERE day BETWEEN '{DAY_FROM}' AND '{DAY_TO}' GROUP BY 1, 2")
def per_owner_metrics(spark, d):
    return funnel.per_owner(_fact(spark, d), DAY_FROM, DAY_TO)


_WEEKS = f"wk AS (SELECT DISTINCT h.deal_id, date_trunc('week', {_DAY}::TIMESTAMP)::DATE AS week FROM stage_history h JOIN stage_dim s ON h.stage_id = s.stage_id WHERE s.is_won), wa AS (SELECT week, count(*)::BIGINT AS n_deals, sum(amount) AS amount FROM wk JOIN deals USING (deal_id) GROUP BY 1)"


@query(f"WITH {_WEEKS} SELECT week, n_deals, amount FROM wa")
def won_loc_by_week(spark, d):
    return funnel.won_amount_by_week(*(T(spark, d, t) for t in ("stage_history", "stage_dim", "deals")))


@query(f"WITH {_WEEKS} SELECT week, n_deals, sum(n_deals) OVER (ORDER BY week)::BIGINT AS running FROM wa WHERE week <= DATE '2024-01-22'")
def sprint_rollup(spark, d):
    weeks = funnel.won_amount_by_week(*(T(spark, d, t) for t in ("stage_history", "stage_dim", "deals"))).where("week <= DATE '2024-01-22'")
    return weeks.select("week", "n_deals", F.sum("n_deals").over(Window.orderBy("week")).alias("running"))


@query("SELECT segment, count(*)::BIGINT AS n, sum(amount) / 1e6 AS amount_m FROM deals x JOIN stage_dim s ON x.stage_id = s.stage_id WHERE NOT s.is_won AND NOT s.is_closed GROUP BY 1")
def open_pipeline_loc(spark, d):
    open_stages = T(spark, d, "stage_dim").where("NOT is_won AND NOT is_closed").select("stage_id")
    return T(spark, d, "deals").join(open_stages, "stage_id").groupBy("segment").agg(F.count("*").alias("n"), (F.sum("amount") / 1e6).alias("amount_m"))


@query(f"SELECT x.deal_id, coalesce(list_sort(list(DISTINCT {_DAY}) FILTER (WHERE h.actor = x.owner)), [any_value(x.created_day)]) AS days FROM deals x LEFT JOIN stage_history h ON x.deal_id = h.deal_id GROUP BY 1")
def assignment_days(spark, d):
    """Days on which a deal went to the owner it has now, else its day of creation."""
    own = T(spark, d, "stage_history").join(T(spark, d, "deals").select("deal_id", "owner"), "deal_id").where("actor = owner").select("deal_id", dates.local_day(F.col("ts")).alias("day")).distinct()
    days = own.groupBy("deal_id").agg(F.array_sort(F.collect_list("day")).alias("days"))
    return T(spark, d, "deals").select("deal_id", "created_day").join(days, "deal_id", "left").select("deal_id", F.coalesce("days", F.array("created_day")).alias("days"))


@query("SELECT deal_id, coalesce(o.label, CAST(owner AS VARCHAR)) AS owner_name FROM deals LEFT JOIN (VALUES (1, 'Asha'), (2, 'Ben')) AS o(id, label) ON owner = o.id")
def owner_fallback(spark, d):
    names = spark.createDataFrame([(1, "Asha"), (2, "Ben")], "id long, label string")
    return T(spark, d, "deals").join(F.broadcast(names), F.col("owner") == F.col("id"), "left").select("deal_id", F.coalesce("label", F.col("owner").cast("string")).alias("owner_name"))


@query("SELECT x.deal_id, s.label, s.depth FROM deals x JOIN stage_dim s ON x.stage_id = s.stage_id WHERE x.owner IS NOT NULL")
def known_stage_filter(spark, d):
    return T(spark, d, "deals").where("owner IS NOT NULL").join(T(spark, d, "stage_dim"), "stage_id").select("deal_id", "label", "depth")


@query("SELECT x.deal_id FROM deals x JOIN stage_dim s ON x.stage_id = s.stage_id WHERE NOT s.is_won AND NOT s.is_closed")
def open_deals_filter(spark, d):
    return T(spark, d, "deals").join(T(spark, d, "stage_dim").where("NOT is_won AND NOT is_closed"), "stage_id").select("deal_id")


@query(f"SELECT event_id, {_DAY} AS day FROM stage_history WHERE {_DAY} BETWEEN '{DAY_FROM}' AND '{DAY_TO}'")
def date_range_filter(spark, d):
    return T(spark, d, "stage_history").select("event_id", dates.local_day(F.col("ts")).alias("day")).where(F.col("day").between(DAY_FROM, DAY_TO))


@query("SELECT deal_id, pipeline, CASE pipeline WHEN 'scraped' THEN 'cold' ELSE 'warm' END AS tag FROM deals WHERE pipeline IN ('scraped', 'campaign')")
def pipelines_tagged_union(spark, d):
    both = T(spark, d, "deals").where(F.col("pipeline").isin("scraped", "campaign"))
    return both.select("deal_id", "pipeline", F.when(F.col("pipeline") == "scraped", "cold").otherwise("warm").alias("tag"))


@query("SELECT deal_id, coalesce(try_cast(nullif(trim(loc_text), '') AS DOUBLE), 0.0) AS loc FROM deals")
def numeric_or_zero(spark, d):
    return T(spark, d, "deals").select("deal_id", cells.number_or_zero(F.col("loc_text")).alias("loc"))


@query("SELECT deal_id, coalesce(CASE WHEN contains(lower(coalesce(lead_source, '')), 'indonesia') THEN 'Indonesia' WHEN contains(lower(coalesce(lead_source, '')), 'india') THEN 'India' END, 'Untagged') AS region FROM deals")
def region_bucket(spark, d):
    return T(spark, d, "deals").select("deal_id", F.coalesce(cells.region_bucket(F.col("lead_source")), F.lit("Untagged")).alias("region"))


@query("""SELECT event_id, coalesce(a.label, r.raw) AS label FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Call Attempted' WHEN 1 THEN 'Dead/Gmeet/Privacy Concerns' WHEN 2 THEN 'Call Attempted (retired)' WHEN 3 THEN s.label END AS raw FROM stage_history h LEFT JOIN stage_dim s ON h.stage_id = s.stage_id) r
LEFT JOIN (VALUES ('Call Attempted', 'No Pickup'), ('Call Attempted (retired)', 'No Pickup'), ('Dead/Gmeet/Privacy Concerns', 'Dead/GMeet/Privacy Concerns')) AS a(raw, label) ON r.raw = a.raw""")
def label_alias(spark, d):
    """Labels of stages as they are called now, whatever they were called when an event came."""
    k = F.col("event_id") % 5
    found = T(spark, d, "stage_history").join(T(spark, d, "stage_dim").select("stage_id", "label"), "stage_id", "left")
    raw = F.when(k == 0, "Call Attempted").when(k == 1, "Dead/Gmeet/Privacy Concerns").when(k == 2, "Call Attempted (retired)").when(k == 3, F.col("label"))
    return found.select("event_id", funnel.current_label(raw).alias("label"))


@query("SELECT x.deal_id, coalesce(s.depth, 0)::INTEGER AS depth FROM deals x LEFT JOIN stage_dim s ON x.stage_id = s.stage_id")
def stage_depth(spark, d):
    return T(spark, d, "deals").join(T(spark, d, "stage_dim").select("stage_id", "depth"), "stage_id", "left").select("deal_id", F.coalesce("depth", F.lit(0)).alias("depth"))


# Dates


@query(f"SELECT event_id, {_DAY} AS day FROM events")
def local_day_shift(spark, d):
    return T(spark, d, "events").select("event_id", dates.local_day(F.col("ts")).alias("day"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def epoch_millis(spark, d):
    return T(spark, d, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))


@query("SELECT event_id, date_trunc('week', ts)::DATE AS week FROM events")
def week_start(spark, d):
    return T(spark, d, "events").select("event_id", dates.week_start(F.col("ts")).alias("week"))


@query("SELECT event_id, (list_filter(list_transform(range(1, 12), lambda i: ts::DATE + i::INTEGER), lambda x: isodow(x) < 6)[2])::TIMESTAMP + INTERVAL 5 HOUR AS due FROM events")
def next_business_day(spark, d):
    return T(spark, d, "events").select("event_id", dates.next_business_day(F.col("ts"), 2).alias("due"))


@query("SELECT event_id, greatest(1, len(list_filter(list_transform(range(0, greatest(0, (DATE '2024-01-31' - ts::DATE) + 1)), lambda i: ts::DATE + i::INTEGER), lambda x: isodow(x) < 6)))::INTEGER AS n FROM events")
def working_days(spark, d):
    return T(spark, d, "events").select("event_id", dates.working_days(F.col("ts").cast("date"), F.lit("2024-01-31").cast("date")).alias("n"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS daily, strftime(ts, '%Y-%m') AS monthly, 'all' AS ever FROM events")
def quota_window_key(spark, d):
    return T(spark, d, "events").select("event_id", *[dates.window_key(F.col("ts"), r).alias(a) for r, a in (("daily", "daily"), ("monthly", "monthly"), ("none", "ever"))])


@query("SELECT c_custkey, round_even(c_acctbal * 3 / 5, 0) AS target FROM customer")
def prorated_target(spark, d):
    return T(spark, d, "customer").select("c_custkey", F.bround(F.col("c_acctbal") * 3 / 5, 0).alias("target"))


# Cells and text


@query("""SELECT ordinal, '=HYPERLINK("' || source_url || '","' || replace(company_name, '"', '""') || '")' AS cell FROM listings""")
def hyperlink_build(spark, d):
    return T(spark, d, "listings").select("ordinal", cells.hyperlink(F.col("source_url"), F.col("company_name")).alias("cell"))


@query("""SELECT ordinal, company_name AS display, CASE WHEN ordinal % 2 = 0 THEN source_url END AS url FROM listings""")
def hyperlink_unwrap(spark, d):
    cell = F.when(F.col("ordinal") % 2 == 0, cells.hyperlink(F.col("source_url"), F.col("company_name"))).otherwise(F.col("company_name"))
    return T(spark, d, "listings").select("ordinal", cells.unwrap_hyperlink(cell).alias("u")).select("ordinal", "u.display", "u.url")


@query("""SELECT ordinal, CASE WHEN coalesce(website_raw, '') = '' THEN 'https://search.example/?q=' || replace(replace(replace(replace(trim(company_name || ' ' || coalesce(city, '') || ' software company'), '(', '%28'), ')', '%29'), ',', '%2C'), ' ', '+')
WHEN contains(website_raw, '://') THEN website_raw ELSE 'https://' || website_raw END AS url FROM listings""")
def resolver_url(spark, d):
    return T(spark, d, "listings").select("ordinal", cells.resolver_url(F.col("website_raw"), F.col("company_name"), F.col("city"), "https://search.example/?q=").alias("url"))


_LABELS = {"north": "North Directory", "south": "South Directory"}


@query(f"""WITH {_COMPANIES}, l AS (SELECT domain, size_band, trim(coalesce(size_source, '')) AS t, array_to_string(list_transform(sources, lambda s: CASE s WHEN 'north' THEN 'North Directory' WHEN 'south' THEN 'South Directory' ELSE upper(s[1]) || s[2:] END), '; ') AS base FROM c)
SELECT domain, CASE WHEN t = '' OR replace(t, ' ', '') = replace(coalesce(size_band, ''), ' ', '') THEN base WHEN base <> '' THEN base || ' (' || t || ')' ELSE t END AS cell FROM l""")
def headcount_source_cell(spark, d):
    return _companies(spark, d).select("domain", cells.headcount_source(F.col("sources"), _LABELS, F.col("size_source"), F.col("size_band")).alias("cell"))


@query(f"WITH {_GATED} SELECT domain, array_to_string(list_filter([gate_reason, CASE WHEN founded_note IS DISTINCT FROM gate_reason THEN founded_note END, segment], lambda x: coalesce(x, '') <> ''), ' | ') AS cell FROM gated")
def notes_cell(spark, d):
    return _gated(spark, d).select("domain", cells.notes_cell(F.col("gate_reason"), F.col("founded_note"), F.col("segment")).alias("cell"))


@query("SELECT ordinal, 'Hi ' || CASE WHEN name IN ('', '(verify)') THEN 'there' ELSE split_part(name, ' ', 1) END || ', about ' || domain AS body FROM people")
def template_render(spark, d):
    body = cells.render(F.lit("Hi {{contact.firstname}}, about {{company.name}}"), {"{{contact.firstname}}": contact.first_name(F.col("name")), "{{company.name}}": F.col("domain")})
    return T(spark, d, "people").select("ordinal", body.alias("body"))


@query("SELECT ordinal, list_filter([CASE WHEN coalesce(role, '') <> '' THEN 'role=' || role END, CASE WHEN coalesce(email, '') <> '' THEN 'email=' || email END], lambda x: x IS NOT NULL) AS props FROM people")
def drop_empty_props(spark, d):
    props = cells.drop_empty(role=F.col("role"), email=F.col("email"))
    return T(spark, d, "people").select("ordinal", F.transform(F.map_entries(props), lambda e: F.concat(e["key"], F.lit("="), e["value"])).alias("props"))


@query("SELECT event_id, (props->>'$.k')::INTEGER AS k FROM events")
def json_extract_noisy(spark, d):
    noisy = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("Here you are: "), F.col("props"), F.lit(" done"))).otherwise(F.col("props"))
    return T(spark, d, "events").select("event_id", F.get_json_object(cells.noisy_json(noisy), "$.k").cast("int").alias("k"))


_CONTACTS = ("email", "personal"), ("mobile_phone", "work"), ("email", "work"), ("email", "work"), ("phone", "home")


@query("""SELECT s_suppkey, ['+91' || s_suppkey, '0' || s_suppkey] AS phones, CASE WHEN s_suppkey % 2 = 0 THEN ['W' || s_suppkey || '@x.in', 'a' || s_suppkey || '@x.in'] ELSE ['W' || s_suppkey || '@x.in', 'a' || s_suppkey || '@x.in'] END AS emails FROM supplier""")
def contacts_extract(spark, d):
    return _contacts(T(spark, d, "supplier")).select("s_suppkey", contact.phones(F.col("contacts")).alias("phones"), contact.emails(F.col("contacts")).alias("emails"))


def _contacts(suppliers: DataFrame) -> DataFrame:
    n = F.col("s_suppkey").cast("string")
    values = (F.concat(F.lit("a"), n, F.lit("@x.in")), F.concat(F.lit("+91"), n), F.concat(F.lit("W"), n, F.lit("@x.in")), F.concat(F.lit("w"), n, F.lit("@X.in")), F.concat(F.lit("0"), n))
    return suppliers.select("s_suppkey", F.array(*[F.struct(F.lit(t).alias("type"), F.lit(s).alias("subtype"), v.alias("value")) for (t, s), v in zip(_CONTACTS, values)]).alias("contacts"))


@query("SELECT s_suppkey, ['W' || s_suppkey || '@x.in', 'a' || s_suppkey || '@x.in'] AS emails FROM supplier")
def ordered_distinct_contacts(spark, d):
    return _contacts(T(spark, d, "supplier")).select("s_suppkey", contact.emails(F.col("contacts")).alias("emails"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 > 2 THEN 'b' ELSE 'a' END AS link FROM supplier")
def best_social_link(spark, d):
    links = F.array(*[F.struct(F.lit(t).alias("type"), F.lit(v).alias("link"), r.alias("rating")) for t, v, r in (("li", "a", F.lit(2)), ("li", "b", (F.col("s_suppkey") % 5).cast("int")), ("fb", "c", F.lit(9)))])
    return T(spark, d, "supplier").select("s_suppkey", contact.best_social(links).alias("link"))


@query("SELECT c_mktsegment AS segment, printf('%.0f%%', round_even(count(*) FILTER (WHERE c_acctbal > 0) * 100.0 / count(*), 0)) AS positive, printf('%.1f%%', round_even(count(*) FILTER (WHERE c_acctbal > 5000) * 100.0 / count(*), 1)) AS rich FROM customer GROUP BY 1")
def pct_half_even(spark, d):
    return T(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(cells.percent(F.count_if(F.col("c_acctbal") > 0), F.count("*")).alias("positive"), cells.percent(F.count_if(F.col("c_acctbal") > 5000), F.count("*"), 1).alias("rich"))


# Aggregates, ranking and limits


@query(f"WITH {_RANKED} SELECT count(*)::BIGINT AS firms, count(*) FILTER (WHERE f1)::BIGINT AS founders, count(*) FILTER (WHERE f2)::BIGINT AS linkedin, count(*) FILTER (WHERE f3)::BIGINT AS phones, count(*) FILTER (WHERE f4)::BIGINT AS emails, count(*) FILTER (WHERE f1 AND f2 AND f3 AND f4)::BIGINT AS all_four FROM rk WHERE rank = 1")
def coverage_stats(spark, d):
    p = contact.presence(*map(F.col, ("name", "linkedin_url", "phone", "email")))
    named = [F.count_if(x).alias(n) for x, n in zip(p, ("founders", "linkedin", "phones", "emails"))]
    return _firsts(spark, d).agg(F.count("*").alias("firms"), *named, F.count_if(p[0] & p[1] & p[2] & p[3]).alias("all_four"))


@query("SELECT count(DISTINCT domain)::BIGINT AS firms, count(*)::BIGINT AS people, count(*) FILTER (WHERE coalesce(phone_raw, '') <> '')::BIGINT AS with_phone FROM people")
def firm_progress(spark, d):
    return T(spark, d, "people").agg(F.count_distinct("domain").alias("firms"), F.count("*").alias("people"), F.count_if(firm.filled(F.col("phone_raw"))).alias("with_phone"))


@query("SELECT 'listings' AS name, count(*)::BIGINT AS n FROM listings UNION ALL SELECT 'people', count(*) FROM people UNION ALL SELECT 'feedback', count(*) FROM feedback")
def table_counts(spark, d):
    one = lambda t: T(spark, d, t).agg(F.lit(t).alias("name"), F.count("*").alias("n"))
    return one("listings").union(one("people")).union(one("feedback"))


@query(f"WITH {_KEYED} SELECT source, count(*)::BIGINT AS n_rows, count(DISTINCT city)::BIGINT AS cities, count(*) FILTER (WHERE domain IS NULL)::BIGINT AS no_domain FROM k GROUP BY 1")
def crawl_source_stats(spark, d):
    return _keyed(spark, d).groupBy("source").agg(F.count("*").alias("n_rows"), F.count_distinct("city").alias("cities"), F.count_if(F.col("domain").isNull()).alias("no_domain"))


@query(f"WITH {_RANKED} SELECT count(DISTINCT domain)::BIGINT AS enriched, count(*) FILTER (WHERE f1)::BIGINT AS founders, count(*) FILTER (WHERE f3)::BIGINT AS phones, count(*) FILTER (WHERE f4)::BIGINT AS emails FROM rk")
def enrich_counters(spark, d):
    p = contact.presence(*map(F.col, ("name", "linkedin_url", "phone", "email")))
    return _people(spark, d).agg(F.count_distinct("domain").alias("enriched"), F.count_if(p[0]).alias("founders"), F.count_if(p[2]).alias("phones"), F.count_if(p[3]).alias("emails"))


@query("SELECT coalesce(max(try_cast(loc_text AS DOUBLE)) FILTER (WHERE regexp_matches(loc_text, '^-?[0-9.]+$')), 0) + 1 AS next FROM deals")
def next_row_number(spark, d):
    return T(spark, d, "deals").agg((F.coalesce(F.max(F.when(F.rlike("loc_text", F.lit(r"^-?[0-9.]+$")), F.col("loc_text").try_cast("double"))), F.lit(0.0)) + 1).alias("next"))


@query("SELECT vec_id, list_max(embedding) AS best FROM embeddings")
def array_max_score(spark, d):
    return T(spark, d, "embeddings").select("vec_id", F.array_max("embedding").alias("best"))


@query("SELECT domain, name FROM people ORDER BY domain, ordinal LIMIT 5")
def bounded_preview(spark, d):
    return T(spark, d, "people").orderBy("domain", "ordinal").limit(5).select("domain", "name")


@query("SELECT domain, row_number() OVER (ORDER BY domain)::INTEGER + 130 AS n FROM (SELECT DISTINCT domain FROM people)")
def export_rows_numbered(spark, d):
    """Numbered rows of the deliverable, continuing after 130."""
    firms = T(spark, d, "people").select("domain").distinct()
    return order.numbered(firms, [F.col("domain")], "n").select("domain", (F.col("n") + 130).cast("int").alias("n"))


@query(f"WITH {_RANKED} SELECT domain, row_number() OVER (ORDER BY domain)::INTEGER AS n FROM rk WHERE rank = 1 AND f1 AND f2 AND domain NOT IN (SELECT domain FROM exclusions WHERE domain IS NOT NULL) ORDER BY domain LIMIT 20")
def append_rows(spark, d):
    ex = T(spark, d, "exclusions").where("domain IS NOT NULL").select("domain")
    real = _firsts(spark, d).where(contact.real_name(F.col("name")) & firm.filled(F.col("linkedin_url"))).join(ex, "domain", "left_anti")
    return real.orderBy("domain").limit(20).select("domain", F.row_number().over(Window.orderBy("domain")).alias("n"))


@query("SELECT n_name, row_number() OVER (ORDER BY CASE n_name WHEN 'INDIA' THEN 0 WHEN 'CHINA' THEN 1 ELSE 9 END, n_name)::INTEGER AS place FROM nation")
def preferred_order(spark, d):
    rank = F.coalesce(F.element_at(F.create_map(F.lit("INDIA"), F.lit(0), F.lit("CHINA"), F.lit(1)), F.col("n_name")), F.lit(9))
    return T(spark, d, "nation").select("n_name", F.row_number().over(Window.orderBy(rank, "n_name")).alias("place"))


@query("SELECT event_id, user_id, spent FROM (SELECT event_id, user_id, sum(1 + event_id % 3) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS spent FROM events) WHERE spent <= 10")
def budget_prefix(spark, d):
    costs = T(spark, d, "events").select("event_id", "user_id", (F.lit(1) + F.col("event_id") % 3).alias("cost"))
    return ledger.budget_prefix(costs, "user_id", "event_id", "cost", 10).select("event_id", "user_id", "spent")


@query("SELECT provider, window_key, used, limit_value, CASE WHEN limit_value IS NOT NULL THEN greatest(1, floor(limit_value * 0.8::DOUBLE))::BIGINT END AS effective FROM (SELECT provider, strftime(ts, '%Y-%m-%d') AS window_key, sum(delta)::BIGINT AS used, arg_max(limit_value, (epoch_us(ts), event_id)) FILTER (WHERE limit_value IS NOT NULL) AS limit_value FROM charges GROUP BY 1, 2)")
def effective_limits(spark, d):
    return ledger.usage(T(spark, d, "charges"), "daily").withColumn("effective", ledger.effective_limit(F.col("limit_value")))


@query("SELECT provider, strftime(ts, '%Y-%m-%d') AS window_key, sum(delta)::BIGINT AS used FROM charges GROUP BY 1, 2")
def usage_by_window(spark, d):
    return ledger.usage(T(spark, d, "charges"), "daily").select("provider", "window_key", "used")


@query("SELECT provider, coalesce(sum(delta), 0)::BIGINT AS used FROM charges WHERE strftime(ts, '%Y-%m-%d') LIKE '2024-01%' GROUP BY 1")
def monthly_usage(spark, d):
    return T(spark, d, "charges").where(F.startswith(dates.window_key(F.col("ts"), "daily"), F.lit("2024-01"))).groupBy("provider").agg(F.coalesce(F.sum("delta"), F.lit(0)).alias("used"))


@query("SELECT event_id, ceil(greatest(0, 4000 - event_id % 4500)::DOUBLE / (day(last_day(ts)) - day(ts) + 1))::BIGINT AS share FROM events")
def daily_fair_share(spark, d):
    return T(spark, d, "events").select("event_id", ledger.fair_share(F.lit(4000), F.col("event_id") % 4500, F.col("ts").cast("date")).alias("share"))


@query("SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 599999999 PRECEDING AND CURRENT ROW)::BIGINT AS in_window FROM events")
def request_window(spark, d):
    return ledger.sliding_count(T(spark, d, "events"), "event_type", "ts", 600).select("event_id", "in_window")


@query("SELECT domain, ordinal, name, role, row_number() OVER (PARTITION BY domain, coalesce(role, '') ORDER BY ordinal)::INTEGER = 1 AS first_of_role FROM people")
def role_span(spark, d):
    w = Window.partitionBy("domain", F.coalesce("role", F.lit(""))).orderBy("ordinal")
    return T(spark, d, "people").select("domain", "ordinal", "name", "role", (F.row_number().over(w) == 1).alias("first_of_role"))


@query("SELECT user_id, string_agg(event_type, chr(10) ORDER BY ts, event_id) AS log FROM events GROUP BY 1")
def call_note_log(spark, d):
    """Each user's whole log in order of time; lines are joined to parts first, so what is put in order for a user is parts, not lines."""
    placed = order.numbered_within(T(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), "user_id", [F.col("ts"), F.col("event_id")], "n")
    lines = F.array_sort(F.collect_list(F.struct("n", "event_type")))
    parts = placed.where("event_type IS NOT NULL").withColumn("part", F.floor((F.col("n") - 1) / 10_000)).groupBy("user_id", "part").agg(lines.alias("lines"))
    joined = parts.select("user_id", F.struct("part", F.array_join(F.transform("lines", lambda x: x["event_type"]), "\n").alias("log")).alias("p"))
    logs = joined.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["log"]), "\n").alias("log"))
    users = placed.select("user_id").distinct()  # one without an event type has no log, but a row
    return users.join(logs.withColumnRenamed("user_id", "of"), F.col("user_id").eqNullSafe(F.col("of")), "left").select("user_id", "log")


@query("SELECT domain, name FROM people ORDER BY domain, ordinal LIMIT 25")
def enrich_cap(spark, d):
    return T(spark, d, "people").orderBy("domain", "ordinal").limit(25).select("domain", "name")


@query("SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey)::INTEGER AS place FROM customer")
def score_sorted(spark, d):
    rows = T(spark, d, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    placed = order.numbered_within(rows, "c_mktsegment", [F.desc("c_acctbal"), F.col("c_custkey")], "place")
    return placed.select("c_mktsegment", "c_custkey", F.col("place").cast("int").alias("place"))


# Sets, snapshots and transitions


@query("SELECT domain FROM exclusions WHERE domain IS NOT NULL UNION SELECT domain FROM people")
def known_domain_union(spark, d):
    return T(spark, d, "exclusions").where("domain IS NOT NULL").select("domain").union(T(spark, d, "people").select("domain")).distinct()


@query("SELECT kind, value FROM (SELECT 'domain' AS kind, domain AS value FROM exclusions UNION SELECT 'name', lower(name) FROM exclusions) WHERE value IS NOT NULL")
def exclusion_union(spark, d):
    ex = T(spark, d, "exclusions")
    both = ex.select(F.lit("domain").alias("kind"), F.col("domain").alias("value")).union(ex.select(F.lit("name"), F.lower("name")))
    return both.where("value IS NOT NULL").distinct()


@query("SELECT lower(trim(company_name)) AS key, arg_min(company_name, ordinal) AS name FROM listings WHERE trim(company_name) <> '' GROUP BY 1")
def ordered_distinct_names(spark, d):
    return T(spark, d, "listings").where("trim(company_name) <> ''").groupBy(F.lower(F.trim("company_name")).alias("key")).agg(F.min_by("company_name", "ordinal").alias("name"))


@query("SELECT DISTINCT lower(name) AS name FROM exclusions EXCEPT SELECT lower(trim(company_name)) FROM listings")
def property_diff(spark, d):
    have = T(spark, d, "listings").select(F.lower(F.trim("company_name")).alias("name"))
    return T(spark, d, "exclusions").select(F.lower("name").alias("name")).distinct().join(have, "name", "left_anti")


@query("SELECT source, company_name, min(ordinal) AS ordinal FROM listings GROUP BY 1, 2")
def insert_ignore(spark, d):
    """The listings after the earlier half was stored and all of them are offered."""
    rows = T(spark, d, "listings").select("source", "company_name", "ordinal")
    first = rows.groupBy("source", "company_name").agg(F.min("ordinal").alias("ordinal"))
    return merge.insert_ignore(first.where("ordinal % 2 = 0"), first, ["source", "company_name"], "ordinal")


@query("""WITH f AS (SELECT lower(trim(email)) AS email, min(pulled_at) AS created_at, arg_max(coalesce(call_outcome, ''), ordinal) AS call_outcome, arg_max({'n': call_notes}, ordinal).n AS call_notes FROM feedback WHERE trim(email) <> '' GROUP BY 1) SELECT * FROM f""")
def feedback_merge(spark, d):
    """Feedback upserted by e-mail: the last outcome and notes win and the first time stays; rows without an e-mail are left out."""
    rows = T(spark, d, "feedback").where(F.trim("email") != "").select(F.lower(F.trim("email")).alias("email"), "pulled_at", F.coalesce("call_outcome", F.lit("")).alias("call_outcome"), "call_notes", "ordinal")
    old = rows.groupBy("email").agg(F.min("pulled_at").alias("created_at"), F.min_by("call_outcome", "ordinal").alias("call_outcome"), F.min_by("call_notes", "ordinal").alias("call_notes"))
    new = rows.select("email", F.col("pulled_at").alias("created_at"), "call_outcome", "call_notes", "ordinal")
    return merge.upsert(old, new, "email", "ordinal")


@query("""WITH o AS (SELECT c_custkey AS key, c_mktsegment AS value, 1 AS created_at FROM customer), n AS (SELECT 2 * c_custkey AS key, upper(c_name) AS value, 2 AS created_at FROM customer)
SELECT coalesce(o.key, n.key) AS key, coalesce(o.created_at, n.created_at)::INTEGER AS created_at, CASE WHEN n.key IS NOT NULL THEN n.value ELSE o.value END AS value FROM o FULL JOIN n ON o.key = n.key""")
def upsert_merge(spark, d):
    """All customers, and all of them again under twice their key: a part is replaced, a part put in, the odd keys stay."""
    c = T(spark, d, "customer")
    old = c.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value"), F.lit(1).alias("created_at"))
    new = c.select((2 * F.col("c_custkey")).alias("key"), F.upper("c_name").alias("value"), F.lit(2).alias("created_at"))
    return merge.upsert(old, new, "key", "created_at")


@query("SELECT domain, ordinal, name FROM people WHERE domain NOT IN (SELECT domain FROM exclusions WHERE domain IS NOT NULL) UNION ALL SELECT domain, ordinal, name FROM exclusions WHERE domain IS NOT NULL")
def replace_by_key(spark, d):
    return merge.replace_by_key(T(spark, d, "people").select("domain", "ordinal", "name"), T(spark, d, "exclusions").where("domain IS NOT NULL").select("domain", "ordinal", "name"), "domain")


@query("""SELECT event_id, deal_id, outcome, CASE WHEN event_id % 3 = 1 THEN 'M1V2' WHEN event_id % 3 = 2 THEN 'M1V1' ELSE '' END AS previous,
CASE outcome WHEN 1 THEN 'M1V1 Sent' WHEN 2 THEN 'Dead - Rejected' WHEN 3 THEN 'Call Attempted' WHEN 4 THEN 'Call Attempted' ELSE CASE event_id % 3 WHEN 0 THEN 'M1V2 Sent' WHEN 1 THEN 'M1V1 Sent' ELSE 'Dead - No Response' END END AS stage FROM outcomes""")
def call_transition(spark, d):
    previous = F.when(F.col("event_id") % 3 == 1, "M1V2").when(F.col("event_id") % 3 == 2, "M1V1").otherwise("")
    return crm.step(T(spark, d, "outcomes").withColumn("previous", previous)).select("event_id", "deal_id", "outcome", "previous", "stage")


@query("""SELECT event_id, CASE WHEN outcome IN (1, 3) OR (outcome = 5 AND event_id % 3 = 0) THEN 'MEDIUM' WHEN outcome = 4 OR event_id % 3 = 1 THEN 'HIGH' END AS priority, CASE WHEN outcome = 4 THEN 'TODO' ELSE 'CALL' END AS task
FROM outcomes WHERE outcome IN (1, 3, 4) OR (outcome = 5 AND event_id % 3 < 2)""")
def task_rows(spark, d):
    previous = F.when(F.col("event_id") % 3 == 1, "M1V2").when(F.col("event_id") % 3 == 2, "M1V1").otherwise("")
    return crm.step(T(spark, d, "outcomes").withColumn("previous", previous)).where("task IS NOT NULL").select("event_id", "priority", "task")


@query()
def escalation_fold(spark, d):
    return crm.escalate(T(spark, d, "outcomes"))


@query("SELECT x.deal_id, x.stage_id FROM deals x WHERE x.stage_id NOT IN (SELECT stage_id FROM stage_dim)")
def stage_move_errors(spark, d):
    return T(spark, d, "deals").join(T(spark, d, "stage_dim"), "stage_id", "left_anti").select("deal_id", "stage_id")


@query("SELECT x.deal_id, p.email FROM deals x JOIN (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ordinal) AS rank FROM people) p ON x.domain = p.domain AND p.rank = 1 WHERE x.stage_id = 'click' AND coalesce(p.email, '') <> '' AND x.deal_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def mail_queue(spark, d):
    first = people.ranked(T(spark, d, "people")).where("is_primary").where(firm.filled(F.col("email"))).select("domain", "email")
    sent = T(spark, d, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("deal_id"))
    return T(spark, d, "deals").where("stage_id = 'click'").join(first, "domain").join(sent, "deal_id", "left_anti").select("deal_id", "email")


@query()
def founder_merge(spark, d):
    """Names of one provenance folded into another's, firm by firm; held against literals in the tests."""
    # people are made once and read for both sides
    p = materialize(T(spark, d, "people").where(contact.real_name(F.col("name"))).select("domain", "ordinal", "name", "role", F.col("name_source").alias("source")), "people")
    return people.merge_founders(p.where("source = 'registry'"), p.where("source <> 'registry'"))


@query("SELECT p.domain, p.name, arg_min({'u': f.linkedin_url}, f.ordinal).u AS url FROM people p JOIN people f ON p.domain = f.domain AND lower(p.name) = lower(f.name) WHERE p.name_source = 'registry' GROUP BY 1, 2")
def best_candidate(spark, d):
    """Candidates of a firm are its people's names with a word more; only one's own holds all of a name's words."""
    p = T(spark, d, "people")
    found = p.select("domain", F.concat("name", F.lit(" Jr")).alias("candidate"), F.col("linkedin_url").alias("url"), "ordinal")
    return people.best_candidate(p.where("name_source = 'registry'"), found, gates.BLOCK_SCORE)


@query("SELECT p.domain, p.name, arg_min(CAST(f.ordinal AS VARCHAR), f.ordinal) AS uid FROM people p JOIN people f ON p.domain = f.domain AND lower(p.name) = lower(f.name) GROUP BY 1, 2")
def best_profile(spark, d):
    """Profiles of a firm are its people's; one of the same name and firm has the full score."""
    # people are made once and read for both sides
    found = materialize(T(spark, d, "people").select("domain", "name", "ordinal"), "people")
    p = found.withColumn("company_name", F.col("domain"))
    profiles = found.select("domain", F.col("ordinal").cast("string").alias("uid"), F.col("name").alias("full_name"), F.array("domain", F.lit("other firm")).alias("companies"), "ordinal")
    return people.best_profile(p.select("domain", "name", "company_name"), profiles)


# Names are a number and a remainder here, so two are close by the common subsequence of their numbers; a place before or after the word can't match better.
@query(f"""WITH {_SRC}, o AS (SELECT *, regexp_extract(name, '^Person([0-9]+) Of ([0-9])$', 1) AS dn, regexp_extract(name, '^Person([0-9]+) Of ([0-9])$', 2) AS dm FROM sc),
r AS (SELECT DISTINCT domain, dn AS rn, dm AS rm FROM o WHERE list_contains(sources, 'registry') AND name NOT IN ('', '(verify)')),
t2 AS (SELECT DISTINCT dn, rn FROM o JOIN r USING (domain) WHERE sources = ['directory'] AND dn <> ''), cm AS (SELECT dn, rn, {_common('dn', 'rn')} AS c FROM t2),
a AS (SELECT DISTINCT o.domain, o.ordinal FROM o JOIN r ON o.domain = r.domain JOIN cm ON o.dn = cm.dn AND r.rn = cm.rn WHERE o.sources = ['directory'] AND 200.0 * (10 + (o.dm = r.rm)::INTEGER + cm.c) / (22 + length(o.dn) + length(r.rn)) >= 88),
x AS (SELECT o.*, o.sources = ['directory'] AND o.domain IN (SELECT domain FROM r) AND NOT EXISTS (SELECT 1 FROM a WHERE a.domain = o.domain AND a.ordinal = o.ordinal) AS overridden FROM o)
SELECT domain, ordinal, CASE WHEN overridden THEN '(verify)' ELSE name END AS name, overridden, CASE WHEN overridden THEN 'red' ELSE confidence END AS confidence,
  CASE WHEN overridden THEN CASE WHEN coalesce(notes, '') <> '' THEN notes || '; ' ELSE '' END || 'registry-vs-aggregator override: dropped aggregator name ''' || name || '''' ELSE notes END AS notes FROM x""")
def registry_override(spark, d):
    return people.override_aggregator(T(spark, d, "people")).select("domain", "ordinal", "name", "overridden", "confidence", "notes")


@query("SELECT DISTINCT domain FROM people WHERE domain NOT IN (SELECT 'firm-' || user_id || '.co.in' FROM events)")
def incremental_firms(spark, d):
    done = T(spark, d, "events").select(F.concat(F.lit("firm-"), F.col("user_id").cast("string"), F.lit(".co.in")).alias("domain"))
    return T(spark, d, "people").select("domain").distinct().join(done, "domain", "left_anti")


# Projections


@query(f"WITH {_RANKED} SELECT domain, name, array_to_string(list_filter([CASE WHEN NOT f1 THEN 'Founder' END, CASE WHEN NOT f2 THEN 'LinkedIn' END, CASE WHEN NOT f3 THEN 'Phone' END, CASE WHEN NOT f4 THEN 'Email' END], lambda x: x IS NOT NULL), ', ') AS missing FROM rk WHERE rank = 1 AND f1::INT + f2::INT + f3::INT + f4::INT = 3")
def review_rows(spark, d):
    """Firms that lack exactly one of the four fields."""
    gone = contact.missing_fields(*map(F.col, ("name", "linkedin_url", "phone", "email")))
    return _firsts(spark, d).withColumn("gone", gone).where(F.size("gone") == 1).select("domain", "name", F.array_join("gone", ", ").alias("missing"))


@query("SELECT domain, name, linkedin_url FROM people WHERE coalesce(linkedin_url, '') <> '' AND NOT coalesce(linkedin_confirmed, false)")
def linkedin_review(spark, d):
    return T(spark, d, "people").where(firm.filled(F.col("linkedin_url")) & ~F.coalesce("linkedin_confirmed", F.lit(False))).select("domain", "name", "linkedin_url")


@query(f"WITH {_RANKED} SELECT domain, name, role, phone, email, linkedin_url FROM rk WHERE rank = 1 AND f1 AND f2 AND f3 AND f4 AND domain NOT IN (SELECT domain FROM exclusions WHERE domain IS NOT NULL)")
def qualified_rows(spark, d):
    full = _firsts(spark, d).where(contact.is_full(*map(F.col, ("name", "linkedin_url", "phone", "email"))))
    return full.join(T(spark, d, "exclusions").where("domain IS NOT NULL"), "domain", "left_anti").select("domain", "name", "role", "phone", "email", "linkedin_url")


@query("SELECT c_custkey, sha1(lower(trim(c_mktsegment)) || '|m') AS key, n FROM customer JOIN (SELECT sha1(lower(trim(c_mktsegment)) || '|m') AS k, count(*)::BIGINT AS n FROM customer GROUP BY 1) ON k = sha1(lower(trim(c_mktsegment)) || '|m')")
def prompt_dedupe(spark, d):
    """Judgements asked for once for each distinct prompt, then joined back."""
    asked = T(spark, d, "customer").withColumn("key", firm.content_key(F.lower(F.trim("c_mktsegment")), F.lit("m")))
    answers = asked.groupBy("key").agg(F.count("*").alias("n"))
    return asked.join(answers, "key").select("c_custkey", "key", "n")


# Streams, run over what is there


@query("SELECT provider, strftime(ts, '%Y-%m-%d') AS day, sum(delta)::BIGINT AS used, count(*)::BIGINT AS n FROM charges GROUP BY 1, 2")
def stream_daily_quota(spark, d):
    """The daily ledger as a stream over the events table, in complete mode; the last batch holds every window."""
    events = spark.read.parquet(f"{d}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(f"{d}/events.parquet*")
    charges = stream.select(F.col("event_type").alias("provider"), "ts", (F.lit(1) + F.col("event_id") % 3).alias("delta"))
    out = quota.run_available(spark, quota.daily_quota(charges, "40 days"), "complete")
    last = out.agg(F.max("batch").alias("batch"))
    return out.join(last, "batch", "left_semi").select("provider", "day", "used", "n")


@query("SELECT user_id, event_type, count(*)::BIGINT AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1, 2")
def stream_event_dedupe(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(f"{d}/events.parquet*")
    out = quota.run_available(spark, quota.first_events(stream, ["user_id", "event_type"], "40 days").select("user_id", "event_type"))
    return out.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
