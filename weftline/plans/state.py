"""Queries over state: runs that carry it over calls, keyed state of streams, admission and keyed snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import admission, cards, crawl, outbox, people
from weftline.operators.keyed_store import KeyedStore
from weftline.plans.catalogue import query
from weftline.scratch import fresh_path, materialize
from weftline.sources.adapters import logical as T
from weftline.streaming import quota, window
from weftline.streaming.runs import NamedRun

# Streams


def _inbox(events, parts: int, part) -> tuple:
    """A folder to which events come file by file, by the number ``part``: what a night's export would put there."""
    folder = fresh_path(events.sparkSession, "inbox")

    def night(k: int) -> None:
        events.where(part == k).write.parquet(f"{folder}/night-{k}")

    return folder, [lambda k=k: night(k) for k in range(parts)]


def _elapsed(events):
    """How far in its time, from 0 to 1, an event lies among all."""
    ends = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    at = lambda c: F.unix_micros(c.cast("timestamp"))
    first, last = F.lit(ends.first), F.lit(ends.last)
    return (at(F.col("ts")) - at(first)) / F.greatest(at(last) - at(first), F.lit(1))


@query("SELECT provider, strftime(ts, '%Y-%m-%d') AS day, sum(delta)::BIGINT AS used, count(*)::BIGINT AS n FROM charges GROUP BY 1, 2")
def stream_carried_quota(spark, d):
    """The daily ledger over three nights: each call of the named run reads the night's files and goes on from the state of the one before."""
    events = T(spark, d, "events").select("event_id", "event_type", "ts")
    folder, nights = _inbox(events, 3, F.least(F.floor(_elapsed(events) * 3), F.lit(2)))
    run = NamedRun(spark, "daily-quota", fresh_path(spark, "carried"))
    for night in nights:
        night()
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/*")
        used = quota.daily_quota(stream.select(F.col("event_type").alias("provider"), "ts", (F.lit(1) + F.col("event_id") % 3).alias("delta")), "40 days")
        run.advance(used, "update")
    return run.latest(used.schema, ["provider", "day"]).select("provider", "day", "used", "n")


@query("SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 599999999 PRECEDING AND CURRENT ROW)::BIGINT AS in_window FROM events")
def stream_request_window(spark, d):
    """The sliding window as a stream: events come in three files, some a good while after newer ones; a last one far ahead closes it."""
    events = T(spark, d, "events").select("event_id", "event_type", "ts")
    # up to a tenth of the whole time late
    folder, nights = _inbox(events, 3, F.least(F.floor((_elapsed(events) + F.pmod(F.xxhash64("event_id"), F.lit(100)) / 1000) * 3), F.lit(2)))
    for night in nights:
        night()
    closing = events.agg(F.lit(-1).cast("long").alias("event_id"), F.lit("close").alias("event_type"), (F.max("ts") + F.expr("INTERVAL 400 DAYS")).alias("ts"))
    closing.where("ts IS NOT NULL").write.parquet(f"{folder}/night-9")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 64).parquet(f"{folder}/*")
    counted = window.sliding_count(stream, "event_type", "ts", "event_id", 600, "100 days")
    with window.store(spark):
        run = NamedRun(spark, "request-window", fresh_path(spark, "windowed")).advance(counted)
    return run.rows(counted.schema).select(F.col("id").alias("event_id"), "in_window")


# Ledger


@query("""WITH RECURSIVE c AS (SELECT event_id, provider, strftime(ts, '%Y-%m-%d') AS day, 1 + event_id % 9 AS delta, CASE WHEN provider = 'view' THEN NULL ELSE 20 + event_id % 7 END AS lim, row_number() OVER (PARTITION BY provider, strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS k FROM charges),
l AS (SELECT provider, day, CASE WHEN count(lim) > 0 THEN greatest(1, floor(arg_max(lim, k) * 0.8::DOUBLE))::BIGINT END AS lim FROM c GROUP BY 1, 2),
r AS (SELECT c.event_id, c.provider, c.day, c.k, l.lim, 0::BIGINT AS used_before, c.delta, l.lim IS NULL OR c.delta <= l.lim AS admitted FROM c JOIN l ON c.provider = l.provider AND c.day = l.day WHERE c.k = 1
  UNION ALL SELECT c.event_id, c.provider, c.day, c.k, r.lim, r.used_before + CASE WHEN r.admitted THEN r.delta ELSE 0 END, c.delta, r.lim IS NULL OR r.used_before + CASE WHEN r.admitted THEN r.delta ELSE 0 END + c.delta <= r.lim
  FROM r JOIN c ON c.provider = r.provider AND c.day = r.day AND c.k = r.k + 1)
SELECT event_id, day AS window_key, used_before, greatest(0, lim - used_before) AS remaining, NOT admitted AS would_exceed, admitted FROM (SELECT * REPLACE (CASE WHEN lim IS NULL THEN NULL ELSE lim END AS lim) FROM r) WHERE lim IS NOT NULL
UNION ALL SELECT event_id, day, used_before, NULL, false, true FROM r WHERE lim IS NULL""")
def charge_admission(spark, d):
    """Each charge of a day taken or refused by what its provider has left; one provider has no limit."""
    e = F.col("event_id")
    charges = T(spark, d, "charges").withColumns({"delta": F.lit(1) + e % 9, "limit_value": F.when(F.col("provider") != "view", F.lit(20) + e % 7)})
    return admission.admit(charges, "daily").select("event_id", "window_key", "used_before", "remaining", "would_exceed", "admitted")


# Keyed snapshots


@query("""WITH w AS (SELECT event_id, user_id, event_type, value, ntile(3) OVER (ORDER BY event_id) AS batch FROM events)
SELECT user_id || '|' || event_type AS key, arg_max(value, event_id) AS value, min(event_id) AS created_at FROM w GROUP BY 1""")
def cache_set(spark, d):
    """A cache set in three batches, the last of them sent twice: the last value of a key stands, the time of its first entry stays."""
    events = T(spark, d, "events").select(F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("key"), "value", F.col("event_id").alias("created_at"), "event_id")
    ends = events.agg(F.min("event_id").alias("low"), F.max("event_id").alias("high")).first()
    third = F.floor((F.col("event_id") - F.lit(ends.low)) * 3 / F.lit(max(1, (ends.high or 0) - (ends.low or 0) + 1)))
    store = KeyedStore(spark, fresh_path(spark, "cache"), "key string, value double, created_at long", ["key"], 16)
    for k in (0, 1, 2, 2):
        store.put(events.where(third == k), "event_id", txn=f"batch-{k}")
    return store.rows()


@query("""SELECT domain, name, max(email) AS email, arg_max({'r': role}, ordinal).r AS role, min(ordinal) AS created_at FROM (SELECT domain, name, ordinal, role, NULL AS email FROM people UNION ALL SELECT 'firm-' || s_suppkey || '.co.in', 'Person' || s_suppkey || ' Of ' || s_suppkey % 7, 10::BIGINT * 1000000000000 + s_suppkey, 'Advisor', 'new' FROM supplier)
GROUP BY domain, name""")
def person_upsert(spark, d):
    """People put in by firm and name, then a second lot of which some are there already: their fields are replaced, their creation stays."""
    none = F.lit(None).cast("string")
    people = T(spark, d, "people").select("domain", "name", none.alias("email"), "role", F.col("ordinal").alias("created_at"), "ordinal")
    key = F.col("s_suppkey")
    more = T(spark, d, "supplier").select(
        F.concat(F.lit("firm-"), key.cast("string"), F.lit(".co.in")).alias("domain"), F.concat(F.lit("Person"), key.cast("string"), F.lit(" Of "), (key % 7).cast("string")).alias("name"), F.lit("new").alias("email"), F.lit("Advisor").alias("role"),
        (F.lit(10 * 10**12) + key).alias("created_at"), (F.lit(10 * 10**12) + key).alias("ordinal"),
    )
    store = KeyedStore(spark, fresh_path(spark, "people"), "domain string, name string, email string, role string, created_at long", ["domain", "name"], 16)
    store.put(people, "ordinal")
    store.put(more, "ordinal")
    return store.rows()


# Mail


_SUBJECTS = (("M1V1", "Hello {{contact.firstname}} of {{company.name}}", "Dear {{contact.firstname}}, {{owner.first_name}} of us would meet {{company.name}}: [CALENDLY_LINK]"), ("M1V2", "{{company.name}}, again", "{{contact.firstname}}, we called. {{owner.first_name}}"))


@query("""WITH f AS (SELECT domain, arg_min({'n': name, 'e': email}, ordinal) AS p FROM people GROUP BY 1),
d AS (SELECT deal_id, domain, CASE stage_id WHEN 'click' THEN 'M1V1' WHEN 'signup' THEN 'M1V2' END AS version, CASE deal_id % 4 WHEN 0 THEN 'M1V1' WHEN 1 THEN 'M1V2' END AS sent_version, CASE WHEN deal_id % 7 <> 3 THEN 'Firm ' || deal_id END AS company FROM deals),
m AS (SELECT d.*, f.p.e AS email, CASE WHEN f.p.n IN ('', '(verify)') THEN 'there' ELSE split_part(f.p.n, ' ', 1) END AS first FROM d LEFT JOIN f ON d.domain = f.domain WHERE version IS NOT NULL)
SELECT deal_id, version, email, CASE version WHEN 'M1V1' THEN 'Hello ' || first || ' of ' || company ELSE company || ', again' END AS subject,
  CASE version WHEN 'M1V1' THEN 'Dear ' || first || ', Asha of us would meet ' || company || ': https://meet.example' ELSE first || ', we called. Asha' END AS body,
  CASE version WHEN 'M1V1' THEN 'calendly_link_sent=true;' ELSE '' END || 'email_version_sent=' || version AS patch, CASE WHEN deal_id % 2 = 0 THEN 'one' ELSE 'two' END AS txn
FROM m WHERE sent_version IS DISTINCT FROM version AND company IS NOT NULL AND coalesce(email, '') <> ''""")
def mail_outbox(spark, d):
    """Messages and property patches of two batches, of which the second holds the first's deals too and both come twice."""
    k = F.col("deal_id")
    deals = T(spark, d, "deals").select(
        "deal_id", "domain", F.when(F.col("stage_id") == "click", "M1V1 Sent").when(F.col("stage_id") == "signup", "M1V2 Sent").otherwise("Interested").alias("stage"), F.when(k % 4 == 0, "M1V1").when(k % 4 == 1, "M1V2").alias("sent_version"),
    )
    firms = deals.select("domain", F.when(k % 7 != 3, F.concat(F.lit("Firm "), k.cast("string"))).alias("company_name"))
    templates = spark.createDataFrame(list(_SUBJECTS), "version string, subject string, body string")
    due = materialize(outbox.due(deals, firms, people.ranked(T(spark, d, "people")), templates, "Asha", "https://meet.example"), "mail-due")
    box = outbox.outbox(spark, fresh_path(spark, "outbox"))
    for txn, batch in (("one", due.where(k % 2 == 0)), ("one", due), ("two", due), ("two", due)):
        outbox.post(box, batch, txn)
    patch = F.array_join(F.array_sort(F.transform(F.map_entries("properties"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return outbox.pending(box).select("deal_id", "version", "email", "subject", "body", patch.alias("patch"), "txn")


# Pages


_CITIES = """SELECT o_orderkey, o_orderpriority AS source, n_name AS city, dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY n_name) AS place, row_number() OVER (PARTITION BY o_orderpriority, n_name ORDER BY o_orderkey) AS page,
  CASE WHEN o_orderkey % 97 = 0 THEN 'blocked' WHEN o_orderkey % 53 = 1 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN o_orderkey % 11 = 2 THEN 0 ELSE o_orderkey % 48 + 1 END AS n_rows
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
# The crawl itself, step by step.
_CRAWL = f"""WITH RECURSIVE p AS ({_CITIES}),
r AS (SELECT source, city, place, page, status, n_rows FROM p WHERE place = 1 AND page = 1
  UNION ALL SELECT n.source, n.city, n.place, n.page, n.status, n.n_rows FROM r JOIN p n ON n.source = r.source AND r.status <> 'blocked' AND (
    (r.status = 'ok' AND r.n_rows > 0 AND n.place = r.place AND n.page = r.page + 1)
    OR (n.place = r.place + 1 AND n.page = 1 AND (r.status = 'failed' OR r.n_rows = 0 OR NOT EXISTS (SELECT 1 FROM p x WHERE x.source = r.source AND x.place = r.place AND x.page = r.page + 1)))))"""


def _crawl_pages(spark, d):
    t = {name: T(spark, d, name) for name in ("orders", "customer", "nation")}
    text = _CITIES
    for name in t:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    return spark.sql(text, **t)


@query(_CRAWL + " SELECT source, city, page, n_rows FROM r WHERE status = 'ok'")
def crawl_pages_taken(spark, d):
    """The pages that a crawl takes before something ends its city or its source."""
    return crawl.visited(_crawl_pages(spark, d)).select("source", "city", "page", "n_rows")


@query(_CRAWL + " SELECT source, count(*) FILTER (WHERE status = 'ok')::BIGINT AS pages, coalesce(sum(n_rows) FILTER (WHERE status = 'ok'), 0)::BIGINT AS n_rows, bool_or(status = 'blocked') AS blocked, count(*) FILTER (WHERE status = 'failed')::BIGINT AS skipped FROM r GROUP BY 1")
def crawl_outcomes(spark, d):
    """What the crawl of each source took, whether a block ended it, how many cities a failed fetch did."""
    return crawl.stats(_crawl_pages(spark, d))


# A page for each listing, in its site's markup: a card without a name, the listing's, and one that lacks most fields.
def _markup(name: str, other: str, city: str, size: str, site: str) -> str:
    def card(open_, close, n, more):
        return f"'{open_}' || {n} || '{close[0]}' || {more} || '{close[1]}'"

    shapes = {
        0: ('<li class="firm-wrapper x"><h3 class="firm-name"><a href="/p">', ("</a></h3>", "</li>"), f"""'<div class="firm-urls"><a class="visit-website" href="/go?u=https://w.example/' || ordinal || '">s</a></div><div class="firm-location"><b>in</b><span>' || {city} || '</span></div><p class="firm-founded">est. <span>' || ordinal % 50 || '</span></p><div class="firm-employees"><span>' || {size} || '</span></div>'"""),
        1: ('<ul class="directory-list"><li><p class="company-name">by <a>', ("</a></p>", "</li></ul>"), f"""'<br><a data-link-type="website" href=" w.example/' || ordinal || ' ">s</a><i class="locality">' || {city} || '</i><i class="founded">' || ordinal % 50 || '</i><span class="employees">' || {size} || '</span>'"""),
        2: ('<div class="co-box"><p class="co-box__name"><span class="verified--ico">Verified <b>Company</b></span>', ("</p>", "</div>"), f"""'<script>var x = "<p class=co-box__descr>no</p>";</script><a class="btn btn-website" href="https://w.example/' || ordinal || ' x">s</a><span class="co-box__loc-itm">' || {city} || ', India</span><span class="co-box__loc-itm">second</span>'"""),
        3: ('<li class="provider-row"><h3><a>', ("</a></h3>", "</li>"), f"""'<a class="visit-website" href="https://w.example/' || ordinal || '">s</a><i class="location">' || {city} || '</i><em class="founded">' || ordinal % 50 || '</em><em class="company-size">' || {size} || '</em>'"""),
        4: ('<div class="agencies-list"><p class="agency"><b class="agency-name"><i>x</i><a>', ("</a></b>", "</p></div>"), f"""'<a target="_blank" rel="noopener nofollow" href="https://w.example/' || ordinal || '">s</a><i class="agency-location">' || {city} || '</i><em class="agency-founded">' || ordinal % 50 || '</em><em class="agency-employees">' || {size} || '</em>'"""),
        5: ('<div class="member-card"><b class="member-name">', ("</b>", "</div>"), f"""'<img src="x"><a class="member-website" href="https://w.example/' || ordinal || '">s</a><i class="city">' || {city} || '</i><em class="member-founded">' || ordinal % 50 || '</em><em class="member-employees">' || {size} || '</em>'"""),
    }
    whens = " ".join(f"WHEN {k} THEN " + " || ".join(card(o, c, n, m) for n, m in (("'  '", "''"), (name, more), (other, "''"))) for k, (o, c, more) in shapes.items())
    return f"CASE {site} {whens} END"


_ESCAPED = "replace(company_name, '&', '&amp;')"
_PAGES = f"""SELECT ordinal, ordinal % 6 AS site, coalesce(company_name, '') AS company_name, size_raw, segment_raw, '<html><title>t</title><body><!-- a card? -->' || {_markup(_ESCAPED, "'Other &lt;' || ordinal || '&gt;'", "'C ' || ordinal % 9", "coalesce(size_raw, '')", "ordinal % 6")} || '</body></html>' AS html FROM listings"""


@query(r"""WITH c AS (SELECT ordinal, ordinal % 6 AS s, trim(regexp_replace(coalesce(company_name, ''), '\s+', ' ', 'g')) AS name, nullif(trim(size_raw), '') AS size FROM listings),
t AS (SELECT ordinal AS page_id, s, name, CASE s WHEN 1 THEN 'w.example/' || ordinal ELSE 'https://w.example/' || ordinal END AS website, 'C ' || ordinal % 9 AS city, CASE WHEN s <> 2 THEN CAST(ordinal % 50 AS VARCHAR) END AS founded, CASE WHEN s <> 2 THEN size END AS size, 0 AS k FROM c WHERE name <> ''
  UNION ALL SELECT ordinal, s, 'Other <' || ordinal || '>', NULL, 'Pune', NULL, NULL, CASE WHEN name <> '' THEN 1 ELSE 0 END FROM c)
SELECT page_id, 'site-' || (s + 1) AS site, k AS pos, name, website, city, founded, size, CAST(NULL AS VARCHAR) AS segment FROM t""")
def card_fields(spark, d):
    """Cards of six sites' pages as rows, each site by its own rules; a field that a card lacks is null, a city is the page's."""
    # pages are dear to read: their listings, small rows, are dealt to as many tasks as shuffles have, however few bytes they are
    listings = T(spark, d, "listings").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "ordinal")
    pages = spark.sql(_PAGES.replace("FROM listings", "FROM {listings}"), listings=listings)
    pages = pages.select(F.col("ordinal").alias("page_id"), F.concat(F.lit("site-"), (F.col("site") + 1).cast("string")).alias("site"), F.lit("Pune").alias("city"), "html")
    return cards.parse_cards(pages)
