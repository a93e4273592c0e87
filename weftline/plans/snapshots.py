"""Queries over lists, notes and provider snapshots; they join the catalogue when this module is imported."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import contact, firm, notes
from weftline.operators import crm, exclusions, people, snapshots
from weftline.plans.catalogue import _RANKED, ORACLE, _people, query
from weftline.sources.adapters import logical as T
from weftline.sources.adapters import with_tables
from weftline.streaming import quota

_HEADER = ["#", "Company", "Domain"]


# Notes and cards

_LINES = r"list_filter(list_transform(string_split(replace(replace(replace(regexp_replace(regexp_replace(coalesce(body, ''), '(?i)<br\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), chr(10)), lambda x: trim(x)), lambda x: x <> '')"


@query(f"""WITH l AS (SELECT ordinal, {_LINES} AS l FROM note_bodies)
SELECT ordinal, substr(coalesce(nullif(trim(substr(list_filter(l, lambda x: starts_with(lower(x), 'remarks:'))[1], 9)), ''),
  array_to_string(list_filter(l, lambda x: NOT regexp_matches(lower(x), '^(\\[pipeline tracker|sheet stage|category:|priority:|metadata:|script output:|last update:|status \\(|\\(phase-2)')), ' ' || chr(183) || ' ')), 1, 260) AS note FROM l""")
def note_cleanup(spark, d):
    return notes.plain(T(spark, d, "note_bodies"), "body", "text").select("ordinal", notes.cleanup(F.col("text")).alias("note"))


@query("SELECT ordinal, trim(regexp_replace(replace(CASE WHEN ordinal % 2 = 0 THEN trim(company_name) || chr(10) || 'Verified Company' ELSE company_name END, 'Verified Company', ' '), '\\s+', ' ', 'g')) AS name FROM listings")
def badge_removal(spark, d):
    card = F.when(F.col("ordinal") % 2 == 0, F.concat(F.trim("company_name"), F.lit("\nVerified Company"))).otherwise(F.col("company_name"))
    return T(spark, d, "listings").select("ordinal", notes.without_badge(card).alias("name"))


# Judge's answers


@query("""WITH a AS (SELECT ordinal, CASE WHEN json_valid(people) AND people LIKE '[%' THEN from_json(people, '["JSON"]') END AS l FROM answers),
p AS (SELECT ordinal, list_filter(list_transform(l, lambda x: {'n': trim(coalesce(x->>'$.name', '')), 'r': trim(coalesce(x->>'$.role', ''))}), lambda x: x.n <> '') AS l FROM a WHERE l IS NOT NULL)
SELECT ordinal, (k - 1)::INTEGER AS pos, l[k].n AS name, l[k].r AS role FROM (SELECT ordinal, l, unnest(range(1, len(l) + 1)) AS k FROM p)""")
def director_rows(spark, d):
    """Lists of any length, empty, broken off or no lists at all, with names that are blank, null or missing."""
    return T(spark, d, "answers").select("ordinal", F.posexplode(snapshots.directors(F.col("people"))).alias("pos", "p")).select("ordinal", "pos", "p.name", "p.role")


@query("SELECT ordinal, CASE WHEN list_contains(['yes', 'uncertain'], lower(trim(coalesce(verdict, '')))) THEN lower(trim(verdict)) ELSE 'no' END AS verdict FROM answers")
def verdict_coerce(spark, d):
    return T(spark, d, "answers").select("ordinal", snapshots.verdict(F.col("verdict")).alias("verdict"))


# Lists, sheets and templates


@query("""WITH n AS (SELECT {'f': '', 'l': ordinal::BIGINT} AS place, trim(name) AS name FROM exclusions
  UNION ALL SELECT {'f': CASE s_suppkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END, 'l': s_suppkey::BIGINT + 1}, CASE WHEN s_suppkey % 3 = 2 THEN 'firm ' || s_suppkey ELSE 'Firm ' || s_suppkey END FROM supplier)
SELECT 'name' AS kind, arg_min(name, place) AS value FROM n GROUP BY lower(name) UNION ALL SELECT 'domain', v FROM (SELECT domain AS v FROM exclusions WHERE domain IS NOT NULL
  UNION SELECT 'firm-' || s_suppkey || CASE s_suppkey % 3 WHEN 0 THEN '.co.in' ELSE '.com' END FROM supplier WHERE s_suppkey % 3 < 2 UNION SELECT 'nation-' || n_nationkey || '.org' FROM nation WHERE n_nationkey % 3 = 2)""")
def exclusion_rows(spark, d):
    rows = T(spark, d, "list_rows").select("file", "line", F.split("text", r"\|").alias("cells"))
    ex = T(spark, d, "exclusions")
    return exclusions.union(rows, T(spark, d, "domain_lines"), ex.select("ordinal", "name"), ex.where("domain IS NOT NULL").select("domain"))


@query("SELECT ordinal, CASE WHEN coalesce(header, '') = '' THEN 'create' WHEN header = '#|Company|Domain' THEN 'keep' WHEN header = '#' OR starts_with(header, '#|') THEN 'overwrite' ELSE 'insert' END AS action FROM answers")
def sheet_header_reconcile(spark, d):
    first = F.split(F.nullif("header", F.lit("")), r"\|")
    return T(spark, d, "answers").select("ordinal", exclusions.reconcile_header(first, _HEADER).alias("action"))


@query("SELECT 3 AS width, (max(ordinal) FILTER (WHERE ordinal % 3 <> 0) + 1)::BIGINT AS next_index FROM listings")
def template_next_index(spark, d):
    number = F.when(F.col("ordinal") % 3 == 0, F.concat(F.lit("x"), F.col("ordinal").cast("string"))).otherwise(F.col("ordinal").cast("string"))
    last = F.max(F.when(number.rlike(r"^\d+$"), number.cast("long")))
    return T(spark, d, "listings").agg(F.lit(len(_HEADER)).alias("width"), (F.coalesce(last, F.lit(0)) + 1).alias("next_index"))


_APPEND = f"""WITH {_RANKED},
w AS (SELECT domain, count(*) AS n, count(*) FILTER (WHERE f1) AS named, count(*) FILTER (WHERE rank = 1 AND f1 AND f2 AND f3 AND f4) AS complete FROM rk GROUP BY domain),
e AS (SELECT 'firm-' || c_custkey || '.co.in' AS domain, c_custkey, coalesce(n, 0) > 0 AS enriched, coalesce(named, 0) > 0 AS has_founder, coalesce(complete, 0) > 0 AS complete FROM customer LEFT JOIN w ON w.domain = 'firm-' || c_custkey || '.co.in')"""


@query(_APPEND + " SELECT domain, enriched, has_founder, complete FROM e")
def append_filters(spark, d):
    """What each filter of an append export asks of a firm: people at all, a real name, a first person with all four fields."""
    ranked = people.ranked(_people(spark, d))
    full = F.col("is_primary") & contact.is_full(*map(F.col, ("name", "linkedin_url", "phone", "email")))
    found = ranked.groupBy("domain").agg(F.lit(True).alias("enriched"), F.max(contact.real_name(F.col("name"))).alias("has_founder"), F.max(full).alias("complete"))
    firms = T(spark, d, "customer").select(F.concat(F.lit("firm-"), F.col("c_custkey").cast("string"), F.lit(".co.in")).alias("domain"))
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return firms.join(found, "domain", "left").select("domain", flag("enriched"), flag("has_founder"), flag("complete"))


@query("SELECT ordinal, [source, company_name, '', '', ''] AS wide, [source] AS narrow FROM listings")
def template_fit(spark, d):
    cells = F.array("source", "company_name")
    return T(spark, d, "listings").select("ordinal", exclusions.fit(cells, 5).alias("wide"), exclusions.fit(cells, 1).alias("narrow"))


# Provider snapshots


_FIRST = lambda *names: "coalesce(" + ", ".join(f"nullif(trim(x->>'$.{n}'), '')" for n in names) + ", '')"


@query(f"""WITH a AS (SELECT ordinal, CASE WHEN json_valid(found) AND found LIKE '[%' THEN from_json(found, '["JSON"]') END AS l FROM answers)
SELECT ordinal, (k - 1)::INTEGER AS pos, {_FIRST('name', 'full_name')} AS name, {_FIRST('headline', 'occupation')} AS headline, {_FIRST('experience_text', 'summary')} AS experience_text, {_FIRST('url', 'linkedin_url', 'profile_url')} AS url
FROM (SELECT ordinal, l[k] AS x, k FROM (SELECT ordinal, l, unnest(range(1, len(l) + 1)) AS k FROM a WHERE l IS NOT NULL))""")
def candidate_normalize(spark, d):
    """Candidates of any number with fields under several names, and answers that are no JSON."""
    return T(spark, d, "answers").select("ordinal", F.posexplode(snapshots.candidates(F.col("found"))).alias("pos", "p")).select("ordinal", "pos", "p.*")


@query("""WITH p AS (SELECT source AS site, doc_id, '[/p' || doc_id || '] ' || substr(text, 1, 9000) AS chunk FROM documents WHERE length(text) > 50),
r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY doc_id) AS n FROM p), t AS (SELECT *, coalesce(sum(length(chunk)) OVER (PARTITION BY site ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r WHERE n <= 3)
SELECT site, substr(string_agg(chunk, chr(10) || chr(10) ORDER BY n), 1, 9000) AS text FROM t WHERE before < 9000 GROUP BY site""")
def site_text_cap(spark, d):
    docs = T(spark, d, "documents")
    return snapshots.site_text(docs.select(F.col("source").alias("site"), F.col("doc_id").alias("priority"), F.concat(F.lit("/p"), F.col("doc_id").cast("string")).alias("path"), "text"))


@query("SELECT domain, CAST(ordinal AS VARCHAR) AS uid, name, trim(coalesce(role, '')) AS title, 100.0::DOUBLE AS company_score FROM people WHERE ordinal % 4 <> 3 AND name <> ''")
def founder_search(spark, d):
    p = T(spark, d, "people")
    firms = p.select("domain").distinct().withColumn("company_name", F.replace(F.split_part("domain", F.lit("."), F.lit(1)), F.lit("-"), F.lit(" ")))
    own = F.when(F.col("ordinal") % 4 == 3, "zzz qqq").otherwise(F.concat(F.replace(F.split_part("domain", F.lit("."), F.lit(1)), F.lit("-"), F.lit(" ")), F.lit(" Labs")))
    entry = lambda company, title: F.struct(company.alias("company"), title.alias("title"))
    experience = F.array(entry(F.lit("Other Ltd"), F.lit("CTO")), entry(own, F.col("role")))
    return snapshots.find_founders(firms, p.select("domain", F.col("ordinal").cast("string").alias("uid"), F.col("name").alias("full_name"), experience.alias("experience")))


def _reveals(spark, d):
    k = F.col("o_orderkey")
    link = lambda kind, address, rating: F.struct(F.lit(kind).alias("type"), address.alias("link"), rating.alias("rating"))
    return T(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("uid"), k.alias("ordinal"), F.when(k % 3 == 0, "failed").otherwise("success").alias("status"), F.array(F.concat(F.lit("98"), (F.lit(10000000) + k % 50).cast("string")), F.lit("12345")).alias("phones"),
        F.array(F.concat(F.lit("P"), (k % 5).cast("string"), F.lit("@x.com ")), F.lit("p0@X.com")).alias("emails"),
        F.array(link("li", F.concat(F.lit("https://li/"), k.cast("string")), (k % 3).cast("int")), link("LI", F.lit("https://li/z"), F.lit(1)), link("tw", F.lit("https://tw/z"), F.lit(9))).alias("social"),
    )


_REVEALED = """s AS (SELECT o_custkey::VARCHAR AS uid, o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0),
ph AS (SELECT uid, list(v ORDER BY place) AS phones FROM (SELECT uid, '+9198' || (10000000 + k % 50) AS v, min(k) AS place FROM s GROUP BY 1, 2) GROUP BY uid),
em AS (SELECT uid, list(v ORDER BY place) AS emails FROM (SELECT uid, min(place) AS place, arg_min(v, place) AS v FROM (SELECT uid, k * 2 AS place, 'P' || (k % 5) || '@x.com' AS v FROM s UNION ALL SELECT uid, k * 2 + 1, 'p0@X.com' FROM s) GROUP BY uid, lower(v)) GROUP BY uid),
li AS (SELECT uid, arg_min('https://li/' || k, k) AS linkedin FROM s GROUP BY uid),
revealed AS (SELECT uid, phones, emails, linkedin FROM li LEFT JOIN ph USING (uid) LEFT JOIN em USING (uid))"""


@query(f"WITH {_REVEALED} SELECT uid, phones, emails, linkedin FROM revealed")
def reveal_merge(spark, d):
    return snapshots.merge_reveals(_reveals(spark, d))


_ASKED = """a AS (SELECT domain, name, CASE WHEN ordinal % 3 = 0 THEN CAST(ordinal % 500 AS VARCHAR) END AS uid FROM (SELECT domain, name, min(ordinal) AS ordinal FROM people WHERE name <> '(verify)' GROUP BY 1, 2)),
f AS (SELECT domain, name, CAST(min(ordinal) % 700 AS VARCHAR) AS found, min(ordinal) AS o FROM people WHERE name <> '(verify)' GROUP BY 1, 2)"""


@query(f"""WITH {_ASKED}, {_REVEALED}, q AS (SELECT a.domain, a.name, coalesce(a.uid, CASE WHEN f.o % 4 <> 1 THEN f.found END) AS uid FROM a JOIN f ON a.domain = f.domain AND a.name = f.name)
SELECT q.domain, q.name, q.uid, coalesce(phones, []) AS phones, coalesce(emails, []) AS emails, linkedin FROM q LEFT JOIN revealed r ON q.uid = r.uid""")
def contact_resolution(spark, d):
    """People by the uid they have or the best profile's, with what its reveal gave."""
    named = T(spark, d, "people").where("name <> '(verify)'").groupBy("domain", "name").agg(F.min("ordinal").alias("o"))
    asked = named.select("domain", "name", F.when(F.col("o") % 3 == 0, (F.col("o") % 500).cast("string")).alias("uid"))
    best = named.where("o % 4 <> 1").select("domain", "name", (F.col("o") % 700).cast("string").alias("uid"))
    return snapshots.resolve_contacts(asked, best, snapshots.merge_reveals(_reveals(spark, d)))


@query("""WITH j AS (SELECT *, ordinal % 5 < 4 AND NOT coalesce(linkedin_confirmed, false) AND name NOT IN ('', '(verify)') AND ordinal % 7 <> 0 AS judged, CASE ordinal % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'uncertain' ELSE 'no' END AS v FROM people)
SELECT domain, ordinal, name, CASE WHEN judged AND v = 'yes' THEN 'https://li/' || ordinal ELSE linkedin_url END AS linkedin_url, CASE WHEN judged AND v = 'yes' THEN true ELSE linkedin_confirmed END AS linkedin_confirmed,
CASE WHEN judged AND v <> 'yes' THEN coalesce(nullif(notes, '') || '; ', '') || 'LI tentative (' || v || '): because' ELSE notes END AS notes FROM j""")
def namesake_guard(spark, d):
    p = T(spark, d, "people").select("domain", "ordinal", "name", "linkedin_url", "linkedin_confirmed", "notes")
    k = F.col("ordinal") % 5
    raw = F.when(k == 0, "Yes").when(k == 1, "no ").when(k == 2, "UNCERTAIN").otherwise("perhaps")
    answers = p.where(k < 4).select("ordinal", F.when(F.col("ordinal") % 7 != 0, F.concat(F.lit("https://li/"), F.col("ordinal").cast("string"))).alias("url"), raw.alias("match"), F.lit(" because ").alias("reason"))
    return snapshots.guard_namesakes(p, answers)


# CRM

_BY_MAIL = "m AS (SELECT lower(trim(email)) AS email, min(domain) AS domain FROM people WHERE coalesce(email, '') <> '' GROUP BY 1)"


@query(f"""WITH {_BY_MAIL}, t AS (SELECT lower(trim(email)) AS email, arg_max({{'o': call_outcome, 'n': call_notes}}, ordinal) AS r FROM feedback WHERE trim(email) <> '' AND (call_notes <> '' OR (coalesce(call_outcome, '') NOT IN ('', 'Not Called'))) GROUP BY 1)
SELECT t.email, m.domain, coalesce(nullif(r.o, ''), '(notes only)') AS outcome, r.n AS notes FROM t LEFT JOIN m ON t.email = m.email""")
def feedback_pull(spark, d):
    by_mail = T(spark, d, "people").where(firm.filled(F.col("email"))).groupBy(F.lower(F.trim("email")).alias("email")).agg(F.min("domain").alias("domain"))
    return crm.pull_feedback(T(spark, d, "feedback"), by_mail)


@query(f"""WITH {_RANKED}, p AS (SELECT domain, lower(trim(email)) AS email FROM rk WHERE rank = 1 AND f1 AND f2 AND f3 AND f4 AND domain IN (SELECT 'firm-' || c_custkey || '.co.in' FROM customer)),
s AS (SELECT domain, name FROM rk WHERE rank = 2 AND f1 AND domain IN (SELECT domain FROM p) AND domain NOT IN (SELECT domain FROM exclusions WHERE domain IS NOT NULL)),
n AS (SELECT * FROM p WHERE domain NOT IN (SELECT domain FROM deals WHERE stage_id <> 'unknown'))
SELECT 'company' AS object, domain AS key, NULL AS other FROM p UNION ALL SELECT DISTINCT 'contact', email, NULL FROM p UNION ALL SELECT 'contact-company', email, domain FROM p UNION ALL SELECT 'second-contact', name, domain FROM s
UNION ALL SELECT 'deal', domain, NULL FROM n UNION ALL SELECT 'deal-company', domain, domain FROM n UNION ALL SELECT 'deal-contact', domain, email FROM n""")
def crm_sync_rows(spark, d):
    ranked = people.ranked(_people(spark, d)).withColumn("full", contact.is_full(*map(F.col, ("name", "linkedin_url", "phone", "email")))).withColumn("real", contact.real_name(F.col("name")))
    firms = T(spark, d, "customer").select(F.concat(F.lit("firm-"), F.col("c_custkey").cast("string"), F.lit(".co.in")).alias("domain"))
    return crm.sync_rows(firms, ranked, T(spark, d, "deals").where("stage_id <> 'unknown'"), T(spark, d, "exclusions").where("domain IS NOT NULL"))


_CALLS = """c AS (SELECT event_id, deal_id, outcome, CASE WHEN event_id % 3 = 1 THEN 'M1V2' WHEN event_id % 3 = 2 THEN 'M1V1' ELSE '' END AS previous, event_id % 4 AS attempts, CASE WHEN event_id % 2 = 0 THEN 'said ' || event_id ELSE '' END AS call_notes,
  ts AS called_at, CASE WHEN event_id % 7 < 3 THEN ts + INTERVAL 26 HOUR END AS callback_at FROM outcomes),
t AS (SELECT *, outcome = 3 AND callback_at IS NOT NULL AS back, CASE outcome WHEN 1 THEN 'Connected - Interested' WHEN 2 THEN 'Connected - Rejected' WHEN 3 THEN 'Connected - Busy' WHEN 4 THEN 'Wrong Number' ELSE 'No Pickup' END AS label,
  outcome IN (1, 3, 4) OR (outcome = 5 AND previous <> 'M1V1') AS has_task, called_at::DATE + (CASE isodow(called_at) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END)::INTEGER AS bd FROM c)"""


@query(f"""WITH {_CALLS} SELECT event_id, deal_id, label AS call_outcome, (attempts + 1)::BIGINT AS call_attempt_count,
CASE outcome WHEN 1 THEN 'M1V1 Sent' WHEN 2 THEN 'Dead - Rejected' WHEN 5 THEN CASE previous WHEN '' THEN 'M1V2 Sent' WHEN 'M1V2' THEN 'M1V1 Sent' ELSE 'Dead - No Response' END ELSE 'Call Attempted' END AS stage,
CASE WHEN outcome = 1 THEN 'M1V1' WHEN outcome = 5 AND previous = '' THEN 'M1V2' WHEN outcome = 5 AND previous = 'M1V2' THEN 'M1V1' END AS version, CASE WHEN outcome = 1 THEN 'true' END AS calendly_link_sent, CASE WHEN outcome = 4 THEN 'true' END AS needs_number_lookup,
CASE WHEN back THEN callback_at END AS callback_datetime,
'[' || strftime(called_at, '%Y-%m-%d %H:%M') || ' UTC] call #' || (attempts + 1) || ' ' || chr(8212) || ' ' || label || CASE WHEN call_notes <> '' THEN ': ' || call_notes WHEN outcome = 2 THEN ' (no reason recorded)' ELSE '' END || CASE WHEN outcome = 4 THEN ' | Wrong number - needs Apollo/alternate lookup' ELSE '' END AS note_line,
CASE WHEN back THEN 'Callback - Firm ' || deal_id WHEN NOT has_task THEN NULL WHEN outcome = 1 THEN 'Follow up - no meeting booked' WHEN outcome = 3 THEN 'Callback - was busy' WHEN outcome = 4 THEN 'Apollo lookup - wrong number' WHEN previous = '' THEN 'Call again - no pickup' ELSE 'Final follow-up call' END AS task_subject,
strftime(CASE WHEN back THEN callback_at WHEN NOT has_task THEN NULL WHEN outcome = 4 THEN called_at + INTERVAL 2 HOUR ELSE bd::TIMESTAMP END, '%Y-%m-%d %H:%M') AS task_due,
CASE WHEN NOT has_task THEN NULL WHEN back OR outcome = 4 OR (outcome = 5 AND previous = 'M1V2') THEN 'HIGH' ELSE 'MEDIUM' END AS task_priority, CASE WHEN has_task THEN CASE WHEN outcome = 4 THEN 'TODO' ELSE 'CALL' END END AS task_type FROM t""")
def call_results(spark, d):
    e = F.col("event_id")
    calls = T(spark, d, "outcomes").select(
        "event_id", "deal_id", "outcome", F.when(e % 3 == 1, "M1V2").when(e % 3 == 2, "M1V1").otherwise("").alias("previous"), (e % 4).alias("attempts"), F.when(e % 2 == 0, F.concat(F.lit("said "), e.cast("string"))).otherwise("").alias("call_notes"),
        F.col("ts").alias("called_at"), F.when(e % 7 < 3, F.col("ts") + F.expr("INTERVAL 26 HOURS")).alias("callback_at"), F.concat(F.lit("Firm "), F.col("deal_id").cast("string")).alias("company"),
    )
    return crm.call_results(calls)


# A fold of each deal's outcomes in order, against the counts that Spark takes.
_STEP = "CASE WHEN o = '1' THEN 'M1V1' WHEN o = '5' THEN CASE v WHEN '' THEN 'M1V2' WHEN 'M1V2' THEN 'M1V1' ELSE v END ELSE v END"
_FOLD = with_tables(f"""WITH l AS (SELECT deal_id, list(outcome::VARCHAR ORDER BY ts, event_id) AS l FROM outcomes GROUP BY deal_id),
f AS (SELECT deal_id, len(l)::BIGINT AS n, l[-1] AS last, list_reduce(list_prepend('', l), lambda v, o: {_STEP}) AS version, list_reduce(list_prepend('', l[:-2]), lambda v, o: {_STEP}) AS before FROM l)
SELECT deal_id, n, CASE last WHEN '1' THEN 'M1V1 Sent' WHEN '2' THEN 'Dead - Rejected' WHEN '5' THEN CASE before WHEN '' THEN 'M1V2 Sent' WHEN 'M1V2' THEN 'M1V1 Sent' ELSE 'Dead - No Response' END ELSE 'Call Attempted' END AS stage, version FROM f""")
ORACLE["escalation_fold"] = _FOLD


@query()
def stream_escalation(spark, d):
    """Where each deal stands, kept as a stream's state: counts and a maximum of each deal, so the state is a row a deal."""
    events = spark.read.parquet(f"{d}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(f"{d}/events.parquet*")
    outcomes = stream.select("event_id", F.col("user_id").alias("deal_id"), "ts", (F.col("event_id") % 5 + 1).cast("int").alias("outcome"))
    out = quota.run_available(spark, crm.escalate(outcomes), "complete")
    return out.join(out.agg(F.max("batch").alias("batch")), "batch", "left_semi").select("deal_id", "n", "stage", "version")


ORACLE["stream_escalation"] = _FOLD
