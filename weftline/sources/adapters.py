"""Logical tables derived from the driver's tables.

Each is one SQL text that Spark and other engines read alike, a pure function
of keys, so results can be held against SQL over the same tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Name -> SQL over the driver's tables and earlier names.
SQL: dict[str, str] = {
    "listings": """
SELECT o.o_orderkey AS ordinal,
  CASE o.o_orderkey % 6 WHEN 0 THEN 'north' WHEN 1 THEN 'south' WHEN 2 THEN 'east' WHEN 3 THEN 'west' WHEN 4 THEN 'central' ELSE 'coast' END AS source,
  concat('https://directory.example/', CAST(o.o_orderkey AS STRING)) AS source_url,
  CASE WHEN o.o_orderkey % 23 = 0 THEN '' WHEN o.o_orderkey % 61 = 4 THEN CASE o.o_orderkey % 7 WHEN 0 THEN 'T-Systems, India' WHEN 1 THEN 'The Cap-Gemini. Group of Pune Works Ltd' WHEN 2 THEN 'Meier & Söhne, Köln' WHEN 3 THEN 'Pre-A.B.Works'
       WHEN 4 THEN 'A.B. Works' WHEN 5 THEN 'Bestsystems T' ELSE 'Big_Cap-Gemini' END WHEN o.o_orderkey % 5 = 0 THEN concat('Firm ', CAST(c.c_custkey AS STRING), ' Technologies')
       WHEN o.o_orderkey % 5 = 1 THEN concat('  Firm ', CAST(c.c_custkey AS STRING)) WHEN o.o_orderkey % 5 = 2 THEN concat('FIRM-', CAST(c.c_custkey AS STRING), ' (India) Ltd')
       ELSE concat('Firm ', CAST(c.c_custkey AS STRING), ' Pvt Ltd') END AS company_name,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL WHEN o.o_orderkey % 17 = 1 THEN 'see our page' WHEN o.o_orderkey % 29 = 3 THEN concat('https://careers.firm-', CAST(c.c_custkey AS STRING), '.ac.in/x')
       WHEN o.o_orderkey % 31 = 4 THEN concat('firm-', CAST(c.c_custkey AS STRING), '.tech/about') WHEN o.o_orderkey % 37 = 5 THEN 'co.in' WHEN o.o_orderkey % 41 = 6 THEN concat('http://me@Shop.Firm-', CAST(c.c_custkey AS STRING), '.COM.AU:81')
       WHEN o.o_orderkey % 43 = 7 THEN concat('a.b.firm-', CAST(c.c_custkey AS STRING), '.de') WHEN o.o_orderkey % 47 = 8 THEN concat('x.firm-', CAST(c.c_custkey AS STRING), '.np')
       WHEN o.o_orderkey % 53 = 9 THEN concat('https://firm-', CAST(c.c_custkey AS STRING), CASE o.o_orderkey % 13 WHEN 0 THEN '.com.vn' WHEN 1 THEN '.com.ph' WHEN 2 THEN '.com.pl' WHEN 3 THEN '.co.at' WHEN 4 THEN '.com.co' WHEN 5 THEN '.com.eg' WHEN 6 THEN '.com.qa'
            WHEN 7 THEN '.com.gh' WHEN 8 THEN '.insure' WHEN 9 THEN '.dental/a' WHEN 10 THEN '.city.kawasaki.jp' WHEN 11 THEN '.a.kawasaki.jp' ELSE '.nosuchsuffix' END) WHEN o.o_orderkey % 59 = 10 THEN 'com.vn' WHEN o.o_orderkey % 4 = 0 THEN concat('https://www.firm-', CAST(c.c_custkey AS STRING), '.co.in/about?x=1')
       WHEN o.o_orderkey % 4 = 1 THEN concat('HTTP://FIRM-', CAST(c.c_custkey AS STRING), '.CO.IN') WHEN o.o_orderkey % 4 = 2 THEN concat('  firm-', CAST(c.c_custkey AS STRING), '.co.in:8080/x ')
       ELSE concat('blog.firm-', CAST(c.c_custkey AS STRING), '.co.in#top') END AS website_raw,
  CASE WHEN o.o_orderkey % 11 = 0 THEN '' ELSE concat(n.n_name, ' , India') END AS city,
  CASE o.o_orderkey % 6 WHEN 0 THEN concat('since ', CAST(year(o.o_orderdate) + 18 AS STRING)) WHEN 1 THEN concat('Founded ', CAST(year(o.o_orderdate) + 20 AS STRING))
       WHEN 2 THEN concat(CAST(c.c_custkey % 40 AS STRING), '+ years') WHEN 3 THEN 'two decades' WHEN 4 THEN NULL ELSE 'long ago' END AS founded_raw,
  CASE o.o_orderkey % 7 WHEN 0 THEN '10 - 49' WHEN 1 THEN '50 - 249' WHEN 2 THEN '250 - 999' WHEN 3 THEN '1,000+' WHEN 4 THEN NULL WHEN 5 THEN '300' ELSE 'Freelancer (1)' END AS size_raw,
  CASE WHEN o.o_orderkey % 3 = 0 THEN '' ELSE c.c_mktsegment END AS segment_raw,
  CASE o.o_orderkey % 9 WHEN 0 THEN 'United States' WHEN 1 THEN ' INDIA' WHEN 2 THEN '' WHEN 3 THEN 'India' ELSE NULL END AS hq_raw
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
    "people": """
SELECT concat('firm-', CAST(o.o_custkey AS STRING), '.co.in') AS domain, min(o.o_orderkey * 10 + l.l_linenumber) * 100000 + s.s_suppkey AS ordinal,
  CASE WHEN s.s_suppkey % 9 = 0 THEN '(verify)' ELSE concat('Person', CAST(s.s_suppkey AS STRING), ' Of ', CAST(s.s_suppkey % 7 AS STRING)) END AS name,
  CASE s.s_suppkey % 4 WHEN 0 THEN 'Founder' WHEN 1 THEN 'CEO' WHEN 2 THEN '' ELSE NULL END AS role,
  CASE s.s_suppkey % 3 WHEN 0 THEN 'registry' WHEN 1 THEN 'company_site' ELSE 'directory' END AS name_source,
  CASE WHEN s.s_suppkey % 5 = 0 THEN NULL ELSE concat('https://people.example/in/', CAST(s.s_suppkey AS STRING)) END AS linkedin_url,
  s.s_suppkey % 2 = 0 AS linkedin_confirmed,
  CASE s.s_suppkey % 6 WHEN 0 THEN concat('+91 98', CAST(10000000 + s.s_suppkey AS STRING)) WHEN 1 THEN concat('098', CAST(10000000 + s.s_suppkey AS STRING))
       WHEN 2 THEN concat('0091-98', CAST(10000000 + s.s_suppkey AS STRING)) WHEN 3 THEN concat('98', CAST(10000000 + s.s_suppkey AS STRING)) WHEN 4 THEN '12345' ELSE NULL END AS phone_raw,
  CASE WHEN s.s_suppkey % 4 = 3 THEN NULL ELSE concat('p', CAST(s.s_suppkey AS STRING), '@firm-', CAST(o.o_custkey AS STRING), '.co.in') END AS email,
  CASE s.s_suppkey % 4 WHEN 0 THEN 'sources: registry, company_site; checked by hand' WHEN 1 THEN 'Sources: Directory' WHEN 2 THEN 'call first' ELSE NULL END AS notes
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY o.o_custkey, s.s_suppkey
""",
    # Stages with how far a deal is in each (the place in the sequence of open stages, or the one at which a lost deal stood), and whether it is closed and won. Ids of stages that event types don't name begin with 's'.
    "stage_dim": """
SELECT * FROM (VALUES ('click', 'Interested', 2, false, false), ('view', 'No Pickup', 1, false, false), ('error', 'Dead/ColdCall/Not Interested', 1, true, false),
  ('purchase', 'Closed/Won', 11, true, true), ('signup', 'Commercial Negotiation', 6, false, false),
  ('s0', 'Cold Call', 0, false, false), ('s1', 'GMeet Fixed', 3, false, false), ('s2', 'Script Shared', 4, false, false), ('s3', 'Script Results Received', 5, false, false), ('s4', 'Deal Contract Signed', 7, false, false),
  ('s5', 'Dead/ColdCall/WrongNumber', 1, true, false), ('s6', 'Dead/ColdCall/NoPickup', 1, true, false), ('s7', 'Dead/GMeet/NoShow', 3, true, false), ('s8', 'Dead/GMeet/wrong fit', 3, true, false), ('s9', 'Dead/GMeet/Privacy Concerns', 3, true, false),
  ('s10', 'Dead/ResultsReceived/WrongFit-Rejected', 5, true, false), ('s11', 'Dead/Negotiation/Pricing', 6, true, false), ('s12', 'Dead/Negotiation/Contractual', 6, true, false), ('s13', 'Dead/ColdCall/WrongFit', 0, true, false)) AS t(stage_id, label, depth, is_closed, is_won)
""",
    # The stages that, when a deal enters one, count for a metric.
    "metric_dim": """
SELECT * FROM (VALUES ('att', 'No Pickup'), ('att', 'Dead/ColdCall/WrongNumber'), ('att', 'Dead/ColdCall/Not Interested'), ('att', 'Dead/ColdCall/NoPickup'), ('att', 'Interested'),
  ('conn', 'Dead/ColdCall/Not Interested'), ('conn', 'Interested'),
  ('gm', 'GMeet Fixed'),
  ('vc', 'Dead/GMeet/NoShow'), ('vc', 'Dead/GMeet/wrong fit'), ('vc', 'Dead/GMeet/Privacy Concerns'), ('vc', 'Script Shared'),
  ('ss', 'Script Shared'),
  ('rr', 'Script Results Received'),
  ('ev', 'Dead/ResultsReceived/WrongFit-Rejected'), ('ev', 'Commercial Negotiation'),
  ('cn', 'Commercial Negotiation'),
  ('neg', 'Dead/Negotiation/Pricing'), ('neg', 'Dead/Negotiation/Contractual'), ('neg', 'Deal Contract Signed'),
  ('dcs', 'Deal Contract Signed'),
  ('won_d', 'Closed/Won')) AS t(metric, stage_label)
""",
    "stage_history": """
SELECT event_id, user_id AS deal_id, CASE WHEN event_id % 4 = 3 THEN concat('s', CAST(event_id % 17 AS STRING)) ELSE event_type END AS stage_id, ts, event_id % 8 AS actor, CASE WHEN event_id % 5 < 3 THEN 'CRM_UI' ELSE 'INTEGRATION' END AS source_type, value FROM events
""",
    "deals": """
SELECT c_custkey AS deal_id, c_custkey % 8 AS owner, CASE c_custkey % 3 WHEN 0 THEN 'scraped' WHEN 1 THEN 'campaign' ELSE 'other' END AS pipeline, c_acctbal AS amount, c_mktsegment AS segment,
  CASE c_custkey % 4 WHEN 0 THEN 'India south' WHEN 1 THEN 'Indonesia, India' WHEN 2 THEN '' ELSE NULL END AS lead_source,
  CASE c_custkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'purchase' WHEN 2 THEN 'error' WHEN 3 THEN 'signup' ELSE CASE WHEN c_custkey % 10 = 9 THEN concat('s', CAST(c_custkey % 15 AS STRING)) ELSE 'unknown' END END AS stage_id,
  CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' ELSE CAST(c_acctbal AS STRING) END AS loc_text, concat('firm-', CAST(c_custkey AS STRING), '.co.in') AS domain,
  concat('2024-01-', lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0')) AS created_day FROM customer
""",
    "charges": """
SELECT event_id, event_type AS provider, ts, 1 + event_id % 3 AS delta, CASE WHEN event_id % 10 = 0 THEN NULL ELSE 1000 + event_id % 7 END AS limit_value FROM events
""",
    "feedback": """
SELECT o_orderkey AS ordinal, CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE concat(' P', CAST(o_orderkey % 40 AS STRING), '@FIRM-', CAST(o_custkey AS STRING), '.co.in ') END AS email,
  CASE o_orderkey % 6 WHEN 0 THEN 'Interested' WHEN 1 THEN 'Rejected' WHEN 2 THEN 'Busy' WHEN 3 THEN 'No Pickup' WHEN 4 THEN '' ELSE NULL END AS call_outcome,
  CASE WHEN o_orderkey % 4 = 0 THEN concat('note ', CAST(o_orderkey AS STRING)) ELSE '' END AS call_notes, o_orderdate AS pulled_at FROM orders
""",
    "exclusions": """
SELECT s_suppkey AS ordinal, concat('Firm ', CAST(s_suppkey * 3 AS STRING), CASE s_suppkey % 3 WHEN 0 THEN ' Solutions' WHEN 1 THEN ' LLP' ELSE '' END) AS name,
  CASE WHEN s_suppkey % 4 = 0 THEN concat('firm-', CAST(s_suppkey AS STRING), '.co.in') ELSE NULL END AS domain FROM supplier
""",
    "note_bodies": """
SELECT o_orderkey AS ordinal, CASE o_orderkey % 6 WHEN 0 THEN concat('<p>Category: x<br>Remarks: call &amp; ask ', CAST(o_orderkey AS STRING), '</p>') WHEN 1 THEN concat('line one<br/>Priority: high<BR >second &lt;b&gt; ', CAST(o_orderkey AS STRING), '<br>')
  WHEN 2 THEN NULL WHEN 3 THEN '' WHEN 4 THEN 'Remarks: <br> Status (old) <br>kept' ELSE concat('<b>', repeat('long text ', 40), '</b>') END AS body FROM orders
""",
    "list_rows": """
SELECT 'a' AS file, 0 AS line, '#|Company|Website' AS text UNION ALL SELECT 'b' AS file, 0 AS line, 'X|Y' AS text UNION ALL SELECT 'c' AS file, 0 AS line, ' FIRM ' AS text UNION ALL
SELECT CASE s_suppkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS file, CAST(s_suppkey + 1 AS INT) AS line,
  CASE s_suppkey % 3 WHEN 0 THEN concat('1|Firm ', CAST(s_suppkey AS STRING), '|https://www.firm-', CAST(s_suppkey AS STRING), '.co.in/x') WHEN 1 THEN concat('y|=HYPERLINK("https://firm-', CAST(s_suppkey AS STRING), '.com","Firm ', CAST(s_suppkey AS STRING), '")')
  ELSE concat(' firm ', CAST(s_suppkey AS STRING), ' ') END AS text FROM supplier
""",
    "answers": """
SELECT ordinal, CASE ordinal % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat('[{"name":"Asha ', CAST(ordinal AS STRING), '","role":') WHEN 3 THEN concat('no list ', CAST(ordinal AS STRING)) WHEN 4 THEN '[]'
  ELSE concat('[', repeat(concat('{"name":" Asha ', CAST(ordinal AS STRING), ' ","role":"CEO "},'), CAST(ordinal % 5 AS INT)), '{"name":"  ","role":"x"},{"role":"none"},{"name":null},{"name":"Ravi ', company_name, '","role":null,"more":', CAST(ordinal % 3 AS STRING), '}]') END AS people,
  CASE ordinal % 8 WHEN 0 THEN NULL WHEN 1 THEN '[{"name":' WHEN 2 THEN 'not JSON' ELSE concat('[', repeat(concat('{"name":" P', CAST(ordinal AS STRING), '","full_name":"other","headline":"","occupation":"CEO","profile_url":"https://x/', CAST(ordinal AS STRING), '"},'), CAST(ordinal % 4 AS INT)),
    '{"full_name":"Q ', company_name, '","summary":" built things ","experience_text":" ","url":null,"linkedin_url":"https://y/', CAST(ordinal AS STRING), '"}]') END AS found,
  CASE ordinal % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'YES' WHEN 3 THEN ' yes  ' WHEN 4 THEN 'Uncertain' WHEN 5 THEN 'yes, surely' WHEN 6 THEN 'NO' WHEN 7 THEN 'unsure' WHEN 8 THEN company_name WHEN 9 THEN '  uncertain' ELSE 'y' END AS verdict,
  CASE ordinal % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '#|Company|Domain' WHEN 3 THEN '#|Company' WHEN 4 THEN '#|Company|Domain|More' WHEN 5 THEN concat(CAST(ordinal AS STRING), '|', company_name) WHEN 6 THEN '#' WHEN 7 THEN 'Company|#|Domain' WHEN 8 THEN '#|Domain|Company' ELSE ' #|Company|Domain' END AS header
FROM listings
""",
    "domain_lines": """
SELECT CASE n_nationkey % 3 WHEN 0 THEN '# a comment' WHEN 1 THEN '  ' ELSE concat('  www.nation-', CAST(n_nationkey AS STRING), '.org/x ') END AS line FROM nation
""",
    "outsourcers": """
SELECT n_nationkey AS ordinal, CASE n_nationkey WHEN 1 THEN 'T-Systems' WHEN 2 THEN ' Cap-Gemini ' WHEN 3 THEN '& SÖHNE' WHEN 4 THEN 'A.B.' WHEN 5 THEN 'söhne' ELSE concat('Firm ', CAST(n_nationkey * 40 + 107 AS STRING), ' Technologies') END AS term FROM nation
""",
    "outcomes": """
SELECT event_id, user_id AS deal_id, ts, CAST(event_id % 5 + 1 AS INT) AS outcome FROM events
""",
}
_NEEDS = {name: set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)\b", text)) for name, text in SQL.items()}

#: Tables that a logical table joins and then groups by far more keys than tasks, and the keys by which they are dealt to as many tasks as shuffles have before that: by their size alone they would meet in a few tasks, each with the hash table of its share.
_DEALT = {"people": {"orders": "o_orderkey", "lineitem": "l_orderkey"}}


def logical(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A logical table, or one of the driver's own."""
    if name not in SQL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = SQL[name].replace("{", "{{").replace("}", "}}")  # braces of texts, not of frames
    frames = {t: logical(spark, sf_dir, t) for t in _NEEDS[name]}
    for t, key in _DEALT.get(name, {}).items():
        frames[t] = frames[t].repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)
    for t in frames:
        text = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **frames) if frames else spark.sql(text)


def with_tables(sql: str) -> str:
    """SQL with the logical tables that it names defined in front."""
    named = {n for n in SQL if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", sql)}
    while more := {m for n in named for m in _NEEDS[n] if m in SQL} - named:
        named |= more
    used = [n for n in SQL if n in named]
    parts = [f"{n} AS ({SQL[n].strip()})" for n in used]
    body = sql.strip()
    if not parts:
        return body
    recursive = "WITH RECURSIVE " if body.upper().startswith("WITH RECURSIVE ") else "WITH "
    if body.upper().startswith(recursive):
        return recursive + ",\n".join(parts) + ",\n" + body[len(recursive) :]
    return recursive + ",\n".join(parts) + "\n" + body
