"""Queries over what is handed over: whole rows of the deliverable and the sheets, and lists read from files."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import deliverables, exclusions
from weftline.plans.catalogue import _GATED, _RANKED, _gated, _people, query
from weftline.scratch import fresh_path, materialize
from weftline.sources import lists
from weftline.sources.adapters import logical as T

_SEARCH = "https://search.example/?q="
_FORM = "replace(replace(replace(replace(replace(trim(company || ' ' || coalesce(city, '') || ' software company'), '&', '%26'), '(', '%28'), ')', '%29'), ',', '%2C'), ' ', '+')"
_ALONE = r"""CASE WHEN real{r} AND len(s{r}) > 0 AND list_distinct(s{r}) = ['directory'] THEN 'founder ''' || name{r} || ''' via Directory - verify' END"""
_MADE = rf"""WITH {_GATED}, {_RANKED},
sd AS (SELECT *, list_filter(list_transform(string_split(regexp_extract(coalesce(notes, ''), '(?i)sources:\s*([a-z_,\s]+)', 1), ','), lambda x: lower(trim(x))), lambda x: x <> '') AS s,
  array_to_string(list_filter(list_transform(string_split(coalesce(notes, ''), ';'), lambda x: trim(x)), lambda x: x <> '' AND NOT starts_with(lower(x), 'sources:')), '; ') AS human,
  CASE WHEN NOT f1 THEN '(verify)' WHEN coalesce(role, '') <> '' THEN name || ' (' || role || ')' ELSE name END AS shown FROM rk),
pp AS (SELECT domain, count(*) AS n_people, count(*) FILTER (WHERE f1) AS real_names, string_agg(shown, '; ' ORDER BY rank) FILTER (WHERE rank <= 2) AS founders,
  {', '.join(f"max({c}) FILTER (WHERE rank = {r}) AS {a}{r}" for r in (1, 2) for c, a in (("name", "name"), ("linkedin_url", "li"), ("phone", "ph"), ("email", "em"), ("human", "human"), ("f1", "real")))}, {', '.join(f"any_value(s) FILTER (WHERE rank = {r}) AS s{r}" for r in (1, 2))},
  any_value(list_filter([CASE WHEN NOT f1 THEN 'Founder' END, CASE WHEN NOT f2 THEN 'LinkedIn' END, CASE WHEN NOT f3 THEN 'Phone' END, CASE WHEN NOT f4 THEN 'Email' END], lambda x: x IS NOT NULL)) FILTER (WHERE rank = 1) AS gone FROM sd GROUP BY domain),
mg AS (SELECT g.*, coalesce(g.company_name, '') AS company, pp.* EXCLUDE (domain), trim(coalesce(size_source, '')) AS t, array_to_string(list_transform(sources, lambda s: CASE s WHEN 'north' THEN 'North Directory' WHEN 'south' THEN 'South Directory' ELSE upper(s[1]) || s[2:] END), '; ') AS base
  FROM gated g LEFT JOIN pp ON g.domain = pp.domain WHERE gate_pass),
made AS (SELECT domain, company, coalesce(n_people, 0) AS n_people, coalesce(real_names, 0) AS real_names, gone,
  '=HYPERLINK("' || CASE WHEN coalesce(website, '') = '' THEN '{_SEARCH}' || {_FORM} WHEN contains(website, '://') THEN website ELSE 'https://' || website END || '","' || replace(company, '"', '""') || '")' AS company_link,
  coalesce(founders, '(verify)') AS founders, coalesce(li1, '') AS linkedin, coalesce(ph1, '') AS phone, coalesce(li2, '') AS linkedin2, coalesce(ph2, '') AS phone2,
  CASE WHEN ph1 LIKE '+%' THEN '''' || ph1 ELSE coalesce(ph1, '') END AS sheet_phone, CASE WHEN ph2 LIKE '+%' THEN '''' || ph2 ELSE coalesce(ph2, '') END AS sheet_phone2,
  coalesce(founded_year::VARCHAR, '') AS year, coalesce(hq_country, '') AS hq, coalesce(size_band, '') AS headcount,
  CASE WHEN t = '' OR replace(t, ' ', '') = replace(coalesce(size_band, ''), ' ', '') THEN base WHEN base <> '' THEN base || ' (' || t || ')' ELSE t END AS headcount_source,
  coalesce(segment, '') AS segment, '' AS status, list_filter([gate_reason, {_ALONE.format(r=1)}, CASE WHEN real1 THEN human1 END, {_ALONE.format(r=2)}, CASE WHEN real2 THEN human2 END], lambda x: coalesce(x, '') <> '') AS parts,
  coalesce(em1, '') AS email, coalesce(size_bucket, '') AS size_bucket FROM mg),
m AS (SELECT * EXCLUDE (parts), array_to_string(list_filter(list_transform(parts, lambda x, i: CASE WHEN list_position(parts, x) = i THEN x END), lambda x: x IS NOT NULL), ' | ') AS notes FROM made)"""


_LABELS_OF = {"north": "North Directory", "south": "South Directory"}


def _rows(spark, d):
    return materialize(deliverables.rows(_gated(spark, d, False), _people(spark, d), _LABELS_OF, _SEARCH), "deliverable")


_CELLS = ", ".join(deliverables.DELIVERABLE[1:])


@query(f"{_MADE} SELECT domain, CAST(row_number() OVER (ORDER BY domain) AS VARCHAR) AS no, {_CELLS} FROM m")
def deliverable_rows(spark, d):
    """The deliverable: 16 cells for each firm that passes the gates."""
    return deliverables.deliverable(_rows(spark, d))


@query(f"{_MADE} SELECT domain, row_number() OVER (ORDER BY domain) + 40 AS no, [CAST(row_number() OVER (ORDER BY domain) + 40 AS VARCHAR), {_CELLS}, '', ''] AS cells FROM m WHERE n_people > 0 AND real_names > 0 AND domain NOT IN (SELECT domain FROM exclusions WHERE domain IS NOT NULL)")
def append_sheet_rows(spark, d):
    """What is appended to a sheet of 18 columns from number 41: firms with a named founder that aren't excluded."""
    ex = T(spark, d, "exclusions").where("domain IS NOT NULL")
    return deliverables.append_rows(_rows(spark, d), 18, 41, ex, founder=True)


@query(f"""{_MADE}, sheet AS (SELECT n_nationkey::VARCHAR AS no, 'FIRM ' || n_nationkey * 7 || ' technologies ' AS display, 'firm-' || n_nationkey * 5 || '.co.in' AS domain FROM nation)
SELECT CAST(row_number() OVER (ORDER BY domain) + 24 AS VARCHAR) AS no, {', '.join(deliverables.QUALIFIED[1:-1])}, '2026-01-05T00:00:00' AS synced_at FROM m WHERE n_people > 0 AND len(gone) = 0
  AND domain NOT IN (SELECT domain FROM exclusions WHERE domain IS NOT NULL) AND domain NOT IN (SELECT domain FROM sheet) AND lower(trim(company)) NOT IN (SELECT lower(trim(display)) FROM sheet)""")
def qualified_sheet_rows(spark, d):
    """18 cells of the firms with all four fields that a sheet lacks."""
    k = F.col("n_nationkey").cast("string")
    sheet = T(spark, d, "nation").select(k.alias("no"), F.concat(F.lit("FIRM "), (F.col("n_nationkey") * 7).cast("string"), F.lit(" technologies ")).alias("display"), F.concat(F.lit("firm-"), (F.col("n_nationkey") * 5).cast("string"), F.lit(".co.in")).alias("domain"))
    return deliverables.qualified(_rows(spark, d), T(spark, d, "exclusions"), sheet, "2026-01-05T00:00:00")


@query(f"{_MADE} SELECT {', '.join(c for c in deliverables.REVIEW if c != 'missing')}, gone[1] AS missing FROM m WHERE n_people > 0 AND len(gone) = 1")
def review_sheet_rows(spark, d):
    """12 cells of the firms that lack one of the four fields."""
    return deliverables.review(_rows(spark, d))


_PCT = lambda what: f"CASE WHEN count(*) FILTER (WHERE n_people > 0) = 0 THEN '0%' ELSE printf('%.0f%%', round_even(100.0 * count(*) FILTER (WHERE n_people > 0 AND {what}) / count(*) FILTER (WHERE n_people > 0), 0)) END"


@query(f"""{_MADE} SELECT '2026-01-05' AS day, count(*) FILTER (WHERE n_people > 0)::BIGINT AS enriched, count(*) FILTER (WHERE n_people > 0 AND len(gone) = 0)::BIGINT AS qualified, count(*) FILTER (WHERE n_people > 0 AND len(gone) = 1)::BIGINT AS review,
{', '.join(f"{_PCT(f'NOT list_contains(gone, {chr(39)}{f}{chr(39)})')} AS {f.lower()}_pct" for f in ("Founder", "LinkedIn", "Phone", "Email"))}, {_PCT('len(gone) = 0')} AS all_pct FROM m""")
def stats_row(spark, d):
    """The row of figures: counts, and percents rounded half to even."""
    return deliverables.stats(_rows(spark, d), "2026-01-05")


# Lists from files


@query("""WITH n AS (SELECT CASE s_suppkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS f, CASE s_suppkey % 3 WHEN 1 THEN 'FIRM ' ELSE 'Firm ' END || s_suppkey // 2 AS name FROM supplier)
SELECT 'name' AS kind, lower(name) AS value FROM n GROUP BY 2 UNION SELECT 'domain', 'firm-' || s_suppkey || '.com.vn' FROM supplier WHERE s_suppkey % 3 = 0 UNION SELECT 'domain', 'nation-' || n_nationkey || '.org' FROM nation WHERE n_nationkey % 3 = 2""")
def exclusion_files(spark, d):
    """Exclusions out of a folder of files with headers of their own, one of them broken, one named twice, one absent, and an export that is left out."""
    home = fresh_path(spark, "lists")
    k = F.col("s_suppkey")
    name = F.concat(F.when(k % 3 == 1, "FIRM ").otherwise("Firm "), F.floor(k / 2).cast("string"))
    s = T(spark, d, "supplier").withColumn("name", name).withColumn("site", F.concat(F.lit("https://www.firm-"), k.cast("string"), F.lit(".com.vn/x")))
    put = lambda df, at: df.coalesce(1).write.option("header", True).csv(f"{home}/{at}")
    put(s.where(k % 3 == 0).select(F.lit("1").alias("#"), F.col("name").alias("Company"), F.col("site").alias("Website")), "a")
    put(s.where(k % 3 == 1).select(F.lit("y").alias("X"), F.col("name").alias("Y")), "b")
    put(s.where(k % 3 == 2).select(F.col("name").alias(" FIRM ")), "c")
    put(s.select(F.concat(F.lit("delivered "), "name").alias("Company")), "exports/d")
    lines = T(spark, d, "domain_lines")
    lines.coalesce(1).write.text(f"{home}/e")
    paths = [f"{home}/{x}" for x in ("a", "b", "c", "./a/", "absent", "e", "exports/d")]
    rows, text = lists.read_rows(spark, paths, f"{home}/exports"), lists.read_lines(spark, paths, f"{home}/exports")
    none = spark.createDataFrame([], "ordinal long, name string"), spark.createDataFrame([], "domain string")
    found = exclusions.union(rows, text, *none)
    return found.select("kind", F.lower("value").alias("value"))
