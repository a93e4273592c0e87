"""Provider and judge flows over snapshot tables: what a live call would have answered is a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import contact, firm
from weftline.functions.fuzzy import token_set_ratio
from weftline.scratch import materialize

# Limits of text that a site yields.
MAX_PAGES, SHORTEST_TEXT, MAX_CHARS = 3, 50, 9000
COMPANY_SCORE = 80.0
VERDICTS = ("yes", "no", "uncertain")


def first_filled(*cs: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cs], F.lit(""))


def candidates(people: Column) -> Column:
    """Provider entries (a JSON array) as structs with the fields that are filled under any of their names."""
    kind = "array<struct<name:string,full_name:string,headline:string,occupation:string,experience_text:string,summary:string,url:string,linkedin_url:string,profile_url:string>>"
    each = lambda p: F.struct(
        first_filled(p["name"], p["full_name"]).alias("name"), first_filled(p["headline"], p["occupation"]).alias("headline"),
        first_filled(p["experience_text"], p["summary"]).alias("experience_text"), first_filled(p["url"], p["linkedin_url"], p["profile_url"]).alias("url"),
    )
    return F.transform(F.coalesce(F.from_json(people, kind), F.array().cast(kind)), each)


def directors(answer: Column) -> Column:
    """A judge's JSON list as structs (name, role), without nameless ones."""
    kind = "array<struct<name:string,role:string>>"
    every = F.transform(F.coalesce(F.from_json(answer, kind), F.array().cast(kind)), lambda p: F.struct(F.trim(F.coalesce(p["name"], F.lit(""))).alias("name"), F.trim(F.coalesce(p["role"], F.lit(""))).alias("role")))
    return F.filter(every, lambda p: p["name"] != "")


def verdict(raw: Column) -> Column:
    v = F.lower(F.trim(raw))
    return F.when(v.isin(*VERDICTS), v).otherwise("no")


def site_text(pages: DataFrame) -> DataFrame:
    """(site, text): of each site's pages (site, priority, path, text) the first MAX_PAGES with more than SHORTEST_TEXT characters, while the text so far is short of MAX_CHARS, joined and cut.

    The pages are chosen by their keys, of which a task keeps MAX_PAGES of a
    site before they are shuffled; only then are their texts joined, once. A key
    that repeats counts once, with its smallest text; a null site is one of its own.
    """
    key = ["site", "priority", "path"]
    place = F.row_number().over(Window.partitionBy("site").orderBy("priority", "path"))
    long = pages.where(F.char_length("text") > SHORTEST_TEXT)
    chosen = materialize(long.groupBy(*key).agg(F.lit(1).alias("one")).withColumn("place", place).where(F.col("place") <= MAX_PAGES).select(*[F.col(c).alias(f"k_{c}") for c in key], "place"), "site-pages")
    same = [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in key]
    chunk = F.concat(F.lit("["), "path", F.lit("] "), F.left("text", F.lit(MAX_CHARS)))
    texts = long.select(*key, chunk.alias("chunk")).join(chosen, same[0] & same[1] & same[2]).groupBy("site", "place").agg(F.min("chunk").alias("chunk"))
    chunks = F.transform(F.array_sort(F.collect_list(F.struct("place", "chunk"))), lambda p: p["chunk"])  # MAX_PAGES at most
    before = lambda k: F.aggregate(F.slice(F.col("chunks"), 1, k), F.lit(0), lambda n, c: n + F.char_length(c))
    used = F.filter("chunks", lambda c, k: before(k) < MAX_CHARS)
    return texts.groupBy("site").agg(chunks.alias("chunks")).select("site", F.left(F.array_join(used, "\n\n"), F.lit(MAX_CHARS)).alias("text"))


def find_founders(firms: DataFrame, profiles: DataFrame, least: float = COMPANY_SCORE) -> DataFrame:
    """(domain, uid, name, title, company_score) of the profiles that title search gave for a firm and whose experience names it.

    firms has domain and company_name; profiles domain, uid, full_name and
    experience (array of struct(company, title)). A profile's best entry
    counts, the first on ties. Entries are scored one by one, not by group.
    """
    each = profiles.where(firm.filled(F.trim("full_name"))).join(firms.select("domain", "company_name"), "domain").select("domain", "uid", F.trim("full_name").alias("name"), "company_name", F.posexplode("experience").alias("k", "e"))
    rated = each.withColumn("s", token_set_ratio(F.lower("company_name"), F.lower(F.coalesce("e.company", F.lit(""))))).where("s > 0")
    best = rated.groupBy("domain", "uid", "name").agg(F.max(F.struct("s", -F.col("k"), F.trim(F.coalesce("e.title", F.lit(""))).alias("title"))).alias("b"))
    return best.where(F.col("b.s") >= least).select("domain", "uid", "name", F.col("b.title").alias("title"), F.col("b.s").alias("company_score"))


def merge_reveals(reveals: DataFrame) -> DataFrame:
    """(uid, phones, emails, linkedin) from reveal answers (uid, ordinal, status, phones, emails, social).

    Only successes count. Phones are normal and distinct, e-mails distinct in
    any case, both in order; the LinkedIn address is that of the first answer
    with one, its best rated, the first on ties.
    """
    done = reveals.where("status = 'success'")
    links = F.filter("social", lambda s: (F.lower(F.coalesce(s["type"], F.lit(""))) == "li") & firm.filled(s["link"]))
    best = F.array_max(F.transform(links, lambda s, k: F.struct(F.coalesce(s["rating"], F.lit(0)).alias("r"), (-k).alias("k"), s["link"].alias("link"))))["link"]
    of = lambda column, value, key: (
        done.select("uid", "ordinal", F.posexplode(column).alias("k", "x")).withColumn("v", value(F.col("x"))).where(firm.filled(F.col("v"))).groupBy("uid", key(F.col("v")).alias("key"))
        .agg(F.min(F.struct("ordinal", "k", "v")).alias("m")).groupBy("uid").agg(F.transform(F.array_sort(F.collect_list("m")), lambda m: m["v"]).alias(column))
    )
    phones, emails = of("phones", contact.e164, lambda v: v), of("emails", F.trim, F.lower)
    linked = done.withColumn("link", best).groupBy("uid").agg(F.min_by(F.when(firm.filled(F.col("link")), F.col("link")), F.when(firm.filled(F.col("link")), F.col("ordinal"))).alias("linkedin"))
    none = F.array().cast("array<string>")
    return linked.join(phones, "uid", "left").join(emails, "uid", "left").select("uid", F.coalesce("phones", none).alias("phones"), F.coalesce("emails", none).alias("emails"), "linkedin")


def resolve_contacts(people: DataFrame, best: DataFrame, revealed: DataFrame) -> DataFrame:
    """people (domain, name, uid) with phones, emails and linkedin: by the uid they have, else by the best profile's (domain, name, uid); without either, empty."""
    asked = people.join(best.select("domain", "name", F.col("uid").alias("found")), ["domain", "name"], "left").withColumn("uid", F.coalesce("uid", "found")).drop("found")
    none = F.array().cast("array<string>")
    got = asked.join(revealed, "uid", "left")
    return got.select(*asked.columns, F.coalesce("phones", none).alias("phones"), F.coalesce("emails", none).alias("emails"), "linkedin")


def guard_namesakes(people: DataFrame, answers: DataFrame) -> DataFrame:
    """people with linkedin_url, linkedin_confirmed and notes after a judge's answers (ordinal, url, match, reason): only a yes writes the address, all else is noted."""
    joined = people.join(answers.select("ordinal", "url", verdict(F.col("match")).alias("v"), F.trim(F.coalesce("reason", F.lit(""))).alias("why")), "ordinal", "left")
    judged = F.col("v").isNotNull() & ~F.coalesce("linkedin_confirmed", F.lit(False)) & contact.real_name(F.col("name")) & firm.filled(F.col("url"))
    yes = judged & (F.col("v") == "yes")
    note = F.concat(F.lit("LI tentative ("), "v", F.lit("): "), "why")
    return joined.select(
        *[c for c in people.columns if c not in ("linkedin_url", "linkedin_confirmed", "notes")], F.when(yes, F.col("url")).otherwise(F.col("linkedin_url")).alias("linkedin_url"),
        F.when(yes, True).otherwise(F.col("linkedin_confirmed")).alias("linkedin_confirmed"),
        F.when(judged & ~yes, F.concat_ws("; ", F.nullif("notes", F.lit("")), note)).otherwise(F.col("notes")).alias("notes"),
    )
