"""Rows that are handed over: the deliverable of 16 cells, the sheets of 18 and of 12, and the row of figures.

All start from the firms that pass the gates, each with its first two people,
joined once; cells are expressions over that row. Numbers follow the order of
domains and come from ranges, so no task numbers all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import cells, contact, firm, provenance
from weftline.operators.exclusions import fit
from weftline.operators.order import numbered
from weftline.operators.people import top
from weftline.scratch import materialize

# The cells of each kind of row, in order.
DELIVERABLE = ("no", "company", "founders", "linkedin", "phone", "linkedin2", "phone2", "year", "hq", "headcount", "headcount_source", "segment", "status", "notes", "email", "size_bucket")
QUALIFIED = ("no", "company_link", "domain", "founders", "linkedin", "email", "sheet_phone", "linkedin2", "sheet_phone2", "year", "hq", "headcount", "size_bucket", "headcount_source", "segment", "status", "notes", "synced_at")
REVIEW = ("company", "domain", "founders", "linkedin", "email", "sheet_phone", "year", "hq", "size_bucket", "segment", "missing", "notes")
#: Sources that alone don't vouch for a name, and how a note calls them.
UNSURE = {"directory": "Directory"}


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _caveat(person: Column) -> list[Column]:
    """What a person adds to the notes: that a source alone gave the name, and the note without its sources."""
    named = F.regexp_extract(F.coalesce(person["notes"], F.lit("")), r"(?i)sources:\s*([a-z_,\s]+)", 1)
    listed = F.filter(F.transform(F.split(named, ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    real = contact.real_name(person["name"]) & person["name"].isNotNull()
    alone = [F.when(real & (F.size(listed) > 0) & (F.size(F.array_except(listed, F.array(F.lit(s)))) == 0), F.concat(F.lit("founder '"), person["name"], F.lit(f"' via {label} - verify"))) for s, label in UNSURE.items()]
    return [*alone, F.when(real, provenance.strip_sources(person["notes"]))]


def rows(companies: DataFrame, people: DataFrame, labels: dict[str, str], search: str) -> DataFrame:
    """One row for each firm that passes the gates: all cells but the number and the time, with n_people, missing (names of absent fields) and real_names.

    companies is gated; people has domain, ordinal, name, role, notes, linkedin_url, phone and email.
    """
    fields = ("name", "role", "notes", "linkedin_url", "phone", "email")
    # firms that pass are few; they are read for their people and again for their cells, and so are their people: both are written once
    firms = materialize(companies.where("gate_pass"), "passing")
    people = materialize(people.join(firms.select("domain"), "domain", "left_semi"), "passing-people")
    two = top(people).groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("rank", *fields))).alias("p"))
    named = people.groupBy("domain").agg(F.count("*").alias("n_people"), F.count_if(contact.real_name(F.col("name"))).alias("real_names"))
    met = firms.join(two, "domain", "left").join(named, "domain", "left")
    one, other = F.get("p", F.lit(0)), F.get("p", F.lit(1))
    name = F.coalesce("company_name", F.lit(""))
    none = F.array().cast("array<string>")
    return met.select(
        "domain", F.col("company_name").alias("company_name"), F.coalesce("n_people", F.lit(0)).alias("n_people"), F.coalesce("real_names", F.lit(0)).alias("real_names"),
        F.coalesce(contact.missing_fields(one["name"], one["linkedin_url"], one["phone"], one["email"]), none).alias("gone"),
        name.alias("company"), cells.hyperlink(cells.resolver_url(F.col("website"), name, F.col("city"), search), name).alias("company_link"), cells.founders_cell(F.col("p")).alias("founders"),
        _text(one["linkedin_url"]).alias("linkedin"), _text(one["phone"]).alias("phone"), _text(other["linkedin_url"]).alias("linkedin2"), _text(other["phone"]).alias("phone2"),
        F.coalesce(contact.sheet_phone(one["phone"]), F.lit("")).alias("sheet_phone"), F.coalesce(contact.sheet_phone(other["phone"]), F.lit("")).alias("sheet_phone2"),
        _text(F.col("founded_year")).alias("year"), _text(F.col("hq_country")).alias("hq"), _text(F.col("size_band")).alias("headcount"), cells.headcount_source(F.col("sources"), labels, F.col("size_source"), F.col("size_band")).alias("headcount_source"),
        _text(F.col("segment")).alias("segment"), F.lit("").alias("status"), cells.notes_cell(F.col("gate_reason"), *_caveat(one), *_caveat(other)).alias("notes"), _text(one["email"]).alias("email"), _text(F.col("size_bucket")).alias("size_bucket"),
    )


def deliverable(made: DataFrame, first: int = 1) -> DataFrame:
    """The rows of 16 cells, numbered by domain from ``first``; the domain stands beside them."""
    placed = numbered(made, [F.col("domain")], "place")
    return placed.withColumn("no", (F.col("place") + first - 1).cast("string")).select("domain", *DELIVERABLE)


def append_rows(made: DataFrame, width: int, first: int = 1, excluded: DataFrame | None = None, enriched: bool = True, founder: bool = False, full: bool = False, limit: int | None = None) -> DataFrame:
    """(domain, no, cells) of what is appended to a sheet of ``width`` columns: rows that pass the filters, numbered from ``first``, padded or cut.

    Only rows that are appended take a number. ``limit`` is the caller's, none if not given.
    """
    kept = made
    for wanted, test in ((enriched, "n_people > 0"), (founder, "real_names > 0"), (full, "n_people > 0 AND size(gone) = 0")):
        kept = kept.where(test) if wanted else kept
    if excluded is not None:
        kept = kept.join(excluded.select("domain").distinct(), "domain", "left_anti")
    placed = deliverable(kept.orderBy("domain").limit(limit) if limit else kept, first)
    return placed.select("domain", F.col("no").cast("long").alias("no"), fit(F.array(*DELIVERABLE), width).alias("cells"))


def qualified(made: DataFrame, excluded: DataFrame, sheet: DataFrame, synced_at: str) -> DataFrame:
    """The rows of 18 cells that a sheet lacks: firms with all four fields, not excluded and not in the sheet by domain or name; numbers go on from the sheet's.

    sheet has no (text), display and domain of the rows that are there.
    """
    full = made.where("n_people > 0 AND size(gone) = 0")
    seen = excluded.select("domain").union(sheet.select("domain")).where("domain IS NOT NULL").distinct()
    names = sheet.select(F.lower(F.trim("display")).alias("seen_name")).where("seen_name IS NOT NULL").distinct()
    fresh = full.join(seen, "domain", "left_anti").withColumn("seen_name", F.lower(F.trim("company"))).join(names, "seen_name", "left_anti")
    last = sheet.agg(F.coalesce(F.max(F.when(F.trim("no").rlike(r"^\d+$"), F.trim("no").try_cast("long"))), F.lit(0)).alias("last")).first().last
    placed = numbered(fresh, [F.col("domain")], "place")
    return placed.withColumns({"no": (F.col("place") + last).cast("string"), "synced_at": F.lit(synced_at)}).select(*QUALIFIED)


def review(made: DataFrame) -> DataFrame:
    """The rows of 12 cells: firms whose first person lacks exactly one field, with its name."""
    return made.where("n_people > 0 AND size(gone) = 1").withColumn("missing", F.array_join("gone", ", ")).select(*REVIEW)


def stats(made: DataFrame, day: str) -> DataFrame:
    """One row: the day, firms with people, with all fields and with all but one, and the percents of each field and of all."""
    has = lambda field: F.count_if((F.col("n_people") > 0) & ~F.array_contains("gone", field))
    count = lambda test: F.count_if(F.expr(test))
    n = count("n_people > 0")
    full = count("n_people > 0 AND size(gone) = 0")
    shares = [cells.percent(has(f), n).alias(f"{f.lower()}_pct") for f in ("Founder", "LinkedIn", "Phone", "Email")]
    return made.agg(F.lit(day).alias("day"), n.alias("enriched"), full.alias("qualified"), count("n_people > 0 AND size(gone) = 1").alias("review"), *shares, cells.percent(full, n).alias("all_pct"))
