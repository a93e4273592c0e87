"""People's names, phones and e-mails, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.firm import filled

#: Stands for a name nobody has confirmed.
SENTINEL = "(verify)"
COUNTRY_CODE = "91"
FIELDS = ("Founder", "LinkedIn", "Phone", "Email")


def real_name(name: Column) -> Column:
    return ~F.coalesce(name, F.lit("")).isin("", SENTINEL)


def e164(raw: Column, cc: str = COUNTRY_CODE) -> Column:
    digits = F.regexp_replace(raw, r"[^0-9]", "")
    return (
        F.when(~filled(digits), F.lit(None).cast("string"))
        .when(F.startswith(F.trim(raw), F.lit("+")), F.concat(F.lit("+"), digits))
        .when(F.startswith(digits, F.lit("00")), F.concat(F.lit("+"), F.substring(digits, 3, 1 << 20)))
        .when(F.startswith(digits, F.lit(cc)) & (F.length(digits) > 10), F.concat(F.lit("+"), digits))
        .when(F.startswith(digits, F.lit("0")) & (F.length(digits) == 11), F.concat(F.lit("+" + cc), F.substring(digits, 2, 1 << 20)))
        .when(F.length(digits) == 10, F.concat(F.lit("+" + cc), digits))
    )


def sheet_phone(phone: Column) -> Column:
    """Phone for a cell that would take a leading plus for a formula."""
    p = F.coalesce(phone, F.lit(""))
    return F.when(F.startswith(p, F.lit("+")), F.concat(F.lit("'"), p)).otherwise(p)


def presence(name: Column, linkedin: Column, phone: Column, email: Column) -> list[Column]:
    return [real_name(name), filled(linkedin), filled(phone), filled(email)]


def missing_fields(name: Column, linkedin: Column, phone: Column, email: Column) -> Column:
    return F.array_compact(F.array(*[F.when(~p, F.lit(f)) for f, p in zip(FIELDS, presence(name, linkedin, phone, email))]))


def is_full(name: Column, linkedin: Column, phone: Column, email: Column) -> Column:
    a, b, c, d = presence(name, linkedin, phone, email)
    return a & b & c & d


def name_split(full: Column) -> Column:
    """struct(first, last)."""
    parts = F.filter(F.split(F.trim(F.coalesce(full, F.lit(""))), r"\s+"), lambda x: x != "")
    first = F.coalesce(F.get(parts, F.lit(0)), F.lit(""))
    return F.struct(first.alias("first"), F.array_join(F.slice(parts, 2, 1 << 20), " ").alias("last"))


def first_name(name: Column) -> Column:
    return F.when(real_name(name), name_split(name)["first"]).otherwise("there")


def phones(contacts: Column) -> Column:
    """Values of contacts (array of struct(type, subtype, value)) whose type names a phone, distinct in order."""
    return F.array_distinct(F.transform(F.filter(contacts, lambda c: F.contains(F.lower(c["type"]), F.lit("phone")) & filled(c["value"])), lambda c: c["value"]))


def emails(contacts: Column) -> Column:
    """E-mails of contacts, work ones first, distinct without regard to case, first spelling kept."""
    own = F.filter(contacts, lambda c: (F.lower(c["type"]) == "email") & filled(c["value"]))
    work = F.filter(own, lambda c: F.coalesce(F.lower(c["subtype"]) == "work", F.lit(False)))
    rest = F.filter(own, lambda c: ~F.coalesce(F.lower(c["subtype"]) == "work", F.lit(False)))
    values = F.transform(F.concat(work, rest), lambda c: c["value"])
    return F.aggregate(values, F.array().cast("array<string>"), lambda a, x: F.when(F.exists(a, lambda y: F.lower(y) == F.lower(x)), a).otherwise(F.array_append(a, x)))


def best_social(links: Column, kind: str = "li") -> Column:
    """Link of the kind with the highest rating, the first on ties; links is array of struct(type, link, rating)."""
    own = F.filter(links, lambda x: x["type"] == kind)
    best = F.aggregate(
        own, F.get(own, F.lit(0)), lambda a, x: F.when(F.coalesce(x["rating"], F.lit(0)) > F.coalesce(a["rating"], F.lit(0)), x).otherwise(a),
    )
    return best["link"]
