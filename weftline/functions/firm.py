"""Firm attributes out of raw listing text, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

HOST = r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]+)"

# Corporate tokens that don't tell firms apart.
GENERIC_TOKENS = (
    "technologies", "technology", "technolabs", "tech", "solutions", "solution",
    "software", "softwares", "labs", "lab", "systems", "system", "services",
    "service", "consulting", "consultancy", "infotech", "infosystems", "digital",
    "studio", "studios", "global", "worldwide", "group", "ventures",
    "pvt", "private", "ltd", "limited", "llp", "inc", "incorporated", "co",
    "company", "corp", "corporation", "india", "indian",
)
# How a founding year, a number of years, decades in words are written; band limits and middles, bucket edges.
YEAR, YEARS = r"\b(19\d{2}|20\d{2})\b", r"(\d{1,2})\s*\+?\s*years?"
DECADES = (("one decade", 10), ("a decade", 10), ("two decade", 20), ("three decades", 30), ("four decades", 40))
BANDS = ((10, "<10"), (50, "10-49"), (250, "50-249"))
TOP_BAND = "250+"
MIDDLES = {"<10": 5, "10-49": 30, "50-249": 150, "250+": 600}
BUCKETS = ((100, "1-100"), (500, "100-500"), (1000, "500-1000"))


def filled(c: Column) -> Column:
    """True where a text is neither null nor empty."""
    return F.coalesce(c, F.lit("")) != ""


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once for each row however often it is read."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def host(website: Column) -> Column:
    """The host of an address with or without a scheme, lower-cased, without the root's dot; empty where there is none."""
    return F.rtrim(F.regexp_extract(F.lower(F.trim(website)), HOST, 1), F.lit(".\u3002\uff0e\uff61"))


def clean_website(raw: Column) -> Column:
    url = F.regexp_extract(raw, r"(https?://[^\s\"'<>]+)", 1)
    return F.coalesce(F.nullif(url, F.lit("")), F.nullif(F.trim(raw), F.lit("")))


def founded(raw: Column, as_of_year: int) -> Column:
    """struct(year, approx, note): a year, else years or decades back from as_of_year, else null with a note."""
    s = F.lower(F.trim(raw))
    exact = F.nullif(F.regexp_extract(s, YEAR, 1), F.lit(""))
    years = F.nullif(F.regexp_extract(s, YEARS, 1), F.lit(""))
    decade = F.coalesce(*[F.when(F.contains(s, F.lit(phrase)), F.lit(n)) for phrase, n in DECADES])
    quoted = F.concat(F.lit("'"), F.trim(raw), F.lit("'"))
    back = F.lit(as_of_year) - decade
    year = F.coalesce(exact.cast("int"), F.lit(as_of_year) - years.cast("int"), back)
    note = (
        F.when(~filled(raw) | exact.isNotNull(), F.lit(None).cast("string"))
        .when(years.isNotNull(), F.concat(F.lit("approx from "), quoted))
        .when(decade.isNotNull(), F.concat(F.lit("~"), back.cast("string"), F.lit(" (verify) from "), quoted))
        .otherwise(F.concat(F.lit("unparsed founded "), quoted))
    )
    return F.struct(F.when(filled(raw), year).alias("year"), F.coalesce(exact.isNull() & year.isNotNull(), F.lit(False)).alias("approx"), note.alias("note"))


def numbers(raw: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.replace(raw, F.lit(","), F.lit("")), F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("int"))


def size_band(raw: Column) -> Column:
    def band(low: Column) -> Column:
        name = F.when(low < BANDS[0][0], BANDS[0][1])
        for edge, label in BANDS[1:]:
            name = name.when(low < edge, label)
        return F.when(low.isNotNull(), name.otherwise(TOP_BAND))

    return _once(F.array_min(numbers(raw)), band)


def size_headcount(raw: Column, band: Column) -> Column:
    n = numbers(F.coalesce(raw, F.lit("")))
    middle = F.coalesce(*[F.when(band == k, F.lit(v)) for k, v in MIDDLES.items()])
    return F.when(F.size(n) >= 2, F.floor((n[0] + n[1]) / 2).cast("int")).when(F.size(n) == 1, n[0]).otherwise(middle)


def size_bucket(headcount: Column) -> Column:
    bucket = F.when(headcount <= BUCKETS[0][0], BUCKETS[0][1])
    for edge, name in BUCKETS[1:]:
        bucket = bucket.when(headcount <= edge, name)
    return bucket


def core_tokens(name: Column) -> Column:
    """Sorted distinct tokens of a name without the generic ones."""
    # a split by one sign compiles no pattern for each row
    tokens = F.split(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "), " ")
    return F.sort_array(F.array_except(tokens, F.array(*[F.lit(t) for t in ("", *GENERIC_TOKENS)])))


def city_slug(city: Column, overrides: dict[str, str]) -> Column:
    lower = F.lower(F.trim(city))
    known = F.coalesce(*[F.when(lower == k, F.lit(v)) for k, v in overrides.items()]) if overrides else F.lit(None)
    return F.coalesce(known, F.regexp_replace(lower, " ", "-"))


def city_first_token(city: Column) -> Column:
    return F.trim(F.split_part(city, F.lit(","), F.lit(1)))


def content_key(*parts: Column) -> Column:
    return F.sha1(F.concat_ws("|", *parts))
