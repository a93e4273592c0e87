"""Cells of deliverables and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.contact import SENTINEL, real_name
from weftline.functions.firm import filled

_FORMULA = r'^=HYPERLINK\("([^"]*)","((?:[^"]|"")*)"\)$'


def hyperlink(url: Column, label: Column) -> Column:
    return F.concat(F.lit('=HYPERLINK("'), url, F.lit('","'), F.replace(label, F.lit('"'), F.lit('""')), F.lit('")'))


def unwrap_hyperlink(cell: Column) -> Column:
    """struct(display, url): both from a formula, else the cell and null."""
    is_formula = F.rlike(cell, F.lit(_FORMULA))
    return F.struct(
        F.when(is_formula, F.regexp_extract(cell, _FORMULA, 2)).otherwise(cell).alias("display"), F.when(is_formula, F.regexp_extract(cell, _FORMULA, 1)).alias("url"),
    )


def resolver_url(website: Column, name: Column, city: Column, prefix: str) -> Column:
    """The website with a scheme, else a search for the firm; plus for space, tilde plain and star escaped, as form encoders do."""
    query = F.trim(F.concat(name, F.lit(" "), F.coalesce(city, F.lit("")), F.lit(" software company")))
    encoded = F.replace(F.replace(F.url_encode(query), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    own = F.when(F.contains(website, F.lit("://")), website).otherwise(F.concat(F.lit("https://"), website))
    return F.when(filled(website), own).otherwise(F.concat(F.lit(prefix), encoded))


def founders_cell(people: Column) -> Column:
    """The first two of people (array of struct(name, role)) as 'name (role)'."""
    each = F.transform(F.slice(people, 1, 2), lambda p: F.when(~real_name(p["name"]), F.lit(SENTINEL)).when(filled(p["role"]), F.concat(p["name"], F.lit(" ("), p["role"], F.lit(")"))).otherwise(p["name"]))
    return F.when(F.coalesce(F.size(people), F.lit(0)) > 0, F.array_join(each, "; ")).otherwise(SENTINEL)


def headcount_source(sources: Column, labels: dict[str, str], raw: Column, band: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    base = F.array_join(F.array_distinct(F.filter(F.transform(sources, lambda s: F.coalesce(F.element_at(known, F.lower(s)), F.initcap(s))), filled)), "; ")
    text = F.trim(F.coalesce(raw, F.lit("")))
    differs = (text != "") & (F.replace(text, F.lit(" "), F.lit("")) != F.replace(F.coalesce(band, F.lit("")), F.lit(" "), F.lit("")))
    return F.when(~differs, base).when(base != "", F.concat(base, F.lit(" ("), text, F.lit(")"))).otherwise(text)


def notes_cell(*parts: Column) -> Column:
    """The parts that say something, once each, in order."""
    return F.array_join(F.array_distinct(F.filter(F.array(*parts), filled)), " | ")


def render(template: Column, values: dict[str, Column]) -> Column:
    for placeholder, value in values.items():
        template = F.replace(template, F.lit(placeholder), value)
    return template


def drop_empty(**props: Column) -> Column:
    """A map of the properties that are neither null nor empty."""
    pairs = [x for k, v in props.items() for x in (F.lit(k), v.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: filled(v))


def percent(part: Column, whole: Column, digits: int = 0) -> Column:
    """Percent as text, rounded half to even."""
    value = F.when(whole == 0, F.lit(0.0)).otherwise(F.bround(part * 100.0 / whole, digits))
    return F.format_string(f"%.{digits}f%%", value)


def noisy_json(text: Column) -> Column:
    """The first JSON value in a text that may be fenced or wrapped in prose, as normal JSON text."""
    bare = F.trim(F.regexp_replace(F.trim(text), "(?m)^```(?:json)?|```$", ""))
    inner = F.regexp_extract(bare, r"(?s)(\{.*\}|\[.*\])", 1)
    return F.coalesce(F.try_parse_json(bare), F.try_parse_json(inner)).cast("string")


def number_or_zero(x: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(x), F.lit("")).try_cast("double"), F.lit(0.0))


def region_bucket(text: Column) -> Column:
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.contains(t, F.lit("indonesia")), "Indonesia").when(F.contains(t, F.lit("india")), "India")
