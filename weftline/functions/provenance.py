"""Where a name comes from and how far to trust it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.contact import real_name
from weftline.functions.firm import filled

# Fixed values.
INDEPENDENT = ("company_site", "registry")
AGGREGATOR = ("directory",)


def sources(notes: Column, name_source: Column) -> Column:
    """Sorted distinct sources that a note names, else the name's own source."""
    named = F.regexp_extract(F.coalesce(notes, F.lit("")), r"(?i)sources:\s*([a-z_,\s]+)", 1)
    listed = F.filter(F.transform(F.split(named, ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    own = F.when(filled(name_source), F.array(F.lower(name_source))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.when(F.size(listed) > 0, listed).otherwise(own)))


def confidence(name: Column, found: Column, linkedin: Column, confirmed: Column) -> Column:
    independent = F.size(F.array_intersect(found, F.array(*map(F.lit, INDEPENDENT))))
    only_aggregator = (F.size(found) > 0) & (F.size(F.array_except(found, F.array(*map(F.lit, AGGREGATOR)))) == 0)
    unsure = filled(linkedin) & ~F.coalesce(confirmed, F.lit(False))
    return F.when(~real_name(F.trim(name)) | only_aggregator, "red").when((independent >= 2) & ~unsure, "green").otherwise("amber")


def strip_sources(note: Column) -> Column:
    parts = F.transform(F.split(F.coalesce(note, F.lit("")), ";"), lambda x: F.trim(x))
    return F.array_join(F.filter(parts, lambda x: (x != "") & ~F.startswith(F.lower(x), F.lit("sources:"))), "; ")
