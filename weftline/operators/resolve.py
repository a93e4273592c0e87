"""Listings to one firm for each registered domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import firm
from weftline.operators import domains
from weftline.scratch import materialize, settled


def with_keys(listings: DataFrame, as_of_year: int) -> DataFrame:
    """listings with domain, band and founded (struct), all in the scan's stage: the suffix rules are broadcast."""
    # both are read at many places, and rules, bands and years are long expressions
    keyed = domains.registered(settled(listings), F.col("website_raw"))
    return keyed.withColumns({"band": firm.size_band(F.col("size_raw")), "founded": firm.founded(F.col("founded_raw"), as_of_year)})


#: Columns of listings of which a firm takes the first that is filled, and the firm's names for them.
_FIRSTS = {"website_raw": "website", "city": "city", "segment_raw": "segment", "hq_raw": "hq_country"}


def parts(keyed: DataFrame) -> DataFrame:
    """Listings with a domain: what a firm is made of, with the trimmed name; few have domain, name and source in common, so they aren't aggregated by them."""
    read = ("domain", "source", "ordinal", "company_name", *_FIRSTS, "founded_raw", "size_raw", "band", "founded")
    # settled before the filter, which would work out each domain once more
    return settled(keyed.select(*read)).where("domain IS NOT NULL").withColumn("name", F.trim("company_name")).drop("company_name")


def best_names(parts: DataFrame) -> DataFrame:
    """(domain, company_name): most frequent trimmed name, then the longest, then the first."""
    counts = parts.where(firm.filled(F.col("name"))).groupBy("domain", "name").agg(F.count("*").alias("n"), F.min("ordinal").alias("at"))
    return counts.groupBy("domain").agg(F.max_by("name", F.struct("n", F.char_length("name"), -F.col("at"))).alias("company_name"))


def sources(parts: DataFrame) -> DataFrame:
    """(domain, sources): distinct source names in order of their first listing."""
    first = parts.groupBy("domain", "source").agg(F.min("ordinal").alias("at"))
    return first.groupBy("domain").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "source"))), lambda x: x["source"]).alias("sources"))


def dedupe(listings: DataFrame, as_of_year: int) -> DataFrame:
    """One row for each domain.

    Each column picks its value by the listing's ordinal, never by arrival, so
    the result doesn't depend on partitioning: every pick is a minimum that leads
    with it, and combines before its shuffle. Listings with what is read of them
    are worked out once and written; names, sources and the other columns are
    aggregated of them, each by what it needs.
    """
    rows = materialize(parts(with_keys(listings, as_of_year)), "listing-parts")
    year, sized = F.col("founded.year").isNotNull(), F.col("band").isNotNull()
    firsts = [F.min(F.when(firm.filled(F.col(c)), F.struct("ordinal", F.col(c).alias("value")))).alias(name) for c, name in _FIRSTS.items()]
    best_founded = F.min(F.when(year, F.struct("founded.approx", "ordinal", "founded.year", "founded.note", F.col("founded_raw").alias("raw")))).alias("f")
    best_size = F.min(F.when(sized, F.struct("ordinal", "band", "size_raw"))).alias("s")
    picked = rows.groupBy("domain").agg(*firsts, best_founded, best_size, F.count("*").alias("n_listings"))
    firms = picked.select(
        "domain", *[F.col(f"{c}.value").alias(c) for c in _FIRSTS.values()], F.col("f.year").alias("founded_year"), F.col("f.raw").alias("founded_source"), F.col("f.note").alias("founded_note"),
        F.col("s.band").alias("size_band"), F.col("s.size_raw").alias("size_source"), "n_listings",
    )
    return firms.join(best_names(rows), "domain", "left").join(sources(rows), "domain", "left")


def quarantine(listings: DataFrame, as_of_year: int) -> DataFrame:
    """Listings without a registered domain, once each."""
    return with_keys(listings, as_of_year).where("domain IS NULL").select("company_name", "city", "source", "source_url").distinct()
