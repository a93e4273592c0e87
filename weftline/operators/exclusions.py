"""Known names and domains out of list files, and what a sheet or a template asks of an export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import firm
from weftline.functions.cells import unwrap_hyperlink
from weftline.operators import domains

# Headers that name a firm or its domain.
NAME_HEADERS = ("company", "company name", "firm", "name")
DOMAIN_HEADERS = ("domain", "domain name", "website", "url", "site", "web")


def _clean(c: Column) -> Column:
    return F.lower(F.trim(F.replace(c, F.lit("\ufeff"), F.lit(""))))


def _column(header: Column, names: tuple[str, ...]) -> Column:
    """Place (from 0) of the first cell of a header that is one of names, else null."""
    at = F.filter(F.transform(header, lambda h, k: F.when(_clean(h).isin(*names), k)), lambda k: k.isNotNull())
    return F.get(at, F.lit(0))


def from_lists(rows: DataFrame) -> DataFrame:
    """(file, line, name, domains) of the rows (file, line, cells) of list files, line 0 being the header.

    The name's column is found by the header, else it is the second, or the
    first of one; a name may be a hyperlink formula, whose address gives a domain
    as a domain column does. One short row for each file is joined.
    """
    heads = rows.where("line = 0").select("file", _column(F.col("cells"), NAME_HEADERS).alias("n"), _column(F.col("cells"), DOMAIN_HEADERS).alias("d"), F.size("cells").alias("width"))
    placed = rows.where("line > 0").join(heads, "file")
    cell = F.trim(F.get("cells", F.coalesce("n", F.when(F.col("width") > 1, 1).otherwise(0))))
    parts = placed.withColumn("u", unwrap_hyperlink(cell)).withColumn("own", F.get("cells", F.col("d")))
    both = domains.registered(domains.registered(parts, F.col("u.url"), "linked"), F.col("own"), "listed")
    found = F.array_distinct(F.array_compact(F.array("linked", "listed")))
    return both.select("file", "line", F.nullif(F.trim("u.display"), F.lit("")).alias("name"), found.alias("domains"))


def from_lines(lines: DataFrame) -> DataFrame:
    """(domain) of a text file's lines (line), without blank lines and comments."""
    kept = lines.select(F.trim(F.replace("line", F.lit("\ufeff"), F.lit(""))).alias("line")).where("line <> '' AND NOT startswith(line, '#')")
    return domains.registered(kept, F.col("line")).select("domain").where("domain IS NOT NULL").distinct()


def union(rows: DataFrame, lines: DataFrame, names: DataFrame, own: DataFrame) -> DataFrame:
    """(kind, value) of everything excluded: names once each, however they are written in case, as first met, and domains.

    rows and lines are as in :func:`from_lists` and :func:`from_lines`; names
    (ordinal, name) and own (domain) are given literally and come first.
    """
    listed = from_lists(rows)
    place = lambda *c: F.struct(*c)
    every = names.select(place(F.lit("").alias("file"), F.col("ordinal").cast("long").alias("line")).alias("at"), F.trim("name").alias("name")).union(
        listed.select(place("file", F.col("line").cast("long").alias("line")).alias("at"), "name"),
    ).where(firm.filled(F.col("name")))
    first = every.groupBy(F.lower("name").alias("k")).agg(F.min_by("name", "at").alias("value"))
    found = listed.select(F.explode("domains").alias("value")).union(from_lines(lines)).union(own.select(F.lower(F.trim("domain")))).distinct()
    return first.select(F.lit("name").alias("kind"), "value").union(found.select(F.lit("domain").alias("kind"), "value"))


def reconcile_header(first: Column, header: list[str]) -> Column:
    """What a sheet's first row (an array, null where there is none) asks for: create, keep, overwrite or insert."""
    want = F.array(*map(F.lit, header))
    return F.when(first.isNull() | (F.size(first) == 0), "create").when(first == want, "keep").when(F.get(first, F.lit(0)) == header[0], "overwrite").otherwise("insert")


def fit(cells: Column, width: int) -> Column:
    """An array of cells padded with empty ones, or cut, to a width."""
    return F.slice(F.concat(cells, F.array_repeat(F.lit(""), width)), 1, width)
