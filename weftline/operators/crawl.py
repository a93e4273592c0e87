"""Which pages a crawl takes: paging that an empty page ends, a city that a failed fetch ends, a source that a block ends.

The crawl goes through a source's cities in order and a city's pages in order.
What ends a city is its first page that is empty, failed or blocked; what ends a
source is the first city that a block ends. Both are minima, combined before the
shuffle, so neither a city's nor a source's pages are put in order or held.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EMPTY, FAILED, BLOCKED = "empty", "failed", "blocked"


def visited(pages: DataFrame) -> DataFrame:
    """pages (source, city, place, page, status, n_rows and others) that the crawl reaches and takes.

    ``place`` is the city's place in its source, ``status`` 'ok', 'failed' or
    'blocked'; a page that is 'ok' and has no rows is empty. An empty page is
    taken and ends its city; a failed or blocked one isn't taken.
    """
    kind = F.when(F.col("status") == BLOCKED, BLOCKED).when(F.col("status") == FAILED, FAILED).when(F.coalesce("n_rows", F.lit(0)) == 0, EMPTY)
    ends = pages.withColumn("kind", kind).where("kind IS NOT NULL").groupBy("source", "place").agg(F.min(F.struct("page", "kind")).alias("end"))
    stops = ends.groupBy("source").agg(F.min(F.when(F.col("end.kind") == BLOCKED, F.col("place"))).alias("stop"))
    met = pages.join(ends, ["source", "place"], "left").join(stops, "source", "left")
    reached = F.col("stop").isNull() | (F.col("place") <= F.col("stop"))
    taken = F.col("end").isNull() | (F.col("page") < F.col("end.page")) | ((F.col("page") == F.col("end.page")) & (F.col("end.kind") == EMPTY))
    return met.where(reached & taken).select(*pages.columns)


def stats(pages: DataFrame) -> DataFrame:
    """source, pages, n_rows, blocked, skipped: what the crawl of each source took, whether a block ended it, and how many cities a failed fetch did."""
    kind = F.when(F.col("status") == BLOCKED, BLOCKED).when(F.col("status") == FAILED, FAILED).when(F.coalesce("n_rows", F.lit(0)) == 0, EMPTY)
    ends = pages.withColumn("kind", kind).groupBy("source", "place").agg(F.min(F.when(F.col("kind").isNotNull(), F.struct("page", "kind"))).alias("end"))
    per = ends.groupBy("source").agg(F.min(F.when(F.col("end.kind") == BLOCKED, F.col("place"))).alias("stop"))
    failed = ends.join(per, "source").where((F.col("end.kind") == FAILED) & (F.col("stop").isNull() | (F.col("place") < F.col("stop")))).groupBy("source").agg(F.count("*").alias("skipped"))
    took = visited(pages).groupBy("source").agg(F.count("*").alias("pages"), F.sum(F.coalesce("n_rows", F.lit(0))).alias("n_rows"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return per.join(took, "source", "left").join(failed, "source", "left").select("source", zero("pages"), zero("n_rows"), F.col("stop").isNotNull().alias("blocked"), zero("skipped"))
