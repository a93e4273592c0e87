"""Source divergence audit: how a source's use of terms departs from its language's and from the other sources'.

A language keeps the terms in at least MIN_DOCS of its documents. A group (one
source of a language, or the whole language) gives a kept term with count c the
scaled share ``p = 1 + floor(SCALE * (c + 1) / (N + V))``, N the group's count
of kept terms and V their number; two shares differ by
``f = floor((p - q)^2 / q)``. A pair of sources scores the sum of f over all
kept terms, a term of a source its f against the language.

Most terms are rare and share their counts with many others, so terms are first
grouped by their identical sparse vector of counts by source. What follows runs
over distinct vectors with their multiplicity:

* A pair of sources that both have the vector is evaluated once for it and
  multiplied by how many terms it stands for. Vectors are sparse, so pairs of
  which only one has it are not spelled out: their f depends on one source's
  count alone, so it is evaluated once for each distinct (source, count), and
  the pairs of which neither has it once for all. The sum over all terms
  follows by inclusion and exclusion and is exact.
* For a source's terms, vectors are ranked first; only terms whose vector may
  reach the first TOP are looked up, and those original terms are ranked.

Counting goes in tasks: each keeps a bounded table of (lang, source, term) and
hands it on when full, Spark adds the rest up. No task holds a language or a
source; what goes through windows is one row for each source of a language, or
at most TOP rows of a source from each task.

All arithmetic is on whole numbers (64 bits for shares, 38 digits for products
and sums). Defined cases: null text, lang or source counts as empty; a group
without terms has its rows all the same; without kept terms V is 0 and a pair's
value 0; repeated rows count as documents each; ties go to the smaller item by
UTF-8 bytes; an empty table gives an empty result; a very long text is counted
whole in one task; only the three columns are read, whatever others there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.scratch import materialize

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
#: Entries of the table that a counting task keeps before it hands them on; within one table a term's occurrences stay below 2 to the DOC_BITS.
ENTRIES = 800_000
DOC_BITS = 40
ONE_DOC = 1 << DOC_BITS

#: Bytes of a term as they are, A-Z lower-cased, all others as a space: bytes from 0x80 up only occur in code points beyond ASCII.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that hold it), not null anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        import numpy as np

        # a term's documents and occurrences in one number
        seen: dict[tuple[str, str], dict[bytes, int]] = {}
        held = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), of in seen.items():
                terms, both = list(of), np.fromiter(of.values(), np.int64, len(of))
                for at in range(0, len(terms), 50_000):
                    some = pa.array(terms[at : at + 50_000], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(lang, len(some)), pa.repeat(source, len(some)), some, pa.array(both[at : at + 50_000] & (ONE_DOC - 1)), pa.array(both[at : at + 50_000] >> DOC_BITS)], names=["lang", "source", "term", "n", "docs"],
                    )

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.binary())):
                own = Counter((text.as_py() or b"").translate(_TERM_BYTES).split())
                of = seen.setdefault((lang, source), {})
                before = len(of)
                for term, n in own.items():
                    of[term] = of.get(term, 0) + n + ONE_DOC
                held += len(of) - before
                if held >= ENTRIES:
                    yield from rows()
                    seen.clear()
                    held = 0
        yield from rows()

    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    counted = docs.select(*map(empty, ("lang", "source", "text"))).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """The scaled share of a term with n of the group's total, out of ``kept`` terms."""
    return F.expr("1L") + _div((n + 1).cast("decimal(38,0)") * F.lit(SCALE).cast("decimal(10,0)"), (total + kept).cast("decimal(38,0)"))


def _div(a: Column, b: Column) -> Column:
    """Whole division, without a fraction on the way; null by 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0).cast("decimal(38,0)"))).cast("long")


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _exact(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def groups_of(docs: DataFrame) -> DataFrame:
    """lang, source and sid (its place among the language's sources, from 0) of each group that occurs."""
    found = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    return materialize(found.withColumn("sid", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1), "div-groups")


def kept_terms(counts: DataFrame, groups: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term and vector: the array of (sid, n) by sid of each term that the language keeps."""
    entries = counts.join(groups, ["lang", "source"]).select("lang", "term", "docs", F.struct("sid", "n").alias("e"))
    per_term = entries.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list("e")).alias("vector"))
    return materialize(per_term.where(F.col("docs") >= min_docs).select("lang", "term", "vector"), "div-terms")


def distinct_vectors(kept: DataFrame) -> DataFrame:
    """lang, vector, terms: how many kept terms have it."""
    return materialize(kept.groupBy("lang", "vector").agg(F.count("*").alias("terms")), "div-vectors")


def sides(vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, sid, source, total (of the group's kept terms), kept (the language's number of them), lang_total."""
    per_lang = vectors.groupBy("lang").agg(F.sum("terms").alias("kept"))
    counted = vectors.select("lang", "terms", F.explode("vector").alias("e")).groupBy("lang", F.col("e.sid").alias("sid")).agg(F.sum(F.col("terms") * F.col("e.n")).alias("total"))
    all_of = groups.join(counted, ["lang", "sid"], "left").join(per_lang, "lang", "left").withColumns({"total": F.coalesce("total", F.lit(0)), "kept": F.coalesce("kept", F.lit(0))})
    return materialize(all_of.withColumn("lang_total", F.sum("total").over(Window.partitionBy("lang"))), "div-sides")


def _weighed(vectors: DataFrame, side: DataFrame) -> DataFrame:
    """vectors with their entries' shares: e of (sid, n, p), and q, the language's share."""
    totals = materialize(side.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("sid", "total"))), lambda x: x["total"]).alias("totals"), F.first("kept").alias("kept"), F.first("lang_total").alias("lang_total")), "div-langs")
    with_p = F.transform("vector", lambda e: F.struct(e["sid"].alias("sid"), e["n"].alias("n"), share(e["n"], F.get("totals", e["sid"]), F.col("kept")).alias("p")))
    all_n = F.aggregate("vector", F.lit(0).cast("long"), lambda a, e: a + e["n"])
    return vectors.join(totals, "lang").select("lang", "vector", "terms", with_p.alias("entries"), share(all_n, F.col("lang_total"), F.col("kept")).alias("q"))


def pair_values(weighed: DataFrame, side: DataFrame) -> DataFrame:
    """lang, a, b (sids), value: the sum of f of a's shares against b's over all kept terms, for each ordered pair of sources.

    With 0 for the share of a count of 0, a sum over all terms of f(a, b) is
    that over the terms which both have of f(a,b) - f(a,0) - f(0,b) + f(0,0),
    over those which a has of f(a,0) - f(0,0), over those which b has of
    f(0,b) - f(0,0), and f(0,0) for every term.
    """
    base = side.where("kept > 0").withColumn("p0", share(F.lit(0), F.col("total"), F.col("kept")))
    pairs = base.select("lang", F.col("sid").alias("a"), F.col("p0").alias("a0"), "kept").join(base.select("lang", F.col("sid").alias("b"), F.col("p0").alias("b0")), "lang").where("a <> b")
    bases = pairs.select("lang", "a", "b", _exact(F.col("kept")) * _exact(apart(F.col("a0"), F.col("b0"))))
    # p0 follows from the group, so it is joined once for each vector as an array
    zero = materialize(base.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("sid", "p0"))), lambda x: x["p0"]).alias("zero")), "div-zero")
    one = weighed.select("lang", "terms", "entries", F.explode("entries").alias("x")).join(zero, "lang")
    two = one.select("lang", "terms", "x", F.explode("entries").alias("y"), "zero").where("x.sid <> y.sid").select("lang", "terms", F.col("x.sid").alias("a"), F.col("y.sid").alias("b"), F.col("x.p").alias("p"), F.col("y.p").alias("q"), F.get("zero", F.col("x.sid")).alias("a0"), F.get("zero", F.col("y.sid")).alias("b0"))
    p, q, a0, b0 = map(F.col, ("p", "q", "a0", "b0"))
    both = _exact(apart(p, q)) - _exact(apart(p, b0)) - _exact(apart(a0, q)) + _exact(apart(a0, b0))
    shared = two.select("lang", "a", "b", (_exact(F.col("terms")) * both).alias("v"))
    # a row for each distinct count of a source, and each other source
    single = weighed.select("lang", "terms", F.explode("entries").alias("x")).groupBy("lang", F.col("x.sid").alias("sid"), F.col("x.p").alias("p")).agg(F.sum("terms").alias("terms"))
    single = materialize(single, "div-counts").join(zero, "lang").select("lang", "sid", "p", "terms", F.get("zero", F.col("sid")).alias("own"), F.posexplode("zero").alias("other", "o0")).where("sid <> other")
    own, o0, terms = F.col("own"), F.col("o0"), _exact(F.col("terms"))
    as_a = single.select("lang", F.col("sid").alias("a"), F.col("other").alias("b"), (terms * (_exact(apart(p, o0)) - _exact(apart(own, o0)))).alias("v"))
    as_b = single.select("lang", F.col("other").alias("a"), F.col("sid").alias("b"), (terms * (_exact(apart(o0, p)) - _exact(apart(o0, own)))).alias("v"))
    value = F.sum(_exact(F.col("v"))).cast("long")
    summed = lambda df: df.groupBy("lang", "a", "b").agg(F.sum(_exact(F.col("v"))).alias("v"))
    return summed(shared).union(summed(as_a.union(as_b))).union(bases).toDF("lang", "a", "b", "v").groupBy("lang", "a", "b").agg(value.alias("value"))


def top_terms(weighed: DataFrame, kept: DataFrame, top: int = TOP) -> DataFrame:
    """lang, sid, term, value, rank of the terms of a source that depart most from the language, upwards."""
    scored = weighed.select("lang", "vector", "q", F.explode("entries").alias("x")).where("x.p > q").select("lang", "vector", F.col("x.sid").alias("sid"), apart(F.col("x.p"), F.col("q")).alias("value"))
    group = Window.partitionBy("lang", "sid")
    # each vector has a term at least, so the first terms are of the first vectors, ties included
    ahead = scored.withColumn("r", F.rank().over(group.orderBy(F.col("value").desc()))).where(F.col("r") <= top)
    chosen = materialize(ahead.select("lang", "vector", "sid", "value"), "div-chosen")
    terms = kept.join(chosen, ["lang", "vector"]).select("lang", "sid", "term", "value")
    return terms.withColumn("rank", F.row_number().over(group.orderBy(F.col("value").desc(), "term"))).where(F.col("rank") <= top)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: for each source of a language all other sources ('pair') and its first terms ('term')."""
    groups = groups_of(docs)
    kept = kept_terms(term_counts(docs), groups, min_docs)
    vectors = distinct_vectors(kept)
    side = sides(vectors, groups)
    weighed = materialize(_weighed(vectors, side), "div-weighed")
    name = groups.select("lang", "sid", "source")
    ordered = name.toDF("lang", "a", "source").join(name.toDF("lang", "b", "item"), "lang").where("a <> b")
    valued = ordered.join(materialize(pair_values(weighed, side), "div-pairs"), ["lang", "a", "b"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = valued.select("lang", "source", F.lit("pair").alias("part"), "item", "value", place.alias("rank"))
    terms = top_terms(weighed, kept, top).join(name, ["lang", "sid"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.union(terms)
