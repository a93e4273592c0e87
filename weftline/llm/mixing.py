"""Mixing sources to target weights.

Tokens are summed for each source, targets follow from weights, and each
document is emitted floor(rate) times plus once more with probability equal to
the rate's fraction, by a hash of the seed and the document's id, so reruns and
retries agree.

The draws of one source are not independent, or a few long documents would
carry a small source far from its target. Documents fall in size classes,
largest first; how many of a class get the copy follows from where the running
count times the fraction, from a seeded offset, passes whole numbers, and those
with the smallest hashes get it. Each document's probability, over seeds, stays
the fraction; what a source takes is off by about one document. No rows are
put in order: the largest hash that gets a copy is selected digit by digit from
counts, so no task holds a source.

Defined cases: a null source is a source of its own, last in order; a null or
empty text has size 0 and still is emitted at its source's rate; a source
without words has target 0 and rate 0; repeated rows with one id and size draw
alike; an empty table gives an empty mix; a very long text is one row like any
other. Columns of the input pass through untouched whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import n_words
from weftline.scratch import materialize

#: Weights in source order, repeated as often as needed.
WEIGHTS = (1, 2, 3)
#: No source is taken more often than this, so no document is either.
MAX_REPEATS = 3
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """A row for each source: source, source_size, weight, target.

    ``sizes`` has source and size. Shares go by weight; a source whose share is
    above max_repeats times its size is held there and what is left over is
    shared again by weight among the rest. With the sources in order of
    ``cap / weight`` the held ones come first, so the level at which sharing
    stops is found with running sums instead of rounds. The windows run over
    one row for each source, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("n", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_repeats)
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "n")
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    leveled = (
        per.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("weight_left"))
        .withColumn("open_level", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")))
        .withColumn("final", F.first("open_level", ignorenulls=True).over(everything))
    )
    held = F.col("cap").cast("double")
    return leveled.select("source", "source_size", "weight", F.coalesce(F.least(F.col("final") * F.col("weight"), held), held).alias("target"))


def _unit(key: Column) -> Column:
    """32 bits of a hash of a key."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """32 bits of a hash of the seed and the id."""
    return _unit(F.concat(F.lit(seed + "|"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def size_class(size: str) -> Column:
    """Classes of nearly equal size: a number's length in bits, then its four leading bits."""
    return F.expr(f"16 * length(bin({size})) + shiftright({size}, greatest(length(bin({size})) - 4, 0))").cast("int")


#: Bits of a hash that each round of the selection looks at, 32 in all.
DIGITS = (8, 12, 12)


def thresholds(sizes: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """(source, class, whole, below): copies of each document of a class, and the largest hash that gets one more (-1: none).

    ``sizes`` has doc_id, source, size; ``targets`` source, source_size, target.
    The hash up to which a class's documents get one is selected digit by digit:
    a round counts, by the next bits, the hashes that agree with those found so
    far, and running sums over at most 4096 counts say which value comes next.
    So no rows are put in order, however many a class has.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _unit(F.concat(F.lit(seed + "|offset|"), F.coalesce("source", F.lit("null")))) / F.lit(float(2**32))
    rates = targets.select("source", F.floor(rate).cast("int").alias("whole"), (rate - F.floor(rate)).alias("fraction"), offset.alias("offset"))
    rows = sizes.select("source", size_class("size").alias("class"), draw(F.col("doc_id"), seed).alias("u"))
    per_class = materialize(rows.groupBy("source", "class").agg(F.count("*").alias("n")), "mix-counts")
    # a window over the classes of a source
    passed = lambda n: F.floor(n * F.col("fraction") + F.col("offset"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy(F.col("class").desc()))
    wanted = (
        per_class.withColumn("upto", upto).alias("c").join(rates.alias("r"), F.col("c.source").eqNullSafe(F.col("r.source")))
        .select("c.source", "class", "whole", (passed(F.col("upto")) - passed(F.col("upto") - F.col("n"))).alias("extra"))
    )
    wanted = materialize(wanted, "mix-wanted")
    found = wanted.where("extra > 0").select("source", "class", F.lit(0).cast("long").alias("high"), F.col("extra").alias("rank"))
    left = 32
    for digits in DIGITS:
        near = rows.alias("b").join(found.alias("f"), F.col("b.source").eqNullSafe(F.col("f.source")) & (F.col("b.class") == F.col("f.class")) & (F.shiftright("u", left) == F.col("high")))
        left -= digits
        counts = near.groupBy("b.source", "b.class", F.shiftright("u", left).alias("high")).agg(F.count("*").alias("n"), F.first("rank").alias("rank"))
        before = F.sum("n").over(Window.partitionBy("source", "class").orderBy("high")) - F.col("n")
        step = counts.withColumn("before", before).where((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("n")))
        found = materialize(step.select("source", "class", "high", (F.col("rank") - F.col("before")).alias("rank")), "mix-digits")
    return (
        wanted.alias("w").join(found.alias("f"), F.col("w.source").eqNullSafe(F.col("f.source")) & (F.col("w.class") == F.col("f.class")), "left")
        .select("w.source", "w.class", "whole", F.coalesce("high", F.lit(-1)).cast("long").alias("below"))
    )


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """One row for each row of docs: doc_id, source, size, source_size, target, copies.

    The text is read once, for its size. The tables of sources and classes are
    written before they are joined, so Spark knows their size: it broadcasts
    them below the session's threshold and joins by source, splitting hot ones,
    above it.
    """
    sizes = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, max_repeats), "mix-targets")
    per_class = materialize(
        thresholds(sizes, targets, seed).alias("c").join(targets.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
        .select("c.source", "class", "whole", "below", "source_size", "target"), "mix-classes",
    )
    placed = sizes.withColumn("size_class", size_class("size"))
    return placed.alias("d").join(per_class.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("size_class") == F.col("class"))).select(
        "doc_id", "d.source", "size", "source_size", "target", (F.col("whole") + (draw(F.col("doc_id"), seed) <= F.col("below")).cast("int")).alias("copies"),
    )


def emit(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mixed corpus: the rows of docs, each as often as the mix takes it, with docs' own columns. Texts aren't shuffled."""
    sizes = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, max_repeats), "mix-targets")
    per_class = materialize(thresholds(sizes, targets, seed).select(F.col("source").alias("mix_source"), F.col("class").alias("mix_class"), "whole", "below"), "mix-classes")
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).withColumn("mix_size", n_words(F.col("row.text"))).withColumn("row_class", size_class("mix_size"))
    copies = F.col("whole") + (draw(F.col("row.doc_id"), seed) <= F.col("below")).cast("int")
    return (
        packed.join(per_class, F.col("row.source").eqNullSafe(F.col("mix_source")) & (F.col("row_class") == F.col("mix_class")))
        .where(copies > 0)
        .select("row", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
        .select("row.*")
    )
