"""Line dedup by content-defined chunks of lines.

Each line is hashed, and a rolling hash runs over two line hashes at a time. A
boundary lies after each line where the rolling hash is at a local minimum, so
no inner chunk is a single line; a second set of chunks has its boundaries at
local maxima. In both a chunk ends after MAX_LINES at the latest. A boundary
depends on a few lines before it, so an insertion elsewhere shifts no chunk.
Chunks of two or more lines that occur again anywhere in the corpus are removed,
but for the first: smallest (doc_id, hash of the text, position).

Hashes only propose. Chunks that follow each other in a text as their firsts do
in theirs are one run; the lines of a run and of its first are fetched and
compared byte by byte, and only lines that are equal go. With a run go the lines
on either side as far as they are equal too: windows of lines around both are
fetched, first NEAR lines wide, and wider ones for the runs whose window was
equal to its end, until none is. A line goes only where its neighbour goes too,
so a collision of hashes removes no line but one of two or more in a row that
have an equal copy at an earlier place; one copy of every line stays.

Of the lines in passages of three or more that an earlier place has, that is
over nine in ten (tests/llm measures it); a passage whose boundaries all fall
outside it is missed.

All of it is DataFrame functions. What crosses a shuffle by chunk is a key and
a position; texts cross one to be fetched for runs, which are only the parts
that occur twice, and one to be cut; rounds with wider windows read the texts
that the round before fetched. No window or collected group holds the
copies of a chunk: the first is a minimum, which Spark combines before the
shuffle, and the rest meet it in an inner join whose hot keys Spark may split;
windows run over the chunks of one text that repeat one other. The joins are
merge joins at every size, so a small corpus shows what a large one costs.

Defined cases: a null text stays null, an empty one empty; rows that repeat
both doc_id and text count as one document, so each keeps its first chunks; a
document whose lines all go keeps its row with an empty text; null ids sort
first; an empty table gives an empty result; other columns pass through; a very
long text is cut whole, in one task. Texts of one id are told apart by a 64-bit
hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import let
from weftline.scratch import materialize

MAX_LINES = 4
MIN_LINES = 2
#: Lines on either side of a run that are fetched with it, and how much wider the next window is where that was not enough.
NEAR, WIDER = 8, 8
#: Fixed values of the rolling hash.
BASE, MODULUS = 8191, 1000003


def line_hash(line: Column) -> Column:
    """24 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 6), 16, 10).cast("long")


def ends(lines: Column) -> tuple[Column, Column]:
    """Positions (from 0) of the last line of each chunk, ascending: of chunks parted at minima, and at maxima."""

    def rolled(h: Column) -> Column:
        return F.transform(h, lambda x, k: (F.coalesce(F.get(h, k - 1), F.lit(0)) * BASE + x) % MODULUS)

    def at(r: Column, sign: int) -> Column:
        x = lambda k: F.get(r, k) * sign
        low = lambda k: (k == F.size(r) - 1) | ((k > 0) & (x(k) < x(k - 1)) & (x(k) <= x(k + 1)))
        found = F.filter(F.transform(r, lambda _, k: F.when(low(k), k)), lambda k: k.isNotNull())
        return let(found, lambda e: F.flatten(F.transform(e, lambda last, k: F.concat(_stops(_start(e, k), last), F.array(last)))))

    both = let(F.transform(lines, line_hash), lambda h: let(rolled(h), lambda r: F.struct(at(r, 1).alias("low"), at(r, -1).alias("high"))))
    return both["low"], both["high"]


def _start(e: Column, k: Column) -> Column:
    return F.when(k == 0, 0).otherwise(F.get(e, k - 1) + 1)


def _stops(start: Column, last: Column) -> Column:
    """Ends before ``last`` of a chunk that is longer than MAX_LINES."""
    return F.when(start + (MAX_LINES - 1) < last, F.sequence(start + (MAX_LINES - 1), last - 1, F.lit(MAX_LINES))).otherwise(F.array().cast("array<int>"))


def chunks(text: Column) -> Column:
    """Chunks of MIN_LINES or more of a text, of both sets: struct(start, n_lines, body), start counted in lines."""

    def pieces(lines: Column) -> Column:
        def piece(e: Column, last: Column, k: Column) -> Column:
            start = _start(e, k)
            return F.struct(start.alias("start"), (last - start + 1).alias("n_lines"), F.array_join(F.slice(lines, start + 1, last - start + 1), "\n").alias("body"))

        def of(e: Column) -> Column:
            spans = F.transform(e, lambda last, k: F.when(last - _start(e, k) + 1 >= MIN_LINES, piece(e, last, k)))
            return F.filter(spans, lambda c: c.isNotNull())

        low, high = ends(lines)
        return F.concat(let(low, of), let(high, of))

    return let(F.split(text, "\n", -1), pieces)


def _doc_hash(text: Column) -> Column:
    return F.xxhash64(text)


def chunk_key(body: Column) -> list[Column]:
    """k1 and k2, by which equal chunks meet."""
    return [F.xxhash64(body).alias("k1"), F.crc32(body).alias("k2")]


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, doc_hash, a, b, first_id, first_hash, first_a: lines a to b (without b) whose chunks have the keys of those of an earlier place, beginning there at first_a."""
    pieces = docs.select("doc_id", _doc_hash(F.col("text")).alias("doc_hash"), F.explode(chunks(F.col("text"))).alias("c"))
    keyed = materialize(pieces.select("doc_id", "doc_hash", "c.start", "c.n_lines", *chunk_key(F.col("c.body"))).distinct(), "line-chunks")
    at = F.struct("doc_id", "doc_hash", "start")
    hot = materialize(keyed.groupBy("k1", "k2").agg(F.min(at).alias("first"), F.max(at).alias("last")).where(~F.col("first").eqNullSafe(F.col("last"))).select("k1", "k2", "first"), "line-keys")
    again = keyed.join(hot.hint("merge"), ["k1", "k2"]).where(~at.eqNullSafe(F.col("first")))
    placed = again.select(
        "doc_id", "doc_hash", F.col("start").alias("a"), (F.col("start") + F.col("n_lines")).alias("b"), F.col("first.doc_id").alias("first_id"), F.col("first.doc_hash").alias("first_hash"), (F.col("start") - F.col("first.start")).alias("shift"),
    )
    pair = ["doc_id", "doc_hash", "first_id", "first_hash", "shift"]
    w = Window.partitionBy(*pair).orderBy("a", "b")
    fresh = F.coalesce(F.col("a") > F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int")
    numbered = placed.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(*pair, "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return materialize(merged.select("doc_id", "doc_hash", "a", "b", "first_id", "first_hash", (F.col("a") - F.col("shift")).alias("first_a")), "line-runs")


def texts_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, doc_hash, text, spans of the texts (doc_id, doc_hash, text) that runs lie in, their own and their firsts': spans holds the (a, b) of each, once. Written: what a later round needs is among them."""
    first_b = F.col("first_a") + F.col("b") - F.col("a")
    wanted = found.select("doc_id", "doc_hash", "a", "b").union(found.select("first_id", "first_hash", "first_a", first_b)).distinct()
    per_doc = wanted.groupBy("doc_id", "doc_hash").agg(F.collect_list(F.struct("a", "b")).alias("spans")).select(F.col("doc_id").alias("i"), F.col("doc_hash").alias("h"), "spans")
    met = docs.select("doc_id", "doc_hash", "text").join(per_doc.hint("merge"), F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("doc_hash") == F.col("h")))
    # rows that repeat id and text are one; no shuffle beyond the join's
    return materialize(met.groupBy("doc_id", "doc_hash").agg(F.first("text").alias("text"), F.first("spans").alias("spans")), "line-texts")


def windows(texts: DataFrame, near: int) -> DataFrame:
    """doc_id, doc_hash, a, b, lead, lines: the lines of each span of texts and up to ``near`` before, lead in number, and after it."""
    lead = lambda x: F.least(x["a"], F.lit(near))
    cut_out = lambda ls: F.transform("spans", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), lead(x).alias("lead"), F.slice(ls, x["a"] - lead(x) + 1, x["b"] - x["a"] + lead(x) + near).alias("lines")))
    return texts.select("doc_id", "doc_hash", F.explode(let(F.split("text", "\n", -1), cut_out)).alias("s")).select("doc_id", "doc_hash", "s.*")


def compared(texts: DataFrame, found: DataFrame, near: int) -> DataFrame:
    """found (runs) with gone, the numbers of the lines that are equal to their first's and one of two or more such in a row, and more: whether a window was equal to its end."""
    first_b = F.col("first_a") + F.col("b") - F.col("a")
    own = windows(texts, near).toDF("i", "h", "oa", "ob", "lead", "lines")
    first = windows(texts, near).toDF("fi", "fh", "fa", "fb", "first_lead", "first_lines")
    same_id = lambda x, y: F.col(x).eqNullSafe(F.col(y))
    both = found.join(own.hint("merge"), same_id("doc_id", "i") & same_id("doc_hash", "h") & same_id("a", "oa") & same_id("b", "ob"))
    both = both.join(first.hint("merge"), same_id("first_id", "fi") & same_id("first_hash", "fh") & same_id("first_a", "fa") & (first_b == F.col("fb")))
    behind = F.col("lead") - F.col("first_lead")
    same = F.transform("lines", lambda x, k: F.coalesce(x == F.get("first_lines", k - behind), F.lit(False)))
    size, until = F.size("lines"), F.col("lead") + F.col("b") - F.col("a")
    # the last line before the run, and the first one after it, that isn't equal
    unlike = F.filter(F.transform("same", lambda x, k: F.when(~x, k)), lambda k: k.isNotNull())
    low = F.coalesce(F.array_max(F.filter("unlike", lambda k: k < F.col("lead"))), F.lit(-1)) + 1
    high = F.coalesce(F.array_min(F.filter("unlike", lambda k: k >= F.col("until"))), F.col("size"))
    inside = lambda k: (k >= F.col("low")) & (k < F.col("high"))
    equal = lambda k: F.coalesce(F.get("same", k), F.lit(False)) & inside(k)
    gone = F.filter(F.transform("same", lambda x, k: F.when(equal(k) & (equal(k - 1) | equal(k + 1)), k + F.col("a") - F.col("lead"))), lambda k: k.isNotNull())
    full = lambda n: n == near
    more = ((F.col("low") == 0) & full(F.col("lead")) & full(F.col("first_lead"))) | ((F.col("high") == F.col("size")) & full(F.col("size") - F.col("until")) & full(F.size("first_lines") - F.col("first_lead") - F.col("b") + F.col("a")))
    marked = both.withColumns({"same": same, "size": size, "until": until}).withColumn("unlike", unlike).withColumns({"low": low, "high": high})
    return marked.select(*found.columns, gone.alias("gone"), more.alias("more"))


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, gone): numbers of lines to remove; those of one text may overlap."""
    found, near, out = runs(docs), NEAR, None
    texts = docs.select("doc_id", _doc_hash(F.col("text")).alias("doc_hash"), "text")
    while True:
        texts = texts_of(texts, found)
        seen = materialize(compared(texts, found, near), "line-compared")
        cuts = seen.where(F.size("gone") > 0).select("doc_id", "doc_hash", "gone")
        out = cuts if out is None else out.union(cuts)
        found, near = seen.where("more").select(*found.columns), near * WIDER
        if found.isEmpty():
            return out


def cut(docs: DataFrame) -> DataFrame:
    """row (a struct of docs' columns, with the repeated chunks cut from its text), ld_lines and ld_removed: lines before and lines cut."""
    cuts = repeated(docs.select("doc_id", "text"))
    per_doc = cuts.groupBy("doc_id", "doc_hash").agg(F.collect_list("gone").alias("cuts"))
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    joined = packed.withColumn("key", _doc_hash(F.col("row.text"))).join(
        per_doc.hint("merge"), F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("doc_hash")), "left",
    )
    gone = F.flatten("cuts")
    lines = F.split(F.col("row.text"), "\n", -1)
    # marks line by line, aligned with the lines, so that no line looks through the list of cuts
    kept = let(
        lines,
        lambda ls: let(
            F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), gone),
            lambda at: F.struct(F.array_join(F.transform(at, lambda k: F.get(ls, k)), "\n").alias("text"), F.size(at).alias("n")),
        ),
    )
    cut_rows = joined.withColumn("kept", F.when(F.col("cuts").isNotNull(), kept))
    n_lines = F.when(F.col("row.text").isNull(), 0).otherwise(F.size(lines))
    return cut_rows.select(
        F.col("row").withField("text", F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(F.col("kept.text"))).alias("row"),
        n_lines.cast("long").alias("ld_lines"), F.when(F.col("cuts").isNull(), 0).otherwise(n_lines - F.col("kept.n")).cast("long").alias("ld_removed"),
    )


def dedup(docs: DataFrame) -> DataFrame:
    """docs with the repeated chunks cut from text; docs' own columns, whatever their names."""
    return cut(docs).select("row.*")
