"""Near-duplicate detection: banded MinHash, odd sketches, exact confirmation.

A document's set holds the hashes of its distinct word shingles. From the set
come BANDS * ROWS MinHash samples. Bands of samples make bucket keys; all
samples, folded into a bitmap by parity (an odd sketch), estimate the
similarity of a candidate pair from the population count of two bitmaps' XOR.
Pairs that the sketch rules out by a wide margin go; the rest are confirmed on
the full sets.

No bucket is expanded into all pairs, and a key that holds many rows is dealt to
several tasks (:func:`hot_join`):

* Documents with equal sets are one class with one representative.
* Each member of a bucket is compared with the bucket's smallest one. Links so
  confirmed merge documents into components.
* Only buckets that still hold more than one component are looked at again:
  members outside the bucket's largest component are compared with the members
  of other components. Pairs within one component need no comparison, so the
  components come out as if all pairs had been compared. Many of these pairs
  lie just under the threshold, so the join that finds them compares parity
  bitmaps of the whole sets as it goes: each shingle that only one text has
  flips one bit, so the XOR's population count never exceeds the number of such
  shingles, and a pair with more than the threshold allows can't be similar
  enough. No pair is lost to that test and hardly one passes it in vain.

Defined cases: a text without words, or null, has an empty set and links with
nothing; fewer words than a shingle make one shingle of all of them; rows that
share a doc_id are one document, in one component; rows with a null doc_id link
with nothing and have a null component; an empty table gives an empty result;
a very long text is one set in one task; only doc_id and text are read by
:func:`near_duplicates`, and :func:`keep_one` keeps docs' columns whatever their
names.

Probabilities: a pair at exactly 0.8 shares no band with probability 3e-6; its
sketch estimates under 0.6, and rules it out, with less than 1e-8 (of 160
samples more than 63 would have to differ, where 32 do on average). Shingles are compared by
64-bit hashes, equal sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.scratch import materialize

BANDS, ROWS = 32, 5
SAMPLES = BANDS * ROWS
ODD_BITS = 512
#: Candidates whose sketches estimate a similarity under this much below the threshold go without confirmation.
MARGIN = 0.20
#: Members of a bucket above which those of other components are found by prefixes of their sets.
BIG = 256
#: Rows of one key above which a join deals the key to several tasks.
HOT = 500
#: Words whose hashes a task keeps before it starts anew.
CACHE = 300_000


class _Hashes(dict):
    """word -> its 64-bit hash as bytes."""

    def __init__(self, digest) -> None:
        super().__init__()
        self.digest = digest

    def __missing__(self, word: bytes) -> bytes:
        value = self[word] = self.digest(word)
        return value


class Sketcher:
    """Sets, samples and sketches of texts, with numpy."""

    def __init__(self, n: int) -> None:
        import numpy as np
        import xxhash

        self.np, self.n = np, n
        self.known = _Hashes(xxhash.xxh3_64_digest)
        rng = np.random.default_rng(20240229)
        self.mult = rng.integers(0, 2**32, SAMPLES, np.uint32) | np.uint32(1)
        self.flip = rng.integers(0, 2**32, SAMPLES, np.uint32)
        self.place = np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.poly = np.uint64(0x5851F42D4C957F2D)
        self.block = np.empty((2048, SAMPLES), np.uint32)

    def mix(self, x):
        np = self.np
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def shingles(self, text: str | None):
        """Sorted distinct 64-bit hashes of the text's shingles."""
        np = self.np
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > CACHE:
            self.known.clear()
        codes = np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.uint64)
        n = min(self.n, len(codes))
        out = codes[: len(codes) - n + 1].copy()
        for k in range(1, n):
            out = out * self.poly + codes[k : len(codes) - n + 1 + k]
        return np.unique(self.mix(out + np.uint64(n)))

    def samples(self, shingles):
        np = self.np
        low = np.full(SAMPLES, 2**32 - 1, np.uint32)
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(short), len(self.block)):
            part = short[at : at + len(self.block), None]
            block = self.block[: len(part)]
            np.bitwise_xor(part, self.flip, out=block)
            np.multiply(block, self.mult, out=block)
            np.minimum(low, block.min(axis=0), out=low)
        return low

    def bands(self, samples):
        np = self.np
        rows = samples.astype(np.uint64).reshape(BANDS, ROWS)
        key = self.place[:BANDS].copy()
        for k in range(ROWS):
            key = self.mix(key * self.poly + rows[:, k])
        return key.view(np.int64)

    def odd(self, samples):
        np = self.np
        bit = self.mix(samples.astype(np.uint64) + self.place) % np.uint64(ODD_BITS)
        parity = (np.bincount(bit.astype(np.int64), minlength=ODD_BITS) & 1).astype(np.uint8)
        return np.packbits(parity).view(np.int64)

    def parity(self, shingles):
        """Parity bitmap of a whole set, WIDE longs."""
        np = self.np
        bit = (shingles >> np.uint64(7)) % np.uint64(64 * WIDE)
        return np.packbits((np.bincount(bit.astype(np.int64), minlength=64 * WIDE) & 1).astype(np.uint8)).view(np.int64)


_sketchers: dict[int, Sketcher] = {}


def sketcher(n: int) -> Sketcher:
    if n not in _sketchers:
        _sketchers[n] = Sketcher(n)
    return _sketchers[n]


def sketch(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, s1 and s2 (digest of the set), bands, odd; the last two null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import numpy as np

        sk = sketcher(n)
        for batch in batches:
            sizes, digests, bands, odds = [], [], [], []
            for x in batch.column("text"):
                s = sk.shingles(x.as_py())
                sizes.append(len(s))
                digests.append(np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64))
                m = sk.samples(s) if len(s) else None
                bands.append(sk.bands(m) if len(s) else None)
                odds.append(sk.odd(m) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(odds, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "s1", "s2", "bands", "odd"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>, odd array<long>")


#: Bits, in longs, of the parity bitmap of a whole set.
WIDE = 16
_BITS = [f"p{k}" for k in range(WIDE)]


def full_sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, its whole set as an array of long, and p0, p1, ...: the parity bitmap of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        sk = sketcher(n)
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                some = batch.slice(first, 1000)
                sets = [sk.shingles(x.as_py()) for x in some.column("text")]
                wide = np.array([sk.parity(x) for x in sets])
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id").cast(pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())), *(pa.array(np.ascontiguousarray(wide[:, k])) for k in range(WIDE))],
                    names=["doc_id", "members", *_BITS],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, members array<long>, " + ", ".join(f"{p} long" for p in _BITS))


def odd_estimate(a: Column, b: Column) -> Column:
    """Similarity that two odd sketches estimate."""
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    share = F.least(F.lit(0.999), apart * (2.0 / ODD_BITS))
    return F.lit(1.0) + F.log(1.0 - share) * (ODD_BITS / 2.0) / (2.0 * SAMPLES)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of each vertex of edges (a, b) that isn't itself the smallest of its component.

    Alternates two steps until nothing changes: every vertex links its larger
    neighbours to the smallest one it sees, then its smaller neighbours and
    itself. Both are a minimum by key, combined before the shuffle, and an
    inner join. Each round's edges are written to the shared folder.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())

    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    seen = state(e)
    while seen[0]:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select("v", "u"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        up = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        low = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(down.union(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))


def hot_join(left: DataFrame, right: DataFrame, on: list[str], by: str, condition: Column | None = None) -> DataFrame:
    """Inner join of left and right on columns that neither has null, with a key of many rows on the left dealt to several tasks.

    Keys with more than HOT rows on the left are few, at most one in HOT rows;
    their table is written, so Spark broadcasts it where it is small. Their left
    rows are parted by a hash of column ``by``, and their right rows repeated for
    each part.
    """
    counts = materialize(left.groupBy(*on).agg(F.count("*").alias("c")).where(F.col("c") > HOT).select(*on, F.ceil(F.col("c") / HOT).alias("parts")), "hot-keys")
    parts = F.coalesce("parts", F.lit(1))
    a = left.join(counts, on, "left").withColumn("part", F.pmod(F.xxhash64(by), parts)).drop("parts")
    b = right.join(counts, on, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    joined = a.join(b, [*on, "part"]).drop("part")
    return joined if condition is None else joined.where(condition)


def _confirm(pairs: DataFrame, narrow: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough: first by size and odd sketch (narrow: doc_id, n, odd), then by the sets. Many pairs may have one a."""
    a, b = narrow.toDF("a", "na", "oa"), narrow.toDF("b", "nb", "ob")
    likely = (
        hot_join(pairs, a, ["a"], "b").join(b, "b")
        .where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (odd_estimate(F.col("oa"), F.col("ob")) >= percent / 100 - MARGIN))
        .select("a", "b").distinct()
    )
    whole = sets.select("doc_id", "members")
    both = hot_join(materialize(likely, "likely"), whole.toDF("a", "ma"), ["a"], "b").join(whole.toDF("b", "mb"), "b")
    shared = F.size(F.array_intersect("ma", "mb"))
    return both.select("a", "b", shared.alias("i"), (F.size("ma") + F.size("mb")).alias("t")).where(100 * F.col("i") >= percent * (F.col("t") - F.col("i"))).select("a", "b").distinct()


def _possible(percent: int) -> Column:
    """Whether bitmaps x_p*, y_p* and sizes nx, ny allow the similarity; exact: a false result rules the pair out."""
    apart = sum((F.bit_count(F.col(f"x_{p}").bitwiseXOR(F.col(f"y_{p}"))) for p in _BITS[1:]), F.bit_count(F.col("x_p0").bitwiseXOR(F.col("y_p0"))))
    # at most (100 - percent) / (100 + percent) of both sizes may lie in one set alone
    return (100 + percent) * apart <= (100 - percent) * (F.col("nx") + F.col("ny"))


def prefix_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of rows (id, c, n, members) of unlike c whose sets may be similar enough: exact, no similar pair is left out.

    Of two sets of which each has percent of the other's members, in one order
    for all members, the first ``n - ceil(percent * n / 100) + 1`` of each have
    one in common. Members are ordered by how many of these sets have them, the
    rarest first, so what many share is hardly ever in a prefix.
    """
    one = rows.select("id", "c", "n", F.explode("members").alias("m"))
    counts = materialize(one.groupBy("m").agg(F.count("*").alias("f")), "prefix-counts")
    place = F.row_number().over(Window.partitionBy("id").orderBy("f", "m"))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # windows over the members of one set; a member that no other set has needs no partner
    prefix = materialize(one.join(counts, "m").withColumn("place", place).where((F.col("place") <= length) & (F.col("f") > 1)).select("m", "id", "c", "n"), "prefixes")
    alike = (F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy")) & (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
    return hot_join(prefix.toDF("m", "x", "cx", "nx"), prefix.toDF("m", "y", "cy", "ny"), ["m"], "x", alike).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs."""
    sketches = materialize(sketch(docs, n), "sketches")
    usable = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = materialize(usable.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")), "classes")
    copies = hot_join(usable.select("doc_id", "s1", "s2"), classes, ["s1", "s2"], "doc_id", F.col("doc_id") != F.col("rep")).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reps = usable.join(classes.select("s1", "s2", F.col("rep").alias("doc_id")), ["s1", "s2", "doc_id"], "left_semi")
    in_bands = reps.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    shared = in_bands.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("key", "first")
    members = materialize(in_bands.join(shared, "key"), "members")

    # sets of the documents that share a bucket with another; texts are shuffled for this once
    ids = members.select(F.col("id").alias("doc_id")).distinct().hint("merge")
    sets = materialize(full_sets(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi"), n), "sets")

    stars = materialize(members.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), "stars")
    narrow = reps.select("doc_id", F.col("n_shingles").alias("n"), "odd")
    links = materialize(_confirm(stars, narrow, sets, percent).union(copies), "links")
    label = components(links)

    placed = members.select("key", "id").join(label, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    mixed = (
        placed.groupBy("key", "c").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("c", "n").alias("main"), F.count("*").alias("n_c")).where("n_c > 1").select("key", "main")
    )
    bitmaps = sets.select(F.col("doc_id").alias("id"), F.size("members").alias("n"), *_BITS)
    among = placed.join(mixed, "key")
    sizes = materialize(among.groupBy("key").agg(F.count("*").alias("size")), "mixed-buckets")
    big = materialize(among.join(sizes.where(F.col("size") > BIG).select("key"), "key", "left_semi").select("id", "c").distinct(), "big-buckets")
    rest = materialize(among.join(sizes.where(F.col("size") <= BIG).select("key"), "key", "left_semi").join(bitmaps, "id"), "rest")
    side = lambda rows, s: rows.select("key", F.col("id").alias(s), F.col("c").alias(f"c{s}"), F.col("n").alias(f"n{s}"), *[F.col(p).alias(f"{s}_{p}") for p in _BITS])
    few, every = side(rest.where("c <> main"), "x"), side(rest, "y")
    pairs = hot_join(few, every, ["key"], "x", (F.col("cx") != F.col("cy")) & _possible(percent)).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    whole = big.join(sets.select(F.col("doc_id").alias("id"), F.size("members").alias("n"), "members"), "id")
    met = prefix_pairs(whole.select("id", "c", "n", "members"), percent)
    bits = lambda s: bitmaps.select(F.col("id").alias("a" if s == "x" else "b"), F.col("n").alias(f"n{s}"), *[F.col(p).alias(f"{s}_{p}") for p in _BITS])
    met = met.join(bits("x"), "a").join(bits("y"), "b").where(_possible(percent)).select("a", "b")
    more = materialize(_confirm(pairs.union(met).distinct(), narrow, sets, percent), "more-links")
    label = components(label.toDF("a", "b").union(more))
    return sketches.select("doc_id", "n_shingles").join(label.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, with docs' own columns whatever their names, without all but one document of each component.

    The smallest doc_id stays. Rows without an id all stay. Where ids repeat,
    a document is an id with a text: rows that repeat both are one, other texts
    of the id are judged by themselves, and of two copies under one id that with
    the smaller SHA-256 stays.
    """
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    if not docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count():
        found = materialize(near_duplicates(docs, n, percent).select("doc_id", "component_id"), "near")
        gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("nd_gone"))
        return packed.join(gone, F.col("row.doc_id") == F.col("nd_gone"), "left_anti").select("row.*")
    digest = lambda text: F.coalesce(F.sha2(text, 256), F.lit(""))
    named = docs.where("doc_id IS NOT NULL").select("doc_id", "text", digest(F.col("text")).alias("digest")).dropDuplicates(["doc_id", "digest"])
    vertices = materialize(named.withColumn("vertex", F.monotonically_increasing_id()), "vertices")
    found = near_duplicates(vertices.select(F.col("vertex").alias("doc_id"), "text"), n, percent).select(F.col("doc_id").alias("vertex"), "component_id")
    least = vertices.select("vertex", "doc_id", "digest").join(found, "vertex").groupBy("component_id").agg(F.min(F.struct("doc_id", "digest")).alias("k"))
    stay = materialize(least.select(F.col("k.doc_id").alias("i"), F.col("k.digest").alias("g")), "near")
    rows = packed.where("row.doc_id IS NOT NULL").select(F.col("row.doc_id").alias("i"), digest(F.col("row.text")).alias("g"), "row").join(stay, ["i", "g"], "left_semi")
    one = rows.groupBy("i", "g").agg(F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row"))
    return one.select("row.*").union(packed.where("row.doc_id IS NULL").select("row.*"))
