"""Gates with reasons, and matching against known and blocked firms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import firm
from weftline.functions.fuzzy import common_length
from weftline.scratch import materialize, settled

MAX_YEAR, FLOOR, CEILING, HQ = 2020, 30, 1000, "India"
TARGETS = ("1-100", "100-500", "500-1000")
KNOWN_SCORE, BLOCK_SCORE, SHORTEST_CORE = 92.0, 90.0, 5


#: What gates read of a firm.
READ = ("domain", "company_name", "founded_year", "founded_note", "size_source", "size_band", "hq_country")


def apply_gates(companies: DataFrame, known_domains: DataFrame, known: DataFrame, terms: DataFrame, max_year: int = MAX_YEAR, floor: int = FLOOR, ceiling: int = CEILING, reasons: bool = True) -> DataFrame:
    """companies with size_bucket, gate_pass and gate_reason; failing firms stay, with all their reasons.

    known_domains has a row for each excluded domain, known (ordinal, name) for
    each known firm, terms (ordinal, term) for each blocked name; all are joined,
    not collected. A firm without a country is one of HQ; another country is
    noted, not rejected.

    Without ``reasons`` only gate_pass is asked: it is the same, but a firm that
    its domain, year or size rejects is not matched by name too, nor a known one
    against the blocked; gate_reason has the notes of firms that pass and is null
    for the others.
    """
    flagged = companies.join(known_domains.select("domain").distinct().withColumn("known", F.lit(True)), "domain", "left")
    flagged = settled(flagged.withColumn("headcount", firm.size_headcount(F.col("size_source"), F.col("size_band"))))
    flagged = flagged.withColumn("size_bucket", firm.size_bucket(F.col("headcount")))
    year, count = F.col("founded_year"), F.col("headcount")
    approx = F.concat(F.lit("~"), count.cast("string"))
    size_reason = (
        F.when(count.isNull(), "size unknown").when(count < floor, F.concat(F.lit("size "), approx, F.lit(f" below floor {floor}")))
        .when(F.col("size_bucket").isNull(), F.concat(F.lit("size "), approx, F.lit(f" above ceiling {ceiling}")))
        .when(~F.col("size_bucket").isin(*TARGETS), F.concat(F.lit("size bucket "), F.col("size_bucket"), F.lit(" not targeted")))
    )
    year_reason = F.when(year.isNull(), "founded year unknown").when(year > max_year, F.concat(F.lit("founded "), year.cast("string"), F.lit(f" > {max_year}")))
    flagged = flagged.withColumns({"size_reason": size_reason, "year_reason": year_reason})
    # read for their names, and again for the joins: written once, a row for each firm
    flagged = materialize(flagged.withColumn("open", F.col("known").isNull() & F.col("size_reason").isNull() & F.col("year_reason").isNull()), "companies")
    # a name decides on firms that nothing else rejects, and a known one needs no other match; for the rest either is one reason more
    asked = flagged if reasons else flagged.where("open")
    names = asked.select(F.col("company_name").alias("name")).where("name IS NOT NULL").distinct()
    by_name = match_known(names, known)
    if not reasons:
        by_name = materialize(by_name, "known-names")
        names = names.join(by_name, "name", "left_anti")
    by_name = by_name.select(F.col("name").alias("company_name"), F.col("known").alias("known_name"))
    blocked = match_blocklist(names, terms).select(F.col("name").alias("company_name"), "term")
    out = flagged.join(by_name, "company_name", "left").join(blocked, "company_name", "left")
    paren = lambda text, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(text + " ("), F.col(c), F.lit(")")))
    found = F.array_compact(F.array(F.when(F.col("known"), "already-known firm (domain)"), paren("already-known firm", "known_name"), paren("blocklisted outsourcer", "term"), F.col("year_reason"), F.col("size_reason")))
    near = F.when(F.col("size_reason").isNull() & (count >= 0.9 * ceiling), f"near {ceiling} headcount ceiling")
    country = F.coalesce(F.nullif("hq_country", F.lit("")), F.lit(HQ))
    foreign = F.when(F.lower(F.trim(country)) != HQ.lower(), F.concat(F.lit("foreign-incorporated ("), country, F.lit(f"); {HQ}-delivery assumed")))
    notes = F.array_compact(F.array(F.col("founded_note"), foreign, near))
    # spelt out, so that a filter on it is asked of the firms before names are joined
    passes = F.col("open") & F.col("known_name").isNull() & F.col("term").isNull()
    reason = F.nullif(F.array_join(F.concat(found, notes), "; "), F.lit(""))
    return out.select(*[c for c in companies.columns if c != "hq_country"], country.alias("hq_country"), "size_bucket", passes.alias("gate_pass"), (reason if reasons else F.when(passes, reason)).alias("gate_reason"))


def _core(c: str) -> Column:
    return F.array_join(firm.core_tokens(F.col(c)), " ")


def known_by_core(names: DataFrame, known: DataFrame) -> DataFrame:
    """(name, ordinal of the first known firm with an equal core): an equi-join on the sorted core."""
    a = names.select("name").distinct().withColumn("core", _core("name")).where("core <> ''")
    b = known.select("ordinal", _core("name").alias("core")).where("core <> ''").groupBy("core").agg(F.min("ordinal").alias("ordinal"))
    return a.join(b, "core").select("name", "ordinal")


#: Lengths of the pieces of tokens by which texts meet.
PIECES = (1, 2, 3, 4, 6, 8)
#: Below this threshold a text may have fewer pieces than the edits it allows.
LOWEST = 80.0


def _tokens(c: str | Column) -> Column:
    # a split by one sign compiles no pattern for each row
    return F.sort_array(F.array_except(F.split(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "), " "), F.array(F.lit(""))))


def has_tokens(c: Column) -> Column:
    return F.rlike(c, F.lit(r"(?U)[^\s\x1c-\x1f]"))


def all_tokens(a: Column, b: Column) -> Column:
    """Whether one of two texts with tokens has all of the other's."""
    least = F.least(F.size(_tokens(a)), F.size(_tokens(b)))
    return (least > 0) & (F.size(F.array_intersect(_tokens(a), _tokens(b))) == least)


def token_sets(df: DataFrame, c: str, side: str) -> DataFrame:
    """df without texts that have no tokens, with j (tokens, sorted and joined), k (their number) and b (64 bits of their set), each with side at its end."""
    cut = settled(df.withColumn("ts", _tokens(c))).where(F.size("ts") > 0)
    bits = F.aggregate("ts", F.lit(0).cast("long"), lambda b, t: b.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))))
    return cut.withColumns({f"j{side}": F.array_join("ts", " "), f"k{side}": F.size("ts"), f"b{side}": bits}).drop("ts")


def one_holds_other() -> Column:
    """Whether of the token sets x and y one has all tokens of the other: as many are the same, of others bits are asked first."""
    both = F.col("bx").bitwiseAND(F.col("by"))
    shared = F.size(F.array_intersect(F.split("jx", " "), F.split("jy", " ")))
    return (F.col("jx") == F.col("jy")) | ((F.col("kx") != F.col("ky")) & ((both == F.col("bx")) | (both == F.col("by"))) & (shared == F.least("kx", "ky")))


def large_blocks(a: DataFrame, b: DataFrame, within: str) -> DataFrame:
    """The blocks that have more than DIRECT pairs of rows, written."""
    sizes = lambda df, n: df.groupBy(within).agg(F.count("*").alias(n))
    return materialize(sizes(a, "na").join(sizes(b, "nb"), within).where(F.col("na") * F.col("nb") > DIRECT).select(within), "fuzzy-large")


def _joined_length(tokens: Column) -> Column:
    return F.char_length(F.array_join(tokens, " "))


def _rarest(sets: DataFrame, tokens_there: DataFrame, share: float) -> DataFrame:
    """(block, id, t): of each text the tokens that are rarest on the other side, until the rest alone can't cover the part that must be shared."""
    counts = tokens_there.groupBy("block", "t").agg(F.count("*").alias("f"))
    each = sets.select("block", "id", "n", F.explode("ts").alias("t")).join(counts, ["block", "t"], "left").withColumn("f", F.coalesce("f", F.lit(0)))
    before = Window.partitionBy("block", "id").orderBy("f", "t").rowsBetween(Window.unboundedPreceding, -1)
    lost = F.coalesce(F.sum(F.char_length("t") + 1).over(before), F.lit(0))
    return each.withColumn("lost", lost).where(F.col("lost") <= F.col("n") * (2 * (1 - share) / (2 - share)) + 1e-9).select("block", "id", "t")


#: Texts of a block are compared one by one up to so many pairs; those of a larger block, and texts without blocks, meet on what they share.
DIRECT = 1_000_000
#: Groups of a side of which each is held against each of the other side's, and the most variants of a text's digits.
GROUPS, VARIANTS = 2_000, 500


def candidates(a: DataFrame, b: DataFrame, threshold: float, within: str | None = None) -> DataFrame:
    """Pairs (x, y) of texts whose token-set score may reach the threshold, without a cross join and without meeting on common tokens.

    With ``within``, a column of both sides, only texts of one block meet, and
    the pairs have that column too; a block may hold any part of the texts.

    A score is reached in one of two ways. Either one text's tokens are all
    shared, or the shared ones, joined, are alike to all of one text; they then
    cover a fixed part of its length, so one of its tokens that are rarest on
    the other side, as many as the uncovered part can't hold, is shared. Or the
    shared tokens and the rest are alike to the other's; they then differ by at
    most d insertions and deletions, d following from the threshold and both
    lengths. How such pairs meet: :func:`_by_digits`, and :func:`_by_pieces` for
    what the first leaves; in small blocks they are compared (:func:`_direct`).
    """
    sa, sb = _sides(a, b, within)
    pairs = _pairs(sa, sb, threshold, within is not None).select("block", "x", "y")
    return pairs.withColumnRenamed("block", within) if within else pairs.select("x", "y")


def _sides(a: DataFrame, b: DataFrame, within: str | None) -> tuple[DataFrame, DataFrame]:
    """block, id, ts (tokens), n (their joined length) of each side's texts that have tokens, written, for each is read several times."""
    block = F.col(within) if within else F.lit("")
    sets = lambda df, c: df.select(block.alias("block"), F.col(c).alias("id"), _tokens(c).alias("ts")).where(F.size("ts") > 0).distinct().withColumn("n", _joined_length(F.col("ts")))
    return materialize(sets(a, "x"), "fuzzy-x"), materialize(sets(b, "y"), "fuzzy-y")


def _with_tokens(pairs: DataFrame) -> DataFrame:
    """block, x, y, tx, nx, ty, ny: a pair has its texts, so their tokens follow from it and no table is read for them."""
    cut = settled(pairs.select("block", "x", "y", _tokens("x").alias("tx"), _tokens("y").alias("ty")))
    return cut.select("block", "x", "y", "tx", _joined_length(F.col("tx")).alias("nx"), "ty", _joined_length(F.col("ty")).alias("ny"))


def _pairs(sa: DataFrame, sb: DataFrame, threshold: float, blocks: bool) -> DataFrame:
    """block, x, y, tx, nx, ty, ny of the candidates among two sides."""
    if threshold < LOWEST:
        raise ValueError(f"thresholds below {LOWEST} are not supported")
    share = threshold / 100
    if not blocks:
        return _with_tokens(_sharing(sa, sb, share).union(_by_digits(sa, sb, share)).distinct())
    large = large_blocks(sa, sb, "block")
    if large.isEmpty():
        return _direct(sa, sb, share)
    la, lb = (materialize(df.join(large, "block", "left_semi"), "fuzzy-large") for df in (sa, sb))
    few = _direct(sa.join(large, "block", "left_anti"), sb.join(large, "block", "left_anti"), share)
    many = _with_tokens(_sharing(la, lb, share).union(_by_pieces(la, lb, share)).distinct())
    return few.unionByName(many)


def _bits(hashes: Column) -> list[Column]:
    """A set of hashes as 128 bits, in two halves."""
    of = lambda half: F.aggregate(F.filter(hashes, lambda h: F.pmod(F.shiftright(h, 6), F.lit(2)) == half), F.lit(0).cast("long"), lambda bits, h: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))))
    return [of(0), of(1)]


def _direct(sa: DataFrame, sb: DataFrame, share: float) -> DataFrame:
    """The candidates of blocks whose texts are compared one by one, by bits that are worked out once for each text.

    A text's characters, numbered among their equals, are a set; two texts' sets
    differ by no more than the insertions and deletions between the texts, and
    their images in 128 bits by no more than the sets. Of its tokens, the longest
    until the rest alone can't cover the part that must be shared are another.
    """

    def signed(df: DataFrame, side: str) -> DataFrame:
        ts, n = F.col("ts"), F.col("n")
        chars = F.sort_array(F.split(F.array_join(ts, " "), ""))
        numbered = df.withColumn("chars", chars).withColumn("chars", F.transform("chars", lambda c, k: F.xxhash64(c, k - F.array_position(F.col("chars"), c))))
        longest = F.array_sort(F.transform(ts, lambda t: F.struct((-F.char_length(t)).alias("l"), t.alias("t"))))
        lost = lambda k: F.aggregate(F.slice(F.col("longest"), 1, k), F.lit(0), lambda total, t: total - t["l"] + 1)
        first = F.transform(F.filter(F.col("longest"), lambda t, k: lost(k) <= n * (2 * (1 - share) / (2 - share)) + 1e-9), lambda t: F.xxhash64(t["t"]))
        found = {"c": F.col("chars"), "p": first, "q": F.transform(ts, lambda t: F.xxhash64(t))}
        bits = [half.alias(f"{kind}{k}{side}") for kind, hashes in found.items() for k, half in enumerate(_bits(hashes))]
        return numbered.withColumn("longest", longest).select("block", F.col("id").alias(side), ts.alias(f"t{side}"), n.alias(f"n{side}"), *bits)

    both = lambda one, other: (F.col(f"{one}0{other[0]}").bitwiseAND(F.col(f"{other[1]}0{other[2]}")) != 0) | (F.col(f"{one}1{other[0]}").bitwiseAND(F.col(f"{other[1]}1{other[2]}")) != 0)
    differ = F.bit_count(F.col("c0x").bitwiseXOR(F.col("c0y"))) + F.bit_count(F.col("c1x").bitwiseXOR(F.col("c1y")))
    may = both("p", "xqy") | both("p", "yqx") | (differ <= (1 - share) * (F.col("nx") + F.col("ny")) + 1e-9)
    return signed(sa, "x").hint("merge").join(signed(sb, "y").hint("merge"), "block").where(may).select("block", "x", "y", "tx", "nx", "ty", "ny")


def _sharing(sa: DataFrame, sb: DataFrame, share: float) -> DataFrame:
    """block, x, y of texts whose shared tokens may reach the threshold alone."""
    ta, tb = (df.select("block", "id", F.explode("ts").alias("t")) for df in (sa, sb))
    meet = lambda x, y: x.toDF("block", "x", "t").join(y.toDF("block", "y", "t"), ["block", "t"]).select("block", "x", "y")
    met = meet(_rarest(sa, tb, share), tb).union(meet(ta, _rarest(sb, ta, share))).distinct()
    both = F.array_intersect("tx", "ty")
    covered = _joined_length(both) >= F.least("nx", "ny") * (share / (2 - share)) - 1e-9
    return _with_tokens(met).where((F.size(both) == F.least(F.size("tx"), F.size("ty"))) | covered).select("block", "x", "y")


def _without(text: Column, n: Column) -> Column:
    """The different texts that are left of one without n of its characters."""
    one = lambda t: F.transform(F.sequence(F.lit(1), F.char_length(t)), lambda k: F.concat(F.substr(t, F.lit(1), k - 1), F.substr(t, k + 1)))
    less = F.aggregate(F.sequence(F.lit(1), n), F.array(text), lambda texts, _: F.array_distinct(F.flatten(F.transform(texts, one))))
    return F.when(n > 0, less).otherwise(F.array(text))


def _by_digits(sa: DataFrame, sb: DataFrame, share: float) -> DataFrame:
    """block, x, y of texts that d insertions and deletions or less may part, of one block each side.

    An insertion or deletion is of a digit or of another character, so what parts
    two texts is at least what parts their digits, as they follow one another,
    and what their other characters, in any order, differ by. Texts are grouped
    by those others and the number of digits; groups are few where texts differ
    by numbers. What two groups differ by is taken off d, and what is left of it
    says how many digits may go on either side: texts of two groups meet on what
    remains of their digits without as many, so all that meet are alike so far.

    Texts with several tokens that have digits, whose order sharing may change,
    those of rare groups where there are many, and those with long digits meet
    on pieces (:func:`_by_pieces`).
    """
    joined = F.array_join("ts", " ")
    several = F.size(F.filter("ts", lambda t: t.rlike("[0-9]"))) > 1

    def parted(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
        other = F.array_join(F.sort_array(F.split(F.regexp_replace(joined, "[0-9]", ""), "")), "")
        rows = materialize(df.withColumns({"g": F.regexp_replace(joined, "[^0-9]", ""), "other": other}).withColumn("m", F.char_length("g")), f"fuzzy-digits-{label}")
        groups = rows.where(~several).groupBy("other", "m").agg(F.count("*").alias("texts")).orderBy(F.desc("texts"), "other", "m").limit(GROUPS)
        return rows, materialize(groups.select("other", "m", (F.char_length("other") + F.col("m")).alias("n")), "fuzzy-groups")

    (ra, ga), (rb, gb) = parted(sa, "x"), parted(sb, "y")
    d = F.floor((1 - share) * (F.col("nx") + F.col("ny")) + 1e-9).cast("int")
    met = ga.toDF("ox", "mx", "nx").crossJoin(F.broadcast(gb.toDF("oy", "my", "ny"))).withColumn("d", d).where(F.abs(F.col("nx") - F.col("ny")) <= F.col("d"))
    left = F.col("d") - (F.char_length("ox") + F.char_length("oy") - 2 * common_length("ox", "oy"))
    met = met.withColumn("left", left).where(F.abs(F.col("mx") - F.col("my")) <= F.col("left"))
    gone = lambda one, other: F.floor((F.col("left") + F.col(one) - F.col(other)) / 2).cast("int")
    met = met.withColumns({"gx": F.least(gone("mx", "my"), F.col("mx")), "gy": F.least(gone("my", "mx"), F.col("my"))})
    # as many are taken on both sides that as many remain
    spare = F.greatest(F.col("mx") - F.col("gx"), F.col("my") - F.col("gy"))
    met = met.withColumns({"gx": F.col("mx") - spare, "gy": F.col("my") - spare})
    ways = lambda m, k: F.aggregate(F.sequence(F.lit(1), F.greatest(F.col(k), F.lit(1))), F.lit(1.0), lambda w, i: F.when(F.col(k) > 0, w * (F.col(m) - i + 1) / i).otherwise(w))
    pairs = materialize(met.withColumn("hard", F.greatest(ways("mx", "gx"), ways("my", "gy")) > VARIANTS).withColumn("pair", F.monotonically_increasing_id()), "fuzzy-group-pairs")

    def split(rows: DataFrame, groups: DataFrame, o: str, m: str) -> tuple[DataFrame, DataFrame]:
        easy = groups.join(pairs.where("hard").select(F.col(o).alias("other"), F.col(m).alias("m")).distinct(), ["other", "m"], "left_anti").select("other", "m", F.lit(True).alias("easy"))
        marked = rows.join(F.broadcast(easy), ["other", "m"], "left").withColumn("easy", F.col("easy").isNotNull() & ~several)
        return marked.where("easy"), marked.where("NOT easy").select("block", "id", "ts", "n")

    (ea, ha), (eb, hb) = split(ra, ga, "ox", "mx"), split(rb, gb, "oy", "my")
    keys = lambda rows, o, m, g: rows.join(F.broadcast(pairs.where("NOT hard").select("pair", F.col(o).alias("other"), F.col(m).alias("m"), F.col(g).alias("k"))), ["other", "m"]).select("block", "id", "pair", F.explode(_without(F.col("g"), F.col("k"))).alias("z"))
    alike = keys(ea, "ox", "mx", "gx").withColumnRenamed("id", "x").join(keys(eb, "oy", "my", "gy").withColumnRenamed("id", "y"), ["block", "pair", "z"]).select("block", "x", "y")
    ha, hb = materialize(ha, "fuzzy-hard-x"), materialize(hb, "fuzzy-hard-y")
    if not ha.isEmpty():
        alike = alike.union(_by_pieces(ha, sb, share))
    if not hb.isEmpty():
        alike = alike.union(_by_pieces(ea.select("block", "id", "ts", "n"), hb, share))
    return alike


def _by_pieces(sa: DataFrame, sb: DataFrame, share: float) -> DataFrame:
    """block, x, y of texts that d insertions and deletions or less may part, d following from the length of x.

    Each spoils at most one of the disjoint pieces that x's tokens are cut to, so
    of any d + 1 pieces one is a substring of a token of y; the rarest are taken,
    and of several lengths the one that meets least.
    """
    near = F.abs(F.col("nx") - F.col("ny")) <= (1 - share) * (F.col("nx") + F.col("ny")) + 1e-9
    edits = F.floor(F.col("n") * (2 * (1 - share) / share) + 1e-9).cast("int")
    grams = sb.select("block", "id", "n", F.explode("ts").alias("t")).select("*", F.explode(F.array(*map(F.lit, PIECES))).alias("q")).where(F.char_length("t") >= F.col("q"))
    grams = grams.select("block", "id", "n", F.explode(F.transform(F.sequence(F.lit(1), F.char_length("t") - F.col("q") + 1), lambda k: F.substr("t", k, F.col("q")))).alias("p")).distinct()
    counts = grams.groupBy("block", "p").agg(F.count("*").alias("f"))
    # a token's last piece is cut to the next length of PIECES below
    left = lambda k: F.char_length("t") - k * F.col("q")
    size = lambda k: F.array_max(F.filter(F.array(*map(F.lit, PIECES)), lambda z: (z <= F.col("q")) & (z <= left(k))))
    tokens = sa.select("block", "id", "n", (edits + 1).alias("need"), F.explode("ts").alias("t")).select("*", F.explode(F.array(*map(F.lit, PIECES))).alias("q"))
    pieces = tokens.select("block", "id", "n", "need", "q", F.explode(F.transform(F.sequence(F.lit(0), F.ceil(F.char_length("t") / F.col("q")).cast("int") - 1), lambda k: F.substr("t", k * F.col("q") + 1, size(k)))).alias("p"))
    rated = pieces.join(counts, ["block", "p"], "left").withColumn("f", F.coalesce("f", F.lit(0)))
    chosen = materialize(rated.withColumn("r", F.row_number().over(Window.partitionBy("block", "id", "q").orderBy("f", "p"))).where("r <= need"), "fuzzy-pieces")
    cost = chosen.groupBy("block", "id", "q").agg(F.count("*").alias("k"), F.first("need").alias("need"), F.sum("f").alias("f")).where("k = need").groupBy("block", "id").agg(F.min_by("q", F.struct("f", "q")).alias("q"))
    taken = chosen.join(cost, ["block", "id", "q"]).select("block", F.col("id").alias("x"), F.col("n").alias("nx"), "p").distinct()
    return taken.join(grams.toDF("block", "y", "ny", "p"), ["block", "p"]).where(near).select("block", "x", "y")


def fuzzy_matches(a: DataFrame, b: DataFrame, threshold: float, within: str | None = None) -> DataFrame:
    """(x, y, score) of the pairs that reach the threshold, with ``within`` its column too.

    Shared tokens, joined, begin both joined texts, so their score against
    either follows from lengths, and the two texts have that beginning in common
    and what their rests have. Pairs that lengths rule out go; of the others
    only the rests' common length is counted in Python.
    """
    sa, sb = _sides(a, b, within)
    # what a filter reads is worked out once for each pair before it: rows out of a generator aren't put in again where they are read
    once = lambda df, keep, *cs: df.select(*keep, F.inline(F.array(F.struct(*cs))))
    pairs = once(_pairs(sa, sb, threshold, within is not None), ("block", "x", "y", "tx", "ty", "nx", "ny"), F.array_intersect("tx", "ty").alias("shared"))
    n, ns, nx, ny = F.col("n"), F.col("ns"), F.col("nx"), F.col("ny")
    rest = lambda one, other: F.array_join(F.when(F.size("shared") > 0, F.array_except(one, other)).otherwise(F.col(one)), " ")
    all_of_one = F.size("shared") == F.least(F.size("tx"), F.size("ty"))
    parts = once(pairs, ("block", "x", "y", "nx", "ny"), F.size("shared").alias("n"), _joined_length(F.col("shared")).alias("ns"), ((F.size("shared") > 0) & all_of_one).alias("held"), rest("tx", "ty").alias("rx"), rest("ty", "tx").alias("ry"))
    alone = F.when(F.col("held"), 100.0).when(n > 0, 200.0 * ns / (ns + F.least(nx, ny))).otherwise(0.0)
    parts = parts.select("block", "x", "y", "held", alone.alias("alone"), F.when(n > 0, ns + 1).otherwise(0).alias("begin"), (nx + ny).alias("total"), "rx", "ry")
    both = lambda common: 200.0 * (F.col("begin") + common) / F.col("total")
    parts = parts.where((F.col("alone") >= threshold) | (both(F.least(F.char_length("rx"), F.char_length("ry"))) >= threshold))
    parts = materialize(parts.withColumn("apart", F.levenshtein("rx", "ry")), "fuzzy-pairs")
    # edits that replace no character are no more than insertions and deletions are; as many as the lengths differ by leave all of the shorter rest in common
    all_in_common = F.col("held") | (F.col("apart") == F.abs(F.char_length("rx") - F.char_length("ry")))
    known = parts.where(all_in_common).withColumn("common", F.least(F.char_length("rx"), F.char_length("ry")))
    most = F.floor((F.char_length("rx") + F.char_length("ry") - F.col("apart")) / 2)
    counted = parts.where(~all_in_common & ((F.col("alone") >= threshold) | (both(most) >= threshold)))
    # pairs are small rows and dear ones: as many tasks score them as shuffles have, however few bytes they are; those of blocks are spread already
    counted = counted if within else counted.repartition(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), "x", "y")
    found = known.unionByName(counted.withColumn("common", common_length("rx", "ry"))).where((F.col("alone") >= threshold) | (both(F.col("common")) >= threshold))
    score = F.when(F.col("held"), 100.0).otherwise(F.greatest("alone", both(F.col("common")))).alias("score")
    return found.select(F.col("block").alias(within), "x", "y", score) if within else found.select("x", "y", score)


def match_known(names: DataFrame, known: DataFrame, threshold: float = KNOWN_SCORE) -> DataFrame:
    """(name, known): the first known firm, by its ordinal, whose core equals the name's or is close to it.

    Both ways compete by the known firm's place, so they are unioned before the minimum is taken.
    """
    # both are read for their cores and again for the joins: written once
    n = materialize(settled(settled(names.select("name").distinct()).withColumn("x", _core("name"))).where("x <> ''"), "names")
    k = materialize(known.select(_core("name").alias("y"), F.struct("ordinal", F.col("name").alias("known")).alias("k")).where("y <> ''").groupBy("y").agg(F.min("k").alias("k")), "known")
    long = lambda df, c: df.where(F.char_length(c) >= SHORTEST_CORE).select(c).distinct()
    close = fuzzy_matches(long(n, "x"), long(k, "y"), threshold).select("x", "y")
    # the first of a core's is taken before the names that have the core
    met = close.join(k, "y").select("x", "k").union(k.select("y", "k")).groupBy("x").agg(F.min("k").alias("k"))
    return n.join(met, "x").select("name", "k.known")


#: What a word is made of, and the runs that a text falls into.
WORD = r"[\p{L}\p{N}_]"
_RUNS = rf"{WORD}+|[^\p{{L}}\p{{N}}_]+"
_EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"


def _plain(c: str) -> Column:
    """A text without white space at its ends, lower-cased."""
    return F.lower(F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def holds_phrase(x: Column, y: Column) -> Column:
    """Whether y stands in x with the edge of a word at its beginning and its end, whatever signs y has."""
    return F.rlike(x, F.concat(F.lit(_EDGE + r"\Q"), F.replace(y, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E" + _EDGE)))


def phrases(names: DataFrame, terms: DataFrame) -> DataFrame:
    """Pairs (x, y) of lower-cased names and terms of which the name holds the term as a phrase.

    Where it does, each run of the term's word characters is a whole run of the
    name's, so the two meet on the term's run that is rarest in the names before
    the phrase is tested. A term without word characters lies between two words,
    so it is a whole run itself.
    """
    runs = lambda c: F.explode(F.array_distinct(F.regexp_extract_all(c, F.lit(_RUNS), F.lit(0))))
    there = materialize(names.select("x").distinct().select("x", runs("x").alias("w")), "phrase-words")
    counts = there.groupBy("w").agg(F.count("*").alias("f"))
    asked = terms.select("y").distinct().select("y", runs("y").alias("w")).where(F.col("w").rlike(rf"^{WORD}") | ~F.col("y").rlike(WORD))
    rarest = asked.join(counts, "w", "left").groupBy("y").agg(F.min_by("w", F.struct(F.coalesce("f", F.lit(0)), "w")).alias("w"))
    return there.join(rarest, "w").where(holds_phrase(F.col("x"), F.col("y"))).select("x", "y")


def match_blocklist(names: DataFrame, terms: DataFrame, threshold: float = BLOCK_SCORE) -> DataFrame:
    """(name, term): the first listed term, by ordinal, that a name holds as whole words or is close to.

    The list is a configured one; its size is checked by Spark's broadcast threshold like any table's. Names and
    terms are treated alike: without white space at the ends, lower-cased, their signs kept.
    """
    n = settled(settled(names.select("name").distinct()).withColumn("x", _plain("name"))).where("x <> ''")
    t = terms.select("ordinal", "term", _plain("term").alias("y")).where("y <> ''")
    close = fuzzy_matches(n.select("x").distinct(), t.select("y").distinct(), threshold).select("x", "y")
    met = phrases(n, t).union(close)
    return n.join(met, "x").join(t, "y").groupBy("name").agg(F.min_by("term", "ordinal").alias("term"))
