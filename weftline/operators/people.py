"""People of a firm: order, merging, resolution and scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import contact, provenance
from weftline.functions.fuzzy import Compared, token_set_ratio
from weftline.operators import gates
from weftline.operators.gates import all_tokens, fuzzy_matches, has_tokens, large_blocks, one_holds_other, token_sets
from weftline.operators.graph import components
from weftline.operators.order import numbered_each
from weftline.scratch import materialize

AGREE = 88.0


def ranked(people: DataFrame) -> DataFrame:
    """people with rank within their firm and is_primary, in order of ordinal.

    They are dealt by firm to as many tasks as shuffles have before they are
    sorted: else those who ask for the first ones have them sorted before the
    shuffle too, in the few tasks, and beside the memory, of what made them.
    """
    people = people.repartition(int(people.sparkSession.conf.get("spark.sql.shuffle.partitions")), "domain")
    w = Window.partitionBy("domain").orderBy("ordinal")
    return people.withColumn("rank", F.row_number().over(w)).withColumn("is_primary", F.col("rank") == 1)


def top(people: DataFrame, n: int = 2) -> DataFrame:
    return ranked(people).where(F.col("rank") <= n)


def scored(people: DataFrame) -> DataFrame:
    found = provenance.sources(F.col("notes"), F.col("name_source"))
    return people.withColumn("sources", found).withColumn("confidence", provenance.confidence(F.col("name"), F.col("sources"), F.col("linkedin_url"), F.col("linkedin_confirmed")))


#: Pairs of names that are compared at once.
PAIRS = 500_000
#: Targets of a very large group that a name is compared with at a time.
SOME = 10_000


def _targets(texts: list[str], turn: np.ndarray, starts: np.ndarray, threshold: float) -> np.ndarray:
    """For each place, which of those before it in its group (groups begin at starts) it meets: of the ones that met none themselves the first that is close, if its turn is 1; else itself."""
    n = len(texts)
    compared = Compared(texts, threshold)
    to = np.arange(n)
    begin = np.repeat(starts, np.diff([*starts, n]))
    asked = np.flatnonzero(turn == 1)
    before = np.cumsum([0, *(asked - begin[asked])])
    at = 0
    while at < len(asked):
        end = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, "right")) - 1)
        rows = asked[at:end]
        if end == at + 1 and len(rows) and rows[0] - begin[rows[0]] > PAIRS:
            # of a very large group only the targets, some at a time
            there = np.flatnonzero(to[begin[rows[0]] : rows[0]] == np.arange(begin[rows[0]], rows[0])) + begin[rows[0]]
            for part in np.split(there, range(SOME, len(there), SOME)):
                hit = part[compared.close(np.full(len(part), rows[0]), part)]
                if len(hit):
                    to[rows[0]] = hit[0]
                    break
        else:
            many = rows - begin[rows]
            i = np.repeat(rows, many)
            j = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + begin[i]
            near = compared.close(i, j)
            for x, y in zip(i[near].tolist(), j[near].tolist()):
                if to[x] == x and to[y] == y:
                    to[x] = y
        at = end
    return to


def _meeting(threshold: float):
    """Names that are sorted by domain, group, turn and rank: those of turn 1 with the rank of the name that each meets, as hit if that is of turn 0, else as added. What is held is one group beside a batch."""

    def met(rows: pa.Table, changed: np.ndarray) -> pa.Table:
        turn, rank = (rows[c].to_numpy() for c in ("turn", "rank"))
        to = _targets([t or "" for t in rows["low"].to_pylist()], turn, np.flatnonzero(changed), threshold)
        own, place = turn[to] == 0, rank[to]
        rows = rows.append_column("hit", pa.array(place, pa.int64(), mask=~own)).append_column("added", pa.array(place, pa.int64(), mask=own))
        return rows.filter(pa.array(turn == 1)).drop_columns(["turn", "low", "group"])

    def changes(rows: pa.Table) -> np.ndarray:
        """Which rows begin a group."""
        out = np.ones(len(rows), dtype=bool)
        out[1:] = False
        for c in ("domain", "group"):
            one = rows[c].combine_chunks()
            differ = pc.fill_null(pc.not_equal(one[1:], one[:-1]), False).to_numpy(zero_copy_only=False)
            out[1:] |= differ | (one.is_null()[1:].to_numpy(zero_copy_only=False) != one.is_null()[:-1].to_numpy(zero_copy_only=False))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # nothing ends before the key of the last batch does
            if held and batch.num_rows and [batch[c][batch.num_rows - 1] for c in ("domain", "group")] == [held[0][c][0] for c in ("domain", "group")]:
                held.append(batch)
                continue
            rows = pa.Table.from_batches([*held, batch])
            changed = changes(rows)
            last = int(np.flatnonzero(changed)[-1]) if len(rows) else 0
            if last:
                yield from met(rows.slice(0, last), changed[:last]).combine_chunks().to_batches()
            held = rows.slice(last).combine_chunks().to_batches()
        if held:
            rows = pa.Table.from_batches(held)
            yield from met(rows, changes(rows)).combine_chunks().to_batches()

    return run


def _components_of(rows: DataFrame, threshold: float) -> DataFrame:
    """The names of firms with very many, with group: those that are close, to each other's neighbours and so on, are of one. Close names are found without comparing all (``fuzzy_matches``); a name without tokens is close to nothing, itself included."""
    vertices = materialize(rows.where(F.trim("low") != "").select("domain", "low").distinct().withColumn("vertex", F.monotonically_increasing_id()), "founder-vertices")
    asked = rows.where("turn = 1").select("domain", F.col("low").alias("x")).distinct()
    # blocks that have no null
    named = lambda df: df.withColumn("domain", F.coalesce(F.concat(F.lit("="), "domain"), F.lit("")))
    close = fuzzy_matches(named(asked), named(vertices.select("domain", F.col("low").alias("y"))), threshold, "domain")
    end = lambda c, v: named(vertices).select("domain", F.col("low").alias(c), F.col("vertex").alias(v))
    edges = close.join(end("x", "a"), ["domain", "x"]).join(end("y", "b"), ["domain", "y"]).select("a", "b")
    group = vertices.join(components(edges).withColumnRenamed("id", "vertex"), "vertex", "left").select(F.col("domain").alias("g_domain"), F.col("low").alias("g_low"), F.coalesce("component", "vertex").alias("component"))
    placed = rows.join(group, F.col("domain").eqNullSafe(F.col("g_domain")) & (F.col("low") == F.col("g_low")), "left")
    # without tokens each is a group of its own
    return placed.withColumn("group", F.coalesce(F.col("component").cast("string"), F.concat_ws("|", F.lit("alone"), "turn", "rank"))).drop("g_domain", "g_low", "component")


def merge_founders(primary: DataFrame, other: DataFrame, threshold: float = AGREE) -> DataFrame:
    """Fold other's names into primary's, firm by firm and in order: the first name close enough gains the source, and a role and a uid where it has none; else the row is added.

    Both have domain, ordinal, name, role, source and may have uid; primary may
    have sources, as the result has, in place of source. Rows of other with one
    name all meet the same target, so aggregates first make them one: its first
    place, its sources by their first places, its first role and uid, and its
    last role, null or empty, for where there is no other. Of primary, each
    name's first row alone can gain.

    Which name a row meets depends on the names before it. A firm's different
    names are dealt to one task and compared, many firms at once; of a firm that
    has more than gates.DIRECT pairs, names that are close to each other and to
    each other's neighbours are such groups (``_components_of``), so however
    many it has, they are spread over tasks. Only which name meets which is
    found there; what a target gains is aggregated.
    """
    order = [F.col("ordinal").isNull(), F.col("ordinal"), F.col("name"), F.col("role"), F.col("source")]
    uid = lambda df: F.col("uid") if "uid" in df.columns else F.lit(None).cast("string")
    known = F.col("sources") if "sources" in primary.columns else F.array("source")
    one = F.col("source") if "source" in primary.columns else F.get("sources", F.lit(0))
    rows = lambda df, *more: numbered_each(df.select("domain", "ordinal", "name", "role", uid(df).alias("uid"), *more), "domain", order, "rank")
    first, later = materialize(rows(primary, one.alias("source"), known.alias("sources")).drop("ordinal", "source"), "founders"), rows(other, "source")
    alone = F.when(F.trim(F.coalesce("name", F.lit(""))) == "", F.col("rank"))
    filled = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    at = F.struct("rank", "role")
    by_source = later.withColumn("alone", alone).groupBy("domain", "name", "alone", "source").agg(
        F.min("rank").alias("rank"), F.min(F.when(filled("role"), at)).alias("role"), F.max(at).alias("last"), F.min(F.when(filled("uid"), F.struct("rank", "uid"))).alias("uid"),
    )
    seen = F.array_sort(F.collect_list(F.struct("rank", "source")))
    by_name = by_source.groupBy("domain", "name", "alone").agg(F.min("rank").alias("rank"), F.min("role").alias("role"), F.max("last").alias("last"), F.min("uid").alias("uid"), seen.alias("seen"))
    names = by_name.select("domain", F.lit(1).alias("turn"), "rank", "name", "role", "last", "uid", "seen")
    own = first.groupBy("domain", "name").agg(F.min("rank").alias("rank")).select("domain", F.lit(0).alias("turn"), "rank", "name", *[F.lit(None).cast(names.schema[c].dataType).alias(c) for c in names.columns[4:]])
    every = materialize(own.union(names).withColumn("low", F.lower(F.coalesce("name", F.lit("")))), "founder-names")
    size = every.groupBy(F.col("domain").alias("of")).agg(F.sum("turn").alias("asked"), F.count("*").alias("n"))
    large = materialize(size.where(F.col("asked") * F.col("n") > gates.DIRECT).select("of"), "founder-large")
    of = F.col("domain").eqNullSafe(F.col("of"))
    whole = lambda df: df.withColumn("group", F.lit(""))
    grouped = whole(every) if large.isEmpty() else whole(every.join(large, of, "left_anti")).unionByName(_components_of(materialize(every.join(large, of, "left_semi"), "founder-names"), threshold))
    dealt = grouped.withColumn("h", F.xxhash64("domain", "group")).repartition("h").sortWithinPartitions("h", "domain", "group", "turn", "rank").drop("h")
    kinds = T.StructType([f for f in dealt.schema if f.name not in ("turn", "low", "group")]).add("hit", "long").add("added", "long")
    met = dealt.mapInArrow(_meeting(threshold), kinds)
    sources = F.array_distinct(F.transform(F.array_sort(F.flatten(F.collect_list("seen"))), lambda s: s["source"]))
    folded = met.repartition("domain").groupBy("domain", "hit", "added").agg(
        F.max(F.when(F.col("rank") == F.col("added"), F.col("name"))).alias("f_name"), F.coalesce(F.min("role"), F.max("last"))["role"].alias("f_role"), F.min("uid")["uid"].alias("f_uid"), sources.alias("f_sources"),
    ).withColumnRenamed("domain", "f_domain")
    folded = materialize(folded, "founders-folded")
    own_rows = first.join(folded.where("hit IS NOT NULL"), F.col("domain").eqNullSafe(F.col("f_domain")) & (F.col("rank") == F.col("hit")), "left")
    gained = own_rows.select(
        "domain", (F.col("rank") - 1).alias("ordinal"), "name", F.when(filled("role") | F.col("hit").isNull(), F.col("role")).otherwise(F.col("f_role")).alias("role"),
        F.array_distinct(F.concat("sources", F.coalesce("f_sources", F.array().cast("array<string>")))).alias("sources"), F.when(filled("uid") | F.col("hit").isNull(), F.col("uid")).otherwise(F.col("f_uid")).alias("uid"),
    )
    counts = first.groupBy(F.col("domain").alias("c_domain")).agg(F.count("*").alias("n"))
    new = numbered_each(folded.where("hit IS NULL"), "f_domain", [F.col("added")], "place").join(counts, F.col("f_domain").eqNullSafe(F.col("c_domain")), "left")
    added = new.select(F.col("f_domain").alias("domain"), (F.coalesce("n", F.lit(0)) + F.col("place") - 1).alias("ordinal"), F.col("f_name").alias("name"), F.col("f_role").alias("role"), F.col("f_sources").alias("sources"), F.col("f_uid").alias("uid"))
    return gained.union(added)


def best_candidate(people: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """(domain, name, url): for each person the candidate of the same firm with the best name score, the first on ties.

    Names meet within their firm on what the threshold forces them to share, so a firm's people aren't compared with all its candidates.
    """
    asked = people.select("domain", "name", F.lower("name").alias("x")).where("x IS NOT NULL").distinct()
    # of candidates with one name the first is the one that any person takes
    offered = found.select("domain", F.lower("candidate").alias("y"), "url", "ordinal").groupBy("domain", "y").agg(F.min(F.struct("ordinal", "url")).alias("first"))
    rated = fuzzy_matches(asked, offered, threshold, "domain").join(offered, ["domain", "y"]).join(asked, ["domain", "x"])
    return rated.groupBy("domain", "name").agg(F.max_by("first.url", F.struct("score", -F.col("first.ordinal"))).alias("url"))


def _full_profiles(asked: DataFrame, listed: DataFrame) -> DataFrame:
    """(domain, name, best): the first profile whose name and one of whose companies score 100, null for those that have none.

    Two texts score 100 when one has all of the other's tokens, so nothing is counted. Both sides are dealt and sorted
    by firm once, for all that follows; a hash in front of its name makes sorting compare numbers.
    """
    h = F.xxhash64("domain").alias("h")
    a = token_sets(asked, "x", "x").select(h, "domain", "name", "firm", "jx", "kx", "bx")
    b = token_sets(listed, "y", "y").select(h.alias("g"), F.col("domain").alias("of"), "uid", "ordinal", "companies", "jy", "ky", "by")
    met = a.hint("merge").join(b.hint("merge"), (F.col("h") == F.col("g")) & (F.col("domain") == F.col("of")) & one_holds_other(), "left")
    company = F.exists("companies", lambda c: ((c == F.col("firm")) & has_tokens(c)) | all_tokens(F.col("firm"), c))
    best = F.when(company, F.struct(F.col("ordinal").isNull().alias("last"), "ordinal", "uid")).alias("best")
    # worked out before rows are sorted for the minimum, and dealt as they are
    rated = met.select("h", "domain", "name", F.inline(F.array(F.struct(best))))
    return rated.groupBy("h", "domain", "name").agg(F.min("best").alias("best")).drop("h")


def best_profile(people: DataFrame, profiles: DataFrame) -> DataFrame:
    """(domain, name, uid): name score of 85 or more, weighed two to one with the best company score, 70 or more in all.

    profiles has domain, uid, full_name, companies (array) and ordinal. Nothing is above a total of 100, so who has
    profiles with it takes the first of them (``_full_profiles``) and meets no others. The rest, and people of very
    large firms, meet profiles of their firm as candidates do; a company's score is taken once for each different pair
    of names that is asked for.
    """
    asked = people.select("domain", "name", F.lower("name").alias("x"), F.lower("company_name").alias("firm")).where("x IS NOT NULL AND domain IS NOT NULL")
    listed = profiles.select("domain", F.lower("full_name").alias("y"), "uid", "ordinal", F.transform("companies", lambda c: F.lower(c)).alias("companies"))
    large = large_blocks(people, profiles, "domain")
    few = large.isEmpty()
    full = materialize(_full_profiles(asked if few else asked.join(large, "domain", "left_anti"), listed), "profiles-full")
    found = full.where("best IS NOT NULL").select("domain", "name", "best.uid")
    rest = full.where("best IS NULL").select("domain", "name")
    if few and rest.isEmpty():
        return found
    left = asked.join(rest, ["domain", "name"], "left_semi")
    left = left if few else left.union(asked.join(large, "domain", "left_semi"))
    return found.union(_best_scored(materialize(left.distinct(), "profiles-asked"), listed))


def _best_scored(asked: DataFrame, listed: DataFrame) -> DataFrame:
    named = materialize(fuzzy_matches(asked, listed, 85.0, "domain").join(asked, ["domain", "x"]).join(listed, ["domain", "y"]), "profile-pairs")
    each = named.select("firm", F.explode("companies").alias("company")).distinct().where("firm IS NOT NULL AND company IS NOT NULL").withColumn("c", token_set_ratio("firm", "company"))
    rows = named.withColumn("company", F.explode_outer("companies")).join(each, ["firm", "company"], "left")
    scores = rows.groupBy("domain", "name", "firm", "uid", "ordinal", F.col("score").alias("n")).agg(F.max("c").alias("c"))
    total = F.floor((2 * F.col("n") + F.coalesce("c", F.lit(0.0))) / 3)
    return scores.withColumn("total", total).where("total >= 70").groupBy("domain", "name").agg(F.max_by("uid", F.struct("total", -F.col("ordinal"))).alias("uid"))


def override_aggregator(people: DataFrame, threshold: float = AGREE) -> DataFrame:
    """people with overridden, name, notes and confidence: a name that only directories give and that no registry name of the firm is close to becomes the sentinel, with a note of what it was.

    Where a name comes from is read as for the score: the note's sources, else
    the name's own. A firm without a registry name overrides nothing. The row is
    changed in place, so no copy under the old name stays behind.
    """
    found = provenance.sources(F.col("notes"), F.col("name_source"))
    from_registry, only_directory = F.array_contains(found, "registry"), (F.size(found) > 0) & (F.size(F.array_except(found, F.array(*map(F.lit, provenance.AGGREGATOR)))) == 0)
    official = people.where(from_registry & contact.real_name(F.col("name"))).select("domain", F.lower("name").alias("y")).distinct()
    doubtful = people.where(only_directory).join(official.select("domain").distinct(), "domain", "left_semi").select("domain", "ordinal", F.lower(F.coalesce("name", F.lit(""))).alias("x"))
    agreed = fuzzy_matches(doubtful.select("domain", "x").distinct(), official, threshold, "domain").select("domain", "x").distinct()
    lost = doubtful.join(agreed, ["domain", "x"], "left_anti").select("domain", "ordinal", F.lit(True).alias("overridden")).distinct()
    joined = people.drop("overridden").join(lost, ["domain", "ordinal"], "left").withColumn("overridden", F.coalesce("overridden", F.lit(False)))
    note = F.concat(F.lit("registry-vs-aggregator override: dropped aggregator name '"), F.coalesce("name", F.lit("")), F.lit("'"))
    changed = lambda new, old: F.when(F.col("overridden"), new).otherwise(old)
    scored = provenance.confidence(F.col("name"), found, F.col("linkedin_url"), F.col("linkedin_confirmed"))
    return joined.withColumns(
        {"confidence": changed(F.lit("red"), F.col("confidence") if "confidence" in people.columns else scored), "notes": changed(F.concat_ws("; ", F.nullif("notes", F.lit("")), note), F.col("notes")), "name": changed(F.lit(contact.SENTINEL), F.col("name"))},
    )
