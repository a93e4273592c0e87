"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for each document. The ledger keeps the
measurements and one bit for each failed rule; a policy is a versioned mask of
rules, so applying another policy, or asking what each rule alone rejects,
reads the ledger and never the texts again. A stored ledger names the rule book
that its bits mean, and a policy for another book refuses it.

All of it is DataFrame functions; nothing leaves the JVM.

Defined cases: a null text has no words (all measurements 0) and fails
``few_words``; an empty table gives an empty ledger; repeated rows get a row
each; a very long text is measured whole, its words in one task's memory;
columns besides doc_id and text are ignored by the ledger and kept by
:func:`filter_docs` whatever their names.

Windows of eight words are compared by a 64-bit hash within one document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import let, words
from weftline.scratch import materialize

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
#: A line that starts as an item of a list, and one that breaks off.
BULLET = r"^[\x20\x09]*[-*\u2022]"
ELLIPSIS = r"(\.\.\.|\u2026)[\x20\x09\x0D]*$"

#: The version of RULES, stored with each ledger. A rule whose test changes needs another version.
RULE_BOOK = "rules-2"
#: Rules in bit order: name and when it fails, over the measurements. Only ever append: bits are stored.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("upper_case", "10 * n_upper > 3 * word_chars"),
    ("exclamation", "2 * n_exclaim > n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 30 * n_words"),
    ("stutter", "10 * n_stutter > 3 * n_words"),
    ("bullets", "10 * n_bullets > 9 * n_lines"),
    ("ellipses", "10 * n_ellipses > 3 * n_lines"),
    ("letters", "10 * n_lettered < 8 * n_words"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}
#: Measurements and where measure() has them.
MEASURES = {
    "n_words": "w.n_words", "word_chars": "w.word_chars", "n_symbols": "n_symbols", "n_lines": "l.n", "n_dup_lines": "l.dup", "n_repeat_words": "w.n_repeat_words", "n_upper": "n_upper",
    "n_exclaim": "n_exclaim", "n_stutter": "w.n_stutter", "n_bullets": "l.bullets", "n_ellipses": "l.ellipses", "n_lettered": "n_lettered",
}


@dataclass(frozen=True)
class Policy:
    """A version, the rules that reject under it, and the rule book they are of."""

    version: str
    rules: tuple[str, ...]
    book: str = RULE_BOOK

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
STANDARD = Policy("standard-1", ("few_words", "repeated_windows", "symbols", "duplicate_lines", "upper_case", "exclamation", "word_length", "stutter"))
STRICT = Policy("strict-1", tuple(BIT))


def _repeat_words(w: Column) -> Column:
    """Words that lie in windows found twice or more: a sorted list of such windows' starts, each counting the words up to the next."""

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def starts(s: Column) -> Column:
        again = F.filter(s, lambda e, k: _same(s, e, k))
        return F.sort_array(F.transform(again, lambda e: e["i"]))

    def among(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, lambda s: let(starts(s), covered)))

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(let(hashes, among))


def _same(s: Column, e: Column, k: Column) -> Column:
    after, before = F.get(s, k + 1)["h"], F.get(s, k - 1)["h"]
    return F.coalesce(after == e["h"], F.lit(False)) | F.coalesce(before == e["h"], F.lit(False))


def measure(text: Column) -> Column:
    """A struct of the measurements of a text, all long."""
    text = F.coalesce(text, F.lit(""))

    def of(w: Column) -> Column:
        stutter = F.size(F.filter(w, lambda x, k: F.coalesce(x == F.get(w, k - 1), F.lit(False))))
        chars = F.aggregate(w, F.lit(0), lambda a, x: a + F.char_length(x))
        return F.struct(F.size(w).alias("n_words"), chars.alias("word_chars"), _repeat_words(w).alias("n_repeat_words"), stutter.alias("n_stutter"))

    def of_lines(ls: Column) -> Column:
        like = lambda pattern: F.size(F.filter(ls, lambda x: x.rlike(pattern)))
        return F.struct(F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup"), like(BULLET).alias("bullets"), like(ELLIPSIS).alias("ellipses"))

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        let(words(text), of).alias("w"),
        let(lines, of_lines).alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("n_upper"),
        F.regexp_count(text, F.lit("[!?]")).alias("n_exclaim"),
        # from a word's first letter to its end: one match for each word with a letter
        F.regexp_count(text, F.lit(r"\p{L}[^\x20\x09-\x0D]*")).alias("n_lettered"),
    )


def _measured() -> list[Column]:
    return [F.col(f"m.{path}").cast("long").alias(name) for name, path in MEASURES.items()]


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, failed (the bits of the rules that a document fails) and the rule book's version."""
    m = docs.select("doc_id", measure(F.col("text")).alias("m")).select("doc_id", *_measured())
    return m.select("*", failed_bits().alias("failed"), F.lit(RULE_BOOK).alias("rule_book"))


def store(docs: DataFrame) -> DataFrame:
    """The ledger, written to the shared folder and read back: policies and ablations then read a few numbers a document and no text."""
    return materialize(ledger(docs), "quality-ledger")


def failed_bits() -> Column:
    bits = F.lit(0).cast("long")
    for name, test in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(test), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def _failed(policy: Policy) -> Column:
    """The policy's bits among those failed; an error for a ledger of another rule book."""
    wrong = F.raise_error(F.concat(F.lit(f"policy {policy.version} is for {policy.book}, not for a ledger of "), F.coalesce("rule_book", F.lit("null")))).cast("long")
    return F.when(F.col("rule_book").eqNullSafe(F.lit(policy.book)), F.col("failed").bitwiseAND(F.lit(policy.mask))).otherwise(wrong)


def apply_policy(book: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with policy and kept: true where no rule of the policy failed."""
    return book.withColumn("policy", F.lit(policy.version)).withColumn("kept", _failed(policy) == 0)


def ablations(book: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: how many documents fail it, how many only it rejects, how many are kept without it.

    Documents are first counted by their failed bits, at most 2 to the power of
    the rules whatever the corpus; the rest is arithmetic on those.
    """
    combos = book.groupBy(_failed(policy).alias("bits")).agg(F.count("*").alias("docs"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules])).alias("r")
    each = combos.select("bits", "docs", rules).select("bits", "docs", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    total = lambda cond: F.sum(F.when(cond, F.col("docs")).otherwise(0)).cast("long")
    return each.groupBy(F.lit(policy.version).alias("policy"), "rule").agg(
        total(hit).alias("n_failed"), total(alone).alias("n_only"), total(alone | (F.col("bits") == 0)).alias("n_kept_without"),
    )


def store_with_rows(docs: DataFrame) -> DataFrame:
    """The ledger of docs beside row, a struct of docs' own columns, written and read back: policies are applied without a rule being evaluated again."""
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    m = packed.select("row", measure(F.col("row.text")).alias("m")).select("row", *_measured())
    return materialize(m.select("*", failed_bits().alias("failed"), F.lit(RULE_BOOK).alias("rule_book")), "quality-rows")


def filter_docs(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The rows of docs that the policy keeps, with docs' own columns: the ledger is written once, and the policy reads its bits."""
    return apply_policy(store_with_rows(docs), policy).where("kept").select("row.*")
