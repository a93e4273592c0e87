"""Registered domains by the public suffix list.

The list is data, not code: a text in the list's own format, by default the one
that Spark's distribution ships with its HTTP client. Of its first section each
rule becomes a row: a suffix, how many labels it has, and whether it is exact,
the base of a wildcard or an exception. A host is matched against the rules of
one label, of two, and so on, by as many equi-joins as the longest rule has
labels; the rule that prevails is an exception, else the longest. No row is
multiplied or shuffled: the rules' table is broadcast, and its size is checked.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.firm import host

#: Where the list lies in a jar of Spark's distribution, and the jars that have it.
RESOURCE, JARS = "mozilla/public-suffix-list.txt", ("httpclient-4*.jar", "hadoop-client-runtime-*.jar")
#: The section with the suffixes of registries.
BEGIN, END = "===BEGIN ICANN DOMAINS===", "===END ICANN DOMAINS==="
#: More rules than this are no suffix list, and are not broadcast.
MOST_RULES = 50_000
EXACT, WILDCARD, EXCEPTION = 1, 2, 4
#: A label that a firm can have registered.
LABEL = r"^[\p{L}\p{N}_-]+$"


def list_text(path: str | None = None) -> str:
    """The suffix list as text: of a file, else of Spark's distribution."""
    if path:
        with open(path, encoding="utf-8") as f:
            return f.read()
    from pyspark.find_spark_home import _find_spark_home

    for pattern in JARS:
        for jar in sorted(glob.glob(os.path.join(_find_spark_home(), "jars", pattern))):
            with zipfile.ZipFile(jar) as z:
                if RESOURCE in z.namelist():
                    return z.read(RESOURCE).decode("utf-8")
    raise FileNotFoundError(f"no jar of Spark's distribution holds {RESOURCE}; give the path of a public suffix list")


def parse(text: str) -> dict[str, int]:
    """suffix -> its kinds as bits, of the registries' section (of all lines where no section is marked); names beyond ASCII in both their forms."""
    lines = text.partition(BEGIN)[2].partition(END)[0] if BEGIN in text else text
    kinds: dict[str, int] = {}
    for line in lines.splitlines():
        rule = line.split()[0].lower() if line.split() else ""
        if not rule or rule.startswith("//") or rule.startswith("="):
            continue
        kind = EXCEPTION if rule[0] == "!" else WILDCARD if rule.startswith("*.") else EXACT
        suffix = rule[1:] if kind == EXCEPTION else rule[2:] if kind == WILDCARD else rule
        for form in {suffix, *_ascii(suffix)}:
            kinds[form] = kinds.get(form, 0) | kind
    return kinds


def _ascii(suffix: str) -> set[str]:
    """The form of a suffix that resolvers use."""
    try:
        return {suffix.encode("idna").decode()}
    except UnicodeError:
        return set()


@functools.cache
def _table(path: str | None):
    import pyarrow as pa

    kinds = parse(list_text(path))
    if len(kinds) > MOST_RULES:
        raise ValueError(f"{len(kinds)} rules: more than {MOST_RULES} are not taken for a suffix list")
    return pa.table({"suffix": list(kinds), "labels": [s.count(".") + 1 for s in kinds], "kinds": pa.array(kinds.values(), pa.int32())})


def rules(spark: SparkSession, path: str | None = None) -> DataFrame:
    """suffix, labels, kinds of each rule."""
    return spark.createDataFrame(_table(path))


def registered(df: DataFrame, website: Column, name: str = "domain", path: str | None = None) -> DataFrame:
    """df with the registered domain of an address: its public suffix and one label more, lower-cased.

    Null where no rule matches, where the suffix is all there is (``co.in``,
    ``com.vn``), for an IP address, a null or empty text, and where the label
    isn't one that can be registered.
    """
    table = _table(path)
    most = max(table["labels"].to_pylist(), default=0)
    at = lambda k: f"{name}__tail{k}"
    labels = F.col(f"{name}__labels")
    out = df.withColumn(f"{name}__labels", F.split(F.translate(host(website), "。．｡", "..."), r"\."))
    known = rules(df.sparkSession, path)
    for k in range(1, most + 1):
        out = out.withColumn(at(k), F.when(F.size(labels) >= k, F.array_join(F.slice(labels, -k, k), ".")))
        out = out.join(F.broadcast(known.where(F.col("labels") == k).select(F.col("suffix").alias(at(k)), F.col("kinds").alias(f"{at(k)}_is"))), at(k), "left")
    has = lambda k, kind: F.coalesce(F.col(f"{at(k)}_is"), F.lit(0)).bitwiseAND(F.lit(kind)) != 0
    kept_back = F.coalesce(*[F.when(has(k, EXCEPTION), k - 1) for k in range(1, most + 1)], F.lit(None).cast("int"))
    found = [F.when(has(k, EXACT), k) for k in range(1, most + 1)] + [F.when(has(k, WILDCARD) & (F.size(labels) > k), k + 1) for k in range(1, most + 1)]
    n = F.coalesce(kept_back, F.greatest(*found, F.lit(None).cast("int"))) if found else F.lit(None).cast("int")
    whole = F.when((F.size(labels) > n) & F.get(labels, F.size(labels) - n - 1).rlike(LABEL), F.array_join(F.slice(labels, -(n + 1), n + 1), "."))
    return out.withColumn(name, whole).select(*[c for c in df.columns if c != name], name)
