import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from weftline.llm import line_dedup

from .conftest import corpus, make


def cut(lines):
    """(start, end) of each chunk of two or more lines, of both sets."""
    h = [int(hashlib.md5(x.encode()).hexdigest()[:6], 16) for x in lines]
    r = [((h[k - 1] if k else 0) * 8191 + h[k]) % 1000003 for k in range(len(h))]
    out = set()
    for sign in (1, -1):
        start = 0
        for k in range(len(r)):
            edge = k == len(r) - 1 or (k > 0 and sign * r[k] < sign * r[k - 1] and sign * r[k] <= sign * r[k + 1])
            if edge or k - start == 3:
                if k > start:
                    out.add((start, k))
                start = k + 1
    return sorted(out)


def brute(docs):
    """(doc_id, text) -> lines, removed, text, with rows of equal id and text as one; texts of one id in the order of their hashes."""
    found = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", line_dedup._doc_hash(docs["text"]).alias("h")).collect() if r.text is not None}
    pairs = sorted(found, key=lambda p: ((p[0] is not None, p[0] or 0), found[p]))
    first, result = {}, {}
    for i, t in pairs:
        lines, gone = t.split("\n"), set()
        for a, b in cut(lines):
            other, at = first.setdefault(tuple(lines[a : b + 1]), ((i, t), a))
            if (other, at) == ((i, t), a):
                continue
            gone |= set(range(a, b + 1))
            theirs, step = other[1].split("\n"), at - a
            for ks in (range(a - 1, -1, -1), range(b + 1, len(lines))):
                for k in ks:
                    if not 0 <= k + step < len(theirs) or theirs[k + step] != lines[k]:
                        break
                    gone.add(k)
        result[i, t] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return result


def rows_of(docs):
    out = line_dedup.cut(docs.withColumn("w", docs["text"]))
    return [((r.doc_id, r.w), (r.ld_lines, r.ld_removed, r.text)) for r in out.select("row.doc_id", "row.w", "ld_lines", "ld_removed", "row.text").collect()]


def test_against_brute_force(docs):
    want, got = brute(docs), rows_of(docs)
    assert len(got) == len(corpus())
    for key, found in got:
        assert found == (want[key] if key[1] is not None else (0, 0, None)), key[0]
    assert sum(w[1] for w in want.values()) > 0


def test_narrow_windows_are_widened(docs, monkeypatch):
    """Lines beside a run go as far as they are equal, however far the first window reaches."""
    want = brute(docs)
    monkeypatch.setattr(line_dedup, "NEAR", 1)
    monkeypatch.setattr(line_dedup, "WIDER", 2)
    assert all(found == want[key] for key, found in rows_of(docs) if key[1] is not None)


def test_lines_beside_a_chunk_go_as_far_as_they_are_equal(spark, monkeypatch):
    """Only one chunk of a long passage is taken up, and the whole passage goes."""
    rng = random.Random(4)
    line = lambda: " ".join(f"{rng.randrange(10**6):06d}" for _ in range(5))
    passage = [line() for _ in range(400)]
    texts = [[line() for _ in range(20)] + passage + [line() for _ in range(20)] for _ in range(3)]
    docs = make(spark, [(k, "\n".join(t), None, None) for k, t in enumerate(texts)])
    whole = line_dedup.runs

    def short(d):
        return whole(d).withColumn("b", F.least("b", F.col("a") + 2))

    monkeypatch.setattr(line_dedup, "runs", short)
    assert {r.doc_id: r.ld_removed for r in line_dedup.cut(docs).select("row.doc_id", "ld_removed").collect()} == {0: 0, 1: 400, 2: 400}


def test_passage_goes_everywhere_but_first(docs):
    out = {r.doc_id: r.ld_removed for r in line_dedup.cut(docs).select("row.doc_id", "ld_removed").where("doc_id >= 100").collect()}
    assert out[100] == 0 and all(36 <= out[100 + k] <= 40 for k in range(1, 6))


def test_columns_nulls_and_empty(docs, empty, spark):
    out = line_dedup.dedup(docs)
    assert out.schema == docs.schema
    assert out.where("doc_id = 62").first().text is None and out.where("doc_id = 63").first().text == ""
    assert line_dedup.dedup(empty).count() == 0
    same = make(spark, [(1, "a b\nc d\ne f\ng h", None, None)] * 3 + [(2, "a b\nc d\ne f\ng h", None, None)])
    rows = line_dedup.cut(same).select("row.doc_id", "ld_removed").collect()
    assert {r.ld_removed for r in rows if r.doc_id == 1} == {0} and len(rows) == 4


def test_plan_is_native_and_joins_by_keys(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found = line_dedup.runs(docs)
    texts = line_dedup.texts_of(docs.withColumn("doc_hash", line_dedup._doc_hash(docs["text"])), found)
    plan = spark._jvm.PythonSQLUtils.explainString(line_dedup.compared(texts, found, line_dedup.NEAR)._jdf.queryExecution(), "formatted")
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_equal_hashes_remove_no_unlike_lines(spark, docs, monkeypatch):
    """With one key for all chunks each is taken for the corpus's first one: what goes is still only what has an equal copy before it."""
    monkeypatch.setattr(line_dedup, "chunk_key", lambda body: [F.lit(1).cast("long").alias("k1"), F.lit(2).cast("long").alias("k2")])
    unlike = make(spark, [(k, "\n".join(f"line {k} {j}" for j in range(30)), None, None) for k in range(20)])
    assert all(removed == 0 and text == key[1] for key, (_, removed, text) in rows_of(unlike))
    before, after = Counter(), Counter()
    got = rows_of(docs)
    for (_, was), (_, removed, text) in got:
        if was is not None:
            before.update(was.split("\n"))
            after.update(text.split("\n") if removed < len(was.split("\n")) else [])
    assert set(before) - {""} <= set(after) and sum(r for _, (_, r, _) in got) > 0


def test_a_collision_in_a_run_keeps_its_lines(spark, monkeypatch):
    """Two texts that differ in one line in the middle, with hashes that don't tell: that line stays, its equal neighbours go."""
    lines = [f"some line number {k}" for k in range(40)]
    other = lines[:20] + ["a line of its own"] + lines[21:]
    monkeypatch.setattr(line_dedup, "chunk_key", lambda body: [F.xxhash64(F.replace(body, F.lit("a line of its own"), F.lit("some line number 20"))).alias("k1"), F.lit(0).cast("long").alias("k2")])
    monkeypatch.setattr(line_dedup, "line_hash", lambda line: F.conv(F.substring(F.md5(F.replace(line, F.lit("a line of its own"), F.lit("some line number 20"))), 1, 6), 16, 10).cast("long"))
    docs = make(spark, [(1, "\n".join(lines), None, None), (2, "\n".join(other), None, None)])
    assert dict((k[0], v[2]) for k, v in rows_of(docs)) == {1: "\n".join(lines), 2: "a line of its own"}


def test_recall_on_passages(spark):
    """Lines in runs of three or more that stand at an earlier place, counted by brute force: nine in ten go, no line of which there is no other copy."""
    rows = [(r.doc_id, r.text.split("\n")) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL").orderBy("doc_id").collect()]
    first, again, everywhere = {}, set(), Counter()
    for i, lines in rows:
        everywhere.update(lines)
        for k in range(len(lines) - 2):
            if first.setdefault(tuple(lines[k : k + 3]), (i, k)) != (i, k):
                again |= {(i, k), (i, k + 1), (i, k + 2)}
    out = {r.doc_id: r.text for r in line_dedup.dedup(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("text IS NOT NULL").collect()}
    left, caught = Counter(), 0
    for i, lines in rows:
        rest = out[i].split("\n") if out[i] else []
        left.update(rest)
        stays, at = [], 0
        for line in lines:
            here = at < len(rest) and rest[at] == line
            stays.append(here)
            at += here
        assert at == len(rest)
        caught += sum((i, k) in again and not s for k, s in enumerate(stays))
    assert len(again) > 900 and caught >= 0.9 * len(again)
    assert all(left[line] >= 1 for line in everywhere if line)
