"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bpe, divergence, fingerprint, langid, line_dedup, lm, minhash, mixing, neighbours, quality, token_store, warc, whitening
from weftline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies, the same on driver and executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = token_store.write(docs, vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_store.fetch(store, token_store.lookup(store, docs.select("doc_id")))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.apply_policy(quality.store(table(spark, sf_dir, "documents")), quality.STANDARD)
    base_failed = F.col("failed").bitwiseAND(F.lit(quality.BASE.mask)) != 0
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), "kept", "n_lines", "n_upper", "n_exclaim", "n_stutter",
        "n_bullets", "n_ellipses", "n_lettered", "failed", "rule_book", "policy",
    )


ORACLE["op2_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) > 8)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, sum(least(8, coalesce(nx - i, 8)))::BIGINT AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM dup) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '\p{Lu}'))::BIGINT AS n_upper, len(regexp_extract_all(t, '[!?]'))::BIGINT AS n_exclaim,
        (CASE WHEN len(w) < 2 THEN 0 ELSE len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) END)::BIGINT AS n_stutter,
        len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*[-*\x{2022}]')))::BIGINT AS n_bullets, len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[ \t\r]*$')))::BIGINT AS n_ellipses,
        len(list_filter(w, lambda x: regexp_matches(x, '\p{L}')))::BIGINT AS n_lettered
      FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
f AS (SELECT *, ((CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END) + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
        + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END) + (CASE WHEN 10 * n_upper > 3 * word_chars THEN 16 ELSE 0 END) + (CASE WHEN 2 * n_exclaim > n_words THEN 32 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words OR word_chars > 30 * n_words THEN 64 ELSE 0 END) + (CASE WHEN 10 * n_stutter > 3 * n_words THEN 128 ELSE 0 END)
        + (CASE WHEN 10 * n_bullets > 9 * n_lines THEN 256 ELSE 0 END) + (CASE WHEN 10 * n_ellipses > 3 * n_lines THEN 512 ELSE 0 END) + (CASE WHEN 10 * n_lettered < 8 * n_words THEN 1024 ELSE 0 END))::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, failed & 255 = 0 AS kept,
       n_lines, n_upper, n_exclaim, n_stutter, n_bullets, n_ellipses, n_lettered, failed, 'rules-2' AS rule_book, 'standard-1' AS policy FROM f
"""


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


ORACLE["op6_mixing"] = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n, source_size * 3 AS cap FROM s),
w AS (SELECT *, (n % 3 + 1)::BIGINT AS weight FROM n),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(weight) OVER (ORDER BY cap / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
o AS (SELECT *, CASE WHEN level * weight <= cap THEN level END AS open_level FROM l),
t AS (SELECT source, source_size, coalesce(least((SELECT open_level FROM o WHERE open_level IS NOT NULL ORDER BY cap / weight, n LIMIT 1) * weight, cap::DOUBLE), cap::DOUBLE) AS target FROM o),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
        ('0x' || substr(md5('mix-1|offset|' || coalesce(source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS o FROM t),
b AS (SELECT d.doc_id, d.size, r.*, 16 * length(bin(size)) + (size >> greatest(length(bin(size)) - 4, 0)) AS class,
        ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS u FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
k AS (SELECT source, class, count(*) AS n, sum(count(*)) OVER (PARTITION BY source ORDER BY class DESC)::BIGINT AS upto FROM b GROUP BY source, class),
e AS (SELECT b.*, floor(rate) AS whole, floor(k.upto * (rate - floor(rate)) + o) - floor((k.upto - k.n) * (rate - floor(rate)) + o) AS extra, row_number() OVER (PARTITION BY b.source, b.class ORDER BY u) AS place
      FROM b JOIN k ON b.source IS NOT DISTINCT FROM k.source AND b.class = k.class),
m AS (SELECT source, class, max(u) AS below FROM e WHERE place <= extra GROUP BY source, class),
c AS (SELECT e.*, (whole + CASE WHEN u <= coalesce(m.below, -1) THEN 1 ELSE 0 END)::INTEGER AS copies FROM e LEFT JOIN m ON e.source IS NOT DISTINCT FROM m.source AND e.class = m.class)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM c
"""


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.cut(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", F.col("ld_lines").alias("n_lines"), F.col("ld_removed").alias("n_removed"), "row.text")


ORACLE["op7_line_dedup"] = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, l, list_transform(l, lambda x: ('0x' || substr(md5(x), 1, 6))::BIGINT) AS h FROM l),
r AS (SELECT doc_id, l, list_transform(range(1, len(h) + 1), lambda k: ((CASE WHEN k = 1 THEN 0 ELSE h[k - 1] END) * 8191 + h[k]) % 1000003) AS r FROM h),
f AS (SELECT doc_id, l, list_transform(r, lambda x: x * sign) AS r, sign FROM r, (VALUES (1), (-1)) AS s(sign)),
e AS (SELECT doc_id, l, list_filter(range(0, len(l)), lambda k: k = len(l) - 1 OR (k > 0 AND r[k + 1] < r[k] AND r[k + 1] <= r[k + 2])) AS e FROM f),
w AS (SELECT doc_id, l, flatten(list_transform(range(1, len(e) + 1), lambda k: list_concat(range((CASE WHEN k = 1 THEN 0 ELSE e[k - 1] + 1 END) + 3, e[k], 4), [e[k]]))) AS e FROM e),
c AS (SELECT doc_id, l, unnest(list_transform(range(1, len(e) + 1), lambda k: {'a': CASE WHEN k = 1 THEN 0 ELSE e[k - 1] + 1 END, 'b': e[k]})) AS c FROM w),
p AS (SELECT DISTINCT doc_id, c.a AS a, c.b AS b, array_to_string(list_slice(l, c.a + 1, c.b + 1), chr(10)) AS body FROM c WHERE c.b > c.a),
q AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, a) AS n FROM p),
m AS (SELECT q.doc_id, q.a, q.b, x.doc_id AS d0, q.a - x.a AS shift FROM q JOIN q AS x ON q.body = x.body AND x.n = 1 WHERE q.n > 1),
z AS (SELECT s.doc_id, s.d0, s.shift, list_filter(range(-1, len(x.l) + 1), lambda k: k < 0 OR k >= len(x.l) OR k - s.shift < 0 OR k - s.shift >= len(y.l) OR x.l[k + 1] <> y.l[k - s.shift + 1]) AS unlike
      FROM (SELECT DISTINCT doc_id, d0, shift FROM m) s JOIN l x ON s.doc_id = x.doc_id JOIN l y ON s.d0 = y.doc_id),
y AS (SELECT m.doc_id, list_max(list_filter(unlike, lambda k: k < a)) + 1 AS a, list_min(list_filter(unlike, lambda k: k > b)) - 1 AS b FROM m JOIN z ON m.doc_id = z.doc_id AND m.d0 = z.d0 AND m.shift = z.shift),
g AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS k FROM y),
x AS (SELECT doc_id, unnest(range(0, len(l))) AS k, unnest(l) AS line FROM l),
o AS (SELECT x.doc_id, count(g.k)::BIGINT AS n_removed, count(*)::BIGINT AS n_lines, coalesce(string_agg(x.line, chr(10) ORDER BY x.k) FILTER (WHERE g.k IS NULL), '') AS text
      FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.k = g.k GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(o.n_lines, 0) AS n_lines, coalesce(o.n_removed, 0) AS n_removed, o.text FROM documents d LEFT JOIN o ON d.doc_id = o.doc_id
"""


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=80)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ORACLE["op3_minhash_near_dedup"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) END) AS g FROM w),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.i >= 80 * (x.n + y.n - p.i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept FROM documents d JOIN c ON d.doc_id = c.node LEFT JOIN n ON d.doc_id = n.doc_id
"""


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = warc.folder_for(pages)
    return warc.read(warc.write(pages, folder), folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op8_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT page_id, h, row_number() OVER (PARTITION BY h ORDER BY page_id NULLS LAST) AS n, min(page_id) OVER (PARTITION BY h) AS m FROM p),
d AS (SELECT *, unhex(sha1(h)) AS b FROM r)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (list_reduce(list_transform(range(0, 5), lambda j: substr(bits, k * 5 + j + 1, 1)::INTEGER), lambda a, x: 2 * a + x) + 1)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN n > 1 THEN m END AS refers_to
FROM (SELECT *, array_to_string(list_transform(range(0, 40), lambda i: CASE substr(sha1(h), i + 1, 1) WHEN '0' THEN '0000' WHEN '1' THEN '0001' WHEN '2' THEN '0010' WHEN '3' THEN '0011'
  WHEN '4' THEN '0100' WHEN '5' THEN '0101' WHEN '6' THEN '0110' WHEN '7' THEN '0111' WHEN '8' THEN '1000' WHEN '9' THEN '1001' WHEN 'a' THEN '1010' WHEN 'b' THEN '1011'
  WHEN 'c' THEN '1100' WHEN 'd' THEN '1101' WHEN 'e' THEN '1110' ELSE '1111' END), '') AS bits FROM d)
"""


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"), 3, 1)
    counts = langid.fit(docs.where(~out).select("doc_id", "text", "lang"))
    found = langid.predict(docs.select("doc_id", "text"), counts)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), langid.held_out(F.col("doc_id"), 7, 2), vocabulary("piece_bpe_32k.model"))


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLE["op11_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
o AS (SELECT row_id, lang, source, unnest(t) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM k GROUP BY lang),
s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total FROM g LEFT JOIN (SELECT c.* FROM c JOIN k USING (lang, term)) c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.total + l.v) AS p, 1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
      FROM s JOIN k ON s.lang = k.lang JOIN l ON s.lang = l.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
w AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(w.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN w ON w.lang = a.lang AND w.source = a.source AND w.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""


@query
def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
