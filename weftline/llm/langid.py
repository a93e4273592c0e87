"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to ORDER bytes, with counts from a
sample of labelled texts. A byte that its context has seen with count c out of
n, among q different bytes, has probability c / (n + q); the remaining
q / (n + q) is the escape, shared among the bytes it hasn't seen in proportion
to their probability in the next shorter context, down to a uniform one. The
counts are frozen, so the code length of every byte in every context is a table,
and a text's code length under a language is a sum of table entries. The
shortest code names the language; the score is its share when the code lengths
are read as probabilities.

The sample takes each language's texts in order of their hash until SAMPLE_BYTES
are reached, one text at least, so no language with text is lost; what is put in
order is cut beforehand by the rate that the language's total asks for. Of a row
over ROW_BYTES an inner part is fitted; every text is scored whole.

Defined cases: ``und`` with score 0 for a null text, one without letters, and
where nothing could be learned; ties go to the first language by code point;
repeated rows get a row each; a null doc_id hashes as an empty text; an empty
table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.scratch import materialize

ORDER = 3
SAMPLE_BYTES = 250_000
ROW_BYTES = 64_000
#: Rows are put in order that hold this many times SAMPLE_BYTES, in expectation.
AHEAD = 4
#: Bytes of text that a task scores at once.
GROUP_BYTES = 1 << 20


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the id, as text, falls in a fold by its CRC-32."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)) == fold


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


_PAD = b"\n" * ORDER


def count_contexts(labelled: DataFrame) -> DataFrame:
    """lang, gram (ORDER bytes of context and one more), n over (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        seen: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                data = _PAD + _bytes(text)
                seen.update([(lang, data[k : k + ORDER + 1]) for k in range(len(data) - ORDER)])
        rows = list(seen.items())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())], names=["lang", "gram", "n"])

    return labelled.select("lang", "text").mapInArrow(run, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def sample(labelled: DataFrame, sample_bytes: int = SAMPLE_BYTES, row_bytes: int = ROW_BYTES) -> DataFrame:
    """lang, text: of labelled (text, lang) each language's different texts in order of their hash until sample_bytes are reached, one that isn't empty at least.

    Copies of a text count once, and are made one before they meet; what is put
    in order for a language is AHEAD times the sample in expectation.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("text").alias("h"))
    most = row_bytes // 4  # code points, of 4 bytes at most
    inner = F.substring("text", F.floor((F.char_length("text") - most) / 2).cast("int") + 1, F.lit(most))
    parts = usable.withColumn("text", F.when(F.octet_length("text") <= row_bytes, F.col("text")).otherwise(inner)).withColumn("size", F.octet_length("text")).where("size > 0")
    u = F.pmod("h", F.lit(1 << 30))
    totals = parts.select("lang", "h", "size").distinct().groupBy("lang").agg(F.sum("size").alias("total"), F.min(F.struct(u.alias("u"), "h")).alias("least"))
    rates = materialize(totals.select("lang", "least.h", (F.lit(AHEAD * float(sample_bytes) * (1 << 30)) / F.col("total")).alias("below")).withColumnRenamed("h", "least"), "lang-rates")
    ahead = parts.join(rates, "lang").where((u < F.col("below")) | (F.col("h") == F.col("least"))).groupBy("lang", "h", "size").agg(F.min("text").alias("text"))
    before = F.sum("size").over(Window.partitionBy("lang").orderBy(u, "h", "size").rowsBetween(Window.unboundedPreceding, -1))
    return ahead.withColumn("before", before).where(F.coalesce("before", F.lit(0)) < sample_bytes).select("lang", "text")


class Model:
    """Tables of code lengths, built from counts of grams by language."""

    def __init__(self, counts: list[tuple[str, bytes, int]]) -> None:
        import numpy as np

        self.np = np
        self.langs = sorted({lang for lang, _, _ in counts})
        if not self.langs:
            return
        used = sorted({b for _, gram, _ in counts for b in gram} | {*_PAD})
        width = len(used) + 1  # the last symbol stands for any byte that the sample lacks
        self.width = width
        self.symbol = np.full(256, width - 1, np.int64)
        self.symbol[used] = np.arange(len(used))
        grams = self.symbol[np.frombuffer(b"".join(g for _, g, _ in counts), np.uint8).reshape(-1, ORDER + 1)]
        which, n = np.array([self.langs.index(lang) for lang, _, _ in counts]), np.array([n for _, _, n in counts], float)

        # contexts of each length that occur in any language, as numbers in base ``width``, newest symbol last
        code = [np.zeros(len(grams), np.int64)]
        for k in range(1, ORDER + 1):
            code.append(code[-1] + grams[:, ORDER - k] * width ** (k - 1))
        known = [np.unique(c) for c in code]
        base = np.concatenate([[0], np.cumsum([len(k) for k in known])])

        def state(k: int, c):
            """The state of contexts of length k, or of their longest suffix that occurs."""
            out = np.zeros(len(c), np.int64)
            for j in range(1, k + 1):
                tail = c % width**j
                at = np.minimum(np.searchsorted(known[j], tail), len(known[j]) - 1)
                hit = known[j][at] == tail
                out[hit] = base[j] + at[hit]
            return out

        pairs = np.arange(width * width)
        self.two = state(2, pairs)
        # a state of at most two symbols and the symbol after it
        short = np.concatenate([known[k] for k in range(3)])
        length = np.repeat(np.arange(3), [len(known[k]) for k in range(3)])
        grown = (short[:, None] * width + np.arange(width)).ravel()
        longer = np.repeat(length + 1, width)
        self.three = np.zeros(len(grown), np.int64)
        for k in range(1, ORDER + 1):
            own = longer == k
            self.three[own] = state(k, grown[own])
        self.cost = np.empty((base[-1] * width, len(self.langs)), np.float32)
        for lang in range(len(self.langs)):
            mine = which == lang
            shorter = None
            for k in range(ORDER + 1):
                seen = np.zeros((len(known[k]), width))
                np.add.at(seen, (np.searchsorted(known[k], code[k][mine]), grams[mine, ORDER]), n[mine])
                if k:
                    tail = known[k] % width ** (k - 1)
                    lower = shorter[np.searchsorted(known[k - 1], tail)]
                else:
                    lower = np.full((1, width), 1 / 256)
                    lower[0, -1] = (257 - width) / 256
                total, kinds = seen.sum(1, keepdims=True), (seen > 0).sum(1, keepdims=True)
                left = np.maximum(np.where(seen > 0, 0, lower).sum(1, keepdims=True), 1e-300)
                p = np.where(seen > 0, seen / np.maximum(total + kinds, 1), kinds / np.maximum(total + kinds, 1) * lower / left)
                shorter = np.where(total > 0, p, lower)
                self.cost[base[k] * width : base[k + 1] * width, lang] = -np.log2(np.maximum(shorter, 1e-300)).ravel()
        # the one symbol for missing bytes stands for each of them
        self.cost[width - 1 :: width] += np.log2(max(1, 257 - width))

    def lengths(self, texts: list[bytes]):
        """Code length in bits of each text under each language."""
        np = self.np
        out = np.zeros((len(texts), len(self.langs)))
        pieces, owner, held = [], [], 0

        def flush() -> None:
            nonlocal held
            if not pieces:
                return
            a = self.symbol[np.frombuffer(b"".join(pieces), np.uint8)]
            two = self.two[a[:-1] * self.width + a[1:]]
            three = self.three[two[:-1] * self.width + a[2:]]
            cost = np.zeros((len(a), len(self.langs)), np.float32)
            cost[ORDER:] = self.cost[three[:-1] * self.width + a[ORDER:]]
            starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]])
            for k in range(ORDER):
                cost[starts + k] = 0
            np.add.at(out, owner, np.add.reduceat(cost, starts, axis=0, dtype=np.float64))
            pieces.clear()
            owner.clear()
            held = 0

        for k, text in enumerate(texts):
            data = _PAD + text
            for at in range(0, len(text), GROUP_BYTES):
                pieces.append(data[at : at + GROUP_BYTES + ORDER])
                owner.append(k)
                held += len(pieces[-1])
                if held >= GROUP_BYTES:
                    flush()
        flush()
        return out


_models: dict[str, Model] = {}


def predict(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score for each row of docs (doc_id, text), by the frozen counts."""
    table = [(r.lang, bytes(r.gram), r.n) for r in counts.collect()]  # bounded by the sample
    shared = docs.sparkSession.sparkContext.broadcast(table)
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import regex

        if name not in _models:
            _models.clear()
            _models[name] = Model(shared.value)
        model, letter = _models[name], regex.compile(r"\p{L}").search
        for batch in batches:
            texts = batch.column("text").to_pylist()
            asked = [k for k, t in enumerate(texts) if t and model.langs and letter(t)]
            pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if asked:
                bits = model.lengths([_bytes(texts[k]) for k in asked])
                best = bits.argmin(1)
                pred[asked] = np.array(model.langs, object)[best]
                score[asked] = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def fit(labelled: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """The counts of a sample of labelled (doc_id, text, lang)."""
    return materialize(count_contexts(sample(labelled, sample_bytes)), "lang-contexts")
