"""Document fingerprints from content-defined chunks.

A gear hash rolls over the last 32 bytes. A chunk ends where the hash's top
bits are zero: more bits before the normal size, fewer after it, which draws
sizes towards the normal one; none ends under the least size and all end at the
largest. A boundary depends on the bytes around it, so an edit moves only the
chunks it touches. A fingerprint is the set of chunk digests with the chunks'
lengths; likeness is containment: the length of the shared chunks over the
length of the smaller set.

Defined cases: a null text is an empty one, with an empty fingerprint; equal
fingerprints, empty ones too, have likeness 1, an empty and another one 0; rows
that share a doc_id follow each other by hash of the text; a table of one row
is its own next; an empty table gives an empty one. Only doc_id and text are
read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.scratch import materialize

LEAST, NORMAL, LARGEST = 48, 96, 384
#: Top bits that must be zero before and after the normal size.
HARD_BITS, EASY_BITS = 7, 5
SPAN = 32
#: Bytes of text that a task chunks at once.
GROUP_BYTES = 2 << 20


class Chunker:
    def __init__(self) -> None:
        import numpy as np

        self.np = np
        self.gear = np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=4, person=b"gear").digest() for b in range(256)), np.uint32)

    def rolled(self, data: bytes):
        """The gear hash at each position, over the SPAN bytes that end there: sums of doubled spans."""
        np = self.np
        h, span = self.gear[np.frombuffer(data, np.uint8)], 1
        while span < SPAN:
            wider = h.copy()
            wider[span:] += h[:-span] << np.uint32(span)
            h, span = wider, 2 * span
        return h

    def ends(self, texts: list[bytes]) -> list[list[int]]:
        """Where each text's chunks end. LEAST exceeds SPAN, so no hash that counts reaches over a chunk's start."""
        np = self.np
        h = self.rolled(b"".join(texts))
        easy = np.flatnonzero(h >> np.uint32(32 - EASY_BITS) == 0) + 1
        hard = easy[h[easy - 1] >> np.uint32(32 - HARD_BITS) == 0].tolist()
        easy = easy.tolist()
        out, at = [], 0
        for t in texts:
            stop, found = at + len(t), []
            start = at
            while stop - start > LEAST:
                k = bisect.bisect_left(hard, start + LEAST)
                cut = hard[k] if k < len(hard) and hard[k] < start + NORMAL else 0
                if not cut:
                    k = bisect.bisect_left(easy, start + NORMAL)
                    cut = easy[k] if k < len(easy) else stop
                start = min(cut, start + LARGEST, stop)
                found.append(start - at)
            if start < stop:
                found.append(len(t))
            out.append(found)
            at = stop
        return out

    def fingerprints(self, texts: list[bytes]) -> list[dict[str, int]]:
        """For each text, length by digest."""
        out = []
        for t, ends in zip(texts, self.ends(texts)):
            found, start = {}, 0
            for end in ends:
                found[base64.b64encode(hashlib.blake2b(t[start:end], digest_size=6).digest(), b"-_").decode()] = end - start
                start = end
            out.append(found)
        return out


def text_of(fingerprint: dict[str, int]) -> str:
    """A fingerprint as a string: digest and length of each chunk, sorted."""
    return " ".join([f"{d}{n}" for d, n in sorted(fingerprint.items())])


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    if a == b:
        return 1.0
    least = min(sum(a.values()), sum(b.values()))
    return sum([n for d, n in a.items() if b.get(d) == n]) / least if least else 0.0


def edited(text: str, following: str) -> str:
    """text with its last quarter replaced by the first as many code points of the following one."""
    m = len(text) // 4
    return text[: len(text) - m] + following[:m]


_COLUMNS = (("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()))
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(chunker: Chunker, ids: list, texts: list[str]) -> list[tuple]:
    """Results for all but the last of consecutive documents."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    raw = [t.encode("utf-8", "surrogatepass") for t in (*texts, *changed)]
    prints = chunker.fingerprints(raw)
    own, after = prints[: len(texts)], prints[len(texts) :]
    return [
        (ids[k], len(texts[k]), hashlib.sha256(raw[len(texts) + k]).hexdigest(), text_of(own[k]), text_of(after[k]), likeness(own[k], after[k]), likeness(own[k], own[k + 1]))
        for k in range(len(changed))
    ]


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness.

    Documents are range-sorted once. A task compares neighbours in its range;
    the first and last document of each range are set aside with their texts,
    two for each task, and meet in an equi-join with the neighbouring range.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, chunker = TaskContext.get().partitionId(), Chunker()
        names = [c for c, _ in _COLUMNS]

        def done(found: list[tuple]) -> pa.RecordBatch:
            n = len(found)
            return pa.RecordBatch.from_arrays([*(pa.array([f[k] for f in found], kind) for k, (_, kind) in enumerate(_COLUMNS)), pa.array([0] * n, pa.int32()), pa.array([part] * n, pa.int64()), pa.nulls(n, pa.string())], names=[*names, "kind", "part", "text"])

        def aside(kind: int, doc: int | None, text: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), *(pa.nulls(1, k) for _, k in _COLUMNS[1:]), pa.array([kind], pa.int32()), pa.array([part], pa.int64()), pa.array([text], pa.string())], names=[*names, "kind", "part", "text"])

        ids, texts, size, first = [], [], 0, True
        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                doc, text = doc.as_py(), text.as_py()
                if first:
                    yield aside(1, doc, text)
                    first = False
                ids.append(doc)
                texts.append(text)
                size += len(text)
                if size > GROUP_BYTES and len(ids) > 1:
                    yield done(_compare(chunker, ids, texts))
                    ids, texts, size = ids[-1:], texts[-1:], len(text)
        if ids:
            yield done(_compare(chunker, ids, texts))
            yield aside(2, ids[-1], texts[-1])

    table = materialize(ranged.mapInArrow(run, _SCHEMA + ", kind int, part long, text string"), "fingerprints")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker = Chunker()
        for batch in batches:
            found = [_compare(chunker, [doc, None], [a, b])[0] for doc, a, b in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")))]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, (_, kind) in enumerate(_COLUMNS)], names=[c for c, _ in _COLUMNS])

    # one row for each range, not for each document
    order = Window.orderBy("part")
    ranges = table.where("kind = 2").select("part").withColumn("after", F.coalesce(F.lead("part").over(order), F.min("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    heads = table.where("kind = 1").select(F.col("part").alias("after"), F.col("text").alias("following"))
    last = table.where("kind = 2").select("doc_id", "text", "part").join(ranges, "part").join(heads, "after").select("doc_id", "text", "following").mapInArrow(finish, _SCHEMA)
    return table.where("kind = 0").select(*[c for c, _ in _COLUMNS]).unionByName(last)
