"""Language-model scores from a lattice of subword segmentations.

The pieces of an existing subword vocabulary have unigram scores. They begin
with the prior that the file's own ranking gives; each of PASSES passes then
takes, by a forward and a backward recursion, how often all segmentations of the
training words together are expected to use each piece, and makes scores of that
and the prior. A word's probability sums the products of piece scores over all
its segmentations, by the forward recursion in log space; a text's is the
product over its words and the end. The scores of all segmentations that spell a
text thus count, not only the best one's.

The corpus is read once. A task turns its documents into numbers of its own
dictionary, which it closes before it exceeds BLOCK_BYTES of text; dictionaries are summed
by word, each distinct word of the corpus is scored once, and each block's
documents then meet its dictionary in one group, bounded by BLOCK_BYTES. Only
words, not occurrences, are shuffled.

Defined cases: a null text is an empty one, with the end alone; a null doc_id
counts as an empty text when folds are dealt; repeated rows count each; with
nothing to learn from, counts are 0 and the pieces' prior is all there is; an
empty table gives an empty result; a very long text is a block of its own, a
long word takes time in proportion to its length. Only doc_id and text are read,
whatever else there is.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.scratch import materialize

#: Bytes of text that a dictionary and its group hold, or one longer text.
BLOCK_BYTES = 32 << 20
#: Weight of the vocabulary's own ranking against the counts, in pieces.
PRIOR = 32_000.0
#: Times that expected counts are taken: on sf0.01 the score held out is -8.53, -5.58, -5.43, -5.38, -5.36 and -5.36 (log10 a token) after none to five passes.
PASSES = 4
#: Words whose lattices are worked on at once.
GROUP = 4096
_START = "▁"


def dictionaries(docs: DataFrame, held: Column) -> DataFrame:
    """Rows of two kinds: documents (block, doc_id, held_out, ids) and words (block, word, local, c), c counted in training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        part, seq, size = TaskContext.get().partitionId(), 0, 0
        local: dict[bytes, int] = {}
        counts = np.zeros(1024, np.int64)

        def block() -> int:
            # times an odd number: still one number for each block, but spread over the partitions
            x = (part << 20 | seq) * 0x9E3779B97F4A7C15 % (1 << 64)
            return x - (1 << 64) if x >> 63 else x

        def words() -> Iterator[pa.RecordBatch]:
            known = list(local)
            for at in range(0, len(known), 50_000):
                some = known[at : at + 50_000]
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block()] * n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.binary()), pa.array(some, pa.binary()).cast(pa.string()), pa.array(range(at, at + n), pa.int64()), pa.array(counts[at : at + n])],
                    names=["block", "doc_id", "held_out", "ids", "word", "local", "c"],
                )

        held_rows: list[tuple] = []

        def documents() -> Iterator[pa.RecordBatch]:
            n = len(held_rows)
            if n:
                ids, outs, rows = zip(*held_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block()] * n, pa.int64()), pa.array(ids, pa.int64()), pa.array(outs, pa.bool_()), pa.array(rows, pa.binary()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                    names=["block", "doc_id", "held_out", "ids", "word", "local", "c"],
                )
                held_rows.clear()

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal counts, size, seq
            if len(local) > len(counts):
                counts = np.concatenate([counts, np.zeros(len(local), np.int64)])
            yield from documents()
            yield from words()
            local.clear()
            counts, size, seq = np.zeros(1024, np.int64), 0, seq + 1

        for batch in batches:
            for doc_id, out, text in zip(batch.column("doc_id").cast(pa.int64()).to_pylist(), batch.column("held_out").to_pylist(), batch.column("text")):
                data = (text.as_py() or "").encode()
                if size and size + len(data) > BLOCK_BYTES:
                    yield from close()
                ids = np.array([local.setdefault(w, len(local)) for w in data.lower().split()], np.uint32)
                if not out:
                    if len(local) > len(counts):
                        counts = np.concatenate([counts, np.zeros(max(len(counts), len(local)), np.int64)])
                    np.add.at(counts, ids, 1)
                size += len(data)
                held_rows.append((doc_id, out, ids.tobytes()))
                if len(held_rows) >= 512:
                    yield from documents()
        yield from close()

    return docs.select("doc_id", "text", held.alias("held_out")).mapInArrow(run, "block long, doc_id long, held_out boolean, ids binary, word string, local long, c long")


class Lattice:
    """Natural log probabilities of words over all segmentations into pieces, many words at once with numpy.

    The words of a group lie in one string, a line break between two, in which an
    automaton finds all pieces; no piece holds a line break. Boundaries between
    characters are nodes, pieces are arcs, and the recursions go over the depth of
    nodes in their words. A character that is no piece is spelled by its bytes.
    """

    def __init__(self, path: str, counts: dict[int, float], ends: int) -> None:
        import ahocorasick
        import numpy as np
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size, end = sp.get_piece_size(), sp.eos_id()
        usable = [i for i in range(size) if i == end or not (sp.is_control(i) or sp.is_unknown(i))]
        # the file ranks its merged pieces by score, best first: a harmonic prior over that order; bytes and the end come last
        order = sorted(usable, key=lambda i: (sp.is_byte(i) or i == end, -sp.get_score(i), i))
        prior = {i: 1.0 / (k + 2) for k, i in enumerate(order)}
        scale = PRIOR / sum(prior.values())
        seen = {i: counts.get(i, 0) + (ends if i == end else 0) for i in usable}
        total = sum(seen.values()) + PRIOR
        self.weight, self.length = np.full(size, -np.inf), np.zeros(size, np.int64)
        for i in usable:
            self.weight[i] = math.log((seen[i] + scale * prior[i]) / total)
        self.end = float(self.weight[end])
        self.byte = {int(sp.id_to_piece(i)[3:-1], 16): i for i in usable if sp.is_byte(i)}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.single = {"\n"}
        for i in usable:
            piece = sp.id_to_piece(i)
            if i != end and not sp.is_byte(i) and "\n" not in piece:
                self.automaton.add_word(piece, i)
                self.length[i] = len(piece)
                if len(piece) == 1:
                    self.single.add(piece)
        self.automaton.make_automaton()

    def _forward(self, words: list[str]):
        """The arcs of a group of words with the recursion's values: see the names returned."""
        import numpy as np

        big = "\n".join([_START + w for w in words])
        sizes = np.array([len(w) + 1 for w in words])
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(big)), np.int64).reshape(-1, 2)
        to, piece = found[:, 0] + 1, found[:, 1]
        frm, weight = to - self.length[piece], self.weight[piece]
        odd = set(big) - self.single
        spelled: list[list[int]] = []
        if odd:
            kinds = {c: k for k, c in enumerate(sorted(odd))}
            spelled = [[self.byte[b] for b in c.encode("utf-8", "surrogatepass")] for c in sorted(odd)]
            at = np.array([k for k, c in enumerate(big) if c in odd])
            kind = np.array([kinds[big[k]] for k in at.tolist()])
            to, frm, piece = np.concatenate([to, at + 1]), np.concatenate([frm, at]), np.concatenate([piece, len(self.weight) + kind])
            weight = np.concatenate([weight, np.array([self.weight[x].sum() for x in spelled])[kind]])
        owner = np.repeat(np.arange(len(words)), sizes + 1)
        word = owner[frm]
        depth = to - starts[word]
        order = _by_depth(depth, word)
        to, frm, piece, weight, word, depth = (x[order] for x in (to, frm, piece, weight, word, depth))
        value = np.full(len(big) + 1, -np.inf)
        value[starts] = 0.0
        _recur(value, frm, to, weight, depth)
        return starts, starts + sizes, frm, to, piece, weight, word, value, spelled

    def words(self, words: list[str]):
        """Log probability of each word."""
        import numpy as np

        out = np.zeros(len(words))
        for some in _groups(words):
            _, ends, *_, value, _ = self._forward([words[k] for k in some])
            out[some] = value[ends]
        return out

    def word(self, word: str) -> float:
        return float(self.words([word])[0])

    def expected(self, words: list[str], times):
        """How often each piece is expected in words that occur so many times, and the log probability of all of them."""
        import numpy as np

        times = np.asarray(times, float)
        counts, total = np.zeros(len(self.weight)), 0.0
        for some in _groups(words):
            starts, ends, frm, to, piece, weight, word, value, spelled = self._forward([words[k] for k in some])
            back = np.full(len(value), -np.inf)
            back[ends] = 0.0
            above = (ends - starts)[word] - (frm - starts[word])  # depth from the end
            order = _by_depth(above, word)
            _recur(back, to[order], frm[order], weight[order], above[order])
            share = np.exp(value[frm] + weight + back[to] - value[ends][word]) * times[some][word]
            got = np.bincount(piece, share, len(self.weight) + len(spelled))
            counts += got[: len(self.weight)]
            for k, pieces in enumerate(spelled):
                np.add.at(counts, pieces, got[len(self.weight) + k])
            total += float((value[ends] * times[some]).sum())
        return counts, total


def _by_depth(depth, word):
    """An order by depth and, in it, by word: small numbers, which numpy sorts without comparing."""
    import numpy as np

    def stable(x):
        return np.argsort(x.astype(np.uint16) if len(x) and x.max() < 65536 else x, kind="stable")

    by_word = stable(word)
    return by_word[stable(depth[by_word])]


def _recur(value, frm, to, weight, depth) -> None:
    """Set value at the arcs' targets, one depth after another, to the log of the sum over the arcs; arcs come in order of depth, those of one target together."""
    import numpy as np

    first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.zeros(0, np.int64)
    edges = np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1], [True]])) if len(to) else np.zeros(1, np.int64)
    at = np.searchsorted(first, edges)
    for k in range(len(edges) - 1):
        a, b = edges[k], edges[k + 1]
        own = first[at[k] : at[k + 1]]
        value[to[own]] = np.logaddexp.reduceat(value[frm[a:b]] + weight[a:b], own - a)


def _groups(words: list[str]) -> Iterator:
    """Places of words, GROUP of like length at once."""
    import numpy as np

    order = np.argsort([len(w) for w in words], kind="stable")
    for first in range(0, len(order), GROUP):
        yield order[first : first + GROUP]


def piece_counts(words: DataFrame, path: str, counts: dict[int, float], ends: int) -> DataFrame:
    """(piece, n): how often each piece is expected in words (word, c) under the scores that counts give."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        lattice = _lattice(name, path, counts, ends)
        n = np.zeros(len(lattice.weight))
        for batch in batches:
            n += lattice.expected(batch.column("word").to_pylist(), batch.column("c").to_numpy())[0]
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(n[used])], names=["piece", "n"])

    return words.select("word", "c").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))


_lattices: dict[str, Lattice] = {}


def _lattice(name: str, path: str, counts: dict[int, float], ends: int) -> Lattice:
    """The lattice of one pass, once for each Python worker."""
    if name not in _lattices:
        _lattices.clear()
        _lattices[name] = Lattice(path, counts, ends)
    return _lattices[name]


def score_words(words: DataFrame, path: str, counts: dict[int, float], ends: int) -> DataFrame:
    """words with lp, the log10 probability of each."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, ten = _lattice(name, path, counts, ends), math.log(10)
        for batch in batches:
            lp = lattice.words(batch.column("word").to_pylist()) / ten
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(lp, pa.float64())], names=["word", "c", "lp"])

    return words.select("word", "c").mapInArrow(run, "word string, c long, lp double")


def score(docs: DataFrame, held: Column, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs (doc_id, text)."""
    rows = materialize(dictionaries(docs, F.coalesce(held, F.lit(False))), "lm-dictionaries")
    lists, entries = rows.where("word IS NULL"), rows.where("word IS NOT NULL")
    words = materialize(entries.groupBy("word").agg(F.sum("c").alias("c")), "lm-words")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    ends = lists.where("NOT held_out").count()
    n, v = n + ends, v + (ends > 0)
    pieces: dict[int, float] = {}
    for _ in range(PASSES):
        pieces = {r.piece: r.n for r in piece_counts(words.where("c > 0"), path, pieces, ends).collect()}  # at most the vocabulary
    scored = score_words(words, path, pieces, ends)
    values = entries.select("block", "word", "local").join(scored, "word").select(F.col("block").alias("of"), "local", "c", "lp")
    end_lp = Lattice(path, pieces, ends).end / math.log(10)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(documents: pa.Table, dictionary: pa.Table) -> pa.Table:
        import numpy as np

        order = dictionary.column("local").to_numpy()
        c, lp = np.zeros(len(order), np.int64), np.zeros(len(order))
        c[order], lp[order] = dictionary.column("c").to_numpy(), dictionary.column("lp").to_numpy()
        base, seen = np.log10((c + 1) / (n + v + 1)), c > 0
        out = []
        for x in documents.column("ids"):
            ids = np.frombuffer(x.as_py(), np.uint32)
            out.append((len(ids) + 1, int(seen[ids].sum()) + (ends > 0), base[ids].sum() + math.log10((ends + 1) / (n + v + 1)), lp[ids].sum() + end_lp))
        k = len(out)
        return pa.table(
            {
                "doc_id": documents.column("doc_id"), "held_out": documents.column("held_out"), "n_tokens": pa.array([r[0] for r in out], pa.int64()), "n_known": pa.array([r[1] for r in out], pa.int64()),
                "train_tokens": pa.array([n] * k, pa.int64()), "base_score": pa.array([r[2] for r in out], pa.float64()), "score": pa.array([r[3] for r in out], pa.float64()),
            },
        )

    return lists.select("block", "doc_id", "held_out", "ids").groupBy("block").cogroup(values.groupBy("of")).applyInArrow(run, schema)
