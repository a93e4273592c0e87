import math
import zlib
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F

from weftline.llm import langid, lm

from .conftest import corpus

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def run(docs):
    return lm.score(docs, langid.held_out(F.col("doc_id"), 7, 2), PIECES)


def test_base_against_brute_force(docs):
    rows = [(i, (t or "").encode().lower().split() + [None], zlib.crc32(str("" if i is None else i).encode()) % 7 == 2) for i, t, *_ in corpus()]
    c = Counter()
    for _, tokens, out in rows:
        if not out:
            c.update(tokens)
    n, v = sum(c.values()), len(c)
    want = sorted(((-1 if i is None else i, out, len(t), sum(c[x] > 0 for x in t), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), 4)) for i, t, out in rows), key=str)
    got = sorted(((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in run(docs).collect()), key=str)
    assert got == want


def test_blocks_do_not_matter(docs, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    small = sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in run(docs).collect())
    monkeypatch.undo()
    assert small == sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in run(docs).collect())


def test_blocks_hold_no_more_than_their_bytes(docs, monkeypatch):
    """No block has more text than BLOCK_BYTES, but one that is a single text."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 6000)
    whole = docs.select("doc_id", "text").coalesce(1)
    out = lm.dictionaries(whole, F.lit(False)).where("word IS NULL").select("block", F.octet_length("ids").alias("n")).collect()
    sizes = [r.n for r in whole.select(F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).collect()]
    blocks = {}
    for r, n in zip(out, sizes):
        blocks.setdefault(r.block, []).append(n)
    assert len(out) == len(sizes) and len(blocks) > 5
    assert all(sum(b) <= 6000 or sum(n > 0 for n in b) == 1 for b in blocks.values()) and max(map(len, blocks.values())) > 1


def _all_segmentations(lattice, text):
    """Sum over segmentations by plain recursion."""
    total = 0.0
    if not text:
        return 1.0
    for n in range(1, len(text) + 1):
        piece = text[:n]
        if lattice.automaton.exists(piece):
            total += math.exp(lattice.weight[lattice.automaton.get(piece)]) * _all_segmentations(lattice, text[n:])
    if text[0] not in lattice.single:
        total += math.exp(sum(lattice.weight[lattice.byte[b]] for b in text[0].encode())) * _all_segmentations(lattice, text[1:])
    return total


def test_forward_recursion_sums_all_segmentations():
    lattice = lm.Lattice(PIECES, {300: 50, 1000: 7}, 3)
    for word in ("the", "there", "unzip", "naïve", "x\U0001f642y", "▁▁", "a"):
        assert abs(lattice.word(word) - math.log(_all_segmentations(lattice, "▁" + word))) < 1e-9
    assert -1e6 < lattice.word("z" * 20_000) < -1000


def test_pieces_sum_to_one():
    lattice = lm.Lattice(PIECES, {400: 9}, 2)
    assert abs(sum(map(math.exp, lattice.weight)) - 1) < 1e-9


def _all_pieces(lattice, text):
    """(probability, pieces) of each segmentation, by plain recursion."""
    if not text:
        yield 1.0, []
    for n in range(1, len(text) + 1):
        if lattice.automaton.exists(text[:n]):
            i = lattice.automaton.get(text[:n])
            for p, rest in _all_pieces(lattice, text[n:]):
                yield p * math.exp(lattice.weight[i]), [i, *rest]
    if text and text[0] not in lattice.single:
        own = [lattice.byte[b] for b in text[0].encode()]
        for p, rest in _all_pieces(lattice, text[1:]):
            yield p * math.exp(sum(lattice.weight[own])), own + rest


def test_expected_counts_against_all_segmentations():
    lattice = lm.Lattice(PIECES, {300: 50, 1000: 7}, 3)
    words, times = ["the", "there", "x\U0001f642y", "a", "na\u00efve"], [3, 1, 2, 5, 1]
    want = Counter()
    for w, c in zip(words, times):
        every = list(_all_pieces(lattice, "\u2581" + w))
        whole = sum(p for p, _ in every)
        for p, pieces in every:
            for i in pieces:
                want[i] += c * p / whole
    got, total = lattice.expected(words, times)
    assert all(abs(got[i] - n) < 1e-9 for i, n in want.items()) and abs(got.sum() - sum(want.values())) < 1e-9
    assert abs(total - sum(c * lattice.word(w) for w, c in zip(words, times))) < 1e-9


def test_each_pass_makes_the_training_words_likelier():
    words = Counter(w for _, t, *_ in corpus() for w in (t or "").lower().split() if len(w) < 100)
    counts, before = {}, -math.inf
    for _ in range(4):
        got, total = lm.Lattice(PIECES, counts, 0).expected(list(words), list(words.values()))
        assert total > before
        counts, before = {i: n for i, n in enumerate(got) if n}, total


def test_document_scores_against_plain_sums(docs):
    """Scores of whole documents: the same passes in plain Python over a dictionary."""
    rows = [(i, (t or "").encode().lower().decode().split() if (t or "").isascii() else None, zlib.crc32(str("" if i is None else i).encode()) % 7 == 2) for i, t, *_ in corpus()]
    some = docs.where(F.col("text").isNull() | ~F.col("text").rlike(r"[^\x00-\x7f]"))
    rows = [(i, t, out) for i, t, out in rows if t is not None]
    train = Counter(w for _, t, out in rows if not out for w in t)
    ends, counts = sum(not out for *_, out in rows), {}
    for _ in range(lm.PASSES):
        got, _ = lm.Lattice(PIECES, counts, ends).expected(list(train), list(train.values()))
        counts = {i: n for i, n in enumerate(got) if n}
    last = lm.Lattice(PIECES, counts, ends)
    want = sorted((str(i), round((sum(last.word(w) * c for w, c in Counter(t).items()) + last.end) / math.log(10), 3)) for i, t, _ in rows)
    assert sorted((str(r.doc_id), round(r.score, 3)) for r in run(some).collect()) == want


def test_empty(docs, empty):
    assert run(empty).count() == 0
    only = run(docs.where("doc_id = 62")).first()
    assert only.n_tokens == 1
