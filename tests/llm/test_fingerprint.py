import hashlib
import random

from weftline.llm import fingerprint as fp

from .conftest import corpus, make


def gear_ends(data):
    """Byte by byte."""
    gear = fp.Chunker().gear
    out, start, h = [], 0, 0
    for k, b in enumerate(data):
        h = ((h << 1) + int(gear[b])) & 0xFFFFFFFF
        n = k + 1 - start
        bits = fp.HARD_BITS if n < fp.NORMAL else fp.EASY_BITS
        if k + 1 < len(data) and n >= fp.LEAST and (h >> (32 - bits) == 0 or n == fp.LARGEST):
            out.append(k + 1)
            start = k + 1
    return out + [len(data)] * bool(data)


def test_boundaries_against_byte_by_byte():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abcdefgh \n") for _ in range(rng.randint(0, 3000))) for _ in range(40)] + [b"", b"a" * 5000, b"xyz"]
    assert fp.Chunker().ends(texts) == [gear_ends(t) for t in texts]


def test_against_neighbours(spark, empty):
    rows = [(i, t) for i, t, *_ in corpus() if i is not None and not (i == 5 and t.startswith("another"))]
    rows = sorted(dict(rows).items())
    got = {r.doc_id: r for r in fp.with_next(make(spark, [(i, t, None, None) for i, t in rows])).collect()}
    chunker = fp.Chunker()
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        changed = fp.edited(t, following)
        a, b, c = chunker.fingerprints([x.encode() for x in (t, changed, following)])
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(changed.encode()).hexdigest(), fp.text_of(a), fp.text_of(b))
        assert (r.near_edited, r.near_next) == (fp.likeness(a, b), fp.likeness(a, c))
    assert fp.with_next(empty).count() == 0
    alone = fp.with_next(make(spark, [(1, "only text", None, None)])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_every_row_has_a_result(docs):
    assert fp.with_next(docs).count() == len(corpus())


def test_likeness_survives_shifts():
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(20_000))
    a, b, c = fp.Chunker().fingerprints([text.encode(), ("inserted " + text).encode(), "".join(rng.choice("abcdefghijklmnop ") for _ in range(20_000)).encode()])
    assert fp.likeness(a, b) > 0.95 and fp.likeness(a, c) < 0.02 and fp.likeness({}, {}) == 1 and fp.likeness(a, {}) == 0
