"""BPE encoding and decoding with an existing vocabulary.

A pretoken is encoded by dynamic programming over its prefixes. An automaton of
the vocabulary gives, for each end position, the tokens that are suffixes of
the prefix. A token can be the last one of a prefix if it follows the last
token of the rest: a pair of tokens is compatible if no merge across their
border comes before the merges that built the two sides. Exactly one token
passes, so one is stored for each prefix, and following the stored tokens back
from the end yields the ids of greedy merging.

The file's normalisation is followed: NFC, white space collapsed, lower case by
code point; special tokens are found in the raw text first. Decoding follows
the file too: it names no decoder, so tokens are joined by one space.

Each task encodes a chunk (text between white space) once and keeps it; the
memory is bounded by CACHE entries and CACHE_CHARS, not by the corpus.

Defined cases: a null text is an empty one and has no ids; white space alone
has none; repeated rows are encoded each; a very long text is encoded whole, in
time and memory in proportion; an empty table gives an empty one. The columns of
the input are kept in :func:`encode`, which adds ``bpe_ids`` and ``bpe_n``, and
in :func:`decode`, which adds ``bpe_text``; columns of those names that the
input already has are replaced.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftline.llm.common import byte_alphabet

#: Entries that a task's memory of chunks may hold.
CACHE = 400_000
#: Characters that those entries may stand for: texts without white space make long ones.
CACHE_CHARS = 8_000_000
_END = "\0"
_NEVER = 1 << 60
#: Code points with the Unicode property White_Space, as a regex class body.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Codec:
    """Encoder and decoder of one vocabulary file with word ends."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for k, (a, b) in enumerate(model["merges"]):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.pair[left, right] = k
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = (left, right), k
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self.alphabet = byte_alphabet()
        singles = {*self.alphabet}
        self.automaton = ahocorasick.Automaton()
        for t, i in vocab.items():
            body, ends = (t[: -len(self.suffix)], True) if self.suffix and t.endswith(self.suffix) else (t, False)
            if (i in self.parts and self._is_own(i)) or (i not in self.parts and body in singles):
                self.automaton.add_word(body + _END * ends, (i, len(body) + ends))
        self.automaton.make_automaton()
        self._pretokens = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + _WHITE + r"\p{L}\p{N}]+").findall
        self._chunks = regex.compile(f"[^{_WHITE}]+").findall
        self._odd_space = regex.compile("[\x1c-\x1f]").search
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None

    def _spine(self, token: int, side: int, kept: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int]]:
        """The tokens at one edge of a token while it is built: (token, rank of the merge that ends it)."""
        if token not in kept:
            out, t, until = [], token, _NEVER
            while True:
                out.append((t, until))
                if t not in self.parts:
                    break
                t, until = self.parts[t][side], self.rank[t]
            kept[token] = out
        return kept[token]

    def fits(self, a: int, b: int, but: tuple[int, int] | None = None) -> bool:
        """Whether merging leaves the border between tokens a and b; ``but`` is a pair that may merge."""
        known = self._fits.get((a, b)) if but is None else None
        if known is None:
            known = not any(
                (p := self.pair.get((x, y))) is not None and p < x_until and p <= y_until and (x, y) != but
                for x, x_until in self._spine(a, 1, self._right)
                for y, y_until in self._spine(b, 0, self._left)
            )
            if but is None:
                if len(self._fits) > 2_000_000:
                    self._fits.clear()
                self._fits[a, b] = known
        return known

    def _is_own(self, token: int) -> bool:
        """Whether merging a token's text gives that token."""
        if token not in self.parts:
            return True
        a, b = self.parts[token]
        return self._is_own(a) and self._is_own(b) and self.fits(a, b, but=(a, b))

    def pretoken(self, text: str) -> list[int]:
        symbols = "".join([self.alphabet[b] for b in text.encode("utf-8", "surrogatepass")]) + _END * bool(self.suffix)
        last: list[tuple[int, int] | None] = [None] * (len(symbols) + 1)
        for end, (token, size) in self.automaton.iter(symbols):
            end += 1
            if last[end] is None:
                start = end - size
                if not start or ((before := last[start]) is not None and self.fits(before[0], token)):
                    last[end] = (token, start)
        out, at = [], len(symbols)
        while at:
            token, at = last[at]
            out.append(token)
        return out[::-1]

    def chunk(self, text: str) -> list[int]:
        """Ids of normalised text without white space."""
        return [i for p in self._pretokens(text) for i in self.pretoken(p)]

    def chunks(self, text: str | None) -> Iterator[tuple[int | None, list[str]]]:
        """The text as runs of normalised chunks and special tokens' ids, in order."""
        for k, part in enumerate(self._special(text) if self._special and "<" in (text or "") else [text or ""]):
            if k % 2:
                yield self.special[part], []
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3")
            part = part.lower()
            yield None, self._chunks(part) if self._odd_space(part) else part.split()

    def encode(self, text: str | None) -> list[int]:
        return [i for token, cs in self.chunks(text) for i in ([token] if token is not None else [j for c in cs for j in self.chunk(c)])]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.names[i] for i in ids])


class _Chunks(dict):
    """chunk -> what ``make`` gives for its ids.

    Two generations bound it: when the young one is full it becomes the old one,
    from which chunks that are met again move back, so frequent ones stay.
    """

    def __init__(self, codec: Codec, make) -> None:
        super().__init__()
        self.codec, self.make, self.old, self.chars = codec, make, {}, 0

    def __missing__(self, chunk: str):
        value = self.old.get(chunk)
        if value is None:
            value = self.make(self.codec.chunk(chunk))
        self[chunk] = value
        self.chars += len(chunk)
        return value

    def trim(self) -> None:
        if len(self) > CACHE // 2 or self.chars > CACHE_CHARS // 2:
            self.old, self.chars = dict(self), 0
            self.clear()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, once for each Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


_kept: dict[tuple[str, str], _Chunks] = {}


def _memory(path: str, kind: str, make) -> _Chunks:
    if (path, kind) not in _kept:
        _kept[path, kind] = _Chunks(codec(path), make)
    return _kept[path, kind]


def _texts(column: pa.Array) -> Iterator[str | None]:
    for x in column:
        yield x.as_py()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """docs with bpe_ids (array of int) and bpe_n (long)."""

    kept = [f.name for f in docs.schema.fields if f.name not in ("bpe_ids", "bpe_n")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        known = _memory(path, "ids", lambda ids: np.array(ids, np.int32))
        for batch in batches:
            flat, sizes = [], []
            for text in _texts(batch.column("text")):
                n = 0
                for token, cs in known.codec.chunks(text):
                    got = [np.array([token], np.int32)] if token is not None else list(map(known.__getitem__, cs))
                    flat += got
                    n += sum(map(len, got))
                sizes.append(n)
                known.trim()
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat) if flat else np.array([], np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(sizes, pa.int64())], names=[*batch.schema.names, "bpe_ids", "bpe_n"])

    narrow = docs.select(*[docs[f"`{c}`"] for c in kept])
    schema = T.StructType([*narrow.schema.fields, T.StructField("bpe_ids", T.ArrayType(T.IntegerType())), T.StructField("bpe_n", T.LongType())])
    return narrow.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded with bpe_text, the decoded bpe_ids."""
    narrow = encoded.select(*[encoded[f"`{c}`"] for c in encoded.columns if c != "bpe_text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(path).decode(x.as_py() or []) for x in batch.column("bpe_ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "bpe_text"])

    return narrow.mapInArrow(run, T.StructType([*narrow.schema.fields, T.StructField("bpe_text", T.StringType())]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, of which only digests leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        known = _memory(path, "text", lambda ids: (" ".join(map(str, ids)), c.decode(ids), len(ids)))
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in _texts(batch.column("text")):
                got = []
                for token, cs in c.chunks(text):
                    if token is not None:
                        got.append((str(token), c.names[token], 1))
                    else:
                        got += map(known.__getitem__, cs)
                n.append(sum([g[2] for g in got]))
                ids_sha.append(hashlib.sha256(" ".join([g[0] for g in got]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(" ".join([g[1] for g in got]).encode()).hexdigest())
                known.trim()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select("doc_id", "text")
    return narrow.mapInArrow(run, T.StructType([narrow.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))
