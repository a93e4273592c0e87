"""Token ids in raw binary shards with a minimal perfect hash index.

Documents are range-sorted by id; each task encodes its range and writes the
ids of one document after another, nothing else, to shard files (``.ids``, two
or four bytes an id, little-endian), and the documents' lengths beside them
(``.len``, eight bytes each). Shards in order of their number are the whole
corpus in ascending order of doc_id.

The index is dealt to buckets by a hash of the key, and buckets to files, of
which there are no more than shuffle partitions. A bucket holds a minimal
perfect hash (hash and displace: each small group of keys stores the
displacement that sends all its keys to free slots) and for each slot a
fingerprint of the key and where its runs lie: shard, row, position, copies. A
lookup costs one displacement, one slot and one comparison, whatever the
corpus; a key that isn't stored is refused but for 1 in 2**32. Many keys are
looked up by a Spark job (:func:`lookup`, :func:`fetch`), single ones by
:class:`Reader`, which reads a fixed number of short ranges.

Files appear by rename. The table of shards lies in the store's folder, and
``store.json`` is written last: a folder with it is a whole store, which
:func:`open_store` opens. A task that is run again leaves the same store.

Defined cases: a null text is an empty one, of one end id; a null doc_id is a
key like any other, first in order; rows that repeat a doc_id lie next to each
other, by hash of the text, and a lookup gives them all, one run for each shard
that holds some; an empty table gives a store without shards; a text must fit in
a task's memory; only doc_id and text are read, whatever else there is.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm import files
from weftline.llm.common import byte_alphabet
from weftline.scratch import fresh_path, materialize

#: Ids after which a task starts its next shard.
SHARD_IDS = 64 << 20
#: Keys in a bucket of the index, about.
BUCKET_KEYS = 20_000
MANIFEST = "store.json"
#: Keys in a group that shares a displacement, about.
GROUP_KEYS = 3
#: Bytes of text whose distinct units a task asks the library for at once, and units whose ids it gathers at once.
GROUP_BYTES = 16 << 20
GATHER = 1 << 18
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters that often end a word; the pattern always parts letters from a run of them.
_MARKS = ".,!?;:#*$%&|<>()"
#: How a unit's key tells what stands before it: nothing, or the unit as it is; a key without either follows a space.
_BARE, _SPECIAL, _AS_IS = "\x01", "\x02", "\x03"


def _runs(flat, start, size, units):
    """The ids of a run of units, and where each unit's begin, with the end."""
    import numpy as np

    sizes, ends = size[units], np.zeros(len(units) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    at = np.repeat(start[units] - ends[:-1], sizes)
    at += np.arange(ends[-1])
    return flat[at], ends


class Encoder:
    """Ids of texts by the tokenizers library, asked once for each distinct unit of a group of texts.

    A unit is what the byte-level pattern never joins with its neighbours: a run
    of other characters with the one space before it, or a run of white space.
    In plain text, where single spaces and line breaks part the words, Arrow
    splits a group of texts into units and numbers the distinct ones; other text
    is cut by a pattern. The ids of the units lie in one array, from which those
    of the texts are gathered; nothing is kept from group to group. A unit of letters
    is one pretoken and goes to the library's model, marks after it are a second
    one; the library's whole way takes every other unit. A vocabulary that isn't byte-level gets whole texts.
    """

    def __init__(self, path: str, width: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.tokenize = self.tok.model.tokenize
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"] or {}
        self.by_unit = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec["normalizer"]
        self.width, self.dtype = width, f"<u{width}"
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        marks = "|".join(map(re.escape, self.special))
        self.split = re.compile("(" + marks + ")").split if marks else lambda t: [t]
        self.units = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+").findall
        self.odd = "^[ \n]|[ \n]$|  |\n\n| \n|\n |[\x01-\x03\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]" + ("|" + marks if marks else "")
        self.letters = "^\x01?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+$"
        self.alphabet = byte_alphabet()
        self.code = {2: "H", 4: "I"}[width]

    def _ask(self, keys: pa.Array):
        """The ids of distinct units, one unit after another, and how many each has."""
        import numpy as np
        import pyarrow.compute as pc

        flat, sizes = array(self.code), []
        plain = pc.match_substring_regex(keys, self.letters).to_pylist() if self.by_unit else [False] * len(keys)
        for key, letters in zip(keys.to_pylist(), plain):
            if letters:
                unit = " " + key if key[0] != _BARE else key[1:]
                symbols = unit.replace(" ", "\u0120") if unit.isascii() else "".join([self.alphabet[b] for b in unit.encode()])
                ids = [t.id for t in self.tokenize(symbols)]
            elif key[:1] == _SPECIAL:
                ids = [self.special[key[1:]]]
            else:
                unit = key[1:] if key[:1] in (_BARE, _AS_IS) else key if key == "\n" else " " + key
                ids = self.tok.encode(unit, add_special_tokens=False).ids if unit else []
            flat.extend(ids)
            sizes.append(len(ids))
        return np.frombuffer(flat, self.dtype) if flat else np.zeros(0, self.dtype), np.array(sizes, np.int64)

    def _table(self, keys: pa.Array):
        """(ids, start, size) of distinct units. Letters and the marks after them are asked for apart, so fewer are asked for."""
        import numpy as np
        import pyarrow.compute as pc

        if not self.by_unit:
            ids, size = self._ask(keys)
            return ids, np.cumsum(size) - size, size
        stems = pc.utf8_rtrim(keys, characters=_MARKS)
        marked = pc.and_(pc.not_equal(stems, keys), pc.match_substring_regex(stems, self.letters))
        tails = pc.replace_substring_regex(keys.filter(marked), "^[^" + _MARKS + "]*", _BARE)
        parts = pa.concat_arrays([pc.if_else(marked, stems, keys), tails, pa.array([_BARE])]).dictionary_encode()
        number = parts.indices.to_numpy()
        pairs = np.full((len(keys), 2), number[-1])  # the last part is the empty unit
        pairs[:, 0] = number[: len(keys)]
        pairs[marked.to_numpy(zero_copy_only=False), 1] = number[len(keys) : -1]
        ids, size = self._ask(parts.dictionary)
        joined, ends = _runs(ids, np.cumsum(size) - size, size, pairs.ravel())
        return joined, ends[:-1:2], np.diff(ends[::2])

    def _gather(self, units: pa.Array, offsets) -> list[bytes]:
        """The ids of texts whose units' keys are given, in order, with the offsets of texts."""
        import numpy as np

        coded = units.dictionary_encode()
        table, which = self._table(coded.dictionary), coded.indices.to_numpy()
        out: list[bytes] = []
        first = 0
        while first < len(offsets) - 1:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + GATHER, "right")) - 1)
            ids, ends = _runs(*table, which[offsets[first] : offsets[last]])
            data, at = ids.tobytes(), (ends[offsets[first : last + 1] - offsets[first]] * self.width).tolist()
            out += [data[a:b] for a, b in zip(at, at[1:])]
            first = last
        return out

    def _plain(self, texts: pa.Array) -> list[bytes]:
        import pyarrow.compute as pc

        lines = pc.replace_substring(pc.binary_join_element_wise(_BARE, texts, ""), "\n", f" \n {_BARE}")
        words = pc.split_pattern(lines, " ")
        return self._gather(words.flatten(), words.offsets.to_numpy() - words.offsets[0].as_py())

    def _other(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        keys, offsets = [], [0]
        for text in texts:
            if self.by_unit:
                for k, part in enumerate(self.split(text)):
                    keys += [_SPECIAL + part] if k % 2 else [_AS_IS + u for u in self.units(part)]
            else:
                keys.append(_AS_IS + text)
            offsets.append(len(keys))
        return self._gather(pa.array(keys, pa.string()), np.array(offsets))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as raw little-endian bytes."""
        import numpy as np
        import pyarrow.compute as pc

        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False) if self.by_unit else np.ones(len(texts), bool)
        if not odd.any():
            return self._plain(texts)
        out: list[bytes] = [b""] * len(texts)
        for rows, encode in ((np.flatnonzero(~odd), self._plain), (np.flatnonzero(odd), lambda x: self._other(x.to_pylist()))):
            if len(rows):
                for k, data in zip(rows.tolist(), encode(texts.take(pa.array(rows)))):
                    out[k] = data
        return out


def groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about GROUP_BYTES of text each, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    before = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0)
    first = 0
    while first < len(before):
        done = before[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(before, done + GROUP_BYTES, "right")))
        yield first, last
        first = last


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder_of(path: str, width: int) -> Encoder:
    """The encoder of a file, once for each Python worker."""
    if (path, width) not in _encoders:
        _encoders[path, width] = Encoder(path, width)
    return _encoders[path, width]


@dataclass(frozen=True)
class Store:
    """A written store: its folder, bytes of an id, buckets of the index, buckets in an index file, and the table of shards (shard, n_ids, n_docs, start)."""

    folder: str
    width: int
    n_buckets: int
    per_file: int
    shards: DataFrame


_SHARDS = "shard long, n_ids long, n_docs long, start long"


def open_store(spark: SparkSession, folder: str) -> Store:
    """A store that was written before, from its folder alone."""
    facts = _facts(folder)
    return Store(folder, facts["width"], facts["n_buckets"], facts["per_file"], spark.read.schema(_SHARDS).parquet(folder + "/shards"))


def _facts(folder: str) -> dict:
    filesystem, path = files.at(folder)
    with filesystem.open_input_file(f"{path}/{MANIFEST}") as f:
        return json.loads(f.read())


def _key(doc_id: Column, n_buckets: int) -> list[Column]:
    h1, h2 = F.xxhash64(doc_id), F.xxhash64(F.lit(7), doc_id)
    return [F.pmod(h1, F.lit(n_buckets)).alias("bucket"), h1.alias("h1"), h2.alias("h2")]


def key_hashes(doc_id: int | None) -> tuple[int, int]:
    """The two hashes of a key as Spark computes them, unsigned."""
    import xxhash

    seeds = 42, xxhash.xxh64_intdigest(struct.pack("<i", 7), 42)
    return tuple(s if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), s) for s in seeds)


def write(docs: DataFrame, path: str, end_id: int = 0, width: int = 2, shard_ids: int = SHARD_IDS, bucket_keys: int = BUCKET_KEYS) -> Store:
    """Encode docs (doc_id, text) with the vocabulary at path, append end_id to each, and write shards and index."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "token-store")
    # the hash and the row's place in the input part rows that share an id, so that they too are dealt out
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        part, seq, out, lengths, row, at = TaskContext.get().partitionId(), 0, None, None, 0, 0
        encoder = encoder_of(path, width)
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            ids, column = batch.column("doc_id"), batch.column("text")
            for first, last in groups(column):
                some = ids.slice(first, last - first)
                shards, rows_at, positions, sizes = [], [], [], []
                for data in encoder.encode(column.slice(first, last - first)):
                    if out is None:
                        name, row, at = shard_name(part << 16 | seq), 0, 0
                        out, lengths = files.Committed(folder, name + ".ids"), files.Committed(folder, name + ".len")
                    n = len(data) // width + 1
                    out.write(data + end)
                    lengths.write(struct.pack("<q", n))
                    shards.append(part << 16 | seq)
                    rows_at.append(row)
                    positions.append(at)
                    sizes.append(n)
                    row, at = row + 1, at + n
                    if at >= shard_ids:
                        out.commit()
                        lengths.commit()
                        out, seq = None, seq + 1
                yield pa.RecordBatch.from_arrays([some, *(pa.array(x, pa.int64()) for x in (shards, rows_at, positions, sizes))], names=["doc_id", "shard", "row", "pos", "n"])
        if out is not None:
            out.commit()
            lengths.commit()

    placed = materialize(ranged.mapInArrow(run, "doc_id long, shard long, row long, pos long, n long"), "token-places")
    per_shard = placed.groupBy("shard").agg(F.sum("n").alias("n_ids"), F.count("*").alias("n_docs"))
    # a row for each shard file, not for each document
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per_shard.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long")).write.parquet(folder + "/shards")
    runs = materialize(placed.groupBy("doc_id", "shard").agg(F.min("row").alias("row"), F.min("pos").alias("pos"), F.count("*").alias("copies")), "token-runs")
    n_buckets = max(1, -(-runs.count() // bucket_keys))
    # no more index files than the session has shuffle partitions, whatever the number of keys
    per_file = -(-n_buckets // int(spark.conf.get("spark.sql.shuffle.partitions")))
    _write_index(runs, folder, n_buckets, per_file)
    manifest = files.Committed(folder, MANIFEST)
    manifest.write(json.dumps({"width": width, "end_id": end_id, "n_buckets": n_buckets, "per_file": per_file}).encode())
    manifest.commit()
    return open_store(spark, folder)


class PerfectHash:
    """Minimal perfect hash of keys given by two 64-bit hashes each."""

    def __init__(self, size: int, moves) -> None:
        self.size, self.moves = size, moves

    @staticmethod
    def _slot(h2, move, size: int):
        import numpy as np

        x = h2 + move.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(29))) % np.uint64(size)

    @classmethod
    def build(cls, h1, h2) -> PerfectHash:
        import numpy as np

        size = len(h1)
        n_groups = max(1, -(-size // GROUP_KEYS))
        group = cls.group(h1, n_groups)
        order = np.argsort(group, kind="stable")
        starts = np.searchsorted(group[order], np.arange(n_groups + 1))
        moves, taken, singles = np.zeros(n_groups, np.int64), np.zeros(size, bool), []
        for g in np.argsort(-np.diff(starts), kind="stable"):
            own = order[starts[g] : starts[g + 1]]
            if len(own) < 2:
                singles += [(g, k) for k in own]
                continue
            first, slots = 0, None
            while slots is None:
                # a block of displacements at once; the least that sends all keys of the group to free slots
                moves_tried = np.arange(first, first + 64)
                at = cls._slot(h2[own][None, :], moves_tried[:, None], size)
                free = ~taken[at].any(1)
                if len(own) > 1:
                    ordered = np.sort(at, 1)
                    free &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
                hit = np.flatnonzero(free)
                if len(hit):
                    move, slots = int(moves_tried[hit[0]]), at[hit[0]]
                first += 64
                if first > 1 << 24:
                    raise ValueError("two keys of the index have equal hashes")
            taken[slots] = True
            moves[g] = move
        # groups of one key name their slot: what is left needs no search
        for (g, _), slot in zip(singles, np.flatnonzero(~taken)):
            moves[g] = -int(slot) - 1
        return cls(size, moves)

    @staticmethod
    def group(h1, n_groups: int):
        import numpy as np

        return ((h1 >> np.uint64(20)) % np.uint64(n_groups)).astype(np.int64)

    @classmethod
    def place(cls, h2, move, size: int):
        """Slots from displacements: a negative one names the slot."""
        import numpy as np

        return np.where(move < 0, -move - 1, cls._slot(h2, np.maximum(move, 0), size).astype(np.int64))

    def find(self, h1, h2):
        """Slots of keys; any slot for keys that weren't built in."""
        return self.place(h2, self.moves[self.group(h1, len(self.moves))], self.size)


def _fingerprint(h1, h2):
    import numpy as np

    return ((h1 * np.uint64(0xC2B2AE3D27D4EB4F) ^ h2) >> np.uint64(32)).astype(np.uint32)


def _write_index(runs: DataFrame, folder: str, n_buckets: int, per_file: int) -> None:
    n_files = -(-n_buckets // per_file)
    keyed = runs.select(*_key(F.col("doc_id"), n_buckets), "shard", "row", "pos", "copies").withColumn("file", F.expr(f"bucket div {per_file}"))
    keyed = keyed.repartitionByRange(n_files, "file").sortWithinPartitions("bucket", "h1", "h2", "shard")

    def bucket_bytes(rows) -> bytes:
        import numpy as np

        h1, h2 = rows[:, 1].astype(np.uint64), rows[:, 2].astype(np.uint64)
        first = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
        n_runs = np.diff(np.append(first, len(rows)))
        k1, k2 = h1[first], h2[first]
        table = PerfectHash.build(k1, k2)
        slot = table.find(k1, k2)
        prints, heads = np.empty(table.size, np.uint32), np.empty((table.size, 2), np.int64)
        prints[slot], heads[slot] = _fingerprint(k1, k2), np.stack([first, n_runs], 1)
        return struct.pack("<qqq", table.size, len(table.moves), len(rows)) + b"".join(np.ascontiguousarray(x).tobytes() for x in (table.moves, heads, rows[:, 3:7], prints))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held, current, out, file, places = [], None, None, None, None
        n = 0

        def bucket_done() -> None:
            if held:
                at = out.size
                out.write(bucket_bytes(np.concatenate(held)))
                places[current - file * per_file] = at, out.size
                held.clear()

        def file_done() -> None:
            if out is not None:
                out.write(places.tobytes())
                out.commit()

        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy() for k in range(batch.num_columns)], 1)
            for bucket in np.unique(rows[:, 0]):
                if bucket != current:
                    bucket_done()
                    if bucket // per_file != file:
                        file_done()
                        file, n = int(bucket // per_file), n + 1
                        out, places = files.Committed(folder, index_name(file)), np.zeros((per_file, 2), np.int64)
                    current = int(bucket)
                held.append(rows[rows[:, 0] == bucket])
        bucket_done()
        file_done()
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    materialize(keyed.mapInArrow(run, "n long"), "token-index")


def index_name(file: int) -> str:
    return f"index-{file:06d}.mph"


class Bucket:
    """One bucket of the index, in a file of ``per_file`` of them; where each lies stands at the file's end.

    ``find`` reads the bucket once for many keys. ``find_one`` reads a fixed
    number of short ranges, whatever the bucket's size: one displacement, one
    fingerprint, one head and the key's own runs.
    """

    def __init__(self, folder: str, bucket: int, per_file: int) -> None:
        filesystem, path = files.at(folder)
        name = f"{path}/{index_name(bucket // per_file)}"
        self.size, self.loaded = 0, False
        from pyarrow import fs

        if filesystem.get_file_info(name).type == fs.FileType.NotFound:
            return
        self.file = filesystem.open_input_file(name)
        self.at, self.end = struct.unpack("<qq", self._read(self.file.size() - 16 * (per_file - bucket % per_file), 16))
        if self.end > self.at:
            self.size, self.n_moves, self.n_runs = struct.unpack("<qqq", self._read(self.at, 24))

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _load(self) -> None:
        import numpy as np

        data, at = self._read(self.at, self.end - self.at), 24
        self.table = PerfectHash(self.size, np.frombuffer(data, np.int64, self.n_moves, at))
        at += 8 * self.n_moves
        self.heads = np.frombuffer(data, np.int64, 2 * self.size, at).reshape(-1, 2)
        at += 16 * self.size
        self.runs = np.frombuffer(data, np.int64, 4 * self.n_runs, at).reshape(-1, 4)
        self.prints = np.frombuffer(data, np.uint32, self.size, at + 32 * self.n_runs)
        self.loaded = True

    def find(self, h1, h2):
        """(position among the keys given, run) for each run of each key that is stored."""
        import numpy as np

        if not self.size:
            return np.zeros(0, np.int64), np.zeros((0, 4), np.int64)
        if not self.loaded:
            self._load()
        slot = self.table.find(h1, h2)
        hit = np.flatnonzero(self.prints[slot] == _fingerprint(h1, h2))
        head, n = self.heads[slot[hit]].T
        which = np.repeat(hit, n)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return which, self.runs[np.repeat(head, n) + offset]

    def find_one(self, h1: int, h2: int):
        """The runs (shard, row, pos, copies) of one key, none if it isn't stored."""
        import numpy as np

        if not self.size:
            return np.zeros((0, 4), np.int64)
        k1, k2 = np.array([h1], np.uint64), np.array([h2], np.uint64)
        moves = self.at + 24
        group = int(PerfectHash.group(k1, self.n_moves)[0])
        move = np.frombuffer(self._read(moves + 8 * group, 8), np.int64)
        slot = int(PerfectHash.place(k2, move, self.size)[0])
        heads = moves + 8 * self.n_moves
        runs = heads + 16 * self.size
        (print_,) = struct.unpack("<I", self._read(runs + 32 * self.n_runs + 4 * slot, 4))
        if print_ != int(_fingerprint(k1, k2)[0]):
            return np.zeros((0, 4), np.int64)
        first, n = struct.unpack("<qq", self._read(heads + 16 * slot, 16))
        return np.frombuffer(self._read(runs + 32 * first, 32 * n), np.int64).reshape(-1, 4)


class Reader:
    """Keyed access to a store's files without a Spark job, a fixed number of short reads a key."""

    def __init__(self, folder: str) -> None:
        self.folder, facts = folder, _facts(folder)
        self.width, self.n_buckets, self.per_file = facts["width"], facts["n_buckets"], facts["per_file"]

    def get(self, doc_id: int | None) -> list:
        """The ids of each document stored under a key."""
        import numpy as np

        h1, h2 = key_hashes(doc_id)
        bucket = (h1 - (1 << 64) if h1 >> 63 else h1) % self.n_buckets
        out = []
        for shard, row, pos, copies in Bucket(self.folder, bucket, self.per_file).find_one(h1, h2).tolist():
            name = shard_name(shard)
            sizes = np.frombuffer(files.Window(self.folder, name + ".len", 0).read(8 * row, 8 * copies), np.int64)
            ids = np.frombuffer(files.Window(self.folder, name + ".ids", 0).read(pos * self.width, int(sizes.sum()) * self.width), f"<u{self.width}")
            out += np.split(ids, np.cumsum(sizes)[:-1])
        return out


def shard_name(shard: int) -> str:
    return f"shard-{shard >> 16:06d}-{shard & 65535:04d}"


def lookup(store: Store, keys: DataFrame) -> DataFrame:
    """The runs of the keys' documents: doc_id, shard, row, pos, copies. Keys that aren't stored give none."""
    folder, per_file = store.folder, store.per_file
    keyed = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().select("doc_id", *_key(F.col("doc_id"), store.n_buckets))
    keyed = keyed.withColumn("file", F.expr(f"bucket div {per_file}")).repartitionByRange(-(-store.n_buckets // per_file), "file").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        current, bucket = None, None
        for batch in batches:
            b, h1, h2 = (batch.column(c).to_numpy() for c in ("bucket", "h1", "h2"))
            for value in np.unique(b):
                if value != current:
                    current, bucket = value, Bucket(folder, int(value), per_file)
                own = np.flatnonzero(b == value)
                which, found = bucket.find(h1[own].astype(np.uint64), h2[own].astype(np.uint64))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(own[which])), *(pa.array(found[:, k]) for k in range(4))], names=["doc_id", "shard", "row", "pos", "copies"])

    return keyed.mapInArrow(run, "doc_id long, shard long, row long, pos long, copies long")


def fetch(store: Store, runs: DataFrame, with_ids: bool = False) -> DataFrame:
    """Read runs' ids back from the shards: doc_id, start, n_tokens, ids_crc32, and the ids themselves if asked for."""
    folder, width = store.folder, store.width
    placed = runs.join(store.shards.select("shard", "start"), "shard").repartition("shard").sortWithinPartitions("shard", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        current, payload, lengths = None, None, None
        names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc, shard, row, pos, copies, start in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "shard", "row", "pos", "copies", "start"))):
                if shard != current:
                    name = shard_name(shard)
                    current, payload, lengths = shard, files.Window(folder, name + ".ids"), files.Window(folder, name + ".len")
                for k in range(copies):
                    (n,) = struct.unpack("<q", lengths.read(8 * (row + k), 8))
                    ids = np.frombuffer(payload.read(pos * width, n * width), f"<u{width}")
                    for column, value in zip(rows, (doc, start + pos, n, zlib.crc32(ids.astype("<u4").tobytes()), ids.astype(np.int32))):
                        column.append(value)
                    pos += n
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds)], names=names)

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))
