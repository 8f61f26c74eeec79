"""Token-id shards with a minimal perfect hash index.

Texts are encoded, an end id is appended, and the ids of documents in
ascending key order are written as raw little-endian integers into shard
files of bounded size.  Each shard carries an index from document key to its
records: a minimal perfect hash (levels of bit arrays; a key sits where it is
alone, its rank among set bits is its slot), and per slot a 32-bit
fingerprint of the key, the first record and the number of records.  A lookup
touches one slot and one offset pair, whatever the shard's size; a key that
is not stored fails the fingerprint but for one in 2**32 and then the key.

File: 8 bytes magic, 8 bytes header length, JSON header (item type, counts,
level sizes, place of each section), sections: ids, offsets (uint64, records
+ 1), keys (int64), bits, fingerprints (uint32), first (uint32), count
(uint32).

Files are written under the shared checkpoint folder by the tasks; the
manifest (one row per shard) holds only files of tasks that ended, so a task
that runs again leaves at most files that nothing refers to.

Defined results: a null or empty text has the end id only; a null key sorts
first and is stored beside the index; rows repeated with one key are
consecutive records of its slot; an empty table has no shards; other columns
are not read.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickweave.llm.common import batch, prepare, written
from clickweave.session import scratch_path

MAGIC = b"CWSHARD1"
END_ID = 1
#: Ids of one shard, about (its memory while it is written).
SHARD_IDS = 4_000_000
#: Bits per remaining key in a level of the hash.
GAMMA = 2
#: Words kept per Python worker with their ids.
STORED_WORDS = 700_000


# ---- minimal perfect hash ----------------------------------------------------------


def mix64(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit integers for each seed."""
    x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays of the levels for distinct keys."""
    levels = []
    while len(keys):
        size = GAMMA * len(keys)
        at = (mix64(keys, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, bool)
        bits[at[alone]] = True
        levels.append(bits)
        keys = keys[~alone]
    return levels


def find_slots(levels: list[np.ndarray], ranks: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Slot of each key (any slot or -1 for keys that were not there when it was built)."""
    out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for i, bits in enumerate(levels):
        at = (mix64(keys[left], i) % np.uint64(len(bits))).astype(np.int64)
        hit = bits[at]
        out[left[hit]] = base + ranks[i][at[hit]] - 1
        left, base = left[~hit], base + int(ranks[i][-1])
    return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


# ---- shard files ---------------------------------------------------------------------


def write_shard(path: str, keys: list, ids: list[np.ndarray], item: str) -> None:
    """``keys`` ascending, null first; ``ids`` one array per record."""
    offsets = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    nulls = sum(k is None for k in keys)
    stored = np.array([0 if k is None else k for k in keys], np.int64)
    distinct, first, count = np.unique(stored[nulls:], return_index=True, return_counts=True)
    levels = build_levels(distinct)
    slots = find_slots(levels, [np.cumsum(b) for b in levels], distinct)
    table = np.zeros((3, len(distinct)), np.uint32)
    table[:, slots] = fingerprints(distinct), first + nulls, count
    parts = {"ids": (np.concatenate(ids) if ids else np.zeros(0)).astype(item), "offsets": offsets, "keys": stored,
             "bits": np.packbits(np.concatenate(levels)) if levels else np.zeros(0, np.uint8),
             "fingerprints": table[0], "first": table[1], "count": table[2]}
    head = {"records": len(ids), "nulls": nulls, "levels": [len(b) for b in levels], "parts": {}}
    at = 0
    for name, a in parts.items():
        head["parts"][name] = [a.dtype.newbyteorder("<").str, at, len(a)]
        at += a.nbytes
    text = json.dumps(head).encode()
    system, where = fs.FileSystem.from_uri(path)
    system.create_dir(os.path.dirname(where), recursive=True)
    with system.open_output_stream(where) as f:
        f.write(MAGIC + struct.pack("<Q", len(text)) + text)
        for a in parts.values():
            f.write(a.astype(a.dtype.newbyteorder("<")).tobytes())


class Shard:
    """Keyed access to one shard; sections are read when first used, ids only as asked for."""

    def __init__(self, path: str):
        system, where = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(where)
        magic, size = struct.unpack("<8sQ", self.file.read_at(16, 0))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token shard")
        self.head = json.loads(self.file.read_at(size, 16))
        self.start = 16 + size

    def section(self, name: str, begin: int = 0, end: int | None = None) -> np.ndarray:
        kind, at, n = self.head["parts"][name]
        end, width = n if end is None else end, np.dtype(kind).itemsize
        return np.frombuffer(self.file.read_at((end - begin) * width, self.start + at + begin * width), kind)

    @functools.cached_property
    def index(self):
        sizes = self.head["levels"]
        bits = np.unpackbits(self.section("bits"), count=sum(sizes)).astype(bool)
        levels = np.split(bits, np.cumsum(sizes)[:-1]) if sizes else []
        return levels, [np.cumsum(b) for b in levels], self.section("fingerprints"), self.section("first"), self.section("count")

    @functools.cached_property
    def keys(self) -> list:
        n = self.head["nulls"]
        return [None] * n + self.section("keys")[n:].tolist()

    def records(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key (0 where it is not stored)."""
        levels, ranks, prints, first, count = self.index
        slot = find_slots(levels, ranks, keys)
        ok = (slot >= 0) & (prints[slot] == fingerprints(keys)) if len(prints) else np.zeros(len(keys), bool)
        at = np.where(ok, first[slot], 0) if len(prints) else np.zeros(len(keys), np.int64)
        ok &= self.section("keys")[at] == keys if len(prints) else False
        return at.astype(np.int64), np.where(ok, count[slot], 0) if len(prints) else np.zeros(len(keys), np.int64)

    def get(self, key: int | None) -> list[np.ndarray]:
        """The ids of every record of a key."""
        if key is None:
            first, n = 0, self.head["nulls"]
        else:
            first, n = (int(x[0]) for x in self.records(np.array([key], np.int64)))
        at = self.section("offsets", first, first + n + 1).astype(np.int64)
        return [self.section("ids", *at[i:i + 2]) for i in range(n)]


# ---- encoding -----------------------------------------------------------------------


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), {}


#: Byte to printable character, the alphabet of byte-level models: visible Latin-1 characters stand
#: for themselves, the others follow from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: b for b in _VISIBLE} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_VISIBLE)))}


class _Parts(dict):
    """Ids (as bytes) of the blank-separated parts of texts, encoded when first asked for.

    For a tokenizer that drops white space, never joins across it and
    lower-cases, a part of letters alone is one lower-cased piece of the
    model, and a closing ASCII mark behind a letter or digit is a piece of its
    own; every other part goes through the whole tokenizer.
    """

    def __init__(self, tokenizer, item: str, byte_level: bool):
        super().__init__()
        self.tokenizer, self.model, self.item, self.byte_level = tokenizer, tokenizer.model, item, byte_level
        self.words: dict[str, bytes] = {}

    def word(self, part: str) -> bytes:
        got = self.words.get(part)
        if got is None:
            low = part if not part.isascii() else part.lower()
            if self.byte_level and low.isalpha() and (low.isascii() or low == low.lower() and unicodedata.is_normalized("NFC", low)):
                ids = [t.id for t in self.model.tokenize(low.encode().decode("latin-1").translate(_ALPHABET))]
            else:
                ids = self.tokenizer.encode(part, add_special_tokens=False).ids
            if len(self.words) >= STORED_WORDS:
                self.words.clear()
            got = self.words[part] = np.array(ids, self.item).tobytes()
        return got

    def __missing__(self, part: str) -> bytes:
        if len(self) >= STORED_WORDS:
            self.clear()
        if not part:
            got = b""
        elif part.isascii() and "<|" not in part:
            low = part.lower()
            if len(low) > 1 and low[-1] in ".,!?;:" and low[-2].isalnum():
                got = self.word(low[:-1]) + self.word(low[-1])
            else:
                got = self.word(low)
        else:
            got = self.word(part)
        self[part] = got
        return got


def batch_encoder(path: str, item: str):
    """list of texts -> list of the bytes of their ids, as the library encodes the whole texts."""
    tok, stores = _tokenizer(path)
    if item not in stores:
        kinds = str(json.loads(tok.to_str())["pre_tokenizer"])
        stores[item] = _Parts(tok, item, "ByteLevel" in kinds)
    ids_of = stores[item].__getitem__

    def encode(texts: list[str | None]) -> list[bytes]:
        return [b"".join(map(ids_of, t.replace("\n", " ").replace("\t", " ").split(" "))) if t else b"" for t in texts]

    return encode


# ---- Spark jobs ---------------------------------------------------------------------

_CODED = pa.schema([("range", pa.int32()), ("key", pa.int64()), ("ids", pa.binary())])
_MANIFEST = pa.schema([("range", pa.int32()), ("part", pa.int32()), ("path", pa.string()), ("records", pa.int64()),
                       ("n_ids", pa.int64()), ("first_key", pa.int64()), ("last_key", pa.int64())])
_RECORDS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write_shards(docs: DataFrame, path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, item: str = "<u2", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode, order by key and write; returns the manifest.

    Ranges of keys come from approximate quantiles of the id column, so only
    encoded ids are shuffled, once.  ``item`` is the id type in the files
    (two bytes hold a vocabulary of up to 65,536 ids).
    """
    spark = prepare(docs.sparkSession)
    folder = folder or scratch_path(spark, "token-shards")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(id_col).cast("long")
    cuts = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)] if n > 1 else [0.5], 1000 + 10 * n)).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = batch_encoder(path, item)
        end = np.array([end_id], item).tobytes()
        for b in batches:
            keys = b.column(0)
            place = np.searchsorted(bounds, np.asarray(keys.fill_null(np.iinfo(np.int64).min)), "left")
            ids = [x + end for x in encode(b.column(1).to_pylist())]
            yield batch(_CODED, [place.astype(np.int32), keys, ids])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, held, part, current = [], [], 0, 0, None

        def flush() -> pa.RecordBatch:
            where = f"{folder}/{current:06d}-{part:06d}-{uuid.uuid4().hex[:12]}.shard"
            write_shard(where, keys, ids, item)
            return batch(_MANIFEST, [[current], [part], [where], [len(ids)], [held], [keys[0]], [keys[-1]]])

        for b in batches:
            for place, k, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if ids and (place != current or held >= shard_ids):
                    yield flush()
                    part = part + 1 if place == current else 0
                    keys, ids, held = [], [], 0
                current = place
                keys.append(k)
                ids.append(np.frombuffer(data, item))
                held += len(ids[-1])
        if ids:
            yield flush()

    rows = docs.select(key.alias("key"), F.col(text_col).cast("string").alias("text"))
    coded = rows.mapInArrow(code, "range int, key long, ids binary")
    ordered = coded.repartition(n, "range").sortWithinPartitions("range", "key", "ids")
    return written(ordered.mapInArrow(write, "range int, part int, path string, records long, n_ids long, first_key long, last_key long"), "token-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every record through the index: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all records before; the running sum is over
    the manifest, one narrow row per shard.
    """
    before = F.sum("n_ids").over(Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("path", F.coalesce(before, F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                shard = Shard(path)
                nulls, keys = shard.head["nulls"], np.array(shard.keys[shard.head["nulls"]:], np.int64)
                distinct = np.unique(keys)
                first, count = shard.records(distinct)
                record = np.repeat(first, count) + np.concatenate([np.arange(c) for c in count] or [np.zeros(0, np.int64)])
                record = np.concatenate([np.arange(nulls), record]).astype(np.int64)
                names = [None] * nulls + np.repeat(distinct, count).tolist()
                offsets, ids = shard.section("offsets").astype(np.int64), shard.section("ids").astype("<u4")
                begin, end = offsets[record], offsets[record + 1]
                crc = [zlib.crc32(ids[i:j].tobytes()) for i, j in zip(begin.tolist(), end.tolist(), strict=True)]
                yield batch(_RECORDS, [names, begin + base, end - begin, crc])

    n = max(1, min(manifest.count(), 10 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return placed.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
