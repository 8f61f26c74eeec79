"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece (one match of the split pattern) the table keeps
the one valid last token: the token that ends the encoding of that prefix.
A token fits behind the last token of the prefix before it when the two,
encoded together, stay these two tokens.  The last tokens do not depend on
what follows, so appended bytes only add entries, and after an edit only the
entries from the edited byte on are computed anew.  The ids are read off the
table from its end.

A piece that is itself in the vocabulary is one token, as in the rank-file
library.  Pieces repeat, so each Python worker keeps a bounded store of the
ids of pieces it has seen.  The unseen pieces of a group of texts are encoded
together: their tables grow side by side, one byte at a time, as arrays.

Defined results: a null or empty text has no ids (digests of the empty
string); a null id stays null; repeated rows give repeated results; an
empty table gives an empty result; other columns are not read.  Texts of any
length are encoded whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import arrow_map, batch

#: Pieces kept per Python worker; beyond it the store starts again (memory bound, not a limit on pieces).
STORED_PIECES = 400_000
#: Tables of piece beginnings of these lengths are kept as well, up to so many.
SHARED_PREFIXES = (12, 8, 4)
STORED_TABLES = 100_000
#: Characters of the texts whose unseen pieces are encoded together (a longer text is a group of its own), the pieces of
#: one array, and the longest ones in it (longer ones are encoded one by one).
GROUP_CHARS = 2_000_000
SIDE_BY_SIDE = 50_000
LONGEST_PIECE = 64
#: Ids decoded at a time.
DECODED_IDS = 100_000


class KeyTable:
    """Non-negative integer keys to values, looked up for whole arrays (linear probing)."""

    def __init__(self, keys, values):
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int32)
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            placed = self.keys[at] == keys
            self.values[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], (at[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys; -1 for those not in the table."""
        at = self._slot(keys)
        there, out = self.keys[at], self.values[at]
        other = np.flatnonzero(there != keys)
        out[other] = -1
        other = other[there[other] >= 0]
        while len(other):
            at[other] = (at[other] + 1) & self.mask
            there = self.keys[at[other]]
            hit = there == keys[other]
            out[other[hit]] = self.values[at[other[hit]]]
            other = other[~hit & (there >= 0)]
        return out


class ByteBPE:
    """Encoder and decoder for a rank file; ``encode`` takes the bytes of one piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._fits: dict[tuple[int, int], bool] = {}
        self._tables: dict[bytes, list[int]] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        #: Tokens that merging their own bytes gives; the others never end a prefix.
        self.usable = {b: i for b, i in ranks.items() if self.merged(b) == [i]}
        #: Longest usable token by its last four bytes (shorter tokens need no entry).
        self._reach: dict[bytes, int] = {}
        for b in self.usable:
            if len(b) >= 4:
                self._reach[b[-4:]] = max(len(b), self._reach.get(b[-4:], 0))

    @classmethod
    def load(cls, path: str) -> "ByteBPE":
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def merged(self, data: bytes, below: int = 1 << 40) -> list[int]:
        """Merge by rank, leftmost first, with ranks under ``below``: the definition, used on single tokens."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.ranks.get(parts[i] + parts[i + 1], 1 << 40), i))
            if self.ranks.get(parts[best] + parts[best + 1], below) >= below:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge, done last, makes this one; None for single bytes."""
        if token not in self._halves:
            data = self.bytes_of[token]
            parts = self.merged(data, below=token)
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay two tokens when encoded together.

        Walk back through the merges that built the two, the latest first.  At
        each moment only one fragment touches the border from each side; the
        border would have been merged away if these two make a token of a
        lower rank than the merge undone last (equal ranks go to the leftmost
        pair, so on the right side an equal rank is merged away too).
        """
        got = self._fits.get((left, right))
        if got is not None:
            return got
        a, b, before = left, right, 1 << 40
        while True:
            joined = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if joined is not None and joined < before:
                got = False
                break
            ha, hb = self.halves(a), self.halves(b)
            if ha is None and hb is None:
                got = True
                break
            if hb is None or (ha is not None and a > b):
                before, a = a, ha[1]
            else:
                before, b = b + 1, hb[0]
        if len(self._fits) > 1_000_000:
            self._fits.clear()
        self._fits[left, right] = got
        return got

    @functools.cached_property
    def _arrays(self) -> tuple[KeyTable, np.ndarray, np.ndarray, KeyTable, np.ndarray]:
        """What ``encode_many`` looks up: joined tokens by (left, right), the inner halves of each token (-1: none), and
        the usable tokens as a trie of their bytes from the last to the first."""
        joined, children, ends = {}, {}, [-1]
        left_of, right_of = (np.full(max(self.bytes_of) + 1, -1, np.int64) for _ in range(2))
        for token, data in self.bytes_of.items():
            for k in range(1, len(data)):
                a, b = self.ranks.get(data[:k]), self.ranks.get(data[k:])
                if a is not None and b is not None:
                    joined[a << 32 | b] = token
            parts = self.halves(token)
            if parts:
                left_of[token], right_of[token] = parts
        for data, token in self.usable.items():
            node = 0
            for x in reversed(data):
                key = node << 8 | x
                if key not in children:
                    children[key] = len(ends)
                    ends.append(-1)
                node = children[key]
            ends[node] = token
        return (KeyTable(list(joined), list(joined.values())), left_of, right_of,
                KeyTable(list(children), list(children.values())), np.array(ends, np.int64))

    def fit_many(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``fits`` for arrays of tokens."""
        joined, left_of, right_of, _, _ = self._arrays
        out = np.ones(len(left), bool)
        a, b, before, at = left, right, np.full(len(left), 1 << 40), np.arange(len(left))
        while len(at):
            j = joined.get(a << 32 | b)
            bad = (j >= 0) & (j < before)
            out[at[bad]] = False
            ha, hb = right_of[a], left_of[b]
            go = np.flatnonzero(~bad & ((ha >= 0) | (hb >= 0)))
            a, b, ha, hb, at = a[go], b[go], ha[go], hb[go], at[go]
            undo = (hb < 0) | ((ha >= 0) & (a > b))
            before, a, b = np.where(undo, a, b + 1), np.where(undo, ha, a), np.where(undo, b, hb)
        return out

    def tables(self, pieces: list[bytes]) -> np.ndarray:
        """The prefix tables of pieces (longest first), side by side: entry ``end`` of a row is the last token of so many bytes."""
        _, _, _, child, ends = self._arrays
        sizes = np.array([len(p) for p in pieces])
        data = np.zeros((len(pieces), sizes[0]), np.int64)
        data[np.arange(sizes[0]) < sizes[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        last = np.full((len(pieces), sizes[0] + 1), -1, np.int64)
        for end in range(1, sizes[0] + 1):
            at = np.arange(int(np.searchsorted(-sizes, -end, "right")))  # the pieces of so many bytes
            node, found = np.zeros(len(at), np.int64), []
            for size in range(1, end + 1):
                node = child.get(node << 8 | data[at, end - size]).astype(np.int64)
                at, node = at[node >= 0], node[node >= 0]
                if not len(at):
                    break
                token = ends[node]
                found.append((size, at[token >= 0], token[token >= 0]))
            for size, rows, token in reversed(found):
                open_ = last[rows, end] < 0
                rows, token = rows[open_], token[open_]
                if size < end:
                    ok = self.fit_many(last[rows, end - size], token)
                    rows, token = rows[ok], token[ok]
                last[rows, end] = token
        if (last[np.arange(len(pieces)), sizes] < 0).any():
            raise ValueError("the rank file lacks single bytes")
        return last

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        todo = []
        for i, p in enumerate(pieces):
            if p in self.ranks or not 0 < len(p) <= LONGEST_PIECE:
                out[i] = np.array(self.encode(p), "<u4").tobytes()
            else:
                todo.append(i)
        todo.sort(key=lambda i: -len(pieces[i]))
        for k in range(0, len(todo), SIDE_BY_SIDE):
            part = todo[k:k + SIDE_BY_SIDE]
            last = self.tables([pieces[i] for i in part])
            rows, end = np.arange(len(part)), np.array([len(pieces[i]) for i in part])
            ids, first = np.zeros((len(part), end[0]), "<u4"), np.full(len(part), end[0])
            while len(rows):
                token = last[rows, end]
                first[rows] -= 1
                ids[rows, first[rows]] = token
                end = end - self._sizes[token]
                rows, end = rows[end > 0], end[end > 0]
            for i, row, f in zip(part, ids, first.tolist()):
                out[i] = row[f:].tobytes()
        return out

    @functools.cached_property
    def _sizes(self) -> np.ndarray:
        sizes = np.zeros(max(self.bytes_of) + 1, np.int64)
        for token, data in self.bytes_of.items():
            sizes[token] = len(data)
        return sizes

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Fill ``last`` (one entry per prefix computed so far) up to the whole of ``data``."""
        rank_of, known, reach = self.usable.get, self._fits.get, self._reach.get
        for end in range(len(last) + 1, len(data) + 1):
            far = reach(data[end - 4:end], 3) if end >= 4 else end
            for start in range(end - far if end > far else 0, end):
                token = rank_of(data[start:end])
                if token is None:
                    continue
                if start:
                    ok = known((last[start - 1], token))
                    if not (self.fits(last[start - 1], token) if ok is None else ok):
                        continue
                last.append(token)
                break
            else:
                raise ValueError("the rank file lacks single bytes")
        return last

    def read_off(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes_of[out[-1]])
        return out[::-1]

    def table(self, data: bytes) -> list[int]:
        """The prefix table of a piece; the tables of its first bytes are kept, as pieces share beginnings."""
        last: list[int] = []
        missing = []
        for n in SHARED_PREFIXES:
            if len(data) > n:
                got = self._tables.get(data[:n])
                if got is not None:
                    last = list(got)
                    break
                missing.append(n)
        if len(self._tables) >= STORED_TABLES:
            self._tables.clear()
        for n in missing[::-1]:
            self._tables[data[:n]] = list(self.extend(data[:n], last))
        return self.extend(data, last)

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.read_off(self.table(data))

    @functools.cached_property
    def _spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens in a row, and where each token starts."""
        return np.frombuffer(b"".join(self.bytes_of[i] for i in sorted(self.bytes_of)), np.uint8), np.cumsum(self._sizes) - self._sizes

    def decode(self, ids) -> bytes:
        ids, out = np.asarray(ids, np.int64), []
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self._sizes) or not self._sizes[ids].all()):
            raise KeyError("an id without a token")
        spelled, starts = self._spelled
        for k in range(0, len(ids), DECODED_IDS):
            part = ids[k:k + DECODED_IDS]
            sizes = self._sizes[part]
            ends = np.cumsum(sizes)
            out.append(spelled[np.repeat(starts[part] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes())
        return b"".join(out)


class EditablePiece:
    """A piece with its prefix table, for exact appends and edits."""

    def __init__(self, bpe: ByteBPE, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last)

    def splice(self, at: int, deleted: int, inserted: bytes) -> None:
        """Replace ``deleted`` bytes at ``at``.  Entries before the edit stay; behind it computing
        stops as soon as the new entries have agreed with the old ones for a longest token."""
        tail, old = self.data[at + deleted:], self.last[at + deleted:]
        self.last = self.last[:at]
        self.data = self.data[:at] + inserted
        self.bpe.extend(self.data, self.last)
        agreed = 0
        for i in range(len(tail)):
            if agreed >= self.bpe.longest:
                self.data += tail[i:]
                self.last += old[i:]
                return
            self.data += tail[i:i + 1]
            self.bpe.extend(self.data, self.last)
            agreed = agreed + 1 if self.last[-1] == old[i] else 0

    def ids(self) -> list[int]:
        whole = self.bpe.ranks.get(self.data)
        return [whole] if whole is not None else self.bpe.read_off(self.last)


@functools.cache
def _worker(path: str, pattern: str):
    import regex

    return ByteBPE.load(path), regex.compile(pattern), {}


def groups(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts in order (null: empty), in groups of ``GROUP_CHARS`` characters at most or of one text."""
    group, chars = [], 0
    for text in texts:
        text = text or ""
        if group and chars + len(text) > GROUP_CHARS:
            yield group
            group, chars = [], 0
        group.append(text)
        chars += len(text)
    if group:
        yield group


def text_encoder(path: str, pattern: str):
    """texts -> bytes of the ids of each (little-endian unsigned 32-bit)."""
    bpe, split, seen = _worker(path, pattern)

    def encode(texts: list[str | None]) -> Iterator[bytes]:
        for group in groups(texts):
            pieces = [split.findall(t) for t in group]
            new = list(set().union(*pieces).difference(seen))
            ids = dict(zip(new, bpe.encode_many([p.encode() for p in new])))
            if len(seen) + len(new) <= STORED_PIECES:
                seen.update(ids)
                known = seen
            else:
                known = {p: seen[p] for found in pieces for p in found if p in seen} | ids
                seen.clear()
                seen.update(itertools.islice(known.items(), STORED_PIECES))
            for found in pieces:
                yield b"".join(map(known.__getitem__, found))

    return encode, bpe


def encoder(path: str, pattern: str):
    """text -> bytes of its ids."""
    encode, bpe = text_encoder(path, pattern)
    return lambda text: next(encode([text])), bpe


def encode_documents(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns of ``docs`` and ``ids_col`` (replaced if there): the ids as little-endian unsigned 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _ = text_encoder(path, pattern)
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col)).cast(pa.string())
            ids = list(encode(texts.to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary())], [*b.schema.names, ids_col])

    docs = docs.drop(ids_col)
    schema = docs.withColumn(ids_col, F.lit(None).cast("binary")).schema
    return docs.mapInArrow(run, schema)


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text, decode the ids again, and return the digests of both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bpe = text_encoder(path, pattern)
        for b in batches:
            count, coded, decoded = [], [], []
            for ids in encode(b.column(1).to_pylist()):
                count.append(len(ids) // 4)
                coded.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(np.frombuffer(ids, "<u4"))).hexdigest())
            yield batch(_DIGESTS, [b.column(0), count, coded, decoded])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
