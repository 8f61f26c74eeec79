"""Removal of repeated word windows with a count-min prefilter.

A window is ``WINDOW`` consecutive words of one document.  Three passes read
the texts:

1.  Every task counts its windows in a partial count-min sketch (``ROWS``
    rows, counters that stop at two) and sends the touched counters of each
    segment as coded gaps; merged, they tell for each column whether at least
    two windows fell on it.  The merged sketch never underestimates, so a
    window that occurs twice has all its columns marked.
2.  Only windows with all columns marked are grouped exactly, by a 96-bit
    hash.  Windows that a task has seen twice are sent once, marked as
    repeated, so frequent windows are aggregated before the shuffle.  The
    exact pass returns the windows that turn out to occur once: each has one
    place, so no group is hot.
3.  Each document takes its marked windows less the places found to be
    unique; every word covered by a remaining window goes.

The sketch has about half as many columns per row as the input has bytes
(three per window), up to ``MAX_COLUMNS``; it lies as a table in the shared
folder and each Python worker reads it once: ROWS * MAX_COLUMNS / 8 bytes at
most.  Beyond that size it filters less and loses nothing.

Defined results: null and empty texts have no words (digest of the empty
string); texts shorter than a window keep all words; rows repeated under one
id are separate documents that repeat each other; a null id is a document
like others; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import words as wd
from clickweave.llm.common import batch, prepare, written
from clickweave.session import scratch_path

WINDOW = 35
ROWS = 2
MAX_COLUMNS = 1 << 30
SEGMENT_BITS = 20
#: Windows that a task gathers before it sends them on.
FLUSH = 2_000_000
#: Marked windows of one group of the exact pass, about.
GROUP_WINDOWS = 400_000

_U = np.uint64
_MANY = 0xFFFFFFFF
_SKETCH: dict[str, list[np.ndarray]] = {}


def _hashed(w: wd.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place (word number), 64-bit and 32-bit hash of each window of a slice."""
    at = wd.window_starts(w, k)
    if not len(at):
        return at, np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    return at, wd.windows(w.hashes(21), k, 23)[at], (wd.windows(w.hashes(25), k, 27)[at] >> _U(32)).astype(np.uint32)


def _column(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (wd.mix(h ^ _U((row + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> _U(64 - bits)).astype(np.int64)


# ---- first pass: partial sketches -----------------------------------------------------------


def code_gaps(sorted_values: np.ndarray) -> bytes:
    """Ascending integers as gaps of one byte, 255 meaning that more follows."""
    gaps = np.diff(sorted_values, prepend=0)
    more, rest = np.divmod(gaps, 255)
    out = np.full(int(more.sum()) + len(gaps), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = rest
    return out.tobytes()


def read_gaps(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    return np.cumsum(a, dtype=np.int64)[a != 255]


_PARTIAL = pa.schema([("segment", pa.int32()), ("touched", pa.binary())])


def _partial_sketch(k: int, bits: int, flush: int):
    width = min(bits, SEGMENT_BITS)

    def send(columns: np.ndarray, row: int) -> pa.RecordBatch:
        c = np.sort(columns)
        c = c[np.concatenate([[True] * min(2, len(c)), c[2:] != c[:-2]])]  # a column counts twice at most
        border = np.searchsorted(c, np.arange((1 << (bits - width)) + 1) << width)
        full = np.flatnonzero(np.diff(border))
        inside = c & ((1 << width) - 1)
        blobs = [code_gaps(inside[border[s]:border[s + 1]]) for s in full.tolist()]
        return batch(_PARTIAL, [(full + (row << (bits - width))).astype(np.int32), blobs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for w in wd.slices(b.column(0)):
                at = wd.window_starts(w, k)
                if len(at):
                    held.append(wd.windows(w.hashes(21), k, 23)[at])
                    n += len(at)
            if n >= flush:
                h, held, n = np.concatenate(held), [], 0
                for row in range(ROWS):
                    yield send(_column(h, row, bits), row)
        if held:
            h = np.concatenate(held)
            for row in range(ROWS):
                yield send(_column(h, row, bits), row)
    return run


def _merge_segments(width: int):
    """Rows (segment, touched) in order of segment -> (segment, marks)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("segment", pa.int32()), ("marks", pa.binary())])
        current, counts = None, None

        def done():
            return batch(schema, [[current], [np.packbits(counts >= 2).tobytes()]])

        for b in batches:
            segments, blobs = b.column(0).to_numpy(), b.column(1).to_pylist()
            border = [0, *(np.flatnonzero(np.diff(segments)) + 1).tolist(), len(segments)]
            for i, j in zip(border[:-1], border[1:], strict=True):
                if i == j:
                    continue
                if segments[i] != current:
                    if current is not None:
                        yield done()
                    current, counts = int(segments[i]), np.zeros(1 << width, np.int64)
                counts += np.bincount(np.concatenate([read_gaps(x) for x in blobs[i:j]]), minlength=1 << width)
        if current is not None:
            yield done()
    return run


def _load_sketch(path: str, bits: int) -> list[np.ndarray]:
    """The marks of each row, read once per worker."""
    if path not in _SKETCH:
        _SKETCH.clear()
        width = min(bits, SEGMENT_BITS)
        size, per_row = (1 << width) // 8 or 1, 1 << (bits - width)
        rows = [np.zeros(per_row * size, np.uint8) for _ in range(ROWS)]
        system, where = fs.FileSystem.from_uri(path)
        for b in ds.dataset(where, filesystem=system, format="parquet").to_batches(batch_size=256):
            for s, marks in zip(b.column("segment").to_pylist(), b.column("marks"), strict=True):
                row, s = divmod(s, per_row)
                rows[row][s * size:(s + 1) * size] = np.frombuffer(marks.as_buffer(), np.uint8)
        _SKETCH[path] = rows
    return _SKETCH[path]


def marked(sketch: list[np.ndarray], h: np.ndarray, bits: int) -> np.ndarray:
    """Whether the sketch estimates two windows or more."""
    out = np.ones(len(h), bool)
    for row, marks in enumerate(sketch):
        c = _column(h, row, bits)
        out &= (marks[c >> 3] >> (7 - (c & 7)).astype(np.uint8) & 1).astype(bool)
    return out


# ---- second pass: exact grouping of marked windows -----------------------------------------


_SENT = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("entries", pa.binary())])
_PLACE = pa.schema([("key", pa.int64()), ("pos", pa.int32())])


def _pack(h: np.ndarray, g: np.ndarray, key: np.ndarray, pos: np.ndarray) -> bytes:
    small = len(key) and key.min() >= 0 and key.max() < 1 << 32
    short = len(pos) and pos[pos != _MANY].max(initial=0) < 0xFFFF
    head = bytes([bool(small), bool(short)])
    return head + h.tobytes() + g.tobytes() + (key.astype(np.uint32) if small else key).tobytes() + (
        np.minimum(pos, 0xFFFF).astype(np.uint16) if short else pos).tobytes()


def _unpack(n: int, data: bytes) -> list[np.ndarray]:
    at, out = 2, []
    for kind in (np.uint64, np.uint32, np.uint32 if data[0] else np.int64, np.uint16 if data[1] else np.uint32):
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(data[at:at + size], kind))
        at += size
    out[2] = out[2].astype(np.int64)
    pos = out[3].astype(np.uint32)
    if data[1]:
        pos[pos == 0xFFFF] = _MANY
    out[3] = pos
    return out


def _fold(h, g, key, pos):
    """Sort by hash; windows that occur more than once, or are known to, become one entry marked _MANY."""
    order = np.lexsort((g, h))
    h, g, key, pos = h[order], g[order], key[order], pos[order]
    if not len(h):
        return h, g, key, pos
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
    first = np.flatnonzero(new)
    many = (np.diff(np.append(first, len(h))) > 1) | np.logical_or.reduceat(pos == _MANY, first)
    h, g, key, pos = h[first], g[first], key[first], pos[first].copy()
    pos[many] = _MANY
    return h, g, np.where(many, 0, key), pos


def _send_marked(path: str, k: int, bits: int, parts_bits: int, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, held, n = _load_sketch(path, bits), [], 0

        def send():
            h, g, key, pos = _fold(*(np.concatenate(x) for x in zip(*held, strict=True)))
            part = (h >> _U(64 - parts_bits)).astype(np.int64) if parts_bits else np.zeros(len(h), np.int64)
            border = np.searchsorted(part, np.arange((1 << parts_bits) + 1))
            full = np.flatnonzero(np.diff(border)).tolist()
            cut = [slice(border[p], border[p + 1]) for p in full]
            return batch(_SENT, [full, [c.stop - c.start for c in cut], [_pack(h[c], g[c], key[c], pos[c]) for c in cut]])

        for b in batches:
            keys = b.column(0).to_numpy()
            for w in wd.slices(b.column(1)):
                at, h, g = _hashed(w, k)
                hit = marked(sketch, h, bits)
                if hit.any():
                    doc = w.doc[at[hit]]
                    held.append((h[hit], g[hit], keys[w.first + doc], (at[hit] - w.offset[doc]).astype(np.uint32)))
                    n += len(doc)
            if n >= flush // 4:
                yield send()
                held, n = [], 0
        if held:
            yield send()
    return run


def _unique_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, n, entries) in order of part -> places of windows that occur once."""
    current, held, n = None, [], 0

    def fold():
        return _fold(*(np.concatenate(x) for x in zip(*held, strict=True)))

    def done():
        _, _, key, pos = fold()
        once = pos != _MANY
        return batch(_PLACE, [key[once], pos[once].astype(np.int32)])

    for b in batches:
        for part, m, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if part != current:
                if held:
                    yield done()
                current, held, n = part, [], 0
            held.append(_unpack(m, data))
            n += m
            if n > 8 * GROUP_WINDOWS:
                held = [fold()]
                n = -len(held[0][0])
    if held:
        yield done()


# ---- third pass --------------------------------------------------------------------------------


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def _remove(path: str, k: int, bits: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = _load_sketch(path, bits)
        for b in batches:
            ids, once = b.column(0), b.column(2).to_pylist()
            for w in wd.slices(b.column(1)):
                at = wd.window_starts(w, k)
                hit = np.zeros(len(w.start) + 1, np.int64)
                if len(at):
                    h = wd.windows(w.hashes(21), k, 23)[at]
                    hit[at[marked(sketch, h, bits)]] = 1
                for d in range(w.n_docs):
                    if once[w.first + d]:
                        hit[w.offset[d] + np.array(once[w.first + d], np.int64)] = 0
                steps = hit.copy()
                np.subtract.at(steps, np.minimum(np.flatnonzero(hit) + k, len(hit) - 1), 1)
                gone = np.cumsum(steps)[:-1] > 0
                words, n = w.strings(), np.diff(w.offset)
                removed, digests, texts = [], [], []
                for i, j in zip(w.offset[:-1].tolist(), w.offset[1:].tolist(), strict=True):
                    out = gone[i:j]
                    removed.append(int(out.sum()))
                    left = words[i:j] if not removed[-1] else [words[i + x] for x in np.flatnonzero(~out).tolist()]
                    kept = b" ".join(left)
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept.decode() if with_text else None)
                yield batch(_RESULT, [ids.slice(w.first, w.n_docs), n, removed, digests, texts])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   with_text: bool = False, max_columns: int = MAX_COLUMNS, flush: int = FLUSH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``kept``, the text left, if asked for)."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # documents are named by their id where ids are there and distinct, else by a hash of id, text and row
    odd = rows.groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1 OR doc_id IS NULL")
    key = F.col("doc_id") if odd.isEmpty() else F.xxhash64("doc_id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(size // 2, 1 << 10), max_columns).bit_length()
    bits = bits - 1 if 1 << (bits - 1) >= max_columns else bits
    width = min(bits, SEGMENT_BITS)

    partial = rows.select("text").mapInArrow(_partial_sketch(window, bits, flush), "segment int, touched binary")
    merged = partial.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge_segments(width), "segment int, marks binary")
    path = scratch_path(spark, "window-sketch")
    merged.write.parquet(path)

    keyed = rows.select(key.alias("key"), "doc_id", "text")
    parts_bits = max(0, int(size // 12 // GROUP_WINDOWS).bit_length())
    sent = keyed.select("key", "text").mapInArrow(_send_marked(path, window, bits, parts_bits, flush), "part int, n int, entries binary")
    places = sent.repartition("part").sortWithinPartitions("part").mapInArrow(_unique_places, "key long, pos int")
    once = written(places.groupBy("key").agg(F.collect_list("pos").alias("once")), "window-once")
    joined = keyed.join(once, "key", "left").select("doc_id", "text", "once")
    out = joined.mapInArrow(_remove(path, window, bits, with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out if with_text else out.drop("kept")


ORACLE_SQL = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW} + 2)) AS i FROM w WHERE len(ws) >= {WINDOW}
), found AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS c FROM starts
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM found WHERE c > 1) GROUP BY doc_id
), places AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
  SELECT places.doc_id, string_agg(word, ' ' ORDER BY places.p) AS t
  FROM places ANTI JOIN (SELECT doc_id, unnest(ps) AS p FROM gone) g ON g.doc_id = places.doc_id AND g.p = places.p GROUP BY places.doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
