"""Nearest neighbours by cross-polytope hashing.

Each of ``TABLES`` tables turns a unit vector by a pseudo-rotation (three
rounds of random signs and a fast Hadamard transform) and assigns it to the
nearest signed axis.  A query looks into the cells of its ``PROBES`` nearest
signed axes in every table; all vectors of these cells are candidates and are
ranked by their exact inner product on the original vectors.

Largest inner product: where norms differ, vectors get one more coordinate
that brings them all to the largest norm, so that direction alone decides
(queries get zero there).  Cells above ``CELL_ROWS`` vectors are split into
parts, each of which every query of the cell visits, so no cell meets in one
task and no candidate is lost.  Only the best k of a query and part leave the
task.  A query that found fewer than k of the vectors there are is answered
again from all rows, in blocks.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components, and rows with a null id, take no part; rows repeated
under one id count once (the smallest vector); vectors of different lengths
are never compared; ties go to the smaller id; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickweave.llm.common import batch, prepare, written

K = 20
TABLES = 16
PROBES = 8
CELL_ROWS = 4096
SEED = 20240229


@functools.cache
def _signs(size: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).choice([-1.0, 1.0], size=(tables, 3, size))


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of sign flips and Hadamard transforms of the rows of x (a power of two long)."""
    n, size = x.shape
    for s in signs:
        x, h = x * s, 1
        while h < size:
            y = x.reshape(n, -1, 2, h)
            x, h = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, size), 2 * h
    return x / size ** 1.5


def directions(x: np.ndarray, largest: float, as_query: bool) -> np.ndarray:
    """Unit vectors whose inner products order like those of the originals, padded to a power of two.

    ``largest``: the largest norm where norms differ, 0 where all are alike."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    if not largest:
        y = x / norm
    elif as_query:
        y = np.hstack([x / norm, np.zeros((len(x), 1))])
    else:
        y = np.hstack([x / largest, np.sqrt(np.maximum(0, 1 - (norm / largest) ** 2))])
    size = 1 << max(0, y.shape[1] - 1).bit_length()
    return np.pad(y, ((0, 0), (0, size - y.shape[1])))


def nearest_axes(y: np.ndarray, probes: int) -> np.ndarray:
    """The nearest signed axes of each row, nearest first (axis a: 2a for its plus side, 2a + 1 for its minus side)."""
    both = np.stack([y, -y], axis=2).reshape(len(y), -1)
    probes = min(probes, both.shape[1])
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _matrices(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each vector length of a batch."""
    lengths = np.asarray(vectors.value_lengths())
    flat, at = np.asarray(vectors.flatten(), np.float64), np.concatenate([[0], np.cumsum(lengths)])
    names = np.asarray(ids)
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        yield names[rows], flat[at[rows][:, None] + np.arange(n)]


_CELLS = pa.schema([("cell", pa.string()), ("id", pa.int64()), ("vec", pa.binary())])


def _assign(tables: int, probes: int, largest: dict[int, float], as_query: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, x in _matrices(b.column(0), b.column(1)):
                n = x.shape[1]
                y = directions(x, largest.get(n, 0.0), as_query)
                raw = [v.tobytes() for v in x]
                for t, signs in enumerate(_signs(y.shape[1], tables)):
                    axes = nearest_axes(rotate(y, signs), probes if as_query else 1)
                    for column in axes.T:
                        yield batch(_CELLS, [[f"{n}/{t}/{a}" for a in column.tolist()], ids, raw])
    return run


def _all_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for ids, x in _matrices(b.column(0), b.column(1)):
            yield batch(_CELLS, [[f"{x.shape[1]}/all"] * len(ids), ids, [v.tobytes() for v in x]])


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _rank(k: int):
    """Rows (cell, part, is_query, id, vec) ordered by the first three: vectors of a part, then its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, ids, data = None, [], None, None
        for b in batches:
            cells, parts, asked, names, vecs = (c.to_pylist() for c in b.columns)
            out = []
            for cell, part, ask, name, vec in zip(cells, parts, asked, names, vecs, strict=True):
                if (cell, part) != current:
                    current, held, data = (cell, part), [], None
                if not ask:
                    held.append((name, vec))
                    continue
                if not held:
                    continue
                if data is None:
                    ids = np.array([i for i, _ in held])
                    data = np.frombuffer(b"".join(v for _, v in held), np.float64).reshape(len(held), -1)
                q = np.frombuffer(vec, np.float64)
                rough = data @ q
                rough[ids == name] = -np.inf
                if len(rough) > k:
                    edge = np.partition(rough, len(rough) - k)[len(rough) - k]
                    pick = np.flatnonzero(rough >= edge - 1e-9 * (1 + abs(edge)))
                else:
                    pick = np.arange(len(rough))
                pick = pick[ids[pick] != name]
                exact = (data[pick] * q).sum(axis=1)
                best = np.lexsort((ids[pick], -exact))[:k]
                out.append((np.full(len(best), name), ids[pick][best], exact[best]))
            if out:
                yield batch(_FOUND, [np.concatenate(x) for x in zip(*out, strict=True)])
    return run


def _search(data: DataFrame, queries: DataFrame, k: int, cell_rows: int) -> DataFrame:
    """The best k of each query in each part it visits."""
    sizes = data.groupBy("cell").agg(F.count("*").alias("c")).filter(F.col("c") > cell_rows)
    split = written(sizes.select("cell", F.ceil(F.col("c") / cell_rows).alias("parts")), "ann-split")  # at most rows / cell_rows
    data = data.join(F.broadcast(split), "cell", "left").select(
        "cell", F.expr("pmod(xxhash64(id), coalesce(parts, 1L))").alias("part"), F.lit(0).alias("ask"), "id", "vec")
    queries = queries.join(F.broadcast(split), "cell", "left").select(
        "cell", F.explode(F.expr("sequence(0L, coalesce(parts, 1L) - 1)")).alias("part"), F.lit(1).alias("ask"), "id", "vec")
    rows = data.unionByName(queries).repartition("cell", "part").sortWithinPartitions("cell", "part", "ask")
    return rows.mapInArrow(_rank(k), "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
            tables: int = TABLES, probes: int = PROBES, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``.  ``is_query``: a condition on ``vec_id`` (a Column)."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0)).filter(whole).filter(square > 0)
    rows = written(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "ann-vectors")
    norms = rows.groupBy(F.size("v").alias("n")).agg(F.max(F.sqrt(square)).alias("hi"), F.min(F.sqrt(square)).alias("lo")).collect()
    largest = {r.n: r.hi if r.hi - r.lo > 1e-5 * r.hi else 0.0 for r in norms}  # one row per vector length

    asked = rows.filter(is_query)
    cells = "cell string, id long, vec binary"
    found = _search(rows.mapInArrow(_assign(tables, 1, largest, False), cells),
                    asked.mapInArrow(_assign(tables, probes, largest, True), cells), k, cell_rows)
    found = written(found.distinct(), "ann-found")
    # queries that met fewer than k vectors although there are more
    there = rows.groupBy(F.size("v").alias("n")).agg((F.count("*") - 1).alias("others"))
    met = found.groupBy("query_id").agg(F.count("*").alias("met"))
    short = asked.withColumn("n", F.size("v")).join(F.broadcast(there), "n").join(met, F.col("vec_id") == F.col("query_id"), "left")
    short = written(short.filter(F.coalesce("met", F.lit(0)) < F.least(F.lit(k), F.col("others"))).select("vec_id", "v"), "ann-short")
    if not short.isEmpty():
        found = found.unionByName(_search(rows.mapInArrow(_all_rows, cells), short.mapInArrow(_all_rows, cells), k, cell_rows)).distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
