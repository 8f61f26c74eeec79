"""Hard negatives by angular triangle filtering.

Every vector is scaled and floored to integers; a score is the integer inner
product.  ``REFERENCES`` rows, drawn by the hash of their id, are the
reference directions (a bounded sample; any directions give the same result,
only the share of rows that is skipped depends on them).  A row's angles to
them are stored.  For an anchor at angles p and a row at angles t, the angle
between the two lies between max |p - t| and min(p + t, 2 pi - p - t), so its
cosine lies in an interval and, times both norms, the score does.  The bounds
are widened by more than any rounding of the stored angles, and only rows
whose interval can matter get their integer score:

* positives (same label): rows whose upper bound reaches the k-th largest
  lower bound of the part;
* negatives (other labels): rows whose interval overlaps the window
  ``low * positive <= 100 * score <= high * positive`` of one of the anchor's
  positives.

Rows lie in parts of about ``PART_VALUES`` components (positives: parts of
one label, so a label with a third of all rows is split); every anchor visits
every part it may concern, and only its best few of a part leave the task.

Defined results: rows with a null id, a null label, a null or empty vector or
any null or non-finite component take no part, nor do rows whose scaled
components overflow a double; a vector that floors to zero takes part with
score 0; rows repeated under one id count once (the smallest vector, then the
smallest label); vectors of different lengths are never compared; ties go to
the smaller id; fewer rows than asked for are all returned, an anchor without
positives or a positive without negatives gives no row; scores beyond the
range of long are returned at its ends; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickweave.llm.common import batch, prepare, written

POSITIVES = 5
NEGATIVES = 3
#: The window in hundredths of the positive's score.
LOW, HIGH = 50, 95
SCALE = 256
REFERENCES = 32
#: Vector components held at once by a task, and the least rows of a full part.
PART_VALUES = 1 << 19
LEAST_ROWS = 64
#: More than all rounding of an angle: float32 storage, and arccos next to 0 and pi.
SLACK = 4e-6
#: Inner products below this are exact in double precision.
EXACT = float(1 << 52)
_LONG = (1 << 63) - 1


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows, without overflow on the way."""
    top = np.abs(x).max(axis=1)
    with np.errstate(all="ignore"):
        return np.where(top > 0, top * np.linalg.norm(x / np.where(top > 0, top, 1)[:, None], axis=1), 0.0)


def angles(x: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of the rows to the reference directions (0 for a zero row)."""
    unit = lambda m: m / np.where((s := np.abs(m).max(axis=1)) > 0, s, 1)[:, None]
    x, references = unit(x), unit(references)
    length = np.linalg.norm(x, axis=1)
    cosine = x @ (references / np.linalg.norm(references, axis=1, keepdims=True)).T / np.where(length > 0, length, 1)[:, None]
    return np.where((length > 0)[:, None], np.arccos(np.clip(cosine, -1, 1)), 0).astype(np.float32)


def score_bounds(theta: np.ndarray, norm: np.ndarray, t: np.ndarray, n: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible score of each row (angles ``theta``, length ``norm``) with an anchor (t, n)."""
    if theta.shape[1]:
        total = theta + t
        near = np.abs(theta - t).max(axis=1).astype(np.float64) - SLACK
        far = np.minimum(total, np.float32(2 * np.pi) - total).min(axis=1).astype(np.float64) + SLACK
    else:
        near, far = np.zeros(len(norm)), np.full(len(norm), np.pi)
    with np.errstate(all="ignore"):
        product = norm * n
        least = product * np.cos(np.clip(far, 0, np.pi))
        most = product * np.cos(np.clip(near, 0, np.pi))
        room = 1 + 1e-9 * product
        open_ended = ~(product < EXACT)
    return np.where(open_ended, -np.inf, np.floor(least - room)), np.where(open_ended, np.inf, np.ceil(most + room))


def integer_scores(rows: np.ndarray, norm: np.ndarray, q: np.ndarray, n: float) -> np.ndarray:
    """Exact inner products of integer-valued rows with q: int64, or Python integers where doubles would round."""
    with np.errstate(all="ignore"):
        fits = bool((norm * n < EXACT).all())
    if fits:
        return (rows @ q).astype(np.int64)
    whole = [int(v) for v in q]
    exact = np.empty(len(rows), object)
    exact[:] = [sum(int(a) * b for a, b in zip(r, whole, strict=True)) for r in rows]
    return exact


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best (larger score, then smaller id)."""
    if len(scores) > k and scores.dtype != object:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], int)


def _long(values: np.ndarray) -> list[int]:
    return [max(-_LONG - 1, min(_LONG, int(v))) for v in values]


_MEASURED = "id long, size int, label string, vec binary, angles binary, norm double"


def _measure(references: dict[int, np.ndarray]):
    schema = pa.schema([("id", pa.int64()), ("size", pa.int32()), ("label", pa.string()), ("vec", pa.binary()),
                        ("angles", pa.binary()), ("norm", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels = np.asarray(b.column(0)), b.column(2).to_pylist()
            lengths = np.asarray(b.column(1).value_lengths())
            flat, at = np.asarray(b.column(1).flatten(), np.float64), np.concatenate([[0], np.cumsum(lengths)])
            for n in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == n)
                x = flat[at[rows][:, None] + np.arange(n)]
                theta = angles(x, references[n]) if n in references else np.zeros((len(x), 0), np.float32)
                yield batch(schema, [ids[rows], [n] * len(rows), [labels[i] for i in rows], [v.tobytes() for v in x],
                                     [t.tobytes() for t in theta], norms(x)])
    return run


class _Part:
    """The rows of one part, as matrices."""

    def __init__(self, rows: list[tuple]):
        self.ids = np.array([r[0] for r in rows])
        self.labels = np.array([r[1] for r in rows], object)
        self.x = np.frombuffer(b"".join(r[2] for r in rows), np.float64).reshape(len(rows), -1)
        self.theta = np.frombuffer(b"".join(r[3] for r in rows), np.float32).reshape(len(rows), -1)
        self.norm = np.array([r[4] for r in rows])

    def scores(self, pick: np.ndarray, q: np.ndarray, n: float) -> np.ndarray:
        return integer_scores(self.x[pick], self.norm[pick], q, n)


def _positives(k: int):
    def visit(part: _Part, name: int, label: str, q: np.ndarray, t: np.ndarray, n: float, _) -> list[tuple]:
        least, most = score_bounds(part.theta, part.norm, t, n)
        other = part.ids != name
        if other.sum() > k:
            floor = np.partition(least[other], -k)[-k]
            other &= most >= floor
        pick = np.flatnonzero(other)
        scores = part.scores(pick, q, n)
        best = _first(scores, part.ids[pick], k)
        return [(name, 0, i, 0, s, len(pick)) for i, s in zip(part.ids[pick][best].tolist(), _long(scores[best]), strict=True)]
    return visit


def _negatives(k: int, low: int, high: int):
    def visit(part: _Part, name: int, label: str, q: np.ndarray, t: np.ndarray, n: float, positives: list) -> list[tuple]:
        least, most = score_bounds(part.theta, part.norm, t, n)
        met = np.zeros(len(part.ids), bool)
        for p in positives:
            if p["score"] >= 0:  # below zero the window is empty
                met |= (100 * most >= low * p["score"]) & (100 * least <= high * p["score"])
        pick = np.flatnonzero(met & (part.labels != label))
        scores, ids, out = part.scores(pick, q, n), part.ids[pick], []
        for p in positives:
            inside = np.flatnonzero((low * p["score"] <= 100 * scores) & (100 * scores <= high * p["score"]))
            best = inside[_first(scores[inside], ids[inside], k)]
            out += [(name, p["id"], i, p["score"], s, len(pick)) for i, s in zip(ids[best].tolist(), _long(scores[best]), strict=True)]
        return out
    return visit


_FOUND = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("id", pa.int64()), ("positive_score", pa.int64()),
                    ("score", pa.int64()), ("scored", pa.int64())])


def _visit(visit):
    """Rows (part columns, ask, id, label, vec, angles, norm, positives) ordered by part: its rows, then its anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, part = None, [], None
        for b in batches:
            out = []
            for *place, ask, name, label, vec, theta, norm, positives in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if place != current:
                    current, held, part = place, [], None
                if not ask:
                    held.append((name, label, vec, theta, norm))
                elif held:
                    part = part or _Part(held)
                    out += visit(part, name, label, np.frombuffer(vec, np.float64), np.frombuffer(theta, np.float32), norm, positives)
            if out:
                yield batch(_FOUND, [list(c) for c in zip(*out, strict=True)])
    return run


def _search(rows: DataFrame, asks: DataFrame, group: list[str], visit) -> DataFrame:
    """What ``visit`` finds for each anchor in every part of its group."""
    sizes = rows.groupBy(*group).agg(F.count("*").alias("rows"))
    held = F.greatest(F.lit(LEAST_ROWS), F.floor(F.lit(PART_VALUES) / F.col("size")))
    sizes = written(sizes.select(*group, F.ceil(F.col("rows") / held).cast("long").alias("parts")), "negatives-parts")
    data = rows.join(sizes, group).select(
        *group, F.expr("pmod(xxhash64(id), parts)").alias("part"), F.lit(0).alias("ask"),
        "id", F.col("label").alias("lab"), "vec", "angles", "norm", F.expr("cast(null as array<struct<score: long, id: long>>)").alias("positives"))
    asked = asks.join(sizes, group).select(
        *group, F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), F.lit(1).alias("ask"),
        "id", F.col("label").alias("lab"), "vec", "angles", "norm", "positives")
    place = [*group, "part"]
    met = data.unionByName(asked).repartition(*place).sortWithinPartitions(*place, "ask")
    return met.mapInArrow(_visit(visit), "anchor_id long, positive_id long, id long, positive_score long, score long, scored long")


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, references: int = REFERENCES, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor``: a condition on the id column; ``label``: an expression to take for the label column.
    """
    prepare(vectors.sparkSession)
    label = F.col(label_col) if label is None else label
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                          label.cast("string").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    usable = lambda c: F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)).filter(usable("v"))
    # floors stay doubles: they are whole numbers, and no range is lost (Spark's floor gives long)
    scaled = F.transform("v", lambda x: F.when(F.abs(x * SCALE) < 2.0 ** 52, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE))
    rows = rows.withColumn("v", scaled).filter(usable("v"))
    rows = rows.groupBy("id").agg(F.min(F.struct("v", "label")).alias("r"), F.max("anchor").alias("anchor"))
    rows = written(rows.select("id", "r.v", "r.label", "anchor"), "negatives-rows")
    drawn = rows.filter(F.exists("v", lambda x: x != 0)).orderBy(F.xxhash64("id"), "id").limit(references).select("v").collect()
    directions: dict[int, list] = {}
    for r in drawn:
        directions.setdefault(len(r.v), []).append(r.v)
    measure = _measure({n: np.array(v, np.float64) for n, v in directions.items()})
    measured = written(rows.select("id", "v", "label").mapInArrow(measure, _MEASURED)
                       .join(rows.filter("anchor").select("id", "anchor"), "id", "left"), "negatives-measured")

    anchors = measured.filter("anchor").withColumn("positives", F.expr("cast(null as array<struct<score: long, id: long>>)"))
    found = _search(measured, anchors, ["size", "label"], _positives(positives))
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= positives)
    chosen = written(found.groupBy("anchor_id").agg(F.collect_list(F.struct("score", "id")).alias("positives")), "negatives-positives")

    asks = anchors.drop("positives").join(chosen.withColumnRenamed("anchor_id", "id"), "id")
    found = _search(measured, asks, ["size"], _negatives(negatives, low, high))
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


#: Brute force over all pairs of anchors and rows.
ORACLE_SQL = """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select a.vec_id as a, b.vec_id as b, a.label = b.label as same,
         cast(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) as bigint) as score
  from r a join r b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
p as (select a, b, score from s where same qualify row_number() over (partition by a order by score desc, b) <= 5),
n as (
  select p.a, p.b as p, s.b as n, p.score as ps, s.score as ns,
         row_number() over (partition by p.a, p.b order by s.score desc, s.b) as rank
  from p join s on s.a = p.a and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
select a as anchor_id, p as positive_id, cast(rank as int) as rank, n as negative_id, ps as positive_score, ns as negative_score
from n where rank <= 3
"""
