"""Quality classifier: document evidence combined with site posteriors by hierarchical empirical Bayes.

Evidence: two sparse logistic regressions (toxic; low quality) over the
presence of words, of word beginnings and of shape bins (marks per word,
capitals, immediate repetitions, distinct words by length), trained on a
bounded sample of labelled rows (``MAX_LABELLED``, the first by digest of the
id).  A document's evidence is the log-odds that one of the two holds.

Sites: hosts and, below them, paths.  The evidence of all documents is summed
by path and host; beta priors are fitted by moments from the spread of the
hosts around the corpus rate and of the paths around their hosts, and each
site's rate is shrunk by them: host towards the corpus, path towards its
host, so sparse sites say little.  A document's final log-odds are its
evidence plus the log-odds of its path's posterior (without the document's
own part) over those of the corpus; it is rejected above ``REJECT``.

Defined results: null or empty texts have no words and get the base rate as
evidence; null host or path parts are sites of their own; labels that are
null do not count, and of repeated labels of one id the worst counts; without
labels the base rate is one in twenty; rows repeated under one id are judged
row by row; an empty table gives an empty result; other columns are kept by
``accepted`` and not read by ``judge``.

Scale: texts never move.  Sites are joined as a written table, broadcast up to
``BROADCAST_SITES`` and by a skew-splittable shuffle of narrow rows above.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm import words as wd
from clickweave.llm.common import batch, fresh_name, prepare, written

MAX_LABELLED = 16_000
#: Features of a model: at least MIN_ROWS rows of the sample, the MAX_FEATURES largest scores.
MIN_ROWS, MIN_SCORE, MAX_FEATURES = 5, 2.5, 20_000
COMMON = 0.2
L1, ROUNDS = 1e-4, 300
REJECT = 0.0
BROADCAST_SITES = 100_000
_SHAPES = 512
_U = np.uint64
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


# ---- features -----------------------------------------------------------------------------


def _hash_parts(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    inside = np.concatenate([[0], np.cumsum(length)])
    place = np.arange(inside[-1]) - np.repeat(inside[:-1], length)
    base = int(wd._constants(seed, 1)[0]) | 1
    power = np.cumprod(np.full(1 << 10, base, np.uint64))
    value = wd._constants(seed + 1, 256)[data[np.repeat(start, length) + place]] * power[place & 1023]
    return wd.mix(np.add.reduceat(value, inside[:-1]) + length.astype(np.uint64)) | _U(_SHAPES)


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice: first row, number of rows, and the features as (row within the slice, feature).

    Word features may repeat within a row.  Shape features are below _SHAPES."""
    for w in wd.slices(texts):
        start, end = w.start.copy(), w.end.copy()
        for _ in range(4):
            start[(end - start > 1) & _MARK[w.data[start]]] += 1
            end[(end - start > 1) & _MARK[w.data[end - 1]]] -= 1
        low = wd._LOWER[w.data]
        whole = _hash_parts(low, start, end - start, 31)
        head = _hash_parts(low, start, np.minimum(end - start, 5), 41)
        n = np.diff(w.offset)
        full = np.flatnonzero(n)
        rows, parts = [w.doc, w.doc], [whole, head]
        if len(full):
            n = n[full]
            first, last = w.start[w.offset[full]], w.end[w.offset[full] + n - 1]
            marks = np.concatenate([[0], np.cumsum(_MARK[w.data])])
            big = np.concatenate([[0], np.cumsum((w.data >= 65) & (w.data < 91))])
            again = np.concatenate([[0], (whole[1:] == whole[:-1]) & (w.doc[1:] == w.doc[:-1])]).cumsum()
            order = np.lexsort((whole, w.doc))
            fresh = np.concatenate([[True], (whole[order][1:] != whole[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])])
            distinct = np.add.reduceat(fresh.astype(np.int64), w.offset[full])
            a, b = w.offset[full], w.offset[full] + n - 1
            bins = [np.minimum(9, 4 * (marks[last] - marks[first]) // n),
                    16 + np.minimum(9, 10 * (big[last] - big[first]) // (last - first)),
                    32 + np.minimum(9, 10 * (again[b] - again[a]) // n),
                    48 + 10 * distinct // n + 16 * np.minimum(12, np.log2(n).astype(np.int64))]
            for x in bins:
                rows.append(full)
                parts.append(x.astype(np.uint64))
        yield w.first, w.n_docs, np.concatenate(rows), np.concatenate(parts)


# ---- the document model --------------------------------------------------------------------


@dataclass
class Model:
    """Weights of the two regressions over sorted features."""

    known: np.ndarray
    weight: np.ndarray   #: (2, features)
    base: np.ndarray     #: (2,)

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Log-odds per row that the text is toxic or of low quality."""
        out = np.zeros(len(texts))
        for first, n, rows, found in features(texts):
            score = np.repeat(self.base[:, None], n, 1)
            if len(self.known) and len(found):
                at = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
                hit = self.known[at] == found
                once = np.unique(rows[hit] * len(self.known) + at[hit])  # presence, not counts
                r, f = np.divmod(once, len(self.known))
                for m in range(2):
                    score[m] += np.bincount(r, self.weight[m][f], n)
            clean = -np.logaddexp(0, score).sum(0)  # log of P(neither)
            out[first:first + n] = np.log(-np.expm1(np.minimum(clean, -1e-12))) - clean
        return out


def fit_logistic(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, m: int) -> tuple[np.ndarray, float]:
    """Sparse logistic regression with an L1 penalty (accelerated proximal gradient steps) on 0/1 features."""
    n = len(y)
    x = np.random.default_rng(0).normal(size=m)
    for _ in range(15):  # largest eigenvalue, for the step
        x = np.bincount(cols, np.bincount(rows, x[cols], n)[rows] / n, m) / max(np.linalg.norm(x), 1e-12)
    step = 1 / (0.27 * np.linalg.norm(x) + 0.3)
    w = v = np.zeros(m)
    b = vb = np.log((y.sum() + 1) / (n - y.sum() + 19))
    t = 1.0
    for _ in range(ROUNDS):
        r = (1 / (1 + np.exp(-np.bincount(rows, v[cols], n) - vb)) - y) / n
        w_new = v - step * np.bincount(cols, r[rows], m)
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * L1, 0)
        b_new = vb - step * r.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return w, b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on at most ``max_labelled`` labelled documents."""
    prepare(docs.sparkSession)
    votes = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"), F.max(1 - F.col("quality").cast("int")).alias("low"))
    sample = votes.orderBy(F.md5(F.col("id").cast("string")), "id").limit(max_labelled).collect()
    wanted = np.array(sorted(r.id for r in sample), np.int64)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("feature", pa.list_(pa.int64()))])
        for b in batches:
            ids = np.asarray(b.column(0))
            pick = np.flatnonzero(np.isin(ids, wanted))
            for first, n, rows, found in features(b.column(1).take(pa.array(pick))):
                order = np.argsort(rows, kind="stable")
                cut = np.searchsorted(rows[order], np.arange(n + 1))
                found = found[order]
                yield batch(schema, [ids[pick[first:first + n]], [np.unique(found[i:j]).view(np.int64) for i, j in zip(cut[:-1], cut[1:], strict=True)]])

    base = np.array([np.log((sum(v == 1 for v in votes_) + 1) / (sum(v == 0 for v in votes_) + 19))
                     for votes_ in ([r.toxic for r in sample], [r.low for r in sample])])
    if not len(wanted):
        return Model(np.zeros(0, np.uint64), np.zeros((2, 0)), base)
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = written(rows.mapInArrow(sampled, "id long, feature array<long>"), "quality-sample")
    marks = docs.sparkSession.createDataFrame([(r.id, r.toxic, r.low) for r in sample], "id long, toxic int, low int")
    one = rows.join(F.broadcast(marks), "id").select("toxic", "low", F.explode("feature").alias("feature"))
    counts = one.groupBy("feature").agg(F.count("*").alias("n"), *[F.count_if(F.col(c) == v).alias(f"{c}{v}") for c in ("toxic", "low") for v in (0, 1)])
    counts = counts.filter(F.col("n") >= MIN_ROWS)
    totals = [(sum(getattr(r, c) == 0 for r in sample), sum(getattr(r, c) == 1 for r in sample)) for c in ("toxic", "low")]

    def score(c: str, good: int, bad: int) -> Column:
        x, y = F.col(f"{c}1") + 0.5, F.col(f"{c}0") + 0.5
        return F.abs((F.log(x / (bad + 1)) - F.log(y / (good + 1))) / F.sqrt(1 / x + 1 / y))

    shape = (F.col("feature") >= 0) & (F.col("feature") < _SHAPES)
    best = F.greatest(*[score(c, *t) for c, t in zip(("toxic", "low"), totals, strict=True)])
    chosen = counts.withColumn("s", F.when(shape, 1e9).otherwise(best)).filter(
        shape | ((F.col("s") >= MIN_SCORE) & (F.col("n") < COMMON * len(sample))))
    known = np.sort(np.array([r.feature for r in chosen.orderBy(F.desc("s"), "feature").limit(MAX_FEATURES).select("feature").collect()], np.int64).view(np.uint64))

    def selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("at", pa.binary())])
        for b in batches:
            flat, cut = np.asarray(b.column(1).flatten()).view(np.uint64), np.asarray(b.column(1).value_lengths()).cumsum()[:-1]
            hits = [np.flatnonzero(np.isin(known, f)) for f in np.split(flat, cut)] if b.num_rows else []
            yield batch(schema, [b.column(0), [h.astype(np.int32).tobytes() for h in hits]])

    # at most max_labelled rows of a document's selected features (repeated ids: each row counts)
    got = sorted((r.id, r.at) for r in rows.mapInArrow(selected, "id long, at binary").collect())
    of = {r.id: (r.toxic, r.low) for r in sample}
    weight = np.zeros((2, len(known)))
    for m in range(2):
        use = [(of[i][m], at) for i, at in got if of[i][m] is not None]
        y = np.array([v for v, _ in use], float)
        if len(known) and 0 < y.sum() < len(y):
            r = np.repeat(np.arange(len(use)), [len(at) // 4 for _, at in use])
            weight[m], base[m] = fit_logistic(r, np.frombuffer(b"".join(at for _, at in use), np.int32), y, len(known))
    used = np.abs(weight).sum(0) > 0
    return Model(known[used], weight[:, used], base)


def with_evidence(docs: DataFrame, model: Model, text_col: str, name: str) -> DataFrame:
    """All columns of ``docs`` and the evidence."""
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.evidence(texts))], [*b.schema.names, name])

    return docs.mapInArrow(run, schema)


# ---- sites ------------------------------------------------------------------------------------


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, rate: str, n: str, s: str) -> Column:
    """Prior strength by moments: spread of s / n around ``rate`` beyond what n draws give."""
    mean = F.sum(s) / F.sum(n)
    noise = F.sum(F.col(rate) * (1 - F.col(rate))) / F.sum(n)
    spread = F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - F.col(rate), 2)) / F.sum(n) - noise
    return F.least(F.greatest(mean * (1 - mean) / F.greatest(spread, F.lit(1e-9)) - 1, F.lit(1.0)), F.lit(1e6))


def site_posteriors(evidence: DataFrame, host: Column, path: Column, score: str) -> DataFrame:
    """One row per path: ``host, path, n, s, host_rate, k_path, corpus`` from the evidence of all documents."""
    p = 1 / (1 + F.exp(-F.col(score)))
    paths = written(evidence.groupBy(host.alias("host"), path.alias("path")).agg(F.count("*").alias("n"), F.sum(p).alias("s")), "site-paths")
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs")), "site-hosts")
    corpus = hosts.agg((F.sum("hs") / F.sum("hn")).alias("corpus"))
    hosts = hosts.join(F.broadcast(corpus))
    strength = hosts.agg(_strength(hosts, "corpus", "hn", "hs").alias("k"))
    hosts = hosts.join(F.broadcast(strength)).select("host", "corpus", ((F.col("hs") + F.col("k") * F.col("corpus")) / (F.col("hn") + F.col("k"))).alias("host_rate"))
    hosts = written(hosts, "site-hosts")
    sites = written(paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h"), "site-rates")
    k_path = sites.agg(_strength(sites, "host_rate", "n", "s").alias("k_path"))
    return written(sites.join(F.broadcast(k_path)), "site-posteriors")


def _joined(evidence: DataFrame, sites: DataFrame, host: Column, path: Column) -> DataFrame:
    few = sites.count() <= BROADCAST_SITES
    return evidence.join(F.broadcast(sites) if few else sites, host.eqNullSafe(sites["host"]) & path.eqNullSafe(sites["path"]))


def _final(score: str) -> tuple[Column, Column]:
    """Posterior of the path without the document's own part, and the final log-odds."""
    own = 1 / (1 + F.exp(-F.col(score)))
    site = (F.col("s") - own + F.col("k_path") * F.col("host_rate")) / (F.col("n") - 1 + F.col("k_path"))
    return site, F.col(score) + _logit(site) - _logit(F.col("corpus"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          path_col: str = "lang", reject: float = REJECT, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, evidence, host_posterior, path_posterior, bad_probability, kept``."""
    model = train(docs, labels, id_col, text_col, max_labelled)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(host_col).alias("h"), F.col(path_col).alias("p"))
    scored = written(with_evidence(narrow, model, "text", "evidence").drop("text"), "quality-evidence")
    sites = site_posteriors(scored, F.col("h"), F.col("p"), "evidence")
    site, final = _final("evidence")
    return _joined(scored, sites, scored["h"], scored["p"]).select(
        "doc_id", "evidence", F.col("host_rate").alias("host_posterior"), site.alias("path_posterior"),
        (1 / (1 + F.exp(-final))).alias("bad_probability"), (final <= reject).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
             path_col: str = "lang", reject: float = REJECT, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns.  Evidence is computed where the text
    lies, once for the sites and once for the decision, so no text is shuffled or stored."""
    model = train(docs, labels, id_col, text_col, max_labelled)
    score = fresh_name(docs, "evidence")
    scored = with_evidence(docs, model, text_col, score)
    sites = site_posteriors(scored.select(host_col, path_col, score), F.col(host_col), F.col(path_col), score)
    names = {c: fresh_name(docs, f"site_{c}") for c in sites.columns}
    renamed = sites.withColumnsRenamed(names)
    few = sites.count() <= BROADCAST_SITES
    out = scored.join(F.broadcast(renamed) if few else renamed, F.col(host_col).eqNullSafe(F.col(names["host"])) & F.col(path_col).eqNullSafe(F.col(names["path"])))
    own = 1 / (1 + F.exp(-F.col(score)))
    site = (F.col(names["s"]) - own + F.col(names["k_path"]) * F.col(names["host_rate"])) / (F.col(names["n"]) - 1 + F.col(names["k_path"]))
    return out.filter(F.col(score) + _logit(site) - _logit(F.col(names["corpus"])) <= reject).select(*[F.col(f"`{c}`") for c in docs.columns])
